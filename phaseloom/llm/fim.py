"""Fill-in-the-middle transformation over relational units."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A unit: a word with the white space before it, or white space at the end. Possessive, so runs of white space are read once.
UNIT = "[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++|[\\x20\\x09-\\x0D]++"


@dataclass(frozen=True)
class Fim:
    """Markers of prefix, suffix and middle; percent of the texts that are transformed, and percent of these in the form spm."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    percent: int = 50
    spm_percent: int = 80
    seed: int = 42


def units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def _draw(seed: int, doc_id: Column, k: int) -> Column:
    """The k-th 8-digit group (from 0) of the sha256 of seed:doc_id, as a number."""
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(told, 8 * k + 1, 8), 16, 10).cast("long")


def _wanted(docs: DataFrame, fim: Fim) -> DataFrame:
    """doc_id, text, n (its units) and form of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marked = F.lit(False)
    for marker in (fim.prefix, fim.suffix, fim.middle):
        marked = marked | F.contains("text", F.lit(marker))
    plain = (F.col("text") == "") | marked | (_draw(fim.seed, F.col("doc_id"), 2) % 100 >= fim.percent)
    form = F.when(plain, "plain").when(_draw(fim.seed, F.col("doc_id"), 3) % 100 < fim.spm_percent, "spm").otherwise("psm")
    return rows.select("doc_id", "text", F.size(units(F.col("text"))).cast("long").alias("n"), form.alias("form"))


def _keyed(wanted: DataFrame, fim: Fim) -> DataFrame:
    """The rows to cut, spread by 128 bits of their id and text, with the units before each cut (first <= second)."""
    at = [_draw(fim.seed, F.col("doc_id"), k) % (F.col("n") + 1) for k in (0, 1)]
    rows = wanted.where("form <> 'plain'").select(
        F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(fim.seed), "text", "doc_id").alias("k2"), "doc_id", "text", "n", "form", F.least(*at).alias("first"), F.greatest(*at).alias("second")
    )
    return rows.repartition("k1", "k2")


def _offsets(keyed: DataFrame) -> DataFrame:
    """k1, k2 and the code points before the first and the second cut, one row a key.

    Units up to the second cut are exploded with their ordinals, and a window adds up their lengths. Rows of one id
    and text have one key and the same units; a unit's copies are counted and divided out. Requests meet the units
    at the ordinals of the last units before the cuts.
    """
    key = ["k1", "k2"]
    lengths = F.transform(F.slice(units(F.col("text")), F.lit(1), F.col("second").cast("int")), F.length)
    exploded = keyed.select(*key, F.posexplode(lengths).alias("ordinal", "length"))
    upto = Window.partitionBy(*key).orderBy("ordinal").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = exploded.select(*key, "ordinal", F.sum("length").over(upto).alias("sum"), F.count(F.lit(1)).over(upto).alias("seen"))
    placed = summed.select(*key, (F.col("ordinal") + 1).cast("long").alias("done"), F.expr("sum div (seen div (ordinal + 1))").alias("chars"))
    requests = keyed.select(*key, "first", "second")
    met = placed.join(requests, [*key]).where((F.col("done") == F.col("first")) | (F.col("done") == F.col("second")))
    return met.groupBy(*key).agg(*[F.max(F.when(F.col("done") == F.col(c), F.col("chars"))).alias(f"{c}_chars") for c in ("first", "second")])


def transformed(docs: DataFrame, fim: Fim = Fim()) -> DataFrame:
    """One row per row of docs: doc_id, n, form, text, prefix_chars, middle_chars, output.

    A text is cut into units; prefix, middle and suffix end after numbers of units that are drawn from a hash of seed and doc_id.
    Forms: plain (the text itself: where it is empty, holds a marker, or is not drawn), psm (prefix, suffix, middle,
    each after its marker) and spm (suffix, prefix, middle). In plain rows the two lengths are null.

    A null text counts as empty. A null doc_id draws as an empty one would. Rows of one doc_id draw alike; repeated rows give
    repeated results. A text of any length is cut over all its units. An empty table gives no rows; other columns of
    docs are ignored. Texts are shuffled by id and text, so copies under other ids do not meet.
    """
    wanted = _wanted(docs, fim)
    keyed = _keyed(wanted, fim)
    found = keyed.join(_offsets(keyed), ["k1", "k2"], "left")
    first, second = (F.coalesce(f"{c}_chars", F.lit(0)).cast("int") for c in ("first", "second"))
    text = F.col("text")
    cut = found.select(
        "doc_id", "n", "form", "text", first.cast("long").alias("prefix_chars"), (second - first).cast("long").alias("middle_chars"),
        F.substring(text, F.lit(1), first).alias("p"), F.substring(text, first + 1, second - first).alias("m"), F.substring(text, second + 1, F.length(text)).alias("s"),
    )
    mark = {c: F.concat(F.lit(m), F.col(c)) for c, m in (("p", fim.prefix), ("m", fim.middle), ("s", fim.suffix))}
    output = F.when(F.col("form") == "psm", F.concat(mark["p"], mark["s"], mark["m"])).otherwise(F.concat(mark["s"], mark["p"], mark["m"]))
    none = F.lit(None).cast("long")
    plain = wanted.where("form = 'plain'").select("doc_id", "n", "form", "text", none.alias("prefix_chars"), none.alias("middle_chars"), F.col("text").alias("output"))
    return plain.unionByName(cut.select("doc_id", "n", "form", "text", "prefix_chars", "middle_chars", output.alias("output")))


def restored(output: Column, form: Column, fim: Fim = Fim()) -> Column:
    """The text, rebuilt from an output and its form alone."""
    after = lambda text, marker: F.substring(text, F.length(F.substring_index(text, marker, 1)) + len(marker) + 1, F.length(text))
    before = lambda text, marker: F.substring_index(text, marker, 1)
    middle = after(output, fim.middle)
    head = before(output, fim.middle)
    psm = F.concat(before(after(head, fim.prefix), fim.suffix), middle, after(head, fim.suffix))
    spm = F.concat(after(head, fim.prefix), middle, before(after(head, fim.suffix), fim.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, fim: Fim = Fim()) -> DataFrame:
    """transformed() with sha256 digests of the output and of the text that is rebuilt from it, in place of the texts."""
    out = transformed(docs, fim)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form"), fim), 256).alias("restored_sha256")
    )
