"""Mixing of sources to target weights over a domain-language-source tree, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phaseloom.llm.common import stored

LEAF = ["domain", "lang", "source"]
NONE = "(none)"


@dataclass(frozen=True)
class Mixture:
    """Weights are whole numbers by name; a name without one has weight 1. The budget is a share of all tokens there are."""

    domain_sql: str  # of the column source
    domain_weights: dict[str, int] = field(default_factory=dict)
    lang_weights: dict[str, int] = field(default_factory=dict)
    source_weights: dict[str, int] = field(default_factory=dict)
    share: tuple[int, int] = (1, 2)
    max_epochs: int = 2
    seed: int = 7


#: The production mixture of query and pipeline.
PRODUCTION = Mixture(
    domain_sql="CASE WHEN source IN ('src0','src1','src2','src3','src4','src5','src6','src7') THEN 'crawl' "
    "WHEN source IN ('src8','src9','src10','src11','src12') THEN 'books' ELSE 'reference' END",
    domain_weights={"crawl": 5, "books": 3, "reference": 2},
    lang_weights={"en": 6, "de": 2, "fr": 2, "es": 1},
    source_weights={"src0": 2},
)


def _weight(name: str, weights: dict[str, int]) -> Column:
    if not weights:
        return F.lit(1)
    pairs = [F.lit(x) for kv in weights.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(name)), F.lit(1))


def leaves_of(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """docs with domain, lang and source as leaf columns (null: '(none)') and tokens, a quarter of the text's UTF-8 bytes, rounded up."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(NONE))
    tokens = F.expr("(coalesce(octet_length(cast(text as string)), 0) + 3) div 4").cast("long")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source.alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"),
        tokens.alias("n_tokens"),
    )
    return keyed.withColumn("domain", F.expr(mixture.domain_sql))


def _fill(children: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Shares out each parent's budget among its children by weight, none above its capacity; the rest goes to the siblings with room.

    Children are sorted by capacity for a unit of weight: those whose capacity is at most their share of what is
    left are filled, all others share the remainder by weight. Fractions are rounded down.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("cap").cast("double") / F.col("w"), F.col(key))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    seen = (
        children.withColumn("_c", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_w", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_left", F.col("budget") - F.col("_c"))
        .withColumn("_full", big("cap") * F.col("_w").cast("decimal(12,0)") <= big("_left") * F.col("w").cast("decimal(12,0)"))
    )
    rest = seen.withColumn("_fc", F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(by)).withColumn(
        "_fw", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("w"))).over(by)
    )
    alloc = F.when(F.col("_full"), F.col("cap")).otherwise(F.expr("(budget - _fc) * w div greatest(_fw, 1)")).cast("long")
    return rest.withColumn("alloc", alloc).drop("_c", "_w", "_left", "_full", "_fc", "_fw")


def leaf_budgets(supply: DataFrame, mixture: Mixture) -> DataFrame:
    """Budgets of all leaves, from the root down, from their tokens; at each node shortages go to siblings before any ancestor.

    A node's capacity is that of its leaves, max_epochs times their tokens, so what a leaf lacks is met inside its
    language as long as that has room, then inside its domain, then by other domains.
    """
    num, den = mixture.share
    leaf = supply.withColumn("cap", F.col("supply") * mixture.max_epochs)
    all_ = Window.partitionBy(F.lit(0))
    domains = leaf.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply"))
    domains = (
        domains.withColumn("w", _weight("domain", mixture.domain_weights))
        .withColumn("_cap", F.sum("cap").over(all_))
        .withColumn("_all", F.sum("supply").over(all_))
        .withColumn("budget", F.expr(f"least({num} * _all div {den}, _cap)"))
    )
    domains = _fill(domains, [], "domain").select("domain", F.col("alloc").alias("budget"))
    langs = leaf.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(domains, "domain")
    langs = _fill(langs.withColumn("w", _weight("lang", mixture.lang_weights)), ["domain"], "lang")
    langs = langs.select("domain", "lang", F.col("alloc").alias("budget"))
    sources = leaf.join(langs, ["domain", "lang"]).withColumn("w", _weight("source", mixture.source_weights))
    return _fill(sources, ["domain", "lang"], "source").select(*LEAF, "supply", "alloc")


def _keyed(rows: DataFrame, mixture: Mixture) -> DataFrame:
    """Each row's place in its leaf's last, partial epoch: a seeded digest of epoch and doc_id, and the digest's bucket."""
    text = F.concat_ws(":", F.lit(str(mixture.seed)), F.col("full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return rows.withColumn("key", F.md5(text.cast("binary"))).withColumn("bucket", F.substring("key", 1, 3))


def leaf_cuts(rows: DataFrame, mixture: Mixture) -> DataFrame:
    """One stored row a leaf: full epochs, tokens of the partial epoch, and the last key that is in it.

    rows: leaf columns, doc_id and n_tokens. A leaf, even one with a third of all rows, is summed up in 4,096
    buckets of keys; only rows of the bucket in which its budget ends are sorted.
    """
    supply = stored(rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("supply")), "mix-supply")
    plan = leaf_budgets(supply, mixture).select(
        *LEAF,
        F.expr("CASE WHEN supply > 0 THEN alloc div supply ELSE 0 END").alias("full"),
        F.expr("CASE WHEN supply > 0 THEN alloc % supply ELSE 0 END").alias("part"),
    )
    plan = stored(plan, "mix-plan")
    keyed = _keyed(rows.join(plan.where("part > 0"), LEAF), mixture)
    sums = keyed.groupBy(*LEAF, "bucket", "part").agg(F.sum("n_tokens").alias("tokens"))
    run = Window.partitionBy(*LEAF).orderBy("bucket")
    edge = (
        sums.withColumn("upto", F.sum("tokens").over(run.rowsBetween(Window.unboundedPreceding, 0)))
        .where("upto > part")
        .groupBy(*LEAF)
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("tokens")).alias("before"))).alias("edge"))
        .select(*LEAF, F.col("edge.bucket").alias("bucket"), F.col("edge.before").alias("before"))
    )
    edge = stored(edge, "mix-edge")
    peers = Window.partitionBy(*LEAF).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    last = (
        keyed.join(edge, [*LEAF, "bucket"])
        .withColumn("upto", F.col("before") + F.sum("n_tokens").over(peers))
        .where("upto <= part")
        .groupBy(*LEAF)
        .agg(F.max("key").alias("last"))
    )
    cuts = plan.join(edge.drop("before"), LEAF, "left").join(last, LEAF, "left")
    return stored(cuts.select(*LEAF, "full", "part", F.col("bucket").alias("edge"), "last"), "mix-cuts")


def drawn(rows: DataFrame, cuts: DataFrame, mixture: Mixture) -> DataFrame:
    """rows with `copies`, the times that each is taken; the leaves' cuts decide row by row, nothing else is shuffled."""
    keyed = _keyed(rows.join(cuts, LEAF), mixture)
    inside = (F.col("part") > 0) & ((F.col("bucket") < F.col("edge")) | ((F.col("bucket") == F.col("edge")) & (F.col("key") <= F.col("last"))))
    return keyed.withColumn("copies", (F.col("full") + F.when(F.coalesce(inside, F.lit(False)), 1).otherwise(0)).cast("int"))


def mix(docs: DataFrame, mixture: Mixture = PRODUCTION) -> DataFrame:
    """Documents drawn to target weights: doc_id, domain, lang, source, n_tokens, epoch; a row for each epoch that takes the document.

    Each leaf's budget takes whole epochs, then of one more epoch, in its seeded order, the longest prefix within
    the rest. Repeated doc_ids stand or fall together; a leaf without tokens takes none. Null lang and source are
    leaves called '(none)', a null text has no tokens. An empty table gives no rows. Other columns are ignored.
    """
    rows = stored(leaves_of(docs, mixture), "mix-rows")
    out = drawn(rows, leaf_cuts(rows, mixture), mixture).where("copies > 0")
    return out.select("doc_id", *LEAF, "n_tokens", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))


def mixed_documents(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """docs, all columns, each as often as it is drawn; texts are not shuffled.

    A null language or source is a leaf of its own; null and empty texts have no tokens and are drawn with their leaf's whole
    epochs, or before its cut. Ties in the seeded order (rows of one doc_id) are drawn together. An empty table stays empty.
    """
    cuts = leaf_cuts(stored(leaves_of(docs, mixture), "mix-rows"), mixture)
    own = [f"_c{k}" for k in range(len(docs.columns))]
    kept = docs.select(F.struct(*[F.col(c).alias(o) for c, o in zip(docs.columns, own, strict=True)]).alias("_row"), "doc_id", "source", "lang")
    rows = kept.select(
        "_row",
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"),
    ).withColumn("domain", F.expr(mixture.domain_sql))
    out = drawn(rows, cuts, mixture).where("copies > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))) if mixture.max_epochs > 1 else out
    return out.select(*[F.col("_row")[o].alias(c) for c, o in zip(docs.columns, own, strict=True)])
