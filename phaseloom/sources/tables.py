"""Typed tab-separated tables, interval reads and sample metadata."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phaseloom.sources import bgzf

NA = "NA"


def read_tsv(spark: SparkSession, path: str, schema: str, keep_na: tuple[str, ...] = ()) -> DataFrame:
    """A table with a header and the given types. NA and null are missing; in the columns of keep_na they are the text NA."""
    typed = spark.createDataFrame([], schema).schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in typed])
    raw = spark.read.schema(text).option("sep", "\t").option("header", True).option("nullValue", NA).option("quote", "").csv(path)

    def cell(f: T.StructField) -> Column:
        value = F.nullif(F.col(f"`{f.name}`"), F.lit("null")).cast(f.dataType)
        return (F.coalesce(value, F.lit(NA)) if f.name in keep_na else value).alias(f.name)

    return raw.select([cell(f) for f in typed])


def write_tsv(df: DataFrame, path: str, one_file: bool = False, quoted: bool = False, block_gzip: bool = False) -> None:
    """A tab-separated folder with headers, a file a task (or one for all, by one task); missing values are NA.

    quoted: fields with tabs, quotes or line feeds stand in quotes, and quotes in them are doubled; others never do.
    block_gzip: files are block-gzipped text, without quotes.
    """
    out = df.coalesce(1) if one_file else df
    if block_gzip:
        cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NA)) for c in df.columns]
        bgzf.write_lines(out.select(F.concat_ws("\t", *cells).alias("line")), "line", path, "\t".join(df.columns))
        return
    quotes = {"quote": '"', "escape": '"'} if quoted else {"quote": ""}
    plain = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # values stay as they are
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", NA).option("emptyValue", "").options(**quotes, **plain).csv(path)


def checked(df: DataFrame, required: list[str]) -> DataFrame:
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def in_interval(text: str, contig: str = "contig", position: str = "position") -> Column:
    """A predicate for 'chr1' or 'chr1:a-b' (both ends included); on Parquet by contig it prunes partitions and row groups."""
    if not (m := re.fullmatch(r"([^:]+)(?::([\d,]+)-([\d,]+))?", text)):
        raise ValueError(f"not an interval: {text}")
    here = F.col(contig) == m[1]
    if m[2] is None:
        return here
    return here & F.col(position).between(int(m[2].replace(",", "")), int(m[3].replace(",", "")))


#: Bases that one bin of an interval join spans at least; contigs whose bounds are named to the scan.
BIN, CONTIGS_NAMED = 1 << 14, 2000


def in_intervals(rows: DataFrame, intervals: DataFrame, contig: str = "contig", position: str = "position") -> DataFrame:
    """rows that lie in any of many intervals (contig, start, end; 1-based, both ends included), each row once.

    Rows and intervals meet by bins, so a row is compared with the intervals of its bin alone. The bins are as wide as
    the intervals are on average, so intervals fill few of them. Each contig's least start and greatest end are told to the scan,
    which prunes files and row groups by them. Empty intervals, and those with a null, hold nothing.
    """
    real = intervals.select("contig", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).where("start <= `end` AND contig IS NOT NULL").distinct()
    spans = real.groupBy("contig").agg(F.min("start").alias("low"), F.max("end").alias("high"), F.sum(F.expr("`end` - start + 1")).alias("bases"), F.count(F.lit(1)).alias("n")).limit(CONTIGS_NAMED + 1).collect()
    if not spans:
        return rows.limit(0)
    width = BIN
    while width * sum(r["n"] for r in spans) < sum(r["bases"] for r in spans):
        width *= 2
    if len(spans) <= CONTIGS_NAMED:
        near = F.lit(False)
        for r in spans:
            near = near | ((F.col(contig) == r["contig"]) & F.col(position).between(r["low"], r["high"]))
        rows = rows.where(near)
    binned = real.select(F.col("contig").alias("_contig"), F.col("start").alias("_start"), F.col("end").alias("_end"), F.explode(F.expr(f"sequence(start div {width}, `end` div {width})")).alias("_bin"))
    own = F.expr(f"cast({position} as bigint) div {width}")
    met = (F.col(contig) == F.col("_contig")) & (own == F.col("_bin")) & F.col(position).between(F.col("_start"), F.col("_end"))
    return rows.join(binned, met, "left_semi")


def read_table_pairs(spark: SparkSession, path: str) -> list[tuple[str, str | None, str]]:
    """(contig, haplotype table or None, sites table) rows of a small tab-separated file."""
    rows = checked(spark.read.option("sep", "\t").option("header", True).csv(path), ["contig", "haplotype_table", "sites_table"]).collect()
    return [(r["contig"], r["haplotype_table"] or None, r["sites_table"]) for r in rows]


def id_number(name: str) -> Column:
    """The number at an id's end, by which ids sort in the order that they were given in; null without one."""
    return F.regexp_extract(name, "(\\d+)$", 1).try_cast("long")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """Sorted values, one a line."""
    df.select(F.col(column).cast("string")).orderBy(column).coalesce(1).write.mode("overwrite").text(path)
