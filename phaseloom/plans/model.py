"""A genotype model on the order tables: customers are samples, their regions populations, parts variants."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_VARIANTS, POPS, WINDOW, VT = 200, ["africa", "america", "asia", "europe", "mideast"], 25, 0.05


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def variants(spark: SparkSession) -> DataFrame:
    v = F.col("id")
    return spark.range(N_VARIANTS).select(
        v.alias("row_idx"),
        F.concat(F.lit("chr"), (1 + v % 2).cast("string")).alias("contig"),
        (100 + F.expr("id div 2") * 10).cast("int").alias("position"),
        (1 + v % 4).cast("int").alias("ref_len"),
    )


def sites(spark: SparkSession) -> DataFrame:
    """row_idx, pop, af for every variant and population."""
    pops = F.explode(F.array(*[F.lit(p) for p in range(len(POPS))])).alias("pop")
    af = ((F.col("row_idx") * 7 + F.col("pop") * 13) % 50).cast("double") / 100
    return variants(spark).select("row_idx", pops).withColumn("af", af)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s and pop of every sample."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("pop"))
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s"), "c_nationkey")
    return people.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("s", "pop")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (s, strand, row_idx): the alternate alleles that samples carry."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 2).alias("strand"), (F.col("l_partkey") % N_VARIANTS).alias("row_idx"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("s"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("s", "strand", "row_idx").distinct()


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of variants that reach VT in the sample's own population."""
    own = entries(spark, sf_dir).join(samples(spark, sf_dir), "s")
    common = own.join(sites(spark).where(F.col("af") >= VT).select("row_idx", "pop"), ["row_idx", "pop"])
    return common.join(variants(spark), "row_idx").select("s", "pop", "strand", "contig", "position", "ref_len", "row_idx")


def stats(spark: SparkSession, sf_dir: str, carried: DataFrame | None = None) -> DataFrame:
    """row_idx, pop, AN (two alleles a sample) and AF of variants that reach VT in the population, from the carriers."""
    carried = carriers(spark, sf_dir) if carried is None else carried
    size = samples(spark, sf_dir).groupBy("pop").agg((2 * F.count(F.lit(1))).alias("AN"))
    ac = carried.groupBy("row_idx", "pop").agg(F.count(F.lit(1)).alias("AC"))
    cells = sites(spark).where(F.col("af") >= VT).select("row_idx", "pop").join(size, "pop").join(ac, ["row_idx", "pop"], "left")
    return cells.select("row_idx", "pop", "AN", (F.coalesce("AC", F.lit(0)).cast("double") / F.col("AN")).alias("AF"))


#: Alleles for the queries on composition and conflicts, in both dialects: one for each part, some at one position, overlapping references of 1 to 14 bases.
_PAIRS = {0: ("CA", "C"), 1: ("C", "CA"), 3: ("C", "CA"), 4: ("C", "CGG"), 6: ("C", "A"), 7: ("C", "G"), 9: ("CAA", "C"), 10: ("CA", "C"), 12: ("AT", "GC"), 13: ("AT", "CG"), 15: ("CA", "C"), 16: ("C", "CGG")}


def _allele(side: int, other: str) -> str:
    return f"CASE v % 42 {' '.join(f"WHEN {k} THEN '{x[side]}'" for k, x in _PAIRS.items())} ELSE {other} END"


ALLELES = {
    "row_idx": "v",
    "contig": "'chr1'",
    "position": "CAST(100 + 3 * (v - CASE WHEN v % 3 = 1 THEN 1 ELSE 0 END) AS INT)",
    "ref": _allele(0, "substr('ACGTTGCAACGTGA', 1, CAST(1 + (v * 5) % 14 AS INT))"),
    "alt": _allele(1, "substr('ACGTTGCAACGTGA', CAST(1 + v % 3 AS INT), CAST(1 + (v * 3) % 5 AS INT))"),
}


def alleles(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """row_idx of every part, and as vs the alleles of it and the n - 1 numbers after it."""
    fields = ", ".join(f"{re.sub(r'\bv\b', '(row_idx + k)', ALLELES[c])} AS {c}" for c in ("contig", "position", "ref", "alt"))
    keys = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("row_idx"))
    return keys.select("row_idx", F.expr(f"transform(sequence(0, {n - 1}), k -> struct({fields}))").alias("vs"))


def part_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variant for each part."""
    v = F.col("p_partkey").cast("long")
    return table(spark, sf_dir, "part").select(
        v.alias("row_idx"),
        F.concat(F.lit("chr"), (1 + v % 2).cast("string")).alias("contig"),
        (100 + F.expr("cast(p_partkey as bigint) div 2") * 10 + (v % 7) * 9).cast("int").alias("position"),
        (1 + v % 4).cast("int").alias("ref_len"),
    )


def part_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_idx, pop, af for every part and population."""
    pops = F.explode(F.array(*[F.lit(p) for p in range(len(POPS))])).alias("pop")
    af = ((F.col("row_idx") * 7 + F.col("pop") * 13) % 50).cast("double") / 100
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("row_idx"), pops).withColumn("af", af)
