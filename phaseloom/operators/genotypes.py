"""Ploidy and call statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phaseloom.operators.filters import in_x_nonpar


def haploid_adjusted(contig: Column, position: Column, gt: Column, karyotype: Column) -> Column:
    """Calls of males outside chrX's pseudoautosomal regions keep their first allele only."""
    haploid = F.coalesce(in_x_nonpar(contig, position) & (karyotype == "XY"), F.lit(False))
    return F.struct(gt["a"].alias("a"), F.when(haploid, F.lit(None).cast("tinyint")).otherwise(gt["b"]).alias("b"))


def call_stats(entries: DataFrame, keys: list[str], gt: str = "gt") -> DataFrame:
    """AC, AN, AF and homozygotes of called alleles by keys; AF is null without called alleles."""
    a, b = F.col(gt)["a"].cast("int"), F.col(gt)["b"].cast("int")
    stats = entries.groupBy(*keys).agg(
        (F.coalesce(F.sum(a), F.lit(0)) + F.coalesce(F.sum(b), F.lit(0))).alias("AC"),
        (F.count(a) + F.count(b)).alias("AN"),
        F.count_if((a == 1) & (b == 1)).alias("homozygote_count"),
    )
    return stats.withColumn("AF", F.try_divide(F.col("AC").cast("double"), F.col("AN").cast("double")))


def entries(genotypes: DataFrame, samples: DataFrame) -> DataFrame:
    """A row for each site and sample with its call; samples has the columns ordinal, s, pop and sex_karyotype."""
    long = genotypes.select("row_idx", "contig", "position", "ref", "alt", F.posexplode("gt").alias("ordinal", "call"))
    joined = long.join(F.broadcast(samples), "ordinal")  # else the calls, whose files are small, may be taken for the smaller side
    return joined.withColumn("gt", haploid_adjusted(F.col("contig"), F.col("position"), F.col("call"), F.col("sex_karyotype"))).drop("call")


def strands(entries: DataFrame) -> DataFrame:
    """Carriers (s, pop, strand, contig, position, ref_len, row_idx): a row for each allele copy that is alternate."""
    copies = F.array(
        F.struct(F.lit(0).alias("strand"), F.col("gt")["a"].alias("allele")),
        F.struct(F.lit(1).alias("strand"), F.col("gt")["b"].alias("allele")),
    )
    sides = entries.withColumn("side", F.explode(copies)).where(F.col("side.allele") != 0)
    return sides.select("s", "pop", F.col("side.strand").alias("strand"), "contig", "position", F.length("ref").alias("ref_len"), "row_idx")
