"""Phased genotypes from VCF text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phaseloom.sources import bgzf

FIXED = 9  # columns before the samples


def _call(field: Column) -> Column:
    """struct<a,b> of a sample's field, GT first; '.' and a missing second allele are null."""
    alleles = F.split(F.substring_index(field, ":", 1), "[|/]")
    allele = lambda k: F.try_to_number(F.get(alleles, F.lit(k)), F.lit("999")).cast("tinyint")
    return F.struct(allele(0).alias("a"), allele(1).alias("b"))


def read_vcf(spark: SparkSession, path: str, min_partitions: int = 64, block_gzip: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Genotypes (contig, position, ref, alt, gt in sample order) and samples (ordinal, s) of VCF files, gzipped (.gz, .bgz) or not.

    path may be a glob of files with the same samples in the same order. The samples come from the first header;
    another one, or a line of another width, is an error when it is met. Sites with several alternate alleles give no
    row. Block-gzipped files (suffix .bgz, or block_gzip) are read and parsed in splits and stay as they are spread.
    Of other files, a .gz one is read by one task, so parsed calls, which are smaller than their text, are spread over min_partitions.
    """
    block_gzip = path.endswith(".bgz") if block_gzip is None else block_gzip
    lines = bgzf.read_lines(spark, path) if block_gzip else spark.read.text(path)
    header = lines.where(F.col("value").startswith("#CHROM")).first()
    if header is None:
        raise ValueError(f"no header in {path}")
    names = header["value"].split("\t")[FIXED:]
    samples = spark.createDataFrame(list(enumerate(names)), "ordinal int, s string")
    other = F.col("value").startswith("#CHROM") & (F.col("value") != header["value"])
    wrong = F.raise_error(F.lit(f"files of {path} have different headers")).cast("boolean")
    fields = F.split("value", "\t")
    rows = lines.where(F.when(other, wrong).otherwise(~F.col("value").startswith("#"))).select(fields.alias("f"))
    width = F.when(F.size("f") == FIXED + len(names), F.get("f", F.lit(0))).otherwise(F.raise_error(F.concat(F.lit("wrong number of fields: "), F.size("f").cast("string"))).cast("string"))
    parsed = rows.select(
        width.alias("contig"),
        F.get("f", F.lit(1)).cast("int").alias("position"),
        F.get("f", F.lit(3)).alias("ref"),
        F.get("f", F.lit(4)).alias("alt"),
        F.transform(F.slice("f", FIXED + 1, F.size("f")), _call).alias("gt"),
    )
    kept = parsed.where(~F.col("alt").contains(",") & (F.col("alt") != "."))
    return (kept if block_gzip else kept.repartition(min_partitions)), samples
