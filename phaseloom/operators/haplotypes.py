"""Carrier counts, frequency metrics and redundancy of haplotypes (arrays of variant row ids)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phaseloom.operators.blocks import slices
from phaseloom.operators.ordering import numbered


def containment_ac(fragments: DataFrame, n_pops: int) -> DataFrame:
    """haplotype and per_pop_AC, the number of its fragments by population, zeros included."""
    counts = [F.count_if(F.col("pop") == p).alias(f"_{p}") for p in range(n_pops)]
    return fragments.groupBy("haplotype").agg(*counts).select("haplotype", F.array(*[F.col(f"_{p}") for p in range(n_pops)]).alias("per_pop_AC"))


def component_metrics(haplotypes: DataFrame, stats: DataFrame, sites: DataFrame) -> DataFrame:
    """Metrics by haplotype and population.

    stats: row_idx, pop, AN, AF of the genotyped samples, without rows for populations that have no entries;
    sites: row_idx, pop, af. For each population the empirical AF is AC by the least AN of the members, the
    phased fraction that by their least AF, and the estimate the least site AF times the fraction; members
    without statistics are skipped, and what would divide by nothing is null. max_pop is the population with the
    greatest empirical AF, the first of equal ones.
    """
    cells = stats.select("row_idx", "pop", "AN", "AF").join(sites.select("row_idx", "pop", "af"), ["row_idx", "pop"], "full")
    cells = cells.toDF("row_idx", "pop", "AN", "local_AF", "site_af")
    members = haplotypes.select("haplotype", "per_pop_AC", F.explode(F.array_distinct("haplotype")).alias("row_idx"))
    least = members.join(cells, "row_idx", "left").groupBy("haplotype", "per_pop_AC", "pop").agg(
        F.min("AN").alias("min_AN"), F.min("local_AF").alias("min_AF"), F.min("site_af").alias("min_site")
    )
    found = least.groupBy("haplotype", "per_pop_AC").agg(F.collect_list(F.struct("pop", "min_AN", "min_AF", "min_site")).alias("c"))
    return ranked(found, ["haplotype"])


def ranked(found: DataFrame, keys: list[str]) -> DataFrame:
    """Metrics of rows with keys, per_pop_AC and c, an array of the least AN, AF and site AF (min_AN, min_AF, min_site) by pop."""
    ratio = lambda x, y: F.when(y > 0, x.cast("double") / y)

    def by_pop(ac, p):
        own = F.get(F.filter("c", lambda x: x["pop"] == p), F.lit(0))
        af = ratio(ac, own["min_AN"])
        phased = ratio(af, own["min_AF"])
        return F.struct(
            p.alias("pop"),
            ac.alias("empirical_AC"),
            af.alias("empirical_AF"),
            phased.alias("fraction_phased"),
            (own["min_site"] * phased).alias("estimated_gnomad_AF"),
            own["min_AF"].alias("min_variant_frequency"),
        )

    better = (  # empirical AF down, missing last, then population
        lambda x, y: F.when(x["empirical_AF"].isNull() & y["empirical_AF"].isNull(), x["pop"] - y["pop"])
        .when(x["empirical_AF"].isNull(), 1)
        .when(y["empirical_AF"].isNull(), -1)
        .when(x["empirical_AF"] > y["empirical_AF"], -1)
        .when(x["empirical_AF"] < y["empirical_AF"], 1)
        .otherwise(x["pop"] - y["pop"])
    )
    listed = found.select(*keys, "per_pop_AC", F.array_sort(F.transform("per_pop_AC", by_pop), better).alias("freqs"))
    best = F.when(F.get("freqs", F.lit(0))["empirical_AF"].isNotNull(), F.get("freqs", F.lit(0)))
    out = listed.withColumn("best", best)
    return out.select(
        *keys,
        "per_pop_AC",
        F.col("best.pop").alias("max_pop"),
        F.col("best.empirical_AF").alias("max_empirical_AF"),
        F.col("best.empirical_AC").alias("max_empirical_AC"),
        F.col("best.min_variant_frequency").alias("min_variant_frequency"),
        F.col("best.fraction_phased").alias("fraction_phased"),
        F.col("best.estimated_gnomad_AF").alias("estimated_gnomad_AF"),
        F.transform("freqs", lambda f: f.dropFields("min_variant_frequency")).alias("all_pop_freqs"),
    )


def at_threshold(metrics: DataFrame, threshold: float) -> DataFrame:
    return metrics.where((F.col("min_variant_frequency") > 0) & (F.col("estimated_gnomad_AF") >= threshold))


def without_contained(haplotypes: DataFrame) -> DataFrame:
    """Drops haplotypes that are a contiguous part of a longer one with the same counts.

    Only count vectors that occur more than once can matter; their rows' proper slices are joined on slice and counts.
    """
    again = haplotypes.groupBy("per_pop_AC").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("per_pop_AC")
    longer = haplotypes.where("size(haplotype) > 2").join(again, "per_pop_AC", "left_semi")
    parts = longer.select("per_pop_AC", F.col("haplotype").alias("_h"), F.explode(slices(F.col("haplotype"))).alias("haplotype"))
    parts = parts.where("size(haplotype) < size(_h)").select("haplotype", "per_pop_AC").distinct()
    return haplotypes.join(parts, ["haplotype", "per_pop_AC"], "left_anti")


def numbered_variants(variants: DataFrame) -> DataFrame:
    """variants with row_idx from 0 in order of (contig, position, ref, alt)."""
    return numbered(variants, ["contig", "position", "ref", "alt"], "row_idx")
