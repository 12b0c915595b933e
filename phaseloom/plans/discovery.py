"""Haplotype discovery: from carriers to ranked, deduplicated haplotypes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phaseloom.operators import fragments
from phaseloom.operators.blocks import locus_groups, multi_member_groups, parent_blocks
from phaseloom.operators.genotypes import call_stats, entries, strands
from phaseloom.operators.haplotypes import at_threshold, numbered_variants
from phaseloom.operators.filters import max_population_at
from phaseloom.storage import by_shuffle, unnamed


def from_carriers(carriers: DataFrame, stats: DataFrame, sites: DataFrame, n_pops: int, window: int, threshold: float, stage=unnamed) -> DataFrame:
    """Haplotypes with metrics at the threshold, without those contained in longer ones of equal counts.

    Runs of blocks are counted and measured as keys; members are made for what remains. Blocks and metrics are stage
    tables: later steps read them again instead of computing them anew.
    """
    blocks = stage(lambda: fragments.with_values(fragments.distinct_blocks(parent_blocks(carriers, window), n_pops), stats, sites, n_pops), "blocks")
    kept = stage(lambda: at_threshold(fragments.metrics(fragments.counted(blocks, n_pops)), threshold), "metrics")
    return fragments.without_contained(kept, blocks)


def discover(genotypes: DataFrame, samples: DataFrame, sites: DataFrame, pops: list[str], window: int, variant_threshold: float, threshold: float, stage=unnamed) -> DataFrame:
    """Haplotypes of phased genotypes: genotypes (contig, position, ref, alt, gt), samples (ordinal, s, pop, sex_karyotype), sites (with pop_freqs in the order of pops).

    A call counts only where the variant reaches variant_threshold in the sample's own population. Stage tables are
    variants, calls, carriers, blocks, metrics and found; with storage.Stages they stay, and a run that broke goes on from them.
    """
    common = sites.where(max_population_at(F.col("pop_freqs"), variant_threshold))
    known = stage(lambda: numbered_variants(genotypes.join(by_shuffle(common), ["contig", "position", "ref", "alt"])), "variants")
    if known.isEmpty():
        raise ValueError(f"no variants at {variant_threshold}")
    legend = samples.sparkSession.createDataFrame(list(enumerate(pops)), "pop_int int, pop string")
    people = samples.join(F.broadcast(legend), "pop").drop("pop").withColumnRenamed("pop_int", "pop")
    freqs = known.select("row_idx", F.posexplode("pop_freqs").alias("pop", "f")).select("row_idx", "pop", F.col("f.AF").alias("af"))
    calls = entries(known.select("row_idx", "contig", "position", "ref", "alt", "gt"), people).join(by_shuffle(freqs.where(F.col("af") >= variant_threshold)), ["row_idx", "pop"])
    stats = stage(lambda: call_stats(calls, ["row_idx", "pop"]).select("row_idx", "pop", "AN", "AF"), "calls")

    def carriers() -> DataFrame:
        grouped = multi_member_groups(locus_groups(known.withColumn("ref_len", F.length("ref")), window))
        return strands(calls).join(by_shuffle(grouped.select("row_idx", "locus_group")), "row_idx")

    found = stage(lambda: from_carriers(stage(carriers, "carriers"), stats, freqs, len(pops), window, threshold, stage), "found")
    members = found.select("haplotype", F.posexplode("haplotype").alias("k", "row_idx")).join(
        by_shuffle(known.select("row_idx", F.struct("contig", "position", "ref", "alt").alias("v"), "pop_freqs")), "row_idx"
    )
    listed = members.groupBy("haplotype").agg(F.array_sort(F.collect_list(F.struct("k", "v", "pop_freqs"))).alias("m"))
    return found.join(
        by_shuffle(listed.select("haplotype", F.transform("m", lambda x: x["v"]).alias("variants"), F.transform("m", lambda x: x["pop_freqs"]).alias("gnomad_freqs"))), "haplotype"
    )
