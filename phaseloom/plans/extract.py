"""Sites, single-variant and sample tables from release tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phaseloom.legends import frequency_index
from phaseloom.operators.filters import any_population_at, passes, passes_both
from phaseloom.sources.tables import in_interval

STATS = ("AC", "AF", "AN", "homozygote_count")


@dataclass(frozen=True)
class Release:
    """Where a release's table has its frequencies, their key, the popmax statistics and the filters (one set or exomes' and genomes')."""

    freq: str
    pop_key: str
    popmax: str
    popmax_pop: str
    filters: tuple[str, ...]
    path: str  # below a mirror's root


#: The public releases and their mirrors.
RELEASES = {
    "genomes": Release("freq", "pop", "popmax", "popmax.pop", ("filters",), "release/3.1.2/ht/genomes/gnomad.genomes.v3.1.2.sites.ht"),
    "hgdp": Release("gnomad_freq", "pop", "gnomad_popmax", "gnomad_popmax.pop", ("filters",), "release/3.1.2/ht/genomes/gnomad.genomes.v3.1.2.hgdp_1kg_subset_variant_annotations.ht"),
    "joint": Release("joint.freq", "gen_anc", "joint.grpmax", "joint.grpmax.gen_anc", ("exomes.filters", "genomes.filters"), "release/4.1/ht/joint/gnomad.joint.v4.1.sites.ht"),
}
MIRRORS = {"s3": "s3a://gnomad-public-us-east-1", "gcs": "gs://gcp-public-data--gnomad"}


def release_uri(release: str, store: str) -> str:
    """Where a release's table lies in a store's public mirror."""
    return f"{MIRRORS[store]}/{RELEASES[release].path}"


def sample_counts(samples: DataFrame, pops: list[str]) -> DataFrame:
    """total, assigned and dropped samples; those whose population is none of pops, or missing, are dropped."""
    known = F.coalesce(F.col("pop").isin(pops), F.lit(False))
    return samples.agg(F.count(F.lit(1)).alias("total"), F.count_if(known).alias("assigned"), F.count_if(~known).alias("dropped"))


def extract_sites(table: DataFrame, freq_meta: list[dict], pops: list[str], interval: str, threshold: float, freq: str = "gnomad_freq") -> DataFrame:
    """Sites of an interval that pass and reach the threshold in any population (applied even at 0: sites without any frequency go)."""
    at = frequency_index(freq_meta, "pop", pops)
    freqs = F.array(*[F.struct(*[F.col(freq)[k][s].alias(s) for s in STATS]) for k in at])
    rows = table.where(in_interval(interval)).where(passes(F.col("filters")))
    return rows.select("contig", "position", "ref", "alt", freqs.alias("pop_freqs")).where(any_population_at(F.col("pop_freqs"), threshold))


def extract_single(table: DataFrame, freq_meta: list[dict], release: Release, pops: list[str], interval: str, threshold: float = 0.0, apply_filters: bool = True) -> DataFrame:
    """Single variants with their populations' and popmax statistics; the threshold holds only above 0."""
    at = frequency_index(freq_meta, release.pop_key, pops)
    rows = table.where(in_interval(interval))
    if apply_filters:
        sets = [F.col(f) for f in release.filters]
        rows = rows.where(passes(sets[0]) if len(sets) == 1 else passes_both(*sets))
    freqs = F.array(*[F.struct(*[F.col(release.freq)[k][s].alias(s) for s in STATS]) for k in at])
    out = rows.select(
        "contig",
        "position",
        "ref",
        "alt",
        freqs.alias("pop_freqs"),
        *[F.col(f"{release.popmax}.{s}").alias(f"popmax_{s}") for s in ("AC", "AF", "AN")],
        F.col(release.popmax_pop).alias("maxpop"),
    )
    return out.where(any_population_at(F.col("pop_freqs"), threshold)) if threshold > 0 else out


def single_tsv(singles: DataFrame, pops: list[str]) -> DataFrame:
    """Flat columns of a single-variant table: variant, popmax and each population's AC, AF and AN."""
    cells = [F.col("pop_freqs")[k][s].alias(f"{s}_{p}") for k, p in enumerate(pops) for s in ("AC", "AF", "AN")]
    name = F.format_string("%s:%s:%s:%s", "contig", "position", "ref", "alt").alias("variant")
    return singles.select(name, "popmax_AC", "popmax_AF", "popmax_AN", "maxpop", *cells)


def extract_samples(meta: DataFrame) -> DataFrame:
    return meta.select("s", F.col("gnomad_population_inference.pop").alias("pop"), F.col("gnomad_sex_imputation.sex_karyotype").alias("sex_karyotype"))


def stratified_sample(samples: DataFrame, targets: dict[tuple[str, str], int], seed: int = 0) -> DataFrame:
    """So many samples of each (pop, sex_karyotype), those with the smallest seeded hashes; too few of one is an error."""
    rows = [(p, k, n) for (p, k), n in targets.items()]
    wanted = samples.sparkSession.createDataFrame(rows, "pop string, sex_karyotype string, n int")
    have = wanted.join(samples.groupBy("pop", "sex_karyotype").count(), ["pop", "sex_karyotype"], "left")
    if short := have.where(F.coalesce("count", F.lit(0)) < F.col("n")).collect():
        raise ValueError(f"too few samples: {[(r['pop'], r['sex_karyotype'], r['count'], r['n']) for r in short]}")
    order = Window.partitionBy("pop", "sex_karyotype").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "s").cast("binary")), "s")
    ranked = samples.join(wanted, ["pop", "sex_karyotype"]).withColumn("_k", F.row_number().over(order))
    return ranked.where("_k <= n").drop("_k", "n")
