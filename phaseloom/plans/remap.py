"""Hits on index sequences in genome coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phaseloom.functions.variants import parse, render
from phaseloom.schemas import HITS
from phaseloom.sources.tables import checked


def intervals(vs: Column, flank: int) -> Column:
    """0-based half-open places of the alternate alleles in the haplotype's sequence, in the variants' order."""
    spans = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(spans.alias("spans"), (F.element_at(vs, 1)["position"] - flank).alias("shift"))

    def add(acc: Column, v: Column) -> Column:
        at = v["position"] - acc["shift"]
        span = F.struct(at.cast("int").alias("start"), (at + F.length(v["alt"])).cast("int").alias("end"))
        return F.struct(F.concat(acc["spans"], F.array(span)).alias("spans"), (acc["shift"] + F.length(v["ref"]) - F.length(v["alt"])).alias("shift"))

    return F.aggregate(vs, start, add, lambda acc: acc["spans"])


def _numbered(spans: Column) -> Column:
    return F.transform(spans, lambda s, k: F.struct(s["start"].alias("start"), s["end"].alias("end"), k.alias("k")))


def to_reference(at: Column, left: bool, vs: Column, spans: Column) -> Column:
    """The 1-based reference position of a place in the sequence; inside a variant its start (left) or its end."""
    first = F.element_at(spans, 1)["start"]
    ahead = (at if left else at - 1) < first
    beyond = F.filter(_numbered(spans), lambda s: s["start"] > at)
    reached = F.when(F.size(beyond) > 0, F.element_at(beyond, 1)["k"]).otherwise(F.size(spans))
    inside = F.filter(F.slice(_numbered(spans), 1, reached), lambda s: s["end"] > at)
    hit = F.get(vs, F.element_at(inside, 1)["k"])
    last = F.greatest(reached - 1, F.lit(0))
    after = F.get(vs, last)
    end = lambda v: v["position"] + F.length(v["ref"])
    return (
        F.when(ahead, F.element_at(vs, 1)["position"] - first + at)
        .when(F.size(inside) > 0, hit["position"] if left else end(hit))
        .otherwise(end(after) + at - F.get(spans, last)["end"])
        .cast("long")
    )


def involved(start: Column, end: Column, spans: Column) -> Column:
    """struct<first,last> of the variants that [start, end) overlaps, null without any."""
    met = F.transform(F.filter(_numbered(spans), lambda s: (s["start"] < end) & (start < s["end"])), lambda s: s["k"])
    return F.when(F.size(met) > 0, F.struct(F.array_min(met).alias("first"), F.array_max(met).alias("last")))


def frequencies(text: Column) -> Column:
    """Numbers of a comma-separated list; null, NA and nothing are 0."""
    return F.transform(F.split(text, ","), lambda t: F.when(t.isin("null", "NA", ""), 0.0).otherwise(t.cast("double")))


def remap(hits: DataFrame, sequences: DataFrame, window: int, pops: list[str], genome: str = "GRCh38", prefix: str = "index") -> DataFrame:
    """Hits with genome coordinates and what the sequence is made of.

    A hit's padding (bases of padded_target but for dashes beyond the unpadded ones) is added at the end on strand
    '+' and at the start on any other. The sequence's id, start and end go to columns with the prefix; a hit on an unknown id raises an error.
    """
    checked(hits, HITS)
    own = hits.withColumn("chromosome", F.col("chromosome").cast("string"))
    flag = F.col("haplotype_filter") if "haplotype_filter" in sequences.columns else F.lit("PASS")
    keep = ["variants", "popmax_empirical_AF", "popmax_empirical_AC", "max_pop", "source", *[f"{n}_{p}" for p in pops for n in ("gnomAD_AF", "estimated_gnomAD_haplotype_AF")]]
    known = sequences.select(F.col("sequence_id").alias("_id"), F.struct(*keep, flag.alias("haplotype_filter")).alias("_s"))
    joined = own.join(known, own["chromosome"] == known["_id"], "left")
    unknown = F.raise_error(F.concat(F.lit("no sequence called "), F.coalesce("chromosome", F.lit("null")))).cast("string")
    pad = F.length(F.replace("padded_target", F.lit("-"), F.lit(""))) - F.length("unpadded_target_sequence")
    plus = F.col("strand") == "+"
    rows = (
        joined.withColumn("_names", F.when(F.col("_id").isNull(), unknown).otherwise(F.col("_s.variants")))
        .withColumn("_vs", parse(F.col("_names")))
        .withColumn("_spans", intervals(F.col("_vs"), window))
        .withColumn("_from", F.col("coordinate_start").cast("int") - F.when(plus, 0).otherwise(pad))
        .withColumn("_to", F.col("coordinate_end").cast("int") + F.when(plus, pad).otherwise(0))
        .withColumn("_met", involved(F.col("_from"), F.col("_to"), F.col("_spans")))
    )
    met = F.when(F.col("_met").isNull(), F.array().cast("array<string>")).otherwise(
        F.transform(F.slice("_vs", F.col("_met.first") + 1, F.col("_met.last") - F.col("_met.first") + 1), render)
    )
    rest = [c for c in hits.columns if c not in ("chromosome", "coordinate_start", "coordinate_end")]
    return rows.withColumn("_in", met).select(
        F.element_at("_vs", 1)["contig"].alias("chromosome"),
        to_reference(F.col("_from"), True, F.col("_vs"), F.col("_spans")).alias("coordinate_start"),
        to_reference(F.col("_to"), False, F.col("_vs"), F.col("_spans")).alias("coordinate_end"),
        *rest,
        F.col("chromosome").alias(f"{prefix}_sequence_id"),
        F.col("coordinate_start").alias(f"{prefix}_start"),
        F.col("coordinate_end").alias(f"{prefix}_end"),
        F.lit(genome).alias("genome_build"),
        F.col("_names").alias("all_variants"),
        F.array_join("_in", ",").alias("variants_involved"),
        F.size("_in").alias("n_variants_involved"),
        F.col("_s.popmax_empirical_AF").alias("popmax_empirical_AF"),
        F.col("_s.popmax_empirical_AC").alias("popmax_empirical_AC"),
        F.col("_s.max_pop").alias("max_pop"),
        F.col("_s.source").alias("variant_source"),
        F.col("_s.haplotype_filter").alias("haplotype_filter"),
        *[F.col(f"_s.gnomAD_AF_{p}").alias(f"gnomAD_AF_{p}") for p in pops],
        *[F.col(f"_s.estimated_gnomAD_haplotype_AF_{p}").alias(f"estimated_gnomAD_haplotype_AF_{p}") for p in pops],
    )
