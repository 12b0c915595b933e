"""Expressions over variants (contig, position, ref, alt) and arrays of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

END_EXTENDS = "end_extends_past_rightmost_variant"
PASS = "PASS"


def variant(contig: Column, position: Column, ref: Column, alt: Column) -> Column:
    return F.struct(contig.alias("contig"), position.cast("int").alias("position"), ref.alias("ref"), alt.alias("alt"))


def render(v: Column) -> Column:
    """contig:position:ref:alt."""
    return F.concat_ws(":", v["contig"], v["position"].cast("string"), v["ref"], v["alt"])


def render_all(vs: Column) -> Column:
    return F.array_join(F.transform(vs, render), ",")


def parse(text: Column) -> Column:
    """Variants of a comma-separated list, as written; a malformed token raises an error."""

    def one(token: Column) -> Column:
        f = F.split(token, ":")
        good = (F.size(f) == 4) & F.regexp_like(F.get(f, F.lit(1)), F.lit("^[+-]?[0-9]+$"))
        broken = F.raise_error(F.concat(F.lit("expected contig:position:ref:alt, got "), token)).cast("int")
        return variant(F.get(f, F.lit(0)), F.when(good, F.get(f, F.lit(1)).cast("int")).otherwise(broken), F.get(f, F.lit(2)), F.get(f, F.lit(3)))

    return F.transform(F.split(text, ","), one)


def by_position(vs: Column, *more) -> Column:
    """Variants in order of position, then length of ref (and of alt), then as they stood."""

    def keyed(v: Column, k: Column) -> Column:
        return F.struct(v["position"].alias("p"), F.length(v["ref"]).alias("r"), *[f(v) for f in more], k.alias("k"), v.alias("v"))

    return F.transform(F.array_sort(F.transform(vs, keyed)), lambda x: x["v"])


def distance(first: Column, second: Column) -> Column:
    """Reference bases between two variants; negative where they overlap."""
    return second["position"] - first["position"] - F.length(first["ref"])


def max_end(vs: Column) -> Column:
    """The greatest 0-based exclusive end of the variants' reference alleles."""
    return F.array_max(F.transform(vs, lambda v: v["position"] - 1 + F.length(v["ref"])))


def coordinates(vs: Column, flank: int) -> tuple[Column, Column]:
    """0-based half-open window of the variants with flanks."""
    first = F.array_min(F.transform(vs, lambda v: v["position"]))
    return (first - 1 - flank).cast("long"), (max_end(vs) + flank).cast("long")


def compose(vs: Column, flank: int, base: Column, base_start: Column) -> Column:
    """The sequence of a haplotype with flanks; `base` holds the reference from 1-based position base_start on.

    Variants go by position, then length of ref and of alt. Between them the reference is copied from where the
    last one ended; of an alternate allele whose start is already covered the covered bases are left out. A flank
    ends where the base does.
    """
    ordered = by_position(vs, lambda v: F.length(v["alt"]).alias("a"))

    def ref(at: Column, n: Column) -> Column:
        before = F.greatest(base_start - at, F.lit(0))
        return F.substring(base, (at + before - base_start + 1).cast("int"), F.greatest(n - before, F.lit(0)).cast("int"))

    first = F.element_at(ordered, 1)["position"]
    start = F.struct(ref(first - flank, F.lit(flank)).alias("seq"), first.alias("at"))

    def add(acc: Column, v: Column) -> Column:
        reach = F.greatest(acc["at"], v["position"])
        covered = reach - v["position"]
        own = F.substring(v["alt"], (covered + 1).cast("int"), F.length(v["alt"]))
        return F.struct(
            F.concat(acc["seq"], ref(acc["at"], reach - acc["at"]), own).alias("seq"),
            F.greatest(acc["at"], v["position"] + F.length(v["ref"])).alias("at"),
        )

    return F.aggregate(ordered, start, add, lambda acc: F.concat(acc["seq"], ref(acc["at"], F.lit(flank))))


def kind(v: Column) -> Column:
    r, a = F.length(v["ref"]), F.length(v["alt"])
    return F.when(r > a, "deletion").when(r < a, "insertion").when(r == 1, "snp").otherwise("mnv")


def conflict(a: Column, b: Column) -> Column:
    """Why two variants, a not after b, cannot be on one chromosome; null where they can."""
    ka, kb = kind(a), kind(b)
    indels = lambda x, y: (x == "deletion") & (y == "insertion")
    gained = lambda v: F.substring(v["alt"], F.length(v["ref"]) + 1, F.length(v["alt"]))
    lost = lambda v: F.substring(v["ref"], F.length(v["alt"]) + 1, F.length(v["ref"]))
    undone = (indels(ka, kb) & (lost(a) == gained(b))) | (indels(kb, ka) & (lost(b) == gained(a)))
    one_snp = ((ka == "snp") & kb.isin("deletion", "insertion")) | ((kb == "snp") & ka.isin("deletion", "insertion"))
    together = (
        F.when(one_snp, F.lit(None).cast("string"))
        .when(undone, "same_position_reciprocal_insertion_deletion")
        .when(indels(ka, kb) | indels(kb, ka), "same_position_insertion_deletion")
        .when((ka == kb) & (ka != "mnv"), F.concat(F.lit("same_position_"), ka))
        .otherwise("same_position_other")
    )
    inside_deletion = (
        F.when(kb == "snp", "snp_in_deletion")
        .when(kb == "deletion", "overlapping_deletions")
        .when(kb == "insertion", "insertion_in_deletion")
        .otherwise("other_overlap")
    )
    apart = F.when(ka == "deletion", inside_deletion).when(ka == "insertion", "insertion_anchor_conflict").otherwise("other_overlap")
    return F.when(distance(a, b) < 0, F.when(a["position"] == b["position"], together).otherwise(apart))


def conflicts(ordered: Column) -> Column:
    """The conflicts of all pairs of position-sorted variants, one for each such pair."""
    pairs = F.transform(
        ordered, lambda v, k: F.transform(F.slice(ordered, k + 2, F.size(ordered)), lambda w: conflict(v, w))
    )
    return F.filter(F.flatten(pairs), lambda r: r.isNotNull())


def overlapping(ordered: Column) -> Column:
    """Whether any two of the position-sorted variants overlap: one starts before the furthest end so far."""
    start = F.struct(F.lit(0).alias("reach"), F.lit(False).alias("met"))
    step = lambda acc, v: F.struct(
        F.greatest(acc["reach"], v["position"] + F.length(v["ref"])).alias("reach"), (acc["met"] | (v["position"] < acc["reach"])).alias("met")
    )
    return F.aggregate(ordered, start, step, lambda acc: acc["met"])


def end_extends(vs: Column) -> Column:
    """Whether a variant reaches farther than the rightmost one (greatest position, then longest ref)."""
    last = F.array_max(F.transform(vs, lambda v: F.struct(v["position"].alias("p"), F.length(v["ref"]).alias("n"))))
    return max_end(vs) > last["p"] - 1 + last["n"]


def haplotype_filter(vs: Column) -> Column:
    """PASS, or the distinct flags in order, joined by semicolons."""
    ordered = by_position(vs)
    flags = F.array_distinct(F.concat(conflicts(ordered), F.when(end_extends(vs), F.array(F.lit(END_EXTENDS))).otherwise(F.array().cast("array<string>"))))
    return F.when((F.size(vs) < 2) | (F.size(flags) == 0), PASS).otherwise(F.array_join(F.array_sort(flags), ";"))
