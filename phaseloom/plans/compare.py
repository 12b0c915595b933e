"""Comparisons of haplotype catalogs and of releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phaseloom.functions.variants import by_position, overlapping, parse
from phaseloom.operators.blocks import slices

#: Why a release lacks a variant.
BUCKETS = ("absent_from_v41", "below_af_threshold", "exome_filter_only", "genome_filter_only", "both_filters_nonempty", "unexpected_pass")


def catalog(df: DataFrame, key: str, count: str) -> DataFrame:
    """One row a key with its greatest count and the number of rows that it had."""
    return df.groupBy(key).agg(F.max(count).alias(count), F.count(F.lit(1)).alias("n_rows"))


def overlap(old: DataFrame, new: DataFrame, key: str, count: str) -> DataFrame:
    """key, status (shared, old_only, new_only) and both counts."""
    a, b = old.select(key, F.col(count).alias("old_count")), new.select(key, F.col(count).alias("new_count"))
    both = a.join(b, key, "full")
    status = F.when(F.col("old_count").isNull(), "new_only").when(F.col("new_count").isNull(), "old_only").otherwise("shared")
    return both.withColumn("status", status)


def count_changes(compared: DataFrame) -> DataFrame:
    """metric, value: rows by status, and among shared rows same, higher and lower counts of the new catalog."""
    shared = F.col("status") == "shared"
    o, n = F.col("old_count"), F.col("new_count")
    cells = {
        "shared": shared,
        "old_only": F.col("status") == "old_only",
        "new_only": F.col("status") == "new_only",
        "count_same": shared & (o == n),
        "new_higher": shared & (n > o),
        "new_lower": shared & (n < o),
    }
    one = compared.agg(*[F.count_if(c).alias(k) for k, c in cells.items()])
    return one.unpivot([], list(cells), "metric", "value")


def enclosed(old_only: DataFrame, old: DataFrame, new: DataFrame, haplotype: str = "haplotype") -> DataFrame:
    """For each old-only haplotype whether a longer one that contains it is in both catalogs or in the new one only.

    Longer haplotypes are looked up by a haplotype's rarest member: postings (a row a member) meet at that member and the
    runs around it are compared, so no slices are made. A haplotype with a member that no longer one has meets nothing.
    """
    longer = new.join(old.select(haplotype, F.lit(True).alias("_old")), haplotype, "left").where(F.size(haplotype) > 2)
    postings = longer.select(F.coalesce("_old", F.lit(False)).alias("_old"), F.col(haplotype).alias("_h"), F.posexplode(haplotype).alias("_place", "_member"))
    often = postings.groupBy("_member").agg(F.count(F.lit(1)).alias("_n"))
    asked = old_only.select(haplotype).distinct()
    own = asked.select(haplotype, F.posexplode(haplotype).alias("_at", "_member")).join(often, "_member", "left")
    rarest = own.groupBy(haplotype).agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_at").alias("at"), F.col("_member").alias("member"))).alias("_r"))
    keyed = rarest.where("_r.n > 0").select(haplotype, F.col("_r.at").alias("_at"), F.col("_r.member").alias("_member"))
    begin = F.col("_place") - F.col("_at")
    around = F.slice("_h", F.greatest(begin, F.lit(0)) + 1, F.size(haplotype))
    met = keyed.join(postings, "_member").where((F.size("_h") > F.size(haplotype)) & (begin >= 0) & (around == F.col(haplotype)))
    parts = met.groupBy(haplotype).agg(F.bool_or("_old").alias("in_both"), F.bool_or(~F.col("_old")).alias("in_new_only"))
    found = asked.join(parts, haplotype, "left")
    return found.select(haplotype, F.coalesce("in_both", F.lit(False)).alias("in_both"), F.coalesce("in_new_only", F.lit(False)).alias("in_new_only"))


def composition(new_only: DataFrame, old_members: DataFrame, haplotype: str = "haplotype") -> DataFrame:
    """Whether a new-only haplotype's members are all, partly or not among the old catalog's (column member)."""
    members = new_only.select(haplotype, F.explode(F.array_distinct(haplotype)).alias("member"))
    known = members.join(old_members.select("member").distinct().withColumn("_in", F.lit(True)), "member", "left")
    by = known.groupBy(haplotype).agg(F.count("_in").alias("k"), F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("k") == F.col("n"), "all_in_old").when(F.col("k") == 0, "novel").otherwise("mixed")
    return by.select(haplotype, kind.alias("composition"), F.size(haplotype).alias("length"))


def haplotypes_of(sequences: DataFrame, contigs: list[str], source: str = "HGDP_haplotype") -> DataFrame:
    """An index's haplotypes on contigs as a catalog: haplotype (variants as text), n, sequence and overlaps; of rows with equal variants the one with the greatest count."""
    rows = sequences.where((F.col("source") == source) & F.col("contig").isin(contigs))
    best = rows.groupBy("variants").agg(F.max(F.struct(F.col("popmax_empirical_AC").alias("n"), "sequence")).alias("b"))
    return best.select(F.split("variants", ",").alias("haplotype"), F.col("b.n").alias("n"), F.col("b.sequence").alias("sequence"), overlapping(by_position(parse(F.col("variants")))).alias("overlaps"))


def shared_sequences(old: DataFrame, new: DataFrame, haplotype: str = "haplotype") -> DataFrame:
    """metric, value: shared haplotypes by whether their variants overlap (column overlaps of new) and their sequences (column sequence) are the same.

    Without overlap the sequences must be equal; with one, other ways to compose may differ.
    """
    both = old.select(haplotype, F.col("sequence").alias("_old")).join(new.select(haplotype, "sequence", "overlaps"), haplotype)
    same, over = F.col("sequence").eqNullSafe(F.col("_old")), F.col("overlaps")
    cells = {
        "shared_independent_seq_match": ~over & same,
        "shared_independent_seq_mismatch": ~over & ~same,
        "shared_overlapping_seq_match": over & same,
        "shared_overlapping_seq_differ": over & ~same,
    }
    return both.agg(*[F.count_if(c).alias(k) for k, c in cells.items()]).unpivot([], list(cells), "metric", "value")


def summary(old: DataFrame, new: DataFrame, members: DataFrame, haplotype: str = "haplotype", count: str = "n", new_on_x: DataFrame | None = None) -> DataFrame:
    """metric, value of all comparisons of two catalogs; members: the old catalog's variants (column member).

    new_on_x: haplotypes of the new catalog on chrX, which stand beside the comparison and are counted only.
    """
    compared = overlap(old, new, haplotype, count)
    names = {"count_same": "shared_same_ac", "new_higher": "shared_new_higher_ac", "new_lower": "shared_old_higher_ac"}
    counts = count_changes(compared).replace(names, subset="metric")
    only = lambda side, other: side.join(other.select(haplotype), haplotype, "left_anti")
    a, b = F.col("in_both"), F.col("in_new_only")
    within = enclosed(only(old, new), old, new, haplotype).agg(
        F.count_if(a | b).alias("old_only_subfragment_of_new"),
        F.count_if(a).alias("old_only_subfragment_both_have_longer"),
        F.count_if(b & ~a).alias("old_only_subfragment_only_new_has_longer"),
        F.count_if(~a & ~b).alias("old_only_not_subfragment"),
    )
    kind, length = F.col("composition"), F.col("length")
    made = composition(only(new, old), members, haplotype).agg(
        F.count_if(kind == "all_in_old").alias("new_only_all_variants_in_old"),
        F.count_if(kind == "mixed").alias("new_only_mixed_variants"),
        F.count_if(kind == "novel").alias("new_only_all_novel"),
        F.count_if((kind == "novel") & (length == 2)).alias("new_only_all_novel_length_2"),
        F.coalesce(F.max(F.when(kind == "novel", length)), F.lit(0)).cast("long").alias("new_only_all_novel_max_length"),
    )
    tall = lambda one: one.unpivot([], one.columns, "metric", "value")
    out = counts.unionByName(tall(within)).unionByName(tall(made)).unionByName(shared_sequences(old, new, haplotype))
    return out if new_on_x is None else out.unionByName(new_on_x.agg(F.lit("new_chrX_haplotypes").alias("metric"), F.count(F.lit(1)).alias("value")))


def novel_lengths(new_only: DataFrame) -> DataFrame:
    """length, n of haplotypes without a known variant, from composition()."""
    return new_only.where("composition = 'novel'").groupBy("length").agg(F.count(F.lit(1)).alias("n"))


def release_join(ours: DataFrame, release: DataFrame, key: str, pops: list[str]) -> DataFrame:
    """ours with the release's columns and status: 'in_release' unless all of the release's frequencies (new_<pop>) are missing.

    ours has af_<pop>, popmax_AF, popmax_AC and maxpop; the release new_<pop>, new_popmax_AN and new_maxpop. Missing
    frequencies of either table are 0, those of variants that it lacks stay missing.
    """
    zero = lambda df, names: df.withColumns({n: F.coalesce(n, F.lit(0.0)) for n in names})
    both = zero(ours, [f"af_{p}" for p in pops]).join(zero(release, [f"new_{p}" for p in pops]), key, "left")
    none = F.lit(True)
    for p in pops:
        none = none & F.col(f"new_{p}").isNull()
    return both.withColumn("status", F.when(none, "not_in_release").otherwise("in_release"))


def release_changes(joined: DataFrame, key: str, pops: list[str], least: float = 0.001) -> DataFrame:
    """key, maxpop_status, an_change and large_af of variants in the release.

    maxpop_status: 'other' where the release's greatest population is none of pops (or missing), else 'same' or
    'differs'. an_change, for the same population only, is its allele number less ours, which is the ceiling of AC by AF.
    large_af: populations whose frequencies differ by `least` or more, joined by commas.
    """
    far = [F.when(F.abs(F.col(f"new_{p}") - F.col(f"af_{p}")) >= least, F.lit(p)) for p in pops]
    status = F.when(~F.coalesce(F.col("new_maxpop").isin(pops), F.lit(False)), "other").when(F.col("maxpop") == F.col("new_maxpop"), "same").otherwise("differs")
    own = F.when(F.col("popmax_AF") > 0, F.ceil(F.col("popmax_AC") / F.col("popmax_AF")))
    return joined.where("status = 'in_release'").select(
        key,
        status.alias("maxpop_status"),
        F.when(status == "same", F.col("new_popmax_AN") - own).cast("long").alias("an_change"),
        F.array_join(F.array_compact(F.array(*far)), ",").alias("large_af"),
    )


def frequency_changes(old: DataFrame, new: DataFrame, key: str, pops: list[str], least: float = 0.001) -> DataFrame:
    """key, pop, old_af, new_af of frequencies (columns af_<pop>) that differ by `least` or more."""
    long = lambda df, name: df.unpivot([key], [f"af_{p}" for p in pops], "pop", name)
    both = long(old, "old_af").join(long(new, "new_af"), [key, "pop"])
    return both.where(F.abs(F.col("new_af") - F.col("old_af")) >= least).withColumn("pop", F.expr("substring(pop, 4)"))


def exclusion_bucket(present: Column, exome_filters: Column, genome_filters: Column, max_af: Column, threshold: float) -> Column:
    """Why a release lacks a variant. A frequency below the threshold comes before any filter; missing sets are empty, a missing frequency is 0."""
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    exomes, genomes, rare = some(exome_filters), some(genome_filters), F.coalesce(max_af, F.lit(0.0)) < threshold
    named = dict(zip(("absent", "rare", "exomes", "genomes", "both", "none"), BUCKETS, strict=True))
    return (
        F.when(~F.coalesce(present, F.lit(False)), named["absent"])
        .when(rare, named["rare"])
        .when(exomes & genomes, named["both"])
        .when(exomes, named["exomes"])
        .when(genomes, named["genomes"])
        .otherwise(named["none"])
    )


def filter_codes(explained: DataFrame, top: int = 15) -> DataFrame:
    """bucket, exomes, genomes and n: the most common pairs of filter sets (sorted, joined by commas) of each bucket with filters or rarity."""
    text = lambda c: F.array_join(F.array_sort(F.coalesce(F.col(c), F.array().cast("array<string>"))), ",")
    rows = explained.where(~F.col("bucket").isin(BUCKETS[0], BUCKETS[-1]))
    counts = rows.groupBy("bucket", text("exome_filters").alias("exomes"), text("genome_filters").alias("genomes")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("bucket").orderBy(F.desc("n"), "exomes", "genomes")
    return counts.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= top).drop("_k")


#: Lower bounds of the bands of allele numbers.
AN_BANDS = {"0": 0, "1-99": 1, "100-9999": 100, "10000-99999": 10_000, "100000+": 100_000}


def an_band(an: Column) -> Column:
    """The band of an allele number; a missing one is 0."""
    out = F.lit(next(iter(AN_BANDS)))
    for name, low in list(AN_BANDS.items())[1:]:
        out = F.when(F.coalesce(an, F.lit(0)) >= low, name).otherwise(out)
    return out


def ac0_coverage(explained: DataFrame) -> DataFrame:
    """band, n: exome allele numbers of variants that exomes flag with AC0 and genomes pass."""
    ac0 = F.coalesce(F.array_contains("exome_filters", "AC0"), F.lit(False)) & F.coalesce(F.size("genome_filters") == 0, F.lit(True))
    return explained.where(ac0).groupBy(an_band(F.col("exome_AN")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


def completed(counts: DataFrame, levels: dict[str, list[str]], value: str) -> DataFrame:
    """counts with a row for each combination of the levels of its columns, 0 where there was none; other rows stay.

    levels are lists of names that the caller gives, so the grid is small whatever the data.
    """
    grid = counts.sparkSession.range(1)
    for name, own in levels.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(x) for x in own])))
    both = grid.drop("id").join(counts, list(levels), "full")
    return both.withColumn(value, F.coalesce(value, F.lit(0).cast("long")))


def bucket_quantiles(explained: DataFrame, pops: list[str]) -> DataFrame:
    """bucket, pop, n, least, p10, p50, p90 and greatest of the populations' frequencies (columns af_<pop>, missing is 0), for buckets of present variants."""
    rows = explained.where(~F.col("bucket").isin(BUCKETS[0], BUCKETS[-1])).select("bucket", *[f"af_{p}" for p in pops])
    long = rows.unpivot(["bucket"], [f"af_{p}" for p in pops], "pop", "af").select("bucket", F.expr("substring(pop, 4)").alias("pop"), F.coalesce("af", F.lit(0.0)).alias("af"))
    ends = long.groupBy("bucket", "pop").agg(F.count(F.lit(1)).alias("n"), F.min("af").alias("least"), F.max("af").alias("greatest"))
    return ends.join(nearest_rank(long, ["bucket", "pop"], "af"), ["bucket", "pop"])


def nearest_rank(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """10th, 50th and 90th percentiles by nearest rank: the sorted values at n // 10, n // 2 and min(n - 1, 9 n // 10).

    Values are counted first, so a group's sort sees distinct values only.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_k"))
    by = Window.partitionBy(*keys)
    run = by.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_upto", F.sum("_k").over(run)).withColumn("_n", F.sum("_k").over(by))
    at = {"p10": "_n div 10", "p50": "_n div 2", "p90": "least(_n - 1, 9 * _n div 10)"}
    return ranked.groupBy(*keys).agg(*[F.min(F.when(F.col("_upto") > F.expr(e), F.col(value))).alias(n) for n, e in at.items()])


def histogram(df: DataFrame, keys: list[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts by bin (1 to bins; 0 and bins + 1 lie outside)."""
    return df.groupBy(*keys, F.expr(f"width_bucket({value}, {low}D, {high}D, {bins})").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def threshold_edge(parents: DataFrame, case: list[int]) -> DataFrame:
    """Fragments of parent blocks that contain a haplotype and more, with the number of blocks that have them."""
    wanted = F.array(*[F.lit(k).cast("long") for k in case])
    frags = parents.where(F.size(F.array_intersect("parent", wanted)) == len(case)).select(F.explode(slices(F.col("parent"))).alias("haplotype"))
    wider = frags.where((F.size("haplotype") > len(case)) & F.exists(slices(F.col("haplotype"), len(case)), lambda x: x == wanted))
    return wider.groupBy("haplotype").agg(F.count(F.lit(1)).alias("n_blocks"))


def edge_metrics(parents: DataFrame, cases: DataFrame, stats: DataFrame, sites: DataFrame, n_pops: int) -> DataFrame:
    """Metrics by population of the longer fragments around some haplotypes, from their blocks alone: case, haplotype, pop, ac, empirical_af, fraction_phased, estimated_af.

    parents: pop and parent; cases: haplotype, an array of two row_idx or more; stats: row_idx, pop, AN, AF; sites: row_idx, pop, af.
    A block that has a longer fragment has the case in it, so counts over those blocks are the whole counts. A population
    counts only where all members have statistics and some called allele; without local frequency the last two are null.
    Blocks are found by the first member of a case.
    """
    asked = cases.select(F.col("haplotype").alias("case")).distinct().withColumn("member", F.element_at("case", 1))
    placed = parents.select("pop", "parent", F.posexplode("parent").alias("at", "member")).join(asked, "member")
    size = F.size("case")
    around = placed.where(F.slice("parent", F.col("at") + 1, size) == F.col("case")).where(F.size("parent") > size)
    starts = F.sequence(F.lit(0), F.col("at"))
    stops = F.sequence(F.col("at") + size, F.size("parent"))
    wider = F.flatten(F.transform(starts, lambda i: F.transform(F.filter(stops, lambda j: j - i > size), lambda j: F.slice("parent", i + 1, j - i))))
    fragments = around.select("case", "pop", F.explode(wider).alias("haplotype"))
    counts = [F.count_if(F.col("pop") == p).alias(f"_{p}") for p in range(n_pops)]
    counted = fragments.groupBy("case", "haplotype").agg(*counts)
    by_pop = F.explode(F.array(*[F.struct(F.lit(p).alias("pop"), F.col(f"_{p}").alias("ac")) for p in range(n_pops)])).alias("c")
    cells = counted.select("case", "haplotype", by_pop).select("case", "haplotype", "c.pop", "c.ac", F.explode("haplotype").alias("row_idx"))
    known = stats.select("row_idx", "pop", "AN", F.col("AF").alias("_local")).join(sites.select("row_idx", "pop", "af"), ["row_idx", "pop"])
    least = cells.join(known, ["row_idx", "pop"]).groupBy("case", "haplotype", "pop", "ac").agg(
        F.count(F.lit(1)).alias("_n"), F.min("AN").alias("_an"), F.min("_local").alias("_local"), F.min("af").alias("_af")
    )
    own = least.where((F.col("_n") == F.size("haplotype")) & (F.col("_an") > 0)).withColumn("empirical_af", F.col("ac").cast("double") / F.col("_an"))
    own = own.withColumn("fraction_phased", F.when(F.col("_local") > 0, F.col("empirical_af") / F.col("_local")))
    return own.select("case", "haplotype", "pop", "ac", "empirical_af", "fraction_phased", (F.col("_af") * F.col("fraction_phased")).alias("estimated_af"))
