"""Runs of blocks as keys against the operators that make all arrays, and lookups of haplotypes by postings, by brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from phaseloom.operators import blocks, fragments, haplotypes
from phaseloom.plans import compare

PARENTS, STATS, SITES = "pop int, parent array<bigint>", "row_idx bigint, pop int, AN bigint, AF double", "row_idx bigint, pop int, af double"


def _made(spark, seed, n_blocks, longest, n_members, n_pops):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n_blocks):
        start = int(rng.integers(0, n_members - 2))
        size = int(rng.integers(2, min(longest, n_members - start) + 1))
        members = [m for m in range(start, start + size) if rng.random() < 0.9] or [start]
        rows += [(int(rng.integers(0, n_pops)), members)] * int(rng.integers(1, 3)) if len(members) > 1 else []
    stats = [(m, p, int(rng.integers(0, 40)), float(rng.integers(0, 9)) / 10) for m in range(n_members) for p in range(n_pops) if rng.random() < 0.8]
    sites = [(m, p, float(rng.integers(1, 50)) / 100) for m in range(n_members) for p in range(n_pops) if rng.random() < 0.9]
    return spark.createDataFrame(rows, PARENTS), spark.createDataFrame(stats, STATS), spark.createDataFrame(sites, SITES)


@pytest.mark.parametrize(("seed", "n_blocks", "longest", "n_members"), [(1, 40, 6, 12), (2, 120, 9, 30), (3, 5, 20, 20), (4, 1, 2, 4)])
@pytest.mark.parametrize("threshold", [0.0, 0.05])
def test_keys_give_what_arrays_give(spark, seed, n_blocks, longest, n_members, threshold):
    parents, stats, sites = _made(spark, seed, n_blocks, longest, n_members, 3)
    measured = haplotypes.at_threshold(haplotypes.component_metrics(haplotypes.containment_ac(blocks.subfragments(parents), 3), stats, sites), threshold)
    want = haplotypes.without_contained(measured)
    made = fragments.with_values(fragments.distinct_blocks(parents, 3), stats, sites, 3)
    kept = haplotypes.at_threshold(fragments.metrics(fragments.counted(made, 3)), threshold)
    got = fragments.without_contained(kept, made)
    assert kept.count() == measured.count()
    show = lambda df: sorted(str([list(r["haplotype"]), list(r["per_pop_AC"]), *[r[c] for c in ("max_pop", "max_empirical_AF", "max_empirical_AC", "min_variant_frequency", "fraction_phased", "estimated_gnomad_AF", "all_pop_freqs")]]) for r in df.collect())
    assert show(got) == show(want)


def test_long_blocks_stay_small(spark):
    """All 500,000 runs of a block of 1,000, of which the block alone is left: no array of another run is made."""
    n = 1000
    parents = spark.createDataFrame([(0, list(range(n)))] * 3 + [(1, list(range(n)))], PARENTS)
    cells = spark.range(n).select(F.col("id").alias("row_idx"), F.explode(F.array(F.lit(0), F.lit(1))).alias("pop"))
    made = fragments.with_values(fragments.distinct_blocks(parents, 2), cells.select("*", F.lit(8).alias("AN"), F.lit(0.5).alias("AF")), cells.select("*", F.lit(0.25).alias("af")), 2)
    kept = haplotypes.at_threshold(fragments.metrics(fragments.counted(made, 2)), 0.0)
    assert kept.count() == n * (n - 1) // 2
    (left,) = fragments.without_contained(kept, made).collect()
    assert list(left["haplotype"]) == list(range(n)) and list(left["per_pop_AC"]) == [3, 1]


def _within(part, whole):
    return any(whole[k : k + len(part)] == part for k in range(len(whole) - len(part) + 1))


def test_enclosure_by_postings(spark):
    rng = np.random.default_rng(8)
    made = {tuple(int(x) for x in rng.integers(0, 7, rng.integers(2, 7))) for _ in range(160)}
    old, new = {h for h in made if rng.random() < 0.6}, {h for h in made if rng.random() < 0.6}
    frame = lambda hs: spark.createDataFrame([(list(h),) for h in hs], "haplotype array<bigint>")
    got = {tuple(r["haplotype"]): (r["in_both"], r["in_new_only"]) for r in compare.enclosed(frame(old - new), frame(old), frame(new)).collect()}
    longer = lambda h, among: any(len(g) > len(h) and _within(h, g) for g in among)
    assert got == {h: (longer(h, old & new), longer(h, new - old)) for h in old - new}


def test_edge_metrics(spark):
    parents, stats, sites = _made(spark, 9, 60, 7, 12, 3)
    cases = spark.createDataFrame([([3, 4],), ([5, 6, 7],), ([99, 100],), ([3, 4],)], "haplotype array<bigint>")
    rows = [(r["pop"], list(r["parent"])) for r in parents.collect()]
    stat = {(r["row_idx"], r["pop"]): (r["AN"], r["AF"]) for r in stats.collect()}
    site = {(r["row_idx"], r["pop"]): r["af"] for r in sites.collect()}
    want = {}
    for case in ([3, 4], [5, 6, 7]):
        counts: dict = {}
        for pop, parent in rows:
            for i in range(len(parent)):
                for j in range(i + len(case) + 1, len(parent) + 1):
                    if _within(case, parent[i:j]):
                        counts.setdefault(tuple(parent[i:j]), [0, 0, 0])[pop] += 1
        for h, ac in counts.items():
            for p in range(3):
                if all((m, p) in stat and (m, p) in site for m in h) and (an := min(stat[m, p][0] for m in h)) > 0:
                    local = min(stat[m, p][1] for m in h)
                    fraction = ac[p] / an / local if local else None
                    want[tuple(case), h, p] = (ac[p], ac[p] / an, fraction, None if fraction is None else min(site[m, p] for m in h) * fraction)
    out = compare.edge_metrics(parents, cases, stats, sites, 3).collect()
    assert {(tuple(r["case"]), tuple(r["haplotype"]), r["pop"]): (r["ac"], r["empirical_af"], r["fraction_phased"], r["estimated_af"]) for r in out} == want and len(out) == len(want)
