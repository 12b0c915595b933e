"""Blocks, fragments, counts, metrics, redundancy and ploidy on random rows, against a few lines of plain Python each."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from phaseloom.operators import blocks, filters, genotypes, haplotypes, ordering
from phaseloom.plans.discovery import discover
from phaseloom.schemas import CALL_STATS, CARRIERS


def _random_carriers(seed, n=400):
    """(s, pop, strand, contig, position, ref_len, row_idx) rows; positions repeat and references overlap."""
    rng = np.random.default_rng(seed)
    sites = [("chr1" if k % 3 else "chrX", int(p), int(n)) for k, (p, n) in enumerate(zip(np.cumsum(rng.integers(0, 30, 60)), rng.choice([1, 1, 2, 6, 40], 60), strict=True))]
    picked = {(int(s), int(x), int(v)) for s, x, v in zip(rng.integers(0, 6, n), rng.integers(0, 2, n), rng.integers(0, 60, n), strict=True)}
    return [(f"s{s}", s % 3, x, *sites[v], v) for s, x, v in sorted(picked)]


def _runs(rows, window):
    """Lists of rows in order, cut where a row starts `window` or more after all earlier ends."""
    out, reach = [], None
    for r in sorted(rows, key=lambda r: (r[4], r[5], r[6])):
        if reach is None or r[4] - reach >= window:
            out.append([])
        out[-1].append(r)
        reach = max(reach or 0, r[4] + r[5])
    return out


def _by(rows, key):
    out = {}
    for r in rows:
        out.setdefault(key(r), []).append(r)
    return out


def _parents(rows, window):
    strands = _by(rows, lambda r: (r[0], r[2], r[3]))
    return sorted((*k, [r[6] for r in run]) for k, own in strands.items() for run in _runs(own, window) if len(run) > 1)


def _slices(parent):
    return [tuple(parent[i:j]) for i in range(len(parent)) for j in range(i + 2, len(parent) + 1)]


@pytest.mark.parametrize(("seed", "window"), [(1, 5), (2, 25), (3, 1), (4, 200)])
def test_parent_blocks(spark, seed, window):
    rows = _random_carriers(seed)
    df = spark.createDataFrame(rows, CARRIERS)
    found = lambda d: sorted((r["s"], r["strand"], r["contig"], list(r["parent"])) for r in blocks.parent_blocks(d, window).collect())
    assert found(df) == _parents(rows, window)
    # cutting by locus group first changes nothing
    sites = df.select("contig", "position", "ref_len", "row_idx").distinct()
    grouped = blocks.multi_member_groups(blocks.locus_groups(sites, window))
    assert found(df.join(grouped.select("row_idx", "locus_group"), "row_idx")) == _parents(rows, window)


@pytest.mark.parametrize("window", [3, 12])
def test_locus_groups(spark, window):
    rows = _random_carriers(9, 2000)
    sites = sorted({r[3:] for r in rows})
    out = blocks.locus_groups(spark.createDataFrame(sites, "contig string, position int, ref_len int, row_idx long"), window).collect()
    want = {}
    for contig, own in _by(sites, lambda r: r[0]).items():
        for k, run in enumerate(_runs([(0, 0, 0, *r) for r in own], window), 1):
            want |= {r[6]: (contig, k) for r in run}
    assert {r["row_idx"]: (r["contig"], r["locus_group"]) for r in out} == want
    sizes = Counter(want.values())
    kept = blocks.multi_member_groups(spark.createDataFrame([(k, *v) for k, v in want.items()], "row_idx long, contig string, locus_group long"))
    assert {r["row_idx"] for r in kept.collect()} == {k for k, v in want.items() if sizes[v] > 1}


def test_numbers_in_order(spark):
    rng = np.random.default_rng(0)
    rows = [("ab"[k % 2], int(v), k) for k, v in enumerate(rng.permutation(500))]
    df = spark.createDataFrame(rows, "c string, v long, k long")
    out = {r["k"]: r["idx"] for r in ordering.numbered(df, ["v"], offset=10).collect()}
    assert out == {k: 10 + v for _, v, k in rows}
    out = {r["k"]: r["idx"] for r in ordering.numbered(df, ["v"], by=("c",)).collect()}
    assert out == {k: sum(w < v for d, w, _ in rows if d == c) for c, v, k in rows}
    assert ordering.numbered(df.limit(0), ["v"]).count() == 0


def test_fragments_and_counts(spark):
    parents = [(pop, [int(x) for x in np.random.default_rng(k).permutation(5)[: k % 5 + 1]]) for k, pop in enumerate([0, 1, 1, 2, 0, 2] * 8)]
    df = spark.createDataFrame(parents, "pop int, parent array<bigint>")
    frags = blocks.subfragments(df)
    assert sorted((r["pop"], tuple(r["haplotype"])) for r in frags.collect()) == sorted((p, s) for p, parent in parents for s in _slices(parent))
    want = {}
    for p, parent in parents:
        for s in _slices(parent):
            want.setdefault(s, [0, 0, 0])[p] += 1
    assert {tuple(r[0]): list(r[1]) for r in haplotypes.containment_ac(frags, 3).collect()} == want


def _least(values):
    return min((v for v in values if v is not None), default=None)


def _metrics(haplotype, ac, stats, sites):
    """(pop, AC, empirical AF, phased, estimate, least local AF) of every population, in order of empirical AF, missing last."""
    rows = []
    for pop, count in enumerate(ac):
        own = [stats.get((v, pop), (None, None)) for v in haplotype]
        an, af, site = _least(x[0] for x in own), _least(x[1] for x in own), _least(sites.get((v, pop)) for v in haplotype)
        e = count / an if an else None
        fp = e / af if e is not None and af else None
        rows.append((pop, count, e, fp, None if fp is None or site is None else site * fp, af))
    return sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))


def test_metrics(spark):
    rng = np.random.default_rng(6)
    cell = lambda: [(int(v), int(p)) for v in range(8) for p in range(4) if rng.random() < 0.8]
    stats = {k: (int(rng.choice([0, 10, 20, 50])), float(rng.choice([0.0, 0.1, 0.2, 0.5]))) for k in cell()}
    sites = {k: None if rng.random() < 0.1 else float(rng.integers(1, 9)) / 10 for k in cell()}
    haps = {tuple(int(v) for v in rng.permutation(9)[:n]): [int(x) for x in rng.integers(0, 4, 4)] for n in (2, 3, 4, 2, 3, 2, 5)} | {(8, 9): [1, 1, 1, 1]}
    out = haplotypes.component_metrics(
        spark.createDataFrame([(list(h), ac) for h, ac in haps.items()], "haplotype array<bigint>, per_pop_AC array<bigint>"),
        spark.createDataFrame([(*k, *x) for k, x in stats.items()], "row_idx bigint, pop int, AN bigint, AF double"),
        spark.createDataFrame([(*k, x) for k, x in sites.items()], "row_idx bigint, pop int, af double"),
    ).collect()
    assert {tuple(r["haplotype"]): list(r["per_pop_AC"]) for r in out} == haps
    for r in out:
        want = _metrics(r["haplotype"], r["per_pop_AC"], stats, sites)
        assert [tuple(f) for f in r["all_pop_freqs"]] == [pytest.approx(w[:5]) for w in want]
        best = want[0] if want[0][2] is not None else (None,) * 6
        got = (r["max_pop"], r["max_empirical_AC"], r["max_empirical_AF"], r["fraction_phased"], r["estimated_gnomad_AF"], r["min_variant_frequency"])
        assert got == pytest.approx(best)
    kept = haplotypes.at_threshold(spark.createDataFrame(out), 0.3).collect()
    assert {tuple(r["haplotype"]) for r in kept} == {tuple(r["haplotype"]) for r in out if (r["min_variant_frequency"] or 0) > 0 and (r["estimated_gnomad_AF"] or 0) >= 0.3}


def test_redundant_haplotypes_go(spark):
    rng = np.random.default_rng(8)
    haps = {}
    for _ in range(120):
        first, n = rng.integers(0, 6), rng.integers(2, 6)
        haps[tuple(range(first, first + n)) if rng.random() < 0.8 else tuple(int(x) for x in rng.permutation(8)[:n])] = [int(x) for x in rng.integers(0, 2, 2)]
    within = lambda a, b: len(a) < len(b) and any(b[k : k + len(a)] == a for k in range(len(b)))
    want = {h for h, ac in haps.items() if not any(within(h, g) and haps[g] == ac for g in haps)}
    df = spark.createDataFrame([(list(int(x) for x in h), ac) for h, ac in haps.items()], "haplotype array<bigint>, per_pop_AC array<bigint>")
    once = haplotypes.without_contained(df)
    assert {tuple(r["haplotype"]) for r in once.collect()} == want and len(want) < len(haps)
    assert haplotypes.without_contained(once).count() == len(want)


def test_ploidy(spark):
    places = [("chrX", 40_000_000), ("chrX", 2_000_000), ("chrX", filters.PAR1_END), ("chrX", filters.PAR1_END + 1), ("chrX", filters.PAR2_START), ("chr7", 40_000_000)]
    rows = [(c, p, k, a, b) for c, p in places for k in ("XX", "XY", None) for a in (0, 1, None) for b in (0, 1, None)]
    df = spark.createDataFrame(rows, "contig string, position int, k string, a tinyint, b tinyint")
    calls = df.select("contig", "position", genotypes.haploid_adjusted(F.col("contig"), F.col("position"), F.struct("a", "b"), F.col("k")).alias("gt"))
    out = {(r["contig"], r["position"]): (r["AC"], r["AN"], r["homozygote_count"], r["AF"]) for r in genotypes.call_stats(calls, ["contig", "position"]).collect()}
    want = {}
    for c, p in places:
        one = lambda k: c == "chrX" and filters.PAR1_END < p < filters.PAR2_START and k == "XY"
        pairs = [(a, None if one(k) else b) for d, q, k, a, b in rows if (d, q) == (c, p)]
        seen = [x for pair in pairs for x in pair if x is not None]
        want[c, p] = (sum(seen), len(seen), sum(pair == (1, 1) for pair in pairs), sum(seen) / len(seen))
    assert out == want


def test_two_callset_filter(spark):
    sets = [None, [], ["AC0"], ["AS_VQSR"], ["InbreedingCoeff", "AC0"]]
    rows = [(k, e, g) for k, (e, g) in enumerate((e, g) for e in sets for g in sets)]
    df = spark.createDataFrame(rows, "k int, e array<string>, g array<string>")
    want = {k for k, e, g in rows if not g and not set(e or []) - {"AC0"}}
    assert {r["k"] for r in df.where(filters.passes_both(F.col("e"), F.col("g"))).collect()} == want


def test_discover(spark):
    """Three samples: only the first two variants stand close enough together, on copies of two samples."""
    calls = {210: [(1, 1), (0, 1), (0, 0)], 225: [(1, 0), (0, 1), (0, 0)], 900: [(0, 0), (0, 0), (1, 1)]}
    rows = spark.createDataFrame([("chr3", p, "G", "C", c) for p, c in calls.items()], "contig string, position int, ref string, alt string, gt array<struct<a:tinyint,b:tinyint>>")
    samples = spark.createDataFrame([(0, "s0", "afr", "XX"), (1, "s1", "eas", "XY"), (2, "s2", "afr", "XX")], "ordinal int, s string, pop string, sex_karyotype string")
    freq = [(1, 0.5, 2, 0), (1, 0.25, 4, 0)]
    sites = spark.createDataFrame([("chr3", p, "G", "C", freq) for p in calls], f"contig string, position int, ref string, alt string, pop_freqs array<{CALL_STATS}>")
    row = discover(rows, samples, sites, ["afr", "eas"], 25, 0.1, 0.0).collect()
    assert len(row) == 1
    assert (list(row[0]["haplotype"]), list(row[0]["per_pop_AC"])) == ([0, 1], [1, 1])
    assert [v["position"] for v in row[0]["variants"]] == [210, 225]
    assert row[0]["max_pop"] == 1  # 1 of 2 alleles
    with pytest.raises(ValueError, match="no variants"):
        discover(rows, samples, sites, ["afr", "eas"], 25, 0.9, 0.0)
