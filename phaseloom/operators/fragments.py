"""Fragments of blocks as keys: counts, metrics and redundancy of all contiguous runs without their arrays.

A run's key is the exclusive or of its members' 128-bit hashes, got from prefixes of its block, with its length. Members of a run come
in one order, so equal sets are equal runs. Arrays are made for those runs alone that remain at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phaseloom.operators.haplotypes import ranked
from phaseloom.storage import by_shuffle

KEY = ["k1", "k2", "n"]
#: Runs that one Arrow batch holds, about.
BATCH = 20_000


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """64 bits that look random for each number."""
    x = (x.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefixes(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the first 0 to all members."""
    return tuple(np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(_mixed(members, seed))]).astype(np.int64) for seed in (1, 1 << 40))


def distinct_blocks(parents: DataFrame, n_pops: int) -> DataFrame:
    """p1, p2, parent and counts (by population) of each distinct parent block."""
    counts = [F.count_if(F.col("pop") == p).alias(f"_{p}") for p in range(n_pops)]
    blocks = parents.groupBy("parent").agg(*counts).select("parent", F.array(*[F.col(f"_{p}") for p in range(n_pops)]).alias("counts"))

    def keyed(batches):
        for b in batches:
            ends = [[int(k[-1]) for k in _prefixes(np.array(m, np.int64))] for m in b.column("parent").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in ends], pa.int64()), pa.array([e[1] for e in ends], pa.int64()), b.column("parent"), b.column("counts")], ["p1", "p2", "parent", "counts"])

    return blocks.mapInArrow(keyed, "p1 long, p2 long, parent array<long>, counts array<long>")


def with_values(blocks: DataFrame, stats: DataFrame, sites: DataFrame, n_pops: int) -> DataFrame:
    """blocks with `values`: for each member AN, AF and site AF by population, one after the other; what is missing is NaN.

    stats: row_idx, pop, AN, AF; sites: row_idx, pop, af.
    """
    cells = stats.select("row_idx", "pop", "AN", "AF").join(sites.select("row_idx", "pop", "af"), ["row_idx", "pop"], "full")
    nan = F.lit(float("nan"))
    own = [F.coalesce(F.min(F.when(F.col("pop") == p, F.col(c).cast("double"))), nan) for p in range(n_pops) for c in ("AN", "AF", "af_")]
    wide = cells.toDF("row_idx", "pop", "AN", "AF", "af_").groupBy("row_idx").agg(F.array(*own).alias("v"))
    members = blocks.select("p1", "p2", F.posexplode("parent").alias("at", "row_idx")).join(by_shuffle(wide), "row_idx", "left")
    none = F.array(*[nan] * (3 * n_pops))
    listed = members.groupBy("p1", "p2").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("v", none).alias("v")))).alias("m"))
    return blocks.join(by_shuffle(listed.select("p1", "p2", F.flatten(F.transform("m", lambda x: x["v"])).alias("values"))), ["p1", "p2"])


def _batches(rows):
    """Puts column blocks (lists of arrays of equal length) together to batches of some size."""
    kept, n = [], 0
    for cols in rows:
        kept.append(cols)
        n += len(cols[0])
        if n >= BATCH:
            yield [np.concatenate(c) for c in zip(*kept, strict=True)]
            kept, n = [], 0
    if kept:
        yield [np.concatenate(c) for c in zip(*kept, strict=True)]


def counted(blocks: DataFrame, n_pops: int) -> DataFrame:
    """k1, k2, n of each run of two members or more, with per_pop_AC and c, the members' least AN, AF and site AF by population.

    Least values run along each block from every start; equal runs have equal ones, so they meet as numbers only,
    with map-side combining.
    """
    width = 3 * n_pops

    def runs(batches):
        def each(b):
            for parent, counts, values in zip(*(b.column(c).to_pylist() for c in ("parent", "counts", "values")), strict=True):
                a, z = _prefixes(np.array(parent, np.int64))
                v = np.array(values, np.float64).reshape(-1, width)
                size = len(parent)
                for i in range(size - 1):
                    n = size - i - 1
                    least = np.fmin.accumulate(v[i:], axis=0)[1:]
                    yield [a[i + 2 :] ^ a[i], z[i + 2 :] ^ z[i], np.arange(2, n + 2, dtype=np.int32), *np.repeat(np.array(counts, np.int64)[:, None], n, axis=1), *least.T]

        for b in batches:
            for cols in _batches(each(b)):
                arrays = [pa.array(c) if k < 3 + n_pops else pa.array(c, from_pandas=True) for k, c in enumerate(cols)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = [*KEY, *[f"c{p}" for p in range(n_pops)], *[f"m{k}" for k in range(width)]]
    schema = "k1 long, k2 long, n int, " + ", ".join([f"c{p} long" for p in range(n_pops)] + [f"m{k} double" for k in range(width)])
    rows = blocks.select("parent", "counts", "values").mapInArrow(runs, schema)
    sums = rows.groupBy(*KEY).agg(*[F.sum(f"c{p}").alias(f"c{p}") for p in range(n_pops)], *[F.min(f"m{k}").alias(f"m{k}") for k in range(width)])
    cell = lambda p: F.struct(F.lit(p).alias("pop"), F.col(f"m{3 * p}").alias("min_AN"), F.col(f"m{3 * p + 1}").alias("min_AF"), F.col(f"m{3 * p + 2}").alias("min_site"))
    return sums.select(*KEY, F.array(*[F.col(f"c{p}") for p in range(n_pops)]).alias("per_pop_AC"), F.array(*[cell(p) for p in range(n_pops)]).alias("c"))


def metrics(counts: DataFrame) -> DataFrame:
    """Metrics by population of counted() runs, as component_metrics() has them."""
    return ranked(counts, KEY)


def _places(blocks: DataFrame) -> DataFrame:
    """Every run of every distinct block: its key, p1, p2 of the block, and i, its first member's place."""

    def runs(batches):
        def each(b):
            for p1, p2, parent in zip(*(b.column(c).to_pylist() for c in ("p1", "p2", "parent")), strict=True):
                a, z = _prefixes(np.array(parent, np.int64))
                for i in range(len(parent) - 1):
                    n = len(parent) - i - 1
                    yield [a[i + 2 :] ^ a[i], z[i + 2 :] ^ z[i], np.arange(2, n + 2, dtype=np.int32), np.full(n, p1), np.full(n, p2), np.full(n, i, np.int32)]

        for b in batches:
            for cols in _batches(each(b)):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], [*KEY, "p1", "p2", "i"])

    return blocks.select("p1", "p2", "parent").mapInArrow(runs, "k1 long, k2 long, n int, p1 long, p2 long, i int")


def without_contained(kept: DataFrame, blocks: DataFrame) -> DataFrame:
    """kept runs (by key, with per_pop_AC) that are no part of a longer kept one with the same counts, with their members as haplotype.

    If a longer run has the same counts, it surrounds the shorter one wherever that occurs. So each block is looked at
    by itself: in order of their starts, a run is contained if one that began no later, with equal counts, ends no earlier.
    """
    own = kept.select(*KEY, F.col("per_pop_AC").alias("_counts"))
    placed = _places(blocks).join(by_shuffle(own), KEY)
    end = F.col("i") + F.col("n")
    order = Window.partitionBy("p1", "p2", "_counts").orderBy("i", F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    free = placed.withColumn("_reach", F.max(end).over(order)).where(F.col("_reach").isNull() | (F.col("_reach") < end))
    one = free.groupBy(*KEY).agg(F.min(F.struct("p1", "p2", "i")).alias("at")).select(*KEY, "at.p1", "at.p2", "at.i")
    found = kept.join(by_shuffle(one), KEY).join(by_shuffle(blocks.select("p1", "p2", "parent")), ["p1", "p2"])
    return found.withColumn("haplotype", F.slice("parent", F.col("i") + 1, F.col("n"))).drop(*KEY, "p1", "p2", "i", "parent")
