"""Near-duplicate documents: banded MinHash candidates, Bayesian pruning, exact confirmation."""

from __future__ import annotations

from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phaseloom.llm.common import join_spread, stored
from phaseloom.llm.components import components
from phaseloom.llm.shingles import band_keys, digest, shingle_sets, signatures
from phaseloom.llm.tokens import blocks, tidy

#: Node ids up to this many (8 bytes each) are broadcast to find their texts; beyond it the join is shuffled.
BROADCAST_NODES = 2_000_000
BLOCK = 1 << 20  # bytes of text that are shingled at a time
SKETCH = 1 << 20  # counters of the shingle frequencies that order the prefix filter


@dataclass(frozen=True)
class Near:
    """Links hold at `percent` or more; a pair at that similarity shares no band with probability (1 - s^rows)^bands, 4e-5 here."""

    percent: int = 85
    width: int = 5
    bands: int = 32
    rows: int = 8
    batch: int = 32  # signature values compared before each pruning decision
    miss: float = 1e-5  # a pair goes once the posterior probability of a link is below
    seed: int = 11


def least_matches(near: Near) -> list[tuple[int, int]]:
    """(values compared, matches needed to go on) for each batch.

    Values are kept as 8 bits, so they agree with probability q = s + (1 - s) / 256. With a uniform prior, the
    posterior of q after m matches of n is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum.
    """
    s = near.percent / 100
    q = s + (1 - s) / 256
    out = []
    for n in range(near.batch, near.bands * near.rows + 1, near.batch):
        tail, need = 0.0, 0
        for m in range(n + 1):
            tail += comb(n + 1, m) * q**m * (1 - q) ** (n + 1 - m)
            if tail >= near.miss:
                need = m
                break
        out.append((n, need))
    return out


#: Rows without doc_id are told by their texts: ids from here on are made of 62 bits of a text's hash.
MADE_IDS = 1 << 62


def _id(docs: DataFrame) -> Column:
    made = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).bitwiseAND(F.lit(MADE_IDS - 1)) + F.lit(MADE_IDS)
    return F.coalesce(docs["doc_id"].cast("long"), made)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, made from the text where it is null, and text."""
    return docs.select(_id(docs).alias("doc_id"), docs["text"].cast("string").alias("text"))


def _given(doc_id: str) -> Column:
    """An id, null if it was made."""
    return F.when(F.col(doc_id) < MADE_IDS, F.col(doc_id))


def signed(docs: DataFrame, near: Near) -> DataFrame:
    """doc_id, n_shingles, set_digest, bands and signature (8 bits a value) of every whole text; nulls where the set is empty."""

    def sign(batches):
        for b in blocks(batches, "text", BLOCK):
            sets = shingle_sets(b.column("text"), near.width)
            full = [k for k, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            sigs: list = [None] * len(sets)
            if full:
                values = signatures([sets[k] for k in full], near.bands * near.rows, near.seed)
                for k, own, sig in zip(full, band_keys(values, near.bands, near.rows), values.astype(np.uint8), strict=True):
                    keys[k], sigs[k] = own, sig.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sigs, pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_digest", "bands", "sig"],
            )
        tidy()

    schema = "doc_id long, n_shingles long, set_digest binary, bands array<long>, sig binary"
    return docs.mapInArrow(sign, schema)


def _likely(pairs: DataFrame, nodes: DataFrame, near: Near) -> DataFrame:
    """Pairs that survive the comparison of their signatures, batch by batch."""
    steps = least_matches(near)

    def prune(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("sig_a", "sig_b"))
            alive, matches, done = np.arange(b.num_rows), np.zeros(b.num_rows, np.int64), 0
            for n, need in steps:
                matches[alive] += (x[alive, done:n] == y[alive, done:n]).sum(1)
                alive, done = alive[matches[alive] >= need], n
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(alive)), b.column("b").take(pa.array(alive))], ["a", "b"])

    sigs = nodes.select("node", "sig")
    both = pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b")
    return both.mapInArrow(prune, "a long, b long")


def _sets_of(docs: DataFrame, wanted: DataFrame, near: Near) -> DataFrame:
    """Shingle sets of the wanted nodes (a column doc_id), from their whole texts."""

    def sets(batches):
        for b in blocks(batches, "text", BLOCK):
            own = shingle_sets(b.column("text"), near.width)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s.tobytes() for s in own], pa.binary())], ["node", "shingles"])
        tidy()

    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_NODES else wanted
    found = docs.join(wanted, "doc_id", "left_semi").mapInArrow(sets, "node long, shingles binary")
    return stored(found, "near-sets")


def _linked(pairs: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """Pairs whose full sets meet the threshold, in whole numbers."""

    def confirm(batches):
        for b in batches:
            keep = []
            for k, (x, y) in enumerate(zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= near.percent * (len(x) + len(y) - both):
                    keep.append(k)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("a").take(at), b.column("b").take(at)], ["a", "b"])
        tidy()

    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return both.mapInArrow(confirm, "a long, b long")


def _by_prefix(labelled: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """All pairs (a, b) of nodes with different labels that can be linked, by their rarest shingles: none is missed.

    Sets are sorted by one order of shingles, rare ones first (as a sketch of fixed size counts them; any order is
    right). Linked sets of n shingles share one among the first n - ceil(n * s) + 1, and its places leave room for
    the overlap that is needed. Of a shingle's nodes those of its most frequent label only meet the others.
    """
    shift = np.uint64(64 - SKETCH.bit_length() + 1)

    def counted(batches):
        for b in batches:
            at = np.frombuffer(b"".join(b.column("shingles").to_pylist()), np.uint64) >> shift
            slot, n = np.unique(at.astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n.astype(np.int64))], ["slot", "n"])

    sums = sets.select("shingles").mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SKETCH, np.int64)
    counts[sums["slot"].to_numpy()] = sums["n"].to_numpy()
    rarity = labelled.sparkSession.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))

    def prefixes(batches):
        for b in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for node, label, data in zip(*(b.column(c).to_pylist() for c in ("node", "label", "shingles")), strict=True):
                own = np.frombuffer(data, np.uint64)
                n = len(own)
                first = n + (-near.percent * n // 100) + 1
                own = own[np.lexsort((own, rarity.value[(own >> shift).astype(np.int64)]))[:first]].astype(np.int64)
                for col, v in zip(out, (own, np.full(first, node), np.full(first, label), np.full(first, n), np.arange(first)), strict=True):
                    col.append(v)
            cols = [pa.array(np.concatenate([*c, np.zeros(0, np.int64)]).astype(np.int64)) for c in out]
            yield pa.RecordBatch.from_arrays(cols, ["shingle", "node", "label", "n", "pos"])
        tidy()

    rows = labelled.join(sets, "node").mapInArrow(prefixes, "shingle long, node long, label long, n long, pos long")
    rows = stored(rows, "near-prefixes")
    sizes = rows.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("shingle").agg(F.max(F.struct("k", "label")).alias("m"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    main = main.select("shingle", F.col("m.label").alias("main"))
    met = stored(rows.join(main, "shingle"), "near-met")
    x = met.where("label <> main").select("shingle", *[F.col(c).alias(f"x_{c}") for c in ("node", "label", "n", "pos")])
    y = met.select(F.col("shingle").alias("y_shingle"), *[F.col(c).alias(f"y_{c}") for c in ("node", "label", "n", "pos")])
    room = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos")) * (100 + near.percent)
    fits = (F.col("x_label") != F.col("y_label")) & (room >= near.percent * (F.col("x_n") + F.col("y_n")))
    pairs = x.join(y, (F.col("shingle") == F.col("y_shingle")) & fits)
    return pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """The links among candidate pairs (a, b), stored."""
    likely = stored(_likely(pairs, nodes, near), "near-likely")
    wanted = likely.select(F.col("a").alias("doc_id")).unionByName(likely.select(F.col("b").alias("doc_id"))).distinct()
    return stored(_linked(likely, _sets_of(docs, wanted, near), near), "near-links")


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Rows with equal shingle sets are one class, named by its smallest doc_id, so copies make no pairs. Classes that
    share a band's key are candidates. In each such bucket all classes are first compared to its smallest and its
    largest member; what is linked by then needs no more comparing. Where a bucket's members are still in several
    components, the pairs between components come from an exact prefix filter over the members' rarest shingles
    instead of all pairs of the bucket. Every pair goes through Bayesian pruning by signature batches, and the
    survivors' full sets decide.

    A null or empty text, or one without words, has an empty set and is linked with nothing. Rows of one doc_id
    count as linked when any of them is. Rows without doc_id are told by their texts: they are linked like others
    and named by the smallest doc_id of their component; where it has none, component_id is null and the rows of one of its
    texts are kept. doc_ids are to be below 2^62. An empty table gives no rows. Other columns of docs are ignored.
    """
    out = _components_of(_identified(docs), near)
    return out.select(_given("doc_id").alias("doc_id"), "n_shingles", _given("component_id").alias("component_id"), (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _components_of(docs: DataFrame, near: Near) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id of its component, for docs with an id in each row."""
    table = stored(signed(docs, near), "near-signed")
    first = F.min(F.struct("doc_id", "n_shingles", "bands", "sig"))
    named = table.where("set_digest is not null")
    classes = stored(named.groupBy("set_digest").agg(first.alias("c")).select("set_digest", "c.*"), "near-classes")
    nodes = classes.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "bands", "sig")
    rows = nodes.select(F.explode("bands").alias("key"), "node", "n")
    ends = rows.groupBy("key").agg(
        F.min(F.struct("node", "n")).alias("lo"), F.max(F.struct("node", "n")).alias("hi"), F.count(F.lit(1)).alias("_n")
    ).where("lo.node < hi.node")
    ends = stored(ends, "near-ends")
    shared = stored(join_spread(rows, ends.drop("_n"), "key", counts=ends.select("key", "_n")), "near-buckets")
    fits = lambda x, y: 100 * F.least(x, y) >= near.percent * F.greatest(x, y)
    star = [
        shared.where((F.col("node") != F.col(f"{e}.node")) & fits(F.col("n"), F.col(f"{e}.n"))).select(
            F.least("node", f"{e}.node").alias("a"), F.greatest("node", f"{e}.node").alias("b")
        )
        for e in ("lo", "hi")
    ]
    tried = stored(star[0].unionByName(star[1]).distinct(), "near-stars")
    links = confirmed(tried, nodes, docs, near)
    labels = components(links)
    seen = shared.select("key", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    seen = stored(seen, "near-labelled")
    open_ = stored(seen.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key"), "near-open-keys")
    rest = stored(seen.join(open_, "key", "left_semi").select("node", "label").distinct(), "near-open")
    if not rest.isEmpty():
        sets = _sets_of(docs, rest.select(F.col("node").alias("doc_id")), near)
        more = stored(_by_prefix(rest, sets, near).join(tried, ["a", "b"], "left_anti"), "near-cross")
        links = links.unionByName(confirmed(more, nodes, docs, near))
        labels = components(links)
    named = classes.select("set_digest", F.col("doc_id").alias("node")).join(labels, "node", "left")
    named = stored(named.select("set_digest", F.coalesce("label", "node").alias("label")), "near-named")
    out = join_spread(table.select("doc_id", "n_shingles", "set_digest"), named, "set_digest", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """docs without the rows that near_duplicates() does not keep, all columns; rows of a kept doc_id, or without one of a kept text, stay together."""
    own = _identified(docs)
    kept = _components_of(own, near).where("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, _id(docs) == kept["_id"], "left_semi")
