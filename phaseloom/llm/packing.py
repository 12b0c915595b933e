"""Shortest-pack-first packing of token pieces over their length histogram."""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phaseloom.llm.common import stored
from phaseloom.llm.tokens import blocks, encoder, tidy

PIECE = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, part int, nth long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` ids of each whole text and its end id, numbered by length within each partition."""
    schema = PIECE + (", ids binary" if with_ids else "")

    def cut(batches):
        encode = encoder(tokenizer_path).encode
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in blocks(batches, "text"):
            rows: list[tuple] = []
            raw: list[bytes] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text")), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                data = ids.tobytes()
                for start in range(0, len(ids), capacity):
                    own = data[4 * start : 4 * (start + capacity)]
                    length = len(own) // 4
                    rows.append((doc_id, start, length, zlib.crc32(own), len(ids), part, int(seen[length])))
                    seen[length] += 1
                    if with_ids:
                        raw.append(own)
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(raw, pa.binary())] if with_ids else []), names + (["ids"] if with_ids else []))
        tidy()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Packs counts of lengths, longest first, each into the packs that are shortest so far, if it fits there.

    Packs of one pattern are a run of sequence numbers, so a step moves a whole run or a part of it and its cost
    does not depend on the counts. Returns, for pieces of one length in order of rank, intervals
    (length, first rank, first sequence, offset), sorted by length and first rank, and the fill of each
    run of sequences as (first sequence, fill, count).
    """
    packs: list[tuple[int, int, int]] = []  # fill, first sequence, count
    steps, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if packs and packs[0][0] + length <= capacity:
                fill, first, count = heapq.heappop(packs)
                n = min(left, count)
                if n < count:
                    heapq.heappush(packs, (fill, first + n, count - n))
            else:
                fill, first, n = 0, sequences, left
                sequences += n
            steps.append((length, rank, first, fill))
            heapq.heappush(packs, (fill + length, first, n))
            rank, left = rank + n, left - n
    plan = np.array(sorted(steps), np.int64).reshape(-1, 4)
    return plan, np.array(sorted((first, fill, n) for fill, first, n in packs), np.int64).reshape(-1, 3)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Places the ids of all documents into sequences of at most `capacity` ids.

    Documents are cut into pieces of `capacity` ids and a rest. The histogram of piece lengths (at most `capacity`
    rows) is packed shortest-pack-first, and the plan is joined back by each piece's rank among those of its
    length: ranks come from counts by partition and length, so pieces of one length, however many, never meet.
    What is broadcast is the plan; its size depends on `capacity` only.

    A null or empty text is its end id alone. Repeated rows and doc_ids are packed like any others; null doc_ids
    stay null. An empty table gives no rows. Other columns of docs are ignored.
    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids as little-endian uint32).
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, tokenizer_path, capacity, end_id, with_ids), "pieces")
    cells = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(shortest_pack_first(histogram, capacity)[0])
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("_rank", F.col("_before") + F.col("nth")).drop("part", "nth", "_before")
    out = [c for c in ranked.columns if c != "_rank"]
    schema = ", ".join(f"{n} {'long' if n == 'length' else t}" for n, t in ranked.dtypes if n != "_rank") + ", sequence_id long, offset long"

    def place(batches):
        steps = plan.value
        keys = steps[:, 0] * (1 << 44) + steps[:, 1]
        for b in batches:
            length = b.column("length").to_numpy().astype(np.int64)
            rank = b.column("_rank").to_numpy()
            at = np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1
            cols = [pa.array(length) if c == "length" else b.column(c) for c in out]
            cols += [pa.array(steps[at, 2] + rank - steps[at, 1]), pa.array(steps[at, 3])]
            yield pa.RecordBatch.from_arrays(cols, [*out, "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, schema)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))
