"""A content-addressed store of token ids with document recipes and Merkle manifests."""

from __future__ import annotations

import hashlib
import json
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phaseloom.llm.common import delete, in_order, join_spread, shuffle_partitions, stored, with_prefix
from phaseloom.llm.tokens import blocks, encoder, tidy

LEAST, MEAN, MOST = 64, 256, 1024  # ids in a chunk
WINDOW = 16
FAN = 256  # children of a node of the Merkle tree
_POLY = np.uint32(0xEDB88320)
_GEAR = np.random.default_rng(77).integers(0, 2**63, 1 << 16, dtype=np.uint64)


def _marks(ids: np.ndarray) -> np.ndarray:
    """Places after a window of 16 ids whose rolling hash has its 8 low bits clear; the hash is a sum of the ids' random numbers."""
    if len(ids) < WINDOW:
        return np.zeros(0, np.int64)
    sums = np.zeros(len(ids) + 1, np.uint64)
    own = ids.astype(np.uint64)
    own += own
    own += np.uint64(1)
    own *= _GEAR[ids & 0xFFFF]
    np.cumsum(own, out=sums[1:])
    rolled = sums[WINDOW:] - sums[:-WINDOW]
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    return np.flatnonzero((rolled >> np.uint64(40)) & np.uint64(MEAN - 1) == 0) + WINDOW


def _ends(marks: list[int], n: int) -> list[int]:
    ends, at = [], 0
    for m in [*marks, n]:
        while m - at > MOST:
            at += MOST
            ends.append(at)
        if m - at >= LEAST or m == n:
            if m > at:
                at = m
                ends.append(at)
    return ends


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of an id stream's chunks: a cut follows a mark (see _marks), so it depends on the 16 ids before it only.

    An insertion moves no cut farther on. Chunks have at least 64 ids and at most 1,024.
    """
    return cuts_of([ids])[0]


def cuts_of(streams: list[np.ndarray]) -> list[list[int]]:
    """cuts() of each of some streams, whose marks are found together."""
    lengths = np.array([len(s) for s in streams], np.int64)
    marks = _marks(np.concatenate(streams)) if len(streams) else np.zeros(0, np.int64)
    stop = np.cumsum(lengths)
    begin = stop - lengths
    low, high = np.searchsorted(marks, begin + WINDOW), np.searchsorted(marks, stop, side="right")
    out = []
    for n, b, i, j in zip(lengths.tolist(), begin.tolist(), low.tolist(), high.tolist(), strict=True):
        out.append(([n] if n else []) if n <= LEAST else _ends((marks[i:j] - b).tolist(), n))
    return out


def chunk_digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def document_root(digests: bytes, n: int) -> bytes:
    return hashlib.blake2b(n.to_bytes(8, "little") + digests, digest_size=16).digest()


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials over GF(2) modulo that of CRC-32, bits reflected."""
    out = np.zeros(len(a), np.uint32)
    b = b.copy()
    for k in range(31, -1, -1):
        out ^= np.where((a >> np.uint32(k)) & np.uint32(1), b, np.uint32(0))
        b = (b >> np.uint32(1)) ^ np.where(b & np.uint32(1), _POLY, np.uint32(0))
    return out


def shifted_crc(crc: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What chunks with these CRC-32s add (by xor) to the CRC-32 of a whole in which `after` bytes follow them."""
    lengths, where = np.unique(after.astype(np.int64), return_inverse=True)
    factor = np.full(len(lengths), 1 << 31, np.uint32)
    square = np.array([1 << 23], np.uint32)  # x^8
    left = lengths.copy()
    while left.any():
        odd = (left & 1) == 1
        factor[odd] = _times(factor[odd], np.broadcast_to(square, odd.sum()))
        square, left = _times(square, square), left >> 1
    return _times(factor[where], crc.astype(np.uint32))


#: Rows of path/parts: a chunk has digest and ids, a document's recipe the rest.
PARTS = "digest binary, ids binary, doc_id long, n_tokens long, digests binary, ends binary, root binary, chunk boolean"


def _packed(doc_id: int | None, n: int, root: bytes, digests: bytes, ends: bytes) -> bytes:
    return bytes([doc_id is None]) + np.array([doc_id or 0, n], "<i8").tobytes() + root + digests + ends


def _unpacked(data: bytes) -> tuple:
    doc_id, n = np.frombuffer(data[1:17], "<i8").tolist()
    k = (len(data) - 33) // 20  # a chunk takes 16 bytes of digest and 4 of its end
    return (None if data[0] else doc_id), n, data[33 : 33 + 16 * k], data[33 + 16 * k :], data[17:33]


def write_store(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1) -> None:
    """Encodes every whole text once and writes its ids, each unique chunk once, to path.

    path/parts/chunk=true: digest and ids as little-endian uint16 (uint32 for larger vocabularies); tasks drop what
    they have sent before, the rest is sorted by digest and each digest's first row written. path/recipes: a row a
    document in ascending doc_id order: start, n_tokens, chunk digests, chunk ends and the root over them.
    path/manifest: the nodes of the Merkle tree over the recipes, level by level up to the root of the store, and the
    format. Recipes leave the encoding tasks as rows with a number for a key, so copies of one text are spread.

    Null text counts as empty (its end id alone); null doc_ids come first, repeated doc_ids keep their input order. An
    empty table makes an empty store. Other columns are ignored.
    """
    spark = docs.sparkSession
    wide = encoder(tokenizer_path).tokenizer.get_vocab_size() > 1 << 16 or end_id >= 1 << 16
    kind = "<u4" if wide else "<u2"

    def rows(batches):
        encode, sent, done = encoder(tokenizer_path).encode, set(), 0
        size = np.dtype(kind).itemsize
        for b in blocks(batches, "text", 4 << 20):
            keys, data_out = [], []
            streams = [np.append(ids, np.uint32(end_id)) for ids in encode(b.column("text"))]
            for doc_id, ids, ends in zip(b.column("doc_id").to_pylist(), streams, cuts_of(streams), strict=True):
                data = ids.astype(kind).tobytes()
                digests, at = [], 0
                for end in ends:
                    own = data[size * at : size * end]
                    digests.append(chunk_digest(own))
                    if digests[-1] not in sent:
                        if len(sent) >= 100_000:
                            sent.clear()
                        sent.add(digests[-1])
                        keys.append(digests[-1])
                        data_out.append(own)
                    at = end
                whole = b"".join(digests)
                keys.append(done.to_bytes(8, "little"))
                data_out.append(_packed(doc_id, len(ids), document_root(whole, len(ids)), whole, np.array(ends, "<u4").tobytes()))
                done += 1
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(data_out, pa.binary())], ["key", "data"])
        tidy()

    def unique(batches):
        last: tuple = (None, None)
        for b in batches:
            chunks, recipes = [], []
            for key, data in zip(b.column("key").to_pylist(), b.column("data").to_pylist(), strict=True):
                if len(key) == 8:
                    recipes.append(_unpacked(data))
                elif key != last[0]:
                    last = (key, data)
                    chunks.append(last)
                elif data != last[1]:
                    raise ValueError(f"two chunks have the digest {key.hex()}")
            k, m = len(chunks), len(recipes)
            own = [[*c, *([None] * m)] for c in (zip(*chunks, strict=True) if k else ([], []))]
            more = [[*([None] * k), *c] for c in (zip(*recipes, strict=True) if m else ([],) * 5)]
            types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
            columns = [*own, *more, [True] * k + [False] * m]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in PARTS.split(", ")])

    made = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, "key binary, data binary")
    by_key = made.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key")
    by_key.mapInArrow(unique, PARTS).write.option("compression", "zstd").partitionBy("chunk").parquet(f"{path}/parts")
    recipes = spark.read.schema(PARTS).parquet(f"{path}/parts").where("not chunk").select("doc_id", "n_tokens", "digests", "ends", "root")
    placed = with_prefix(in_order(recipes, "doc_id", name="recipes"), ["doc_id"], F.col("n_tokens"))
    final = placed.withColumnRenamed("_before", "start").sortWithinPartitions("_pos")
    final.select("_pos", "doc_id", "start", "n_tokens", "digests", "ends", "root").write.parquet(f"{path}/recipes")
    delete(spark, f"{path}/parts/chunk=false")
    form = F.lit(json.dumps({"ids": kind, "end": end_id}))
    merkle_tree(spark.read.parquet(f"{path}/recipes")).withColumn("format", form).write.parquet(f"{path}/manifest")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARTS).parquet(f"{path}/parts").where("chunk").select("digest", "ids")


def merkle_tree(recipes: DataFrame) -> DataFrame:
    """level, node, below (its children) and root of every inner node above the documents, in places of 256; the last level is the store's root.

    A document's leaf covers its place, doc_id, start, count and root, so that rows that are missing, swapped or
    changed show. A node gathers 256 children at most. A store without documents has one node over nothing.
    """
    spark = recipes.sparkSession
    leaf = F.concat_ws("|", F.col("_pos"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "start", "n_tokens", F.hex("root"))
    nodes, level, levels = recipes.select(F.col("_pos").alias("node"), F.sha2(leaf, 256).alias("root")), 0, []
    n = recipes.count()
    while n > 1 or not level:
        level, n = level + 1, -(-n // FAN)
        children = F.sort_array(F.collect_list(F.struct("node", "root")))
        up = nodes.groupBy(F.expr(f"node div {FAN}").alias("up")).agg(children.alias("c"))
        joined = F.concat_ws("", F.transform("c", lambda x: x["root"]))
        up = up.select(F.lit(level).alias("level"), F.col("up").alias("node"), F.size("c").alias("below"), F.sha2(joined, 256).alias("root"))
        levels.append(stored(up, f"tree-{level}"))
        nodes = levels[-1].select("node", "root")
    if n == 0:
        return spark.range(1).select(F.lit(1).alias("level"), F.lit(0).cast("long").alias("node"), F.lit(0).alias("below"), F.sha2(F.lit(""), 256).alias("root"))
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def store_root(spark: SparkSession, path: str) -> str:
    """The root of the whole store, which the manifest's last level has."""
    return spark.read.parquet(f"{path}/manifest").orderBy(F.desc("level")).first()["root"]


def _checked(spark: SparkSession, path: str, root: str | None) -> tuple[DataFrame, str]:
    """The recipes and the ids' format; raises where recipes and manifest differ, or the root is not the given one."""
    recipes, manifest = spark.read.parquet(f"{path}/recipes"), spark.read.parquet(f"{path}/manifest")
    told = manifest.select("level", "node", F.col("below").alias("_below"), F.col("root").alias("_root"))
    same = F.col("root").eqNullSafe(F.col("_root")) & F.col("below").eqNullSafe(F.col("_below"))
    if not merkle_tree(recipes).join(told, ["level", "node"], "full").where(~same).isEmpty():
        raise ValueError("recipes do not fit the manifest")
    if root is not None and store_root(spark, path) != root:
        raise ValueError("the store has another root")
    return recipes, json.loads(manifest.first()["format"])["ids"]


def _uses(recipes: DataFrame) -> DataFrame:
    """A stored row for each chunk of each document: _pos, k (its number there), digest, length, and the bytes after it."""

    def opened(batches):
        for b in batches:
            pos, nth, keys, at, own = [], [], [], [], []
            for p, n, digests, ends, root in zip(*(b.column(c).to_pylist() for c in ("_pos", "n_tokens", "digests", "ends", "root")), strict=True):
                if document_root(digests, n) != root:
                    raise ValueError(f"the recipe at {p} is damaged")
                stops = np.frombuffer(ends, "<u4").astype(np.int64)
                pos.append(np.full(len(stops), p, np.int64))
                nth.append(np.arange(len(stops)))
                keys.extend(digests[k : k + 16] for k in range(0, len(digests), 16))
                at.append(4 * (n - stops))
                own.append(np.diff(stops, prepend=0))
            pos, nth, at, own = (pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)) for x in (pos, nth, at, own))
            yield pa.RecordBatch.from_arrays([pos, nth, pa.array(keys, pa.binary()), at, own], ["_pos", "k", "digest", "after", "length"])

    rows = recipes.select("_pos", "n_tokens", "digests", "ends", "root").mapInArrow(opened, "_pos long, k long, digest binary, after long, length long")
    return stored(rows, "chunk-uses")


def read_store(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files; raises where they do not fit together.

    Chunk bytes are read where they lie: their digest must be that of the file's row, and their count and CRC-32
    go on. A document's CRC-32 is the xor of its chunks', each moved by the bytes after it, so ids are not gathered
    per document. The tree over the recipes must be the manifest's (and its root the given one), a recipe must give
    its own root, and every chunk must be there.
    """
    recipes, kind = _checked(spark, path, root)

    def weigh(batches):
        for b in batches:
            out = []
            for key, data in zip(b.column("digest").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if chunk_digest(data) != key:
                    raise ValueError(f"chunk {key.hex()} is damaged")
                ids = np.frombuffer(data, kind)
                out.append((key, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            cols = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64()), strict=True)], ["digest", "n", "crc"])

    @F.pandas_udf(T.LongType())
    def moved(crc: pd.Series, after: pd.Series) -> pd.Series:
        return pd.Series(shifted_crc(crc.to_numpy(np.int64), after.to_numpy(np.int64)).astype(np.int64))

    chunks = stored(_chunks(spark, path).mapInArrow(weigh, "digest binary, n long, crc long"), "chunk-crc")
    met = join_spread(_uses(recipes), chunks, "digest")
    met = met.select("_pos", F.when(F.col("n") == F.col("length"), F.col("n")).otherwise(F.lit(-1)).alias("n"), "crc", "after")
    met = met.repartition(shuffle_partitions(spark), "_pos").select("_pos", "n", moved("crc", "after").alias("crc"))
    whole = met.groupBy("_pos").agg(F.sum("n").alias("found"), F.bit_xor("crc").alias("ids_crc32"))
    out = recipes.select("_pos", "doc_id", "start", "n_tokens").join(whole, "_pos", "left")
    sound = F.when(F.col("found") == F.col("n_tokens"), F.col("n_tokens")).otherwise(F.raise_error(F.lit("a chunk is missing")).cast("long"))
    return out.select("doc_id", "start", sound.alias("n_tokens"), "ids_crc32")


def read_ids(spark: SparkSession, path: str, root: str | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id, start, n_tokens and the ids themselves (little-endian uint32) of each document, or of those whose doc_id is in wanted.

    Recipes are joined to the chunks that they name and each document's chunks are put together by number. Digest
    of every chunk and root of every document are computed again from the bytes; raises where one differs.
    """
    recipes, kind = _checked(spark, path, root)
    if wanted is not None:
        recipes = recipes.join(wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")

    def glue(batches):
        for b in batches:
            out = []
            for n, own, pieces in zip(*(b.column(c).to_pylist() for c in ("n_tokens", "root", "pieces")), strict=True):
                data = [p["ids"] for p in pieces or []]
                if document_root(b"".join(map(chunk_digest, data)), n) != own:
                    raise ValueError("a chunk is missing or damaged")
                out.append(np.frombuffer(b"".join(data), kind).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(out, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    met = join_spread(_uses(recipes), _chunks(spark, path), "digest")
    pieces = met.groupBy("_pos").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("pieces"))
    whole = recipes.select("_pos", "doc_id", "start", "n_tokens", "root").join(pieces, "_pos", "left").drop("_pos")
    return whole.mapInArrow(glue, "doc_id long, start long, n_tokens long, ids binary")
