"""Embedding whitening by hierarchical merging of singular value decompositions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phaseloom.llm.common import stored
from phaseloom.llm.tokens import tidy

#: Partial decompositions that one merge takes together.
FAN_IN = 16
#: Vectors (as bytes) that one decomposition starts from.
BLOCK_BYTES = 4 << 20
_PARTIAL = "n long, mean binary, rows binary"
#: Entries of at least this size leave no room in a long once scaled.
_LONG = float(2**62)


@dataclass(frozen=True)
class Whitening:
    """x = floor(scale * c) + offset; the first `components` components are kept."""

    scale: int = 64
    offset: int = 1_000_000
    components: int = 16


def scaled(embeddings: DataFrame, w: Whitening = Whitening()) -> tuple[DataFrame, int]:
    """vec_id and x (8-byte little-endian longs) of each row whose vector has only finite entries, and the dimension.

    The dimension is that of the longest vector. Null and empty vectors go, and so do those with a null, NaN or infinite
    entry; a shorter vector lacks entries and goes too.
    """
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"))
    dims = rows.agg(F.max(F.size("embedding"))).first()[0]
    dims = max(dims or 0, 0)
    whole = rows.where((F.size("embedding") == dims) & (F.size("embedding") > 0) & F.forall("embedding", finite))

    def pack(batches):
        for b in batches:
            if not b.num_rows:
                continue
            flat = b.column("embedding").flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * w.scale
            if len(flat) and np.abs(flat).max() >= _LONG:
                raise OverflowError("an entry does not fit into a long")
            x = (np.floor(flat).astype(np.int64) + w.offset).astype("<i8").reshape(b.num_rows, dims)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "x"])

    return whole.mapInArrow(pack, "vec_id long, x binary"), dims


def _matrix(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dims)


def _decomposed(rows: np.ndarray) -> np.ndarray:
    """Singular values times right vectors of a matrix, no more rows than columns; all dimensions stay."""
    if not len(rows):
        return rows
    _, s, v = np.linalg.svd(rows, full_matrices=False)
    return s[:, None] * v


def merged(a: tuple, b: tuple) -> tuple:
    """The decomposition of the union of two centred sets: (n, mean, rows). A row that corrects for the means' difference is appended."""
    (n, mean, rows), (k, other, more) = a, b
    if not n or not k:
        return b if k else a
    gap = np.sqrt(n / (n + k) * k) * (mean - other)
    return n + k, mean + (other - mean) * (k / (n + k)), _decomposed(np.vstack([rows, more, gap[None]]))


def _start(x: np.ndarray) -> tuple:
    """Of one block: the mean is found about its first row, so that the offset costs no digits."""
    moved = (x - x[0]).astype(np.float64)
    mean = moved.mean(0)
    return len(x), x[0] + mean, _decomposed(moved - mean)


def _pack(part: tuple) -> pa.RecordBatch:
    n, mean, rows = part
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([mean.astype("<f8").tobytes()], pa.binary()), pa.array([rows.astype("<f8").tobytes()], pa.binary())], ["n", "mean", "rows"])


def _unpacked(batch, dims: int):
    for n, mean, rows in zip(*(batch.column(c).to_pylist() for c in ("n", "mean", "rows")), strict=True):
        yield n, np.frombuffer(mean, "<f8"), np.frombuffer(rows, "<f8").reshape(-1, dims)


def decomposition(fit: DataFrame, dims: int) -> tuple:
    """(n, mean, rows) of the distinct vectors x: rows' cross product is n times the covariance.

    Each task merges the decompositions of its blocks; then FAN_IN tasks' results are merged at a time, level by
    level. A result has at most dims + 1 rows of dims numbers, however many vectors it stands for.
    """

    def first(batches):
        part = (0, np.zeros(dims), np.zeros((0, dims)))
        step = max(1, BLOCK_BYTES // (8 * dims))
        for b in batches:
            for k in range(0, b.num_rows, step):
                part = merged(part, _start(_matrix(b.column("x").slice(k, step), dims)))
        tidy()
        if part[0]:
            yield _pack(part)

    def more(batches):
        part = (0, np.zeros(dims), np.zeros((0, dims)))
        for b in batches:
            for own in _unpacked(b, dims):
                part = merged(part, own)
        if part[0]:
            yield _pack(part)

    parts = stored(fit.select("x").mapInArrow(first, _PARTIAL), "whitening-parts")
    left = parts.count()
    while left > 1:
        groups = -(-left // FAN_IN)
        parts = stored(parts.repartition(groups).mapInArrow(more, _PARTIAL), "whitening-merge")
        left = parts.count()
    return next(iter(_unpacked(parts.toArrow(), dims)), (0, np.zeros(dims), np.zeros((0, dims))))


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """n and the exact sum of each dimension."""

    def add(batches):
        n, total = 0, [0] * dims
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("x"), dims)
                low = x.min(0)  # what is above each dimension's least entry; wide ranges are added as Python's numbers
                rest = (x - low).sum(0).tolist() if (x.max(0).astype(float) - low).max() * len(x) < _LONG else [sum(c) for c in (x - low).astype(object).T]
                total = [t + int(s) + int(a) * len(x) for t, s, a in zip(total, rest, low, strict=True)]
                n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), pa.array([str(v) for v in [*total, n]])], ["dim", "s"])

    sums = fit.select("x").mapInArrow(add, "dim int, s string").groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by = {r["dim"]: int(r["s"]) for r in sums}
    return by.get(dims, 0), [by.get(k, 0) for k in range(dims)]


def _projected(x: np.ndarray, n: int, sums: list[int], basis: np.ndarray) -> np.ndarray:
    """(x - S / n) on each column of basis: whole parts of the means are taken off as whole numbers."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return ((x - whole).astype(np.float64) - rest) @ basis


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list:
    """Sum over the dimensions of (n * x - S)^2, exact; null where it does not fit into a long."""
    whole = [s // n for s in sums]
    moved = x - np.array(whole, np.int64)
    rest = [s - n * w for s, w in zip(sums, whole, strict=True)]
    if (float(np.abs(moved).max(initial=0)) + 1) * n < 2**31 / max(1, x.shape[1]) ** 0.5:
        return ((n * moved - np.array(rest, np.int64)) ** 2).sum(1).tolist()
    exact = [sum((n * v - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in moved.tolist()]
    return [e if e < 2**63 else None for e in exact]


def whiten(embeddings: DataFrame, w: Whitening = Whitening()) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    The components come from each distinct scaled vector once, so groups of copies weigh as one. See scaled() for the rows that
    go. Repeated vec_ids and null ones are rows like others. A component without variance (fewer distinct vectors
    than components, equal vectors) has a null whitened and explained 0, and no part in identity_error. Without rows
    there are no results. Other columns of embeddings are ignored.
    """
    spark = embeddings.sparkSession
    rows, dims = scaled(embeddings, w)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not dims:
        return spark.createDataFrame([], schema)
    rows = stored(rows, "whitening-rows")
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    n, sums = _sums(fit, dims)
    if not n:
        return spark.createDataFrame([], schema)
    _, _, r = decomposition(fit, dims)
    _, s, v = np.linalg.svd(r, full_matrices=True) if len(r) else (None, np.zeros(0), np.eye(dims))
    s = np.concatenate([s, np.zeros(dims - len(s))])
    k = min(w.components, dims)
    lost = s[:k] <= s[0] * max(n, dims) ** 0.5 * dims * np.finfo(float).eps
    total = float((s**2).sum())
    explained = [0.0 if gone or not total else float(e) / total for e, gone in zip(s[:k] ** 2, lost, strict=True)]
    scale = np.where(lost, 0.0, np.sqrt(n) / np.where(lost, 1.0, s[:k]))
    basis = v[:k].T * scale

    def products(batches):
        """Sums of the whitened vectors and of their products."""
        one, two = np.zeros(k), np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                y = _projected(_matrix(b.column("x"), dims), n, sums, basis)
                one, two = one + y.sum(0), two + y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k + k), pa.int32()), pa.array([*two.ravel(), *one])], ["cell", "s"])

    cells = fit.select("x").mapInArrow(products, "cell int, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros(k * k + k)
    for c in cells:
        flat[c["cell"]] = c["s"]
    mean = flat[k * k :] / n
    off = flat[: k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)
    error = float(np.abs(off[~lost][:, ~lost]).max(initial=0.0))

    def write(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("x"), dims)
            y = _projected(x, n, sums, basis)
            far = pa.array(_deviations(x, n, sums), pa.int64())
            at = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("vec_id").take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, n, np.int64)),
                    far.take(at),
                    pa.array(y.ravel(), mask=np.tile(lost, len(x))),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(write, schema)
