"""Homomorphic multiset hashes of documents' paragraphs."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phaseloom.llm.common import in_order, shuffle_partitions, with_prefix
from phaseloom.llm.tokens import blocks

#: A paragraph's vector: 1, DENSE lanes modulo 2^16, and one lane of LEVELS x LANES modulo 2^8.
DENSE, LEVELS, LANES = 28, 32, 256
BYTES = 8 + 2 * DENSE + LEVELS * LANES
#: Texts whose sums a task holds at a time.
ROWS = 1024
_CUT = re.compile(r"\n|(?<=[.!?])[ \t]")
UNIT = 64


def paragraphs(text: str) -> list[str]:
    """Lines, cut after sentence ends and every 64 code points, so that texts without line breaks have several; empty ones do not count."""
    out = []
    for p in _CUT.split(text):
        if len(p) <= UNIT:
            if p:
                out.append(p)
        else:
            out.extend(p[k : k + UNIT] for k in range(0, len(p), UNIT))
    return out


def sums_of(texts: list[str]) -> np.ndarray:
    """The fingerprint of each text as a row of BYTES bytes: the lane-wise sum of its paragraphs' vectors modulo 2^64, 2^16 and 2^8.

    The dense lanes tell whether two multisets are equal. Of the sparse lanes a paragraph adds to one only, at a
    level that half of the paragraphs of the level before reach, so differing lanes count differing paragraphs. There
    the repeats of a paragraph are numbered and each is a paragraph of its own, so it counts as often as it occurs.
    LEVELS are enough for some 2^38 of them. Level, lane and value come from bits of their own: 31, 8 and 24.
    Sums do not depend on order, and a paragraph can be added or taken away without the others.
    """
    return _sums([paragraphs(t) for t in texts])


def _repeats(units: list[str], before: dict[str, int] | None = None) -> list[int]:
    """For each paragraph how many equal ones precede it; before: how many there were already."""
    if not before and len(set(units)) == len(units):
        return [0] * len(units)
    seen = dict(before or {})
    out = []
    for p in units:
        out.append(seen.get(p, 0))
        seen[p] = out[-1] + 1
    return out


def _numbered(pick: np.ndarray, repeat: np.ndarray) -> np.ndarray:
    """Another 64 bits for each repeat of a paragraph; the first keeps its own."""
    x = pick + repeat.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.where(repeat > 0, x ^ (x >> np.uint64(31)), pick)


def _sums(units: list[list[str]], before: list[dict[str, int]] | None = None) -> np.ndarray:
    counts = np.array([len(u) for u in units], np.int64)
    out = np.zeros((len(units), BYTES), np.uint8)
    out[:, :8] = counts.astype("<u8").view(np.uint8).reshape(-1, 8)
    if not counts.sum():
        return out
    full = np.flatnonzero(counts)
    raw = np.frombuffer(b"".join([hashlib.blake2b(p.encode("utf-8", "surrogatepass")).digest() for u in units for p in u]), np.uint8).reshape(-1, 64)
    starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
    lanes = np.add.reduceat(raw[:, : 2 * DENSE].copy().view("<u2").astype(np.uint32), starts, axis=0).astype("<u2")
    out[full, 8 : 8 + 2 * DENSE] = lanes.view(np.uint8).reshape(len(full), -1)
    repeats = np.array([k for j, u in enumerate(units) for k in _repeats(u, before[j] if before else None)], np.int64)
    pick = _numbered(raw[:, 2 * DENSE :].copy().view("<u8")[:, 0], repeats)
    level = np.zeros(len(pick), np.int64)
    for k in range(1, LEVELS):
        level += (pick & np.uint64((1 << k) - 1)) == 0
    lane = (pick >> np.uint64(LEVELS - 1)).astype(np.int64) % LANES
    value = ((pick >> np.uint64(40)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    at = np.repeat(np.arange(len(units)), counts) * BYTES + 8 + 2 * DENSE + level * LANES + lane
    np.add.at(out.reshape(-1), at, value)  # modulo 2^8
    return out


def _lanes(row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row = np.ascontiguousarray(row)
    return row[:8].view("<u8"), row[8 : 8 + 2 * DENSE].view("<u2"), row[8 + 2 * DENSE :]


def changed(row: np.ndarray, removed: list[str], added: list[str], counts: dict[str, int] | None = None) -> np.ndarray:
    """The fingerprint after taking some paragraphs away and then adding others.

    counts: how often each of these occurs in the text before; those that are not named occur as often as they are removed.
    """
    away = [p for text in removed for p in paragraphs(text)]
    more = [p for text in added for p in paragraphs(text)]
    there = Counter(away) | Counter(counts or {})
    left = there - Counter(away)
    # the last ones go: their numbers begin where those that stay end
    minus, plus = _sums([away, more], [dict(left), dict(left)])
    parts = [(a + p) - m for a, p, m in zip(_lanes(row), _lanes(plus), _lanes(minus), strict=True)]
    return np.concatenate([x.view(np.uint8) for x in parts])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of paragraphs that two fingerprints have in common, from 0 to 1; equal ones have 1.

    Differing paragraphs are counted from the first level whose lanes are not nearly all taken, so texts may have
    any length; a repeated paragraph counts each time. The standard error is about 0.06 where nothing is common, and less else.
    """
    if (a == b).all():
        return 1.0
    total = int(a[:8].view("<u8")[0]) + int(b[:8].view("<u8")[0])
    if not total:
        return 1.0
    differ = (a[8 + 2 * DENSE :] != b[8 + 2 * DENSE :]).reshape(LEVELS, LANES).sum(1)
    for k in range(LEVELS):
        if differ[k] <= 0.75 * LANES or k == LEVELS - 1:
            found = sum(-LANES * log(1 - min(d, LANES - 0.5) / LANES) for d in differ[k:].tolist())
            return max(0.0, min(1.0, 1 - found * 2**k / total))
    return 0.0


def text_of(row: np.ndarray) -> str:
    """The fingerprint in base64, without the zero bytes at its end, which levels that a short text does not reach have."""
    return base64.b64encode(row.tobytes().rstrip(b"\0")).decode()


def row_of(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text).ljust(BYTES, b"\0"), np.uint8)


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (base64) of each whole text; a null text counts as empty. Other columns are ignored."""

    def run(batches):
        for b in blocks(batches, "text", most_rows=ROWS):
            own = sums_of([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([text_of(r) for r in own])], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fingerprint string")


def _heads(docs: DataFrame, n: int) -> list[int]:
    """The first _at of each of at most n parts of docs (_at, text) of about equal bytes.

    Ids and sizes alone are stored in order of the ids, and prefix sums of the sizes, from one total a range, cut them;
    one row a part comes to the driver.
    """
    sizes = in_order(docs.select("_at", (F.octet_length("text") + 64).cast("long").alias("bytes")), "_at", name="ends")
    whole = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(1))).first()[0]
    parts = with_prefix(sizes, ["_at"], F.col("bytes")).groupBy(F.expr(f"_before * {n} div {whole}").alias("part")).agg(F.min("_at").alias("head"))
    return sorted({r["head"] for r in parts.collect()})


def _places(heads: list[int]):
    first = np.array(heads, np.int64)

    @F.pandas_udf(T.IntegerType())
    def place(at: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(first, at.to_numpy(np.int64), side="right") - 1).astype("int32"))

    return place


def _with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) in one partition a part, sorted by (_tail, doc_id), with the first row after the part, marked _tail.

    Texts are shuffled once; besides, each part's first row goes to the part before it (that of the first part to the last).
    """
    n = shuffle_partitions(docs.sparkSession)
    docs = docs.withColumn("_at", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    heads = _heads(docs, n)
    back = {head: (k - 1) % len(heads) for k, head in enumerate(heads)}

    @F.pandas_udf(T.IntegerType())
    def before(at: pd.Series) -> pd.Series:
        return at.map(back).astype("Int32")

    placed = docs.withColumn("_part", _places(heads)("_at")).withColumn("_back", before("_at"))
    both = F.array_compact(
        F.array(
            F.struct(F.col("_part").alias("part"), F.lit(0).alias("tail")),
            F.when(F.col("_back").isNotNull(), F.struct(F.col("_back").alias("part"), F.lit(1).alias("tail"))),
        )
    )
    out = placed.withColumn("_to", F.explode(both)).select("doc_id", "text", F.col("_to.part").alias("_part"), F.col("_to.tail").alias("_tail"))
    return out.repartitionById(n, F.col("_part")).sortWithinPartitions("_part", "_tail", "doc_id", "text")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, whose last half is replaced from the next document's start.

    The last floor(n_chars / 2) code points give way to as many first ones (or all) of the document with the next
    greater doc_id; after the last comes the first. Of repeated doc_ids the texts' order decides; null doc_ids come
    first. A null text counts as empty; the only document is its own next. An empty table gives no rows.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def pairs(batches):
        """(part, doc_id, text, next text) of each row that has one after it in its part; tails give no row."""
        last = None
        for b in blocks(batches, "text", most_rows=ROWS):
            out = []
            for doc_id, text, part, tail in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "_part", "_tail")), strict=True):
                if last is not None and last[0] == part:
                    out.append((last[1], last[2], text))
                last = None if tail else (part, doc_id, text)
            yield out

    def run(batches):
        for rows in pairs(batches):
            if not rows:
                continue
            edited = []
            for _, own, after in rows:
                half = len(own) // 2
                edited.append(own[: len(own) - half] + after[:half])
            sums = sums_of([r[1] for r in rows] + edited + [rows[-1][2]])
            n = len(rows)
            following = [k + 1 if k + 1 < n and rows[k][2] is rows[k + 1][1] else None for k in range(n)]
            nexts = [sums[f] if f is not None else (sums[2 * n] if k == n - 1 else sums_of([rows[k][2]])[0]) for k, f in enumerate(following)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([len(r[1]) for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
                    pa.array([text_of(s) for s in sums[:n]]),
                    pa.array([text_of(s) for s in sums[n : 2 * n]]),
                    pa.array([likeness(a, b) for a, b in zip(sums[:n], sums[n : 2 * n], strict=True)]),
                    pa.array([likeness(a, b) for a, b in zip(sums[:n], nexts, strict=True)]),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _with_next(source).mapInArrow(run, schema)
