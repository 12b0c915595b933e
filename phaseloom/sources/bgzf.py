"""Block-gzipped text (.bgz), read in splits and written by tasks.

Such a file is a chain of gzip members of at most 64 KiB, whose headers tell their lengths. Spark's text source cuts the
raw file at the members' first bytes, so a file of any size is read by many tasks from any store that Spark reads.
"""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the format: a member's first bytes, the fields up to its length, and the empty member at a file's end.
MAGIC = b"\x1f\x8b\x08\x04"
HEAD = MAGIC + b"\0\0\0\0\0\xff\x06\0BC\x02\0"
EMPTY = HEAD + b"\x1b\0\x03\0\0\0\0\0\0\0\0\0"
BLOCK = 65_280
_LATIN = {"encoding": "ISO-8859-1"}  # a separator's characters are its bytes


def member(data: bytes) -> bytes:
    """A member of at most 65,280 bytes of data."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return HEAD + struct.pack("<H", len(HEAD) + 2 + len(body) + 8 - 1) + body + struct.pack("<II", zlib.crc32(data), len(data))


def member_length(head: bytes) -> int | None:
    """Bytes of the member that begins here, from the extra field of its header: 0 where more bytes are to tell, None where no member begins."""
    if head[:4] != MAGIC[: len(head)]:
        return None
    if len(head) < 12:
        return 0
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 6 <= end:
        if len(head) < at + 6:
            return 0
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and size == 2:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


def inflated(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


class _Split:
    """The members of one split of a file: pieces between occurrences of the first bytes, which may also occur by chance.

    orphan: what precedes the first member, as a chance occurrence ended the last split early; rest: an unfinished member.
    """

    def __init__(self, file: str, start: int):
        self.file, self.start, self.rest, self.orphan = file, start, b"", b""
        self.begun = start == 0
        self.first = start == 0

    def add(self, piece: bytes):
        if self.first:  # before a file's first member there is nothing
            self.first = False
            if piece:
                raise ValueError(f"{self.file} is not block-gzipped")
            return
        self.rest += MAGIC + piece
        while (size := member_length(self.rest)) and len(self.rest) >= size:
            whole, self.rest, self.begun = self.rest[:size], self.rest[size:], True
            yield whole
        if size is None:
            if self.begun:
                raise ValueError(f"{self.file} is broken after the split from byte {self.start}")
            self.orphan, self.rest = self.orphan + self.rest, b""


def _splits(batches):
    """Each split with its pieces in order."""
    now, pieces = None, []
    for b in batches:
        for file, start, data in zip(*(b.column(c).to_pylist() for c in ("file", "start", "data")), strict=True):
            if now is not None and (file, start) != (now.file, now.start):
                yield now, None
                now = None
            if now is None:
                now = _Split(file, start)
            for whole in now.add(data):
                yield now, whole
    if now is not None:
        yield now, None


def _whole_lines(batches):
    """The lines that a split holds from a line feed to a line feed (or from the file's begin)."""
    text, open_, out = b"", None, []
    for split, whole in _splits(batches):
        if whole is None:
            text, open_ = b"", None
            continue
        if open_ is None:
            open_ = split.start == 0
        found = inflated(whole)
        if b"\n" not in found:
            text += found
            continue
        first, *lines, rest = (text + found).split(b"\n")
        out += [first, *lines] if open_ else lines
        text, open_ = rest, True
        if sum(map(len, out)) > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])


_EDGES = "file string, start long, part int, packed boolean, data binary, ends boolean"


def _edges(batches):
    """What a split leaves to its neighbours: text before its first and after its last line feed, and bytes of members that go on.

    Only members at the two ends are inflated.
    """
    out: list[tuple] = []
    head, later = b"", []
    met = False

    def last(members: list[bytes]) -> list[bytes]:
        """The members from the one with the last line feed on."""
        for k in range(len(members) - 1, -1, -1):
            if b"\n" in inflated(members[k]):
                return members[k:]
        return members

    for split, whole in _splits(batches):
        if whole is not None:
            if not met and split.start:
                head += inflated(whole)
                if b"\n" in head:
                    met, head, later = True, head[: head.index(b"\n")], [whole]
                continue
            met = True
            later.append(whole)
            if len(later) > 256:
                later = last(later)
            continue
        at = (split.file, split.start)
        if split.orphan:
            out.append((*at, 0, True, split.orphan, False))
        if not met:  # no line ends here
            out.append((*at, 1, False, head, False))
        else:
            if split.start:
                out.append((*at, 1, False, head, True))
            text = b"".join(map(inflated, last(later)))
            out.append((*at, 2, False, text.rpartition(b"\n")[2], False))
        if split.rest:
            out.append((*at, 3, True, split.rest, False))
        head, later, met = b"", [], False
    types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.bool_()]
    cols = list(zip(*out, strict=True)) or [()] * 6
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["file", "start", "part", "packed", "data", "ends"])


def _joined(batches):
    """Lines from a chain of edges in order; neighbouring packed bytes are members."""
    for b in batches:
        out: list[bytes] = []
        for chain in b.column("chain").to_pylist():
            text, packed = b"", b""
            for piece in [*chain, None]:
                if packed and (piece is None or not piece["packed"]):
                    while packed:
                        size = member_length(packed)
                        if not size or len(packed) < size:
                            raise ValueError("a block-gzipped file is cut off or broken")
                        text, packed = text + inflated(packed[:size]), packed[size:]
                if piece is not None:
                    if piece["packed"]:
                        packed += piece["data"]
                    else:
                        text += piece["data"]
            *lines, rest = text.split(b"\n")
            out += [*lines, rest] if rest or chain[-1]["ends"] else lines
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value: the lines of block-gzipped files, in no order.

    A task reads the members that begin in its split. What lies before the first and after the last line feed of a
    split goes to its neighbours: a few rows a split, joined in order of the splits by a second scan that inflates the
    ends only; so do lines that many splits hold. A file that is not block-gzipped, or broken, raises an error.
    """
    raw = spark.read.options(**_LATIN).option("lineSep", MAGIC.decode("latin-1")).text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("data"))
    edges = pieces.mapInArrow(_edges, _EDGES)
    before = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, -1)
    chained = edges.withColumn("chain_no", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    piece = F.struct("start", "part", "packed", "data", "ends")
    chains = chained.groupBy("file", "chain_no").agg(F.array_sort(F.collect_list(piece)).alias("chain"))
    return pieces.mapInArrow(_whole_lines, "value string").unionByName(chains.select("chain").mapInArrow(_joined, "value string"))


def write_lines(rows: DataFrame, column: str, path: str, header: str | None = None) -> None:
    """Block-gzipped files of a text column, one a task in the order of its rows, each with the header lines first.

    Between members there are empty ones, which are valid anywhere and mark the files' ends.
    """

    def pack(batches):
        text, first = b"", True
        for b in batches:
            if first and header is not None:
                text = header.encode() + b"\n"
            first = False
            lines = b.column("line").to_pylist()
            text += b"".join((x or "").encode("utf-8", "surrogatepass") + b"\n" for x in lines)
            whole = len(text) // BLOCK * BLOCK
            yield pa.RecordBatch.from_arrays([pa.array([member(text[k : k + BLOCK]) for k in range(0, whole, BLOCK)], pa.binary())], ["member"])
            text = text[whole:]
        yield pa.RecordBatch.from_arrays([pa.array([member(text)] if text else [], pa.binary())], ["member"])

    packed = rows.select(F.col(column).cast("string").alias("line")).mapInArrow(pack, "member binary")
    packed.select(F.col("member").cast("string")).write.options(**_LATIN).option("lineSep", EMPTY.decode("latin-1")).text(path)
