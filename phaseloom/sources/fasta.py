"""Reference sequences in chunks, and FASTA files."""

from __future__ import annotations

import os
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phaseloom.operators.ordering import in_ranges, with_earlier
from phaseloom.storage import arrow_batches, by_shuffle, delete, exists, file_system, listed

CHUNK = 10_000


def read_fasta(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """contig, chunk (from 0) and seq, `chunk` bases each, of FASTA files.

    Lines are read by file block (a compressed file is one). What a block adds to its contig is summed up block by
    block, so each line knows its place, and lines meet by chunk: the work is linear and a contig is spread over tasks.
    """
    block = ["_file", "_block"]
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"), "value"
    )
    head = F.when(F.col("value").startswith(">"), F.regexp_extract("value", "^>\\s*(\\S+)", 1))
    bases = F.when(head.isNull(), F.upper(F.regexp_replace("value", "\\s", ""))).otherwise("")
    lines = raw.select(*block, "_line", head.alias("_head"), bases.alias("_seq")).withColumn("_n", F.length("_seq").cast("long"))
    here = Window.partitionBy(*block).orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    run = lines.withColumn("_upto", F.sum("_n").over(here)).withColumn("_mark", F.when(F.col("_head").isNotNull(), F.struct("_head", "_upto")))
    run = run.withColumn("_last", F.last("_mark", ignorenulls=True).over(here))
    sums = run.groupBy(*block).agg(F.sum("_n").alias("_n"), F.max_by("_last", "_line").alias("_last"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    opened = F.when(F.col("_last").isNotNull(), F.struct(F.col("_last._head").alias("_head"), (F.col("_before") + F.col("_last._upto")).alias("_at")))
    carried = before.withColumn("_open", F.last(opened, ignorenulls=True).over(earlier))
    carried = carried.select(*block, F.col("_open._head").alias("_contig"), (F.col("_before") - F.col("_open._at")).alias("_done"))
    placed = run.where("_n > 0").join(F.broadcast(carried), block).select(  # a row a file block
        F.coalesce("_last._head", "_contig").alias("contig"),
        (F.col("_upto") - F.col("_n") + F.coalesce(-F.col("_last._upto"), F.col("_done"))).alias("_at"),
        "_seq",
        "_n",
    )
    first, last = F.expr(f"_at div {chunk}"), F.expr(f"(_at + _n - 1) div {chunk}")
    parts = placed.select("contig", "_at", "_seq", F.explode(F.sequence(first, last)).alias("chunk"))
    start = F.greatest(F.col("chunk") * chunk - F.col("_at"), F.lit(0))
    stop = (F.col("chunk") + 1) * chunk - F.col("_at")
    piece = F.substring(F.col("_seq"), (start + 1).cast("int"), (stop - start).cast("int"))
    met = parts.select("contig", F.col("chunk").cast("int").alias("chunk"), F.struct("_at", piece.alias("s")).alias("p")).groupBy("contig", "chunk").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    return met.select("contig", "chunk", F.array_join(F.transform("ps", lambda x: x["s"]), "").alias("seq"))


#: The columns of a .fai file.
FAI = "contig string, length long, offset long, line_bases long, line_bytes long"


def _opened(path: str):
    """A file system of pyarrow and the path in it; s3a and gs paths as it names them."""
    if "://" not in path and not path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _seekable(path: str) -> bool:
    try:
        store, at = _opened(path)
        return store.get_file_info(at).type == arrow_fs.FileType.File
    except (OSError, ValueError, NotImplementedError):  # a store that Spark alone reads
        return False


def read_ranges(spark: SparkSession, path: str, needed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """contig, chunk and seq of the needed chunks (contig, chunk, each once) of a plain FASTA file with a .fai: tasks read these bytes alone.

    Chunks beyond a contig's end, and contigs that the file lacks, give no row. Tasks read in the file's order.
    """
    fai = spark.read.schema(FAI).option("sep", "\t").csv(f"{path}.fai")
    at = lambda base: F.col("offset") + F.expr(f"({base}) div line_bases") * F.col("line_bytes") + F.expr(f"({base}) % line_bases")
    first, last = f"chunk * {chunk}L", f"least(length, (chunk + 1) * {chunk}L) - 1"
    ranges = needed.join(fai, "contig").where(f"chunk >= 0 AND chunk * {chunk}L < length").select("contig", F.col("chunk").cast("int").alias("chunk"), at(first).alias("start"), (at(last) + 1).alias("stop"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches):
        store, at = _opened(path)
        with store.open_input_file(at) as file:
            for b in batches:
                seqs = []
                for start, stop in zip(b.column("start").to_pylist(), b.column("stop").to_pylist(), strict=True):
                    raw = file.read_at(stop - start, start)
                    if len(raw) < stop - start:
                        raise ValueError(f"{path} ends before byte {stop}: its .fai is another file's")
                    seqs.append(raw.replace(b"\n", b"").replace(b"\r", b"").upper().decode())
                yield pa.RecordBatch.from_arrays([b.column("contig"), b.column("chunk"), pa.array(seqs, pa.string())], ["contig", "chunk", "seq"])

    return ranges.repartitionByRange(tasks, "start").sortWithinPartitions("start").mapInArrow(read, "contig string, chunk int, seq string")


@dataclass(frozen=True)
class Reference:
    """A reference in FASTA. With a .fai beside it only the bases that are needed are read; else, or compressed, the file is scanned."""

    spark: SparkSession
    path: str
    chunk: int = CHUNK

    @property
    def indexed(self) -> bool:
        return exists(self.spark, f"{self.path}.fai") and not self.path.endswith((".gz", ".bgz")) and _seekable(self.path)

    def chunks(self, needed: DataFrame) -> DataFrame:
        """contig, chunk and seq of the needed (contig, chunk)."""
        needed = needed.select("contig", "chunk").distinct()
        if self.indexed:
            return read_ranges(self.spark, self.path, needed, self.chunk)
        return read_fasta(self.spark, self.path, self.chunk).join(by_shuffle(needed), ["contig", "chunk"], "left_semi")


def with_bases(rows: DataFrame, reference: DataFrame | Reference, start: str, end: str, chunk: int = CHUNK) -> DataFrame:
    """rows (a unique column row_id, contig) with `base`, the reference from 1-based position `start` to `end`, and `base_start`.

    Each row meets the chunks that it covers and no other; what lies outside the contig is missing from base. Both joins are by
    shuffle: bases compress so well that a shuffle of a few MB may hold hundreds of MB of them.
    """
    if isinstance(reference, Reference):
        chunk = reference.chunk
    first = F.greatest(F.floor((F.col(start) - 1) / chunk), F.lit(0)).cast("int")
    last = F.floor((F.col(end) - 1) / chunk).cast("int")
    need = rows.select("row_id", "contig", F.explode(F.sequence(first, F.greatest(first, last))).alias("chunk"))
    if isinstance(reference, Reference):
        reference = reference.chunks(need)
    met = need.join(by_shuffle(reference), ["contig", "chunk"]).groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "seq"))).alias("c"))
    joined = met.select("row_id", F.array_join(F.transform("c", lambda x: x["seq"]), "").alias("base"), (F.element_at("c", 1)["chunk"] * chunk + 1).alias("base_start"))
    return rows.join(by_shuffle(joined), "row_id", "left")


def records(sequences: DataFrame) -> DataFrame:
    """FASTA records in order of start and id, one string each."""
    return sequences.orderBy("start", "sequence_id").select(F.concat(F.lit(">"), "sequence_id", F.lit("\n"), "sequence").alias("record"))


def write_fasta(sequences: DataFrame, path: Path, rows: int = 100_000) -> int:
    """Writes the records to one local file, in Arrow batches of at most so many rows; returns how many there are."""
    n = 0
    with path.open("w") as out:
        for batch in arrow_batches(records(sequences), rows):
            out.writelines(f"{r}\n" for r in batch.column("record").to_pylist())
            n += batch.num_rows
    return n


def write_fasta_parts(sequences: DataFrame, path: str) -> None:
    """The same records as a folder of text files in order, for volumes that no single file should hold."""
    records(sequences).withColumn("_o", F.monotonically_increasing_id()).sortWithinPartitions("_o").select("record").write.text(path)


def _placed(rows: DataFrame, order: list[str], text: str) -> tuple[DataFrame, int]:
    """rows with `at`, the bytes of `text` before them in the order, and the bytes of all: prefix sums over ranges of rows."""
    ranged = in_ranges(rows.withColumn("_size", F.octet_length(text).cast("long")), order, "placed")
    before = with_earlier(ranged, [], _bytes=F.sum("_size"))
    here = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = before.withColumn("at", F.coalesce("_bytes", F.lit(0)) + F.sum("_size").over(here) - F.col("_size"))
    total = ranged.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    return placed.sortWithinPartitions("at").drop("_range", "_bytes", "_size"), total


def write_at(placed: DataFrame, text: str, total: int, path: str) -> None:
    """One file of which each task writes its rows at their places (column at): on disks that all executors share.

    The same bytes go to the same place however often a task runs. The file appears under its name once it is whole.
    """
    part = f"{path}.part"
    with open(part, "wb") as whole:
        whole.truncate(total)

    def write(batches):
        with open(part, "r+b") as out:
            for b in batches:
                for at, own in zip(b.column("at").to_pylist(), b.column(text).to_pylist(), strict=True):
                    if at != out.tell():
                        out.seek(at)
                    out.write(own.encode())
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    placed.select("at", text).mapInArrow(write, "n long").agg(F.sum("n")).collect()
    os.replace(part, path)


def write_fasta_file(sequences: DataFrame, path: str) -> None:
    """The records in order as one file, and its .fai, without passing through the driver.

    Bytes before each record are prefix sums over ranges of rows. On a file system tasks write at their places, on HDFS
    parts are written and put together by the name node. Other stores have neither: an error says so.
    """
    spark = sequences.sparkSession
    fs, at = file_system(spark, path)
    record = F.concat(F.lit(">"), "sequence_id", F.lit("\n"), "sequence", F.lit("\n"))
    placed, total = _placed(sequences.select("start", "sequence_id", F.length("sequence").alias("bases"), record.alias("record")), ["start", "sequence_id"], "record")
    line = F.concat_ws("\t", "sequence_id", "bases", F.col("at") + F.octet_length("sequence_id") + 2, "bases", F.col("bases") + 1)
    index = placed.select(F.col("at").alias("place"), F.concat(line, F.lit("\n")).alias("line"))
    if fs.getScheme() == "file":
        local = at.toUri().getPath()
        write_at(placed, "record", total, local)
        lines, size = _placed(index, ["place"], "line")
        write_at(lines, "line", size, f"{local}.fai")
    elif fs.getScheme() == "hdfs":
        for rows, text, to in ((placed.orderBy("at"), "record", path), (index.orderBy("place"), "line", f"{path}.fai")):
            parts = f"{to}.parts"
            rows.select(F.expr(f"substring({text}, 1, length({text}) - 1)").alias("v")).write.mode("overwrite").text(parts)
            names = [f"{parts}/{n}" for n in listed(spark, parts) if n.startswith("part-")]
            paths = [file_system(spark, n)[1] for n in names]
            more = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, len(paths) - 1)
            for k, p in enumerate(paths[1:]):
                more[k] = p
            if len(paths) > 1:
                fs.concat(paths[0], more)
            delete(spark, to)
            fs.rename(paths[0], file_system(spark, to)[1])
            delete(spark, parts)
    else:
        raise ValueError(f"no single file can be written by tasks to {fs.getScheme()}: write parts")


def masked(reference: Reference, windows: DataFrame, line: int = 60) -> DataFrame:
    """contig, line_no and text of all contigs of an indexed reference: the bases of windows (contig, start, end; 1-based, both ends included), N elsewhere.

    Contigs are cut into chunks of whole lines. Only the bytes under windows are read; chunks that windows touch are put together
    from the runs between them, all others are N. Windows may overlap and may go beyond a contig's ends.
    """
    spark, chunk = reference.spark, reference.chunk // line * line
    if not chunk:
        raise ValueError("a chunk is to hold a line at least")
    own = Reference(spark, reference.path, chunk)
    fai = spark.read.schema(FAI).option("sep", "\t").csv(f"{reference.path}.fai").select("contig", "length")
    pieces = fai.where("length > 0").select("contig", "length", F.explode(F.expr(f"sequence(0, cast((length - 1) div {chunk} as int))")).alias("chunk"))
    within = windows.join(fai, "contig").select("contig", F.expr("greatest(cast(start as bigint), 1) - 1").alias("a"), F.expr("least(cast(`end` as bigint), length)").alias("b")).where("a < b")
    cut = within.select("contig", F.explode(F.expr(f"sequence(cast(a div {chunk} as int), cast((b - 1) div {chunk} as int))")).alias("chunk"), "a", "b")
    placed = cut.select("contig", "chunk", F.struct(F.expr(f"cast(greatest(a - chunk * {chunk}L, 0) as int)").alias("a"), F.expr(f"cast(least(b - chunk * {chunk}L, {chunk}) as int)").alias("b")).alias("w"))
    spans = placed.groupBy("contig", "chunk").agg(F.array_sort(F.collect_set("w")).alias("ws"))
    known = spans.join(own.chunks(spans.select("contig", "chunk")), ["contig", "chunk"])
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def add(acc, w):
        begin, end = F.greatest(acc["at"], w["a"]), F.greatest(acc["at"], w["b"])
        return F.struct(F.concat(acc["text"], F.repeat(F.lit("N"), begin - acc["at"]), F.substring("seq", begin + 1, end - begin)).alias("text"), end.alias("at"))

    shown = known.select("contig", "chunk", F.aggregate("ws", start, add, lambda acc: acc["text"]).alias("shown"))
    size = F.least(F.col("length") - F.col("chunk").cast("long") * chunk, F.lit(chunk)).cast("int")
    full = pieces.join(shown, ["contig", "chunk"], "left").select("contig", "chunk", F.rpad(F.coalesce("shown", F.lit("")), size, "N").alias("text"))
    lines = F.transform(F.expr(f"sequence(0, (length(text) - 1) div {line})"), lambda k: F.substring(F.col("text"), k * line + 1, F.lit(line)))
    return full.select("contig", "chunk", F.posexplode(lines).alias("k", "text")).select("contig", (F.col("chunk").cast("long") * (chunk // line) + F.col("k")).alias("line_no"), "text")
