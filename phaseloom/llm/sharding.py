"""Contiguous shards of equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phaseloom.llm.common import in_order, with_prefix


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1; a null text has none) and text_crc32 of each row; reads no other column."""
    text = F.col("text").cast("string")
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )


def assign_shards(docs: DataFrame, n_shards: int) -> DataFrame:
    """Cuts documents, in ascending doc_id order, into n_shards contiguous shards of nearly equal bytes.

    Ranges of doc_id give per-partition byte totals, their prefix sums give each document the bytes before it,
    and the shard is that which holds the document's middle byte: shard sizes differ from the target by at most
    one document at each end. Only (doc_id, size, crc) rows are shuffled, never texts.

    Null doc_ids come first; repeated doc_ids keep one order (by size, checksum, then input position). A null
    text counts as empty. An empty table gives no rows; a shard stays empty when one document is larger than
    several targets. Other columns of docs are ignored, whatever their names.
    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot (place in the shard from 0), grown_shard (null).
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    order = ["doc_id", "size", "text_crc32"]
    ordered = in_order(document_sizes(docs), *order, name="shards")
    placed = with_prefix(ordered, order, F.col("size"))
    total = ordered.agg(F.sum("size")).first()[0] or 1
    middle = F.col("_before").cast("decimal(38,0)") * 2 + F.col("size")
    shard = F.least(F.expr("_middle * {} div {}".format(n_shards, 2 * total)), F.lit(n_shards - 1))
    cut = placed.withColumn("_middle", middle).withColumn("shard", shard.cast("int"))
    first = cut.groupBy("shard").agg(F.min("_pos").alias("_first"))
    return cut.join(first, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_pos") - F.col("_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, shards: DataFrame, path: str) -> None:
    """Writes documents in slot order to path/shard=N; docs must have unique doc_ids."""
    placed = docs.join(shards.select("doc_id", "shard", "slot"), "doc_id")
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
