"""Exact deduplication by a stream with keyed state on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phaseloom.llm.common import delete, join_spread, new_path, stored
from phaseloom.storage import exists, listed

#: State is kept in RocksDB; a store is closed when its task has committed, so that open stores do not pile up on disk.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    """Text with each run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _placed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """doc_id, text and locator of each row, and whether the locator leads back to it: file and row for tables read from files, else a number."""
    try:
        place = docs.select("doc_id", "text", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        return place.select("doc_id", "text", F.concat_ws("#", "_file", "_row").alias("locator")), True
    except Exception as why:  # noqa: BLE001 - the analyzer's error classes differ between classic and Connect
        if "_metadata" not in str(why):
            raise
        return docs.select("doc_id", "text", F.concat(F.lit("row#"), F.monotonically_increasing_id()).alias("locator")), False


def _first() -> Column:
    """The row of a digest that stays: of the earliest batch the smallest doc_id, nulls last."""
    return F.min(F.struct("batch", F.col("doc_id").isNull().alias("none"), "doc_id", "row_no", "locator")).alias("first")


_STATE = "digest string, first struct<batch:int,none:boolean,doc_id:long,row_no:long,locator:string>, n long"


def keyed_state(spark: SparkSession, schema, feed_path: str, checkpoint: str, files_per_batch: int) -> DataFrame:
    """Streams the feed's new files through a RocksDB-backed aggregation and returns the state then, stored.

    State holds, for each digest and without expiry, the stable identifier (batch and smallest doc_id, with row and content
    locator) and the number of rows. Map-side partial aggregation sends one row a task for a digest, however hot.
    With the same checkpoint a later call goes on from what there is, and so does one after a crash.
    """
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{feed_path}/*")
    held = stream.groupBy("digest").agg(_first(), F.count(F.lit(1)).alias("n"))
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        query = (
            held.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if not any(not n.startswith(".") for n in listed(spark, f"{checkpoint}/commits")):  # no file to read: no state
            return spark.createDataFrame([], _STATE)
        state = spark.read.format("statestore").load(checkpoint)
        return stored(state.select("key.digest", "value.*").toDF("digest", "first", "n"), "dedup-final")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _batch(spark: SparkSession, root: str, name: str) -> tuple[int, str]:
    """Number and feed folder of a batch: those that it got in an earlier run, or the next."""
    there = [n for n in listed(spark, f"{root}/feed") if not n.startswith(("_", "."))]
    own = next((n for n in there if n.partition("-")[2] == name), f"{len(there):06d}-{name}")
    return int(own.partition("-")[0]), f"{root}/feed/{own}"


def _texts_at(spark: SparkSession, locators: DataFrame) -> DataFrame:
    """locator and normalised text of rows of files: the content that locators lead to."""
    files = [r[0] for r in locators.select(F.regexp_extract("locator", "^(.*)#\\d+$", 1)).distinct().collect()]
    if not files:
        return spark.createDataFrame([], "locator string, _text string")
    placed, _ = _placed(spark.read.parquet(*files).select("doc_id", "text", "_metadata"))
    return placed.select("locator", normalised(F.col("text")).alias("_text")).join(locators, "locator", "left_semi")


def deduplicate(docs: DataFrame, digest=sha256_digest, files_per_batch: int = 512, state: str | None = None, batch: str = "0") -> DataFrame:
    """One row per row of docs: doc_id, row_no, keep_id, group_size, kept, text_sha256, locator.

    Texts are equal when identical after normalised(); of equal texts the row with the smallest doc_id stays (a
    null doc_id comes last; of rows with one doc_id the first in the input). Only digests go through the stream.
    Rows whose digest was met before are hits: their full normalised texts are found by their locators and compared per digest
    by their least and greatest, which combine map-side, so a hot group of copies never meets in one task. Digests that cover
    different texts are split by the texts themselves. Empty and null texts are copies of each other. An empty
    table gives no rows. Other columns of docs are ignored.

    state: a folder in which state stays, so that a later table is compared with all earlier ones; rows of earlier
    batches win, and group_size counts all. batch names the table: a run that broke is repeated under its name, and a name
    that is done gives its results again (against all batches by then). Tables must be read from Parquet files that stay where they are, as
    full texts of earlier rows are read back by their locators. Without it, state lasts for the call.
    """
    spark = docs.sparkSession
    root = state.rstrip("/") if state else new_path(spark, "dedup-state")
    number, path = _batch(spark, root, batch)
    placed, found = _placed(docs)
    if state and not found:
        raise ValueError("kept state needs tables that are read from files")
    made = placed.select(
        "doc_id", F.monotonically_increasing_id().alias("row_no"), "locator", digest(normalised(F.col("text"))).alias("digest"), F.lit(number).alias("batch")
    )
    if exists(spark, f"{path}/_SUCCESS"):
        feed = spark.read.schema(made.schema).parquet(path)
    else:
        delete(spark, path)
        feed = stored(made, "dedup-feed", path)
    final = keyed_state(spark, made.schema, f"{root}/feed", f"{root}/checkpoint", files_per_batch)
    if not state:
        delete(spark, f"{root}/checkpoint")
    rows = stored(join_spread(feed, final, "digest", counts=final.select("digest", F.col("n").alias("_n"))), "dedup-rows")
    hits = rows.where("n > 1").select("locator" if found else F.col("doc_id").alias("_id")).distinct()
    texts = placed.select("doc_id", "locator", normalised(F.col("text")).alias("_text")).withColumn("digest", digest(F.col("_text")))
    own = texts.join(hits, "locator" if found else texts["doc_id"].eqNullSafe(hits["_id"]), "left_semi").select("digest", "_text")
    if state:
        earlier = stored(rows.where(F.col("first.batch") < number).select("first.locator").distinct(), "dedup-earlier")
        own = own.unionByName(_texts_at(spark, earlier).select(digest(F.col("_text")).alias("digest"), "_text"))
    spread = own.groupBy("digest").agg(F.min("_text").alias("_a"), F.max("_text").alias("_b")).where(F.col("_a") != F.col("_b")).select("digest")
    clashes = stored(spread, "dedup-clashes")
    if not clashes.isEmpty():
        if number:
            raise ValueError("texts that differ have one digest across batches: take a longer digest and an empty state")
        split = (
            feed.join(clashes, "digest", "left_semi")
            .join(texts.join(clashes, "digest", "left_semi").select("doc_id", "_text", "digest").distinct(), ["doc_id", "digest"])
        )
        groups = split.groupBy("_text").agg(_first(), F.count(F.lit(1)).alias("n"))
        again = split.join(groups, "_text").select("digest", "doc_id", "row_no", "locator", "batch", "first", "n")
        rows = rows.join(clashes, "digest", "left_anti").select(again.columns).unionByName(again)
    return rows.select(
        "doc_id",
        "row_no",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        ((F.col("batch") == F.col("first.batch")) & (F.col("row_no") == F.col("first.row_no"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "locator",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """docs without the rows that deduplicate() drops, with all columns, whatever their names.

    Null and empty texts are copies of each other. Of rows with one doc_id and equal texts any one stays (they may differ in
    other columns); of equal texts without doc_id one row. An empty table stays empty.
    """
    out = deduplicate(docs)
    kept = out.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"))
    own = [f"_c{k}" for k in range(len(docs.columns))]
    row = F.struct(*[F.col(c).alias(o) for c, o in zip(docs.columns, own, strict=True)])
    keyed = docs.select(row.alias("_row"), F.col("doc_id").alias("_doc"), sha256_digest(normalised(F.col("text"))).alias("_key"))
    stay = keyed.join(kept, keyed["_doc"].eqNullSafe(kept["_id"]) & (keyed["_key"] == kept["_digest"]), "left_semi")
    twice = out.groupBy("doc_id", "text_sha256").count().where("count > 1")
    if not twice.isEmpty():  # the same row more than once
        stay = stay.dropDuplicates(["_doc", "_key"])
    return stay.select(*[F.col("_row")[o].alias(c) for c, o in zip(docs.columns, own, strict=True)])
