"""Ordered prefix sums and joins that spread hot keys, used by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phaseloom.storage import delete, new_path, stored

__all__ = ["delete", "in_order", "join_spread", "new_path", "shuffle_partitions", "stored", "with_prefix"]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, *order: str, name: str = "ordered") -> DataFrame:
    """Stores df range-partitioned and sorted by `order`, with its range's number in `_range`, its place there in `_tie`.

    Equal keys keep one order, that of the input's partitions; nulls come first. The stored table makes the
    sampled bounds of the ranges final, so that later reads agree.
    """
    n = shuffle_partitions(df.sparkSession)
    keyed = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie")
    return stored(ranged.withColumn("_range", F.spark_partition_id()), name)


def with_prefix(ordered: DataFrame, order: list[str], size: Column) -> DataFrame:
    """Adds `_pos`, the rows before in the whole order, and `_before`, the sum of `size` over them.

    Per-range totals (one row a range) are summed up first; only rows of one range meet in a task.
    """
    sized = ordered.withColumn("_size", size.cast("long"))
    totals = sized.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_s"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s0"),
    )
    here = Window.partitionBy("_range").orderBy(*[F.col(c) for c in order], "_tie")
    placed = (
        sized.withColumn("_k", F.row_number().over(here))
        .withColumn("_c", F.sum("_size").over(here.rowsBetween(Window.unboundedPreceding, 0)))
        .join(offsets, "_range")
    )
    return placed.withColumn("_pos", F.col("_n0") + F.col("_k") - 1).withColumn(
        "_before", F.col("_s0") + F.col("_c") - F.col("_size")
    ).drop("_n0", "_s0", "_k", "_c", "_size")


def join_spread(rows: DataFrame, side: DataFrame, key: str, how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """Inner or left join of rows with side, which has one row a key, such that a key with very many rows never meets in one task.

    Keys with more rows than a shuffle partition's fair share are fewer than the partitions; their rows of side are
    broadcast, all others are shuffled. Null keys match nothing and are not shuffled. rows is read several times and
    should be a stored table. counts: keys with their number of rows (_n), where it is known (others count as few).
    """
    fair = rows.count() // shuffle_partitions(rows.sparkSession)
    if counts is None:
        counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(stored(counts.where(F.col("_n") > fair).select(key), "hot-keys"))
    there = rows.join(hot, key, "left_semi").join(F.broadcast(side.join(hot, key, "left_semi")), key, how)
    rest = rows.where(F.col(key).isNotNull()).join(hot, key, "left_anti").join(side, key, how)
    out = there.unionByName(rest)
    return out.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True) if how == "left" else out
