"""Total orders over ranges of rows: numbers and running values without gathering a contig in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phaseloom.storage import stored


def in_ranges(rows: DataFrame, order: list[str], name: str = "ordered") -> DataFrame:
    """Stores rows cut into ranges of `order`, numbered in `_range`; equal keys are in one range. The stored table fixes the sampled bounds."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    return stored(cut, name)


def with_earlier(ranged: DataFrame, by: list[str], **sums) -> DataFrame:
    """ranged with, for each named aggregate of a range's rows, its value over all earlier ranges of the same `by`: sums, or the greatest for names that end in _max.

    One row a range (and value of `by`) is summed up; it is broadcast, as there are no more than ranges and values of `by` together.
    """
    cells = ranged.groupBy(*by, "_range").agg(*[e.alias(n) for n, e in sums.items()])
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    running = [(F.max(n) if n.endswith("_max") else F.sum(n)).over(earlier).alias(n) for n in sums]
    return ranged.join(F.broadcast(cells.select(*by, "_range", *running)), [*by, "_range"])


def numbered(rows: DataFrame, order: list[str], name: str = "idx", offset: int = 0, by: tuple[str, ...] = ()) -> DataFrame:
    """rows with `name`, their numbers from `offset` in the order of the columns `order`; numbers begin anew for each value of `by`."""
    ranged = in_ranges(rows, [*by, *order])
    placed = with_earlier(ranged, list(by), _rows=F.count(F.lit(1)))
    here = Window.partitionBy(*by, "_range").orderBy(*order)
    number = F.row_number().over(here) - 1 + F.coalesce(F.col("_rows"), F.lit(0)) + offset
    return placed.withColumn(name, number.cast("long")).drop("_range", "_rows")
