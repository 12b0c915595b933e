"""Sessions of events: gap cuts on the time axis, over tables or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """user_id, n, first_ts, last_ts of runs of events that are less than `gap` apart.

    The same plan serves a stream, given how late events may come: state of a session goes once the watermark has passed it.
    """
    rows = events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    if late is not None:
        rows = rows.withWatermark("ts", late)
    window = F.session_window("ts", f"{gap} -1 microseconds")  # a window takes in what comes just at its end
    grouped = rows.groupBy("user_id", window.alias("w"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")).drop("w")
