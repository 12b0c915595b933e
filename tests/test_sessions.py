"""Sessions at the edge of the gap, against the query's SQL."""

from datetime import datetime

import duckdb
from conftest import SF

from phaseloom.plans.catalogue import QUERIES, SQL
from phaseloom.streaming.sessions import sessions

TIMES = {
    1: ["10:00:00.900000", "11:00:00.100000"],  # less than an hour apart, an hour in whole seconds
    2: ["10:00:00.000000", "11:00:00.000000"],  # an hour apart
    3: ["10:00:00.000000", "10:59:59.999999"],
    4: ["10:00:00.100000", "11:00:00.900000", "11:59:59.000000"],
}


def _rows(spark, path):
    rows = [(10 * u + k, datetime.fromisoformat(f"2024-01-01 {t}"), u) for u, ts in TIMES.items() for k, t in enumerate(ts)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long").write.parquet(path)


def _by_sql(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}'")
    return sorted(con.execute(SQL["session_blocks"]).fetchall())


def test_gap_in_whole_seconds(spark, tmp_path):
    _rows(spark, f"{tmp_path}/events.parquet")
    found = sorted(tuple(r) for r in QUERIES["session_blocks"](spark, str(tmp_path)).collect())
    assert found == _by_sql(f"{tmp_path}/events.parquet/*.parquet")
    assert [(u, n) for u, n, *_ in found] == [(1, 1), (1, 1), (2, 1), (2, 1), (3, 2), (4, 1), (4, 2)]


def test_gap_itself_cuts(spark, tmp_path):
    _rows(spark, f"{tmp_path}/events.parquet")
    found = sorted((r["user_id"], r["n"]) for r in sessions(spark.read.parquet(f"{tmp_path}/events.parquet"), "1 hour").collect())
    assert found == [(1, 2), (2, 1), (2, 1), (3, 2), (4, 1), (4, 2)]


def test_all_events(spark):
    folder = SF.replace("sf0.001", "sf0.1")
    found = sorted(tuple(r) for r in QUERIES["session_blocks"](spark, folder).collect())
    assert found == _by_sql(f"{folder}/events.parquet")
