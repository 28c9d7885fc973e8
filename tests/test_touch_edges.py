"""First touch of ideas that enter at 0 or below, and of bars of one time."""

from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tracefoundry.operators import matching

BEGIN = datetime(2024, 1, 1)


def _events(spark, folder):
    """Users whose click is at 0, at -30 and at 100; each has views that reach the target, the stop, or neither."""
    rows, n = [], 0
    for user, (value, moves) in enumerate((value, moves) for value in (0.0, -0.0, -30.0, 100.0) for moves in ((10, 60, -60), (10, -60, 60), (10, -10), ())):
        for i, move in enumerate((0, *moves)):
            rows.append((n, BEGIN + timedelta(hours=3 * i), user, "view" if i else "click", value + move, None))
            n += 1
    made = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    made.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{folder}/events.parquet")


def _agrees(spark, folder, name):
    _events(spark, folder)
    got = sorted(tuple(r) for r in entry.queries()[name](spark, str(folder)).collect())
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
        assert got == sorted(con.sql(entry.oracle_sql()[name]).fetchall())
    assert [ended for _, ended in got] == ["target", "stop", "open", "open"] * 4


def test_theoretical_by_spans_with_entries_at_zero(spark, tmp_path):
    _agrees(spark, tmp_path, "theoretical_by_spans")


@pytest.mark.parametrize("kind", ["double", "int", "decimal(10,2)"])
def test_spans_result_of_an_entry_at_zero(spark, kind):
    ideas = spark.createDataFrame([(1, "A", BEGIN, 0, 5, -5), (2, "A", BEGIN, 10, 11, 9)], "id long, instrument string, ts timestamp, entry int, target int, stop int")
    ideas = ideas.select("id", "instrument", "ts", *(F.col(c).cast(kind).alias(c) for c in ("entry", "target", "stop")))
    bars = spark.createDataFrame([("A", BEGIN + timedelta(hours=h), high, low) for h, high, low in ((1, 10.5, 9.5), (2, 10.6, 9.0), (2, 11.0, 9.5))], "instrument string, ts timestamp, high double, low double")
    for _ in range(3):
        got = {r["id"]: (r["theoretical_pct"], r["stopped"]) for r in matching.first_touch_by_spans(ideas, bars, 5 * 3600).collect()}
        assert got == {1: (None, False), 2: (-10.0, True)}
        bars = bars.orderBy("high" if _ else F.desc("high"))


def test_theoretical_outcome_with_entries_at_zero(spark, tmp_path):
    _agrees(spark, tmp_path, "theoretical_outcome")
