"""The segmented scan gives the rows of the windows per symbol, and deals a busy symbol's fills."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracefoundry.operators import matching, netting

BEGIN = datetime(2025, 1, 1)
ORDER = ("ts", "ordinal")


def fills(spark, seed, n=500, symbols=("BTC", "BTC", "BTC", "BTC", "ETH", "SOL", None)):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = None if rng.random() < 0.02 else BEGIN + timedelta(hours=rng.randint(0, 300))
        rows.append((rng.choice(symbols), at, i, rng.choice(["buy", "sell"]), float(rng.randint(1, 4)) / 4, float(rng.randint(90, 110)), 0.1, str(at)))
    return spark.createDataFrame(rows, "symbol string, ts timestamp, ordinal long, side string, qty double, price double, fee double, ts_raw string").repartition(3)


@pytest.mark.parametrize("seed", range(2))
def test_segmented_netting_equals_windows(spark, seed):
    rows = fills(spark, seed).where("symbol is not null").cache()
    for seconds in (3600 * 5, 86_400):
        plain = netting.leg_events(rows, ORDER, busy=False)
        cut = netting.leg_events(rows, ORDER, busy=True, seconds=seconds)
        assert cut.columns == plain.columns
        key = lambda r: r["ordinal"]
        assert sorted(map(tuple, cut.collect()), key=lambda r: r[2]) == sorted(map(tuple, plain.collect()), key=lambda r: r[2])
    own = lambda busy: sorted(map(repr, netting.legs(rows, ORDER, busy=busy).drop("entered", "left").collect()))
    assert own(True) == own(False)
    rows.unpersist()


@pytest.mark.parametrize("forward", [False, True])
def test_segmented_as_of_equals_windows(spark, forward):
    left, right = fills(spark, 5, 200), fills(spark, 6, 150).withColumn("price", F.when(F.col("ordinal") % 9 != 0, F.col("price")))
    run = lambda seconds: sorted(map(repr, matching.as_of(left, right, "symbol", F.col("price"), ["ts", "ordinal"], forward, seconds).where("symbol is not null").collect()))
    assert run(None) == run(86_400) == run(3600)


def test_one_symbol_is_many_tasks(spark):
    """A symbol with all fills: no task of the windows gets more than a few of its stretches."""
    rows = spark.range(24_000).selectExpr("'BTC' AS symbol", "timestamp_seconds(id * 600) AS ts", "id AS ordinal", "if(id % 3 = 0, 'buy', 'sell') AS side", "1.0D AS qty", "2.0D AS price", "0.0D AS fee", "'' AS ts_raw")
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")
    try:
        spread = netting.leg_events(rows, ORDER, busy=True).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(small)
    assert len(spread) == 4 and max(r["count"] for r in spread) < 2 * 24_000 / 4
    assert not netting.is_busy(rows)


def test_a_busy_symbol_chooses_the_segmented_scan(spark, monkeypatch):
    monkeypatch.setattr(netting, "BUSY", 100)
    rows = fills(spark, 3)
    assert netting.is_busy(rows)
    plan = netting.running_position(rows, ORDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "__stretch" in plan
