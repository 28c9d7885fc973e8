"""Streamed outcomes against the batch labels, over files that come one by one."""

import random
from datetime import datetime, timedelta


from tracefoundry.operators.matching import label_outcomes
from tracefoundry.streaming.outcomes import run_available, stream_outcomes

BEGIN = datetime(2025, 1, 1)
RECORD = "id long, instrument string, ts timestamp"
TRADE = "instrument string, ts timestamp, realized_pnl_pct double"


def arrive(spark, rows, schema, path, parts):
    """``rows`` by time in ``parts`` files, in order of their names."""
    rows = sorted(rows, key=lambda r: r[-2 if schema is TRADE else -1] or BEGIN)
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1).write.mode("append").parquet(path)


def source(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(path)


def drain(spark, base):
    run_available(stream_outcomes(source(spark, RECORD, f"{base}/records"), source(spark, TRADE, f"{base}/trades"), 3600, "2 hours"), f"{base}/out", f"{base}/check")
    return spark.read.parquet(f"{base}/out")


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, tmp_path):
    rng = random.Random(2)
    at = lambda: BEGIN + timedelta(minutes=rng.randint(0, 2000))
    records = [(i, rng.choice(["BTC", "BTC", "ETH", None]), None if rng.random() < 0.05 else at()) for i in range(120)]
    # times differ, so the nearest trade is one
    trades = [(rng.choice(["BTC", "ETH"]), at() + timedelta(seconds=i), float(i % 7 - 3)) for i in range(50)]
    base = str(tmp_path)
    arrive(spark, records, RECORD, f"{base}/records", 3)
    arrive(spark, trades, TRADE, f"{base}/trades", 3)
    early = {r["id"] for r in drain(spark, base).collect()}
    end = BEGIN + timedelta(days=30)
    spark.createDataFrame([(-1, "end", end)], RECORD).write.mode("append").parquet(f"{base}/records")
    spark.createDataFrame([("end", end, 0.0)], TRADE).write.mode("append").parquet(f"{base}/trades")
    got = {r["id"]: (r["verdict"], r["realized_pnl_pct"]) for r in drain(spark, base).where("id >= 0").collect()}
    assert 0 < len(early) < len(records)
    assert spark.read.parquet(f"{base}/out").where("id >= 0").count() == len(got) == len(records)
    want = label_outcomes(spark.createDataFrame(records, RECORD), spark.createDataFrame(trades, TRADE), 3600).select("id", "verdict", "realized_pnl_pct").collect()
    assert got == {r["id"]: (r["verdict"], r["realized_pnl_pct"]) for r in want}
    assert {v for v, _ in got.values()} == {"WIN", "LOSS", "SCRATCH", "EXPIRED"}


def test_a_late_trade_changes_nothing(spark, tmp_path):
    base = str(tmp_path)
    end = BEGIN + timedelta(days=3)
    for part, (records, trades) in enumerate([([(1, "BTC", BEGIN)], [("ETH", BEGIN, 5.0)]), ([(2, "BTC", end)], [("ETH", end, 5.0)]), ([(3, "BTC", BEGIN)], [("BTC", BEGIN, 9.0)]), ([(4, "x", end + timedelta(days=3))], [("x", end + timedelta(days=3), 1.0)])]):
        spark.createDataFrame(records, RECORD).coalesce(1).write.mode("append").parquet(f"{base}/records")
        spark.createDataFrame(trades, TRADE).coalesce(1).write.mode("append").parquet(f"{base}/trades")
        drain(spark, base)
    got = {r["id"]: r["verdict"] for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {1: "EXPIRED", 2: "EXPIRED"}
