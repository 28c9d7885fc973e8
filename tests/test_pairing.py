"""One-to-one pairs against taking the nearest two again and again."""

import random
from datetime import datetime, timedelta

import pytest

from tracefoundry.operators.pairing import _neighbours, complete_records, pair_one_to_one
from tracefoundry.schemas import RAW_RECORD

BEGIN = datetime(2025, 1, 1)


def brute(left, right, seconds):
    """Of each key, the nearest neighbours of different sides, the first of them; then without these two."""
    out = []
    for key in {r[1] for r in left} & {r[1] for r in right} - {None}:
        rows = sorted((r[2], side, r[0]) for side, own in enumerate((left, right)) for r in own if r[1] == key and r[2] is not None and r[0] is not None)
        while True:
            near = [(b[0] - a[0], i) for i, (a, b) in enumerate(zip(rows, rows[1:])) if a[1] != b[1] and b[0] - a[0] <= timedelta(seconds=seconds)]
            if not near:
                break
            apart, i = min(near)
            ids = {rows[i][1]: rows[i][2], rows[i + 1][1]: rows[i + 1][2]}
            out.append((key, ids[0], ids[1], apart // timedelta(microseconds=1)))
            del rows[i : i + 2]
    return sorted(out)


def frames(spark, left, right):
    return (spark.createDataFrame(own, f"{id} long, symbol string, ts timestamp").repartition(3) for own, id in ((left, "trade"), (right, "entry")))


def check(spark, left, right, seconds):
    got = pair_one_to_one(*frames(spark, left, right), "symbol", seconds, "trade", "entry")
    assert got.columns == ["symbol", "trade", "entry", "apart"]
    assert sorted(tuple(r) for r in got.collect()) == brute(left, right, seconds)


@pytest.mark.parametrize("seed", range(2))
def test_pairs(spark, seed):
    """Many equal times, equal distances, busy and quiet symbols, nulls."""
    rng = random.Random(seed)
    at = lambda: BEGIN + timedelta(minutes=rng.randint(0, 300))
    symbol = lambda: rng.choice(["BTC"] * 6 + ["ETH", "SOL", None])
    left = [(i, symbol(), at()) for i in range(150)] + [(900, "BTC", None), (None, "BTC", at())]
    right = [(i, symbol(), at()) for i in range(130)] + [(901, None, at()), (None, None, None)]
    check(spark, left, right, 600)


def test_a_run_of_nearer_and_nearer_rows(spark):
    at = BEGIN
    left, right = [], []
    for i in range(14):
        (left if i % 2 else right).append((i, "BTC", at))
        at += timedelta(seconds=100 - i)
    check(spark, left, right, 120)


@pytest.mark.parametrize(("left", "right"), [([], []), ([(1, "A", BEGIN)], []), ([(1, "A", BEGIN)], [(1, "A", BEGIN)]), ([(1, "A", BEGIN)], [(2, "A", BEGIN + timedelta(seconds=61))])])
def test_few_rows(spark, left, right):
    check(spark, left, right, 60)


def test_a_busy_symbol_is_many_windows(spark):
    """No window holds more than a stretch of the symbol that all rows have."""
    rows = spark.range(4000).selectExpr("'BTC' AS key", "id div 10 AS stretch", "id AS t", "cast(id % 2 AS int) AS side", "id")
    plan = _neighbours(rows)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("stretch#" in w.split("], [")[1] for w in windows)
    assert _neighbours(rows).where("before.t <> t - 1 or after.t <> t + 1").count() == 0


def test_trades_get_the_text_of_their_entry(spark):
    raw = lambda id, source, symbol, at, text: (id, source, symbol, at, text, None, {"k": id})
    trades = [raw("t1", "on_chain", "BTC/USDT", "2025-01-01T10:00:00Z", ""), raw("t2", "on_chain", "BTC/USDT", "2025-01-01T10:05:00Z", ""), raw("t3", "on_chain", "ETH/USDT", "2025-01-01T10:00:00Z", "")]
    entries = [raw("e1", "own_journal", "BTC/USDT", "2025-01-01T10:04:00+00:00", "long"), raw("e2", "own_journal", "BTC/USDT", "2025-01-01T09:50:00", "early"), raw("e3", "own_journal", None, "2025-01-01T10:00:00", "?")]
    got = complete_records(spark.createDataFrame(trades, RAW_RECORD), spark.createDataFrame(entries, RAW_RECORD), 900)
    rows = {r["id"]: r for r in got.collect()}
    assert {k: r["raw_text"] for k, r in rows.items()} == {"t2": "long", "t1": "early"}
    assert rows["t2"]["metadata"] == {"k": "t2", "entry_id": "e1", "entry_source": "own_journal", "entry_seconds_apart": "60.0"}
