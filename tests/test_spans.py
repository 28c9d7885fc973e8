"""First touch by a pyramid of spans against meeting every bar."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tracefoundry.operators import matching

BEGIN = datetime(2025, 1, 1)


def test_spans_make_up_a_range(spark):
    """Each slot of [begin, end) is in one span, negative ones too, and a level has few of them."""
    rng = random.Random(1)
    pairs = [(a, a + rng.choice([-3, 0, 1, 2, 5, 17, 64, 100, 700])) for a in (rng.randint(-400, 400) for _ in range(200))]
    for levels in (0, 2, 4):
        got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", matching.covering(F.col("a"), F.col("b"), levels).alias("c")).collect()
        for r in got:
            slots = sorted(s for level, span in r["c"] for s in range(span * 4**level, (span + 1) * 4**level))
            assert slots == list(range(r["a"], r["b"]))
            counts = [sum(level == k for level, _ in r["c"]) for k in range(levels)]
            assert all(n <= 2 * (matching.FANOUT - 1) for n in counts)


def test_first_touch_by_spans(spark):
    rng = random.Random(4)
    price, bars = {"BTC": 100.0, "ETH": 50.0}, []
    for i in range(1500):
        symbol = rng.choice(["BTC", "ETH"])
        price[symbol] += rng.gauss(0, 0.8)
        bars.append((symbol, BEGIN + timedelta(seconds=97 * i), price[symbol] + rng.random(), price[symbol] - rng.random()))
    ideas = []
    for i in range(150):
        symbol, _, high, low = rng.choice(bars)
        at, way, gap = BEGIN + timedelta(seconds=rng.randint(-5000, 150_000)), rng.choice([1, -1]), rng.choice([1, 4, 9, 40])
        entry = (high + low) / 2
        ideas.append((i, rng.choice([symbol, symbol, symbol, "SOL", None]), None if i % 40 == 7 else at, entry, None if i % 31 == 5 else entry + way * gap, None if i % 29 == 3 else entry - way * gap))
    df = spark.createDataFrame(ideas, "id long, instrument string, ts timestamp, entry double, target double, stop double")
    frame = spark.createDataFrame(bars, "instrument string, ts timestamp, high double, low double")
    key = lambda x: (x[0], repr(x[1]))
    for horizon, slot in ((48 * 3600, 300), (3600, 60), (50, 60)):
        want = sorted(((r["id"], r["theoretical_pct"]) for r in matching.first_touch(df, frame, horizon).collect()), key=key)
        got = sorted(((r["id"], r["theoretical_pct"]) for r in matching.first_touch_by_spans(df, frame, horizon, slot).collect()), key=key)
        assert got == want and len(got) == len(ideas)
    ended = {round(x, 1) > 0 for _, x in sorted(((r["id"], r["theoretical_pct"]) for r in matching.first_touch_by_spans(df, frame, 48 * 3600, 300).collect()), key=key) if x is not None}
    assert ended == {True, False}
