"""Expressions, sources, netting, transforms, labels, validation, sinks and CLI on fixtures."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tracefoundry import cli
from tracefoundry.functions import exprs as E
from tracefoundry.functions import trading as T
from tracefoundry.operators import netting, scoring, selection, semantic, stats, transform
from tracefoundry.operators.matching import as_of, first_touch, label_outcomes, read_back_verdicts, written_before_outcome
from tracefoundry.operators.validate import json_errors, schema_errors, typed_errors
from tracefoundry.plans import dataset
from tracefoundry.sinks import files
from tracefoundry.sinks.shards import read_manifest
from tracefoundry.sources import collectors, post_api
from tracefoundry.sources.fills import read_fills
from tracefoundry.sources.posts import read_posts, trade_ideas

FILLS = """timestamp,symbol,side,price,qty,fee,pnl,order_type
2025-10-12T06:35:00Z,BTC/USDT,buy,61215.50,0.082,4.10,0.00,market
2025-10-12T06:36:00Z,BTC/USDT,buy,61190.00,0.041,2.05,0.00,limit
2025-10-13T00:55:00Z,BTC/USDT,sell,63480.00,0.123,6.35,281.47,limit
2025-10-18T09:20:00Z,ETH/USDT,sell,2428.50,1.240,2.49,0.00,market
2025-10-18T09:21:00Z,ETH/USDT,sell,2431.00,0.620,1.24,0.00,limit
2025-10-20T14:10:00Z,ETH/USDT,buy,2281.00,1.860,3.73,-285.12,limit
2025-11-02T14:05:00Z,SOL/USDT,buy,172.40,23.200,3.31,0.00,market
2025-11-04T11:30:00Z,SOL/USDT,sell,185.20,23.200,3.53,296.64,limit
2025-11-22T07:10:00Z,BTC/USDT,buy,64810.00,0.093,4.97,0.00,market
2025-11-22T07:11:00Z,BTC/USDT,buy,64780.00,0.046,2.46,0.00,limit
2025-11-25T09:45:00Z,BTC/USDT,sell,68490.00,0.139,7.84,508.91,limit
"""


def column(spark, kind, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["out"] for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_numbers_print_like_python(spark):
    rng = random.Random(1)
    values = [0.5, 1.5, 2.5, 2.675, 1.005, 0.25, 1e7, 123456789.125, 1e-4, 5e-5, 1e15, 1e16, 1.5e300, -2.5, 0.0, 100.0, 0.1] + [rng.uniform(-1e5, 1e5) for _ in range(300)] + [round(rng.uniform(0, 9), 3) + 0.0005 for _ in range(200)]
    for n in (0, 2, 4, 6):
        assert column(spark, "double", values[:17] + values[17:], E.rounded(F.col("x"), n)) == [round(v, n) for v in values]
    values = [v for v in values if v < 1e15]
    assert column(spark, "double", values, E.fixed(F.col("x"), 2)) == [f"{v:.2f}" for v in values]
    assert column(spark, "double", values, E.grouped(F.col("x"), 1)) == [f"{v:,.1f}" for v in values]
    assert column(spark, "double", values, E.signed(F.col("x"), 2)) == [f"{v:+.2f}" for v in values]
    plain = [*values, 1e15, 1e16]
    assert column(spark, "double", plain, E.float_text(F.col("x"))) == [str(v) for v in plain]
    assert column(spark, "double", [1.5e300, 1e-7, 1.25e-5, float("inf"), float("nan"), None], E.float_text(F.col("x"))) == ["1.5e+300", "1e-07", "1.25e-05", "inf", "nan", None]


def test_texts_read_like_python(spark):
    words = ["", " ", "a", "  a  bc\n d ", "a b　c", "x\x1cy", "w " * 19, "w " * 20, "w " * 49, "w " * 50, "w " * 400, "w " * 401, "w " * 600, "w " * 601]
    assert column(spark, "string", words, E.word_count(F.col("x"))) == [len(w.split()) for w in words]
    assert column(spark, "string", words[6:], scoring.depth(F.col("x"))) == [0.1, 0.4, 0.4, 1.0, 1.0, 0.8, 0.8, 0.6]
    pads = ["  a ", "　b\t", "\x1cc", "d", ""]
    assert column(spark, "string", pads, E.strip(F.col("x"))) == [p.strip() for p in pads]
    numbers = ["1", " 1.5 ", "1_000.5", "1e3", ".5", "5.", "-2", "+3", "1d", "0x10", "", "abc", "1__0", "inf", "-Infinity"]

    def parse(s):
        try:
            return float(s)
        except ValueError:
            return None

    assert column(spark, "string", numbers, E.parse_float(F.col("x"))) == [parse(s) for s in numbers]


def test_iso_times(spark):
    texts = ["2025-10-12T06:35:00Z", "2025-10-12T06:35:00", "2025-10-12", "2025-10-12T06:35:00.5+08:00", "2025-10-12 06:35", " 2025-01-01T00:00:00Z ", "soon", None]
    iso = ["2025-10-12T06:35:00+00:00", "2025-10-12T06:35:00+00:00", "2025-10-12T00:00:00+00:00", "2025-10-12T06:35:00.500000+08:00", "2025-10-12T06:35:00+00:00", "2025-01-01T00:00:00+00:00", None, None]
    assert column(spark, "string", texts, E.iso_text(F.col("x"))) == iso
    assert column(spark, "string", texts, F.date_format(E.parse_iso(F.col("x")), "yyyy-MM-dd HH:mm:ss.S"))[3] == "2025-10-11 22:35:00.5"
    assert column(spark, "string", ["soon", None], F.date_format(E.parse_iso_or_2020(F.col("x")), "yyyy-MM-dd")) == ["2020-01-01"] * 2


def test_words_tickers_and_prices(spark):
    texts = ["going LONG", "shorting now", "bearish", "belong", "BTC回调 long", "everyone long, WAIT", ""]
    assert column(spark, "string", texts, T.direction_in(F.col("x"))) == ["long", "short", "short", None, "long", "long", None]
    symbols = ["sol-PERP up", "eth/usd", "BTC回调", "ethos", "buy wif and BTC", "opex OP"]
    assert column(spark, "string", symbols, T.symbol_in(F.col("x"))) == ["SOL/USDT", "ETH/USDT", None, None, "WIF/USDT", "OP/USDT"]
    assert column(spark, "string", ["at $61,200.5 or 3 of 12345678"], T.prices_in(F.col("x")))[0][:2] == ["61,200", "5"]
    cases = [(0.5, "BTC/USDT", "$0"), (0.25, "ETH/USDT", "$0.2"), (0.5, "XRP", "$0.5000"), (0.05, "ETH/BTC", "$0"), (None, "BTC", "N/A"), (61200.0, "btc", "$61,200"), (1234.5678, "X", "$1,234.5678")]
    df = spark.createDataFrame([(p, s) for p, s, _ in cases], "p double, s string")
    assert [r[0] for r in df.select(T.format_price(F.col("p"), F.col("s"))).collect()] == [c[2] for c in cases]
    assert column(spark, "double", [1.0, 1.0001, -1.0, -1.0001, 0.0], T.verdict(F.col("x"))) == ["SCRATCH", "WIN", "SCRATCH", "LOSS", "SCRATCH"]
    assert column(spark, "double", [3.99, 4.0, 47.99, 48.0], T.holding_bucket(F.col("x"))) == ["scalp", "swing", "swing", "position-trade"]
    df = spark.createDataFrame([(3.0, 100.0, 99.0), (3.0, 100.0, 100.0), (3.0, 0.0, 1.0), (3.0, 100.0, None)], "p double, e double, s double")
    assert [r[0] for r in df.select(T.r_multiple(*map(F.col, "pes"))).collect()] == [3.0, None, None, None]


def as_fills(spark, rows, parts=3):
    schema = "symbol string, ts timestamp, ts_raw string, side string, price double, qty double, fee double, ordinal struct<path:string,block:bigint,row:bigint>"
    made = [(s, *at(t), side, float(p), float(q), float(f), ("f", 0, i)) for i, (s, t, side, p, q, f) in enumerate(rows)]
    return spark.createDataFrame(made, schema).repartition(parts)


def at(hour):
    from datetime import datetime, timedelta, timezone

    t = datetime(2025, 1, 1, tzinfo=timezone.utc) + timedelta(hours=hour)
    return t, t.isoformat()


def fold(rows):
    """Independent position fold: legs (symbol, direction, entry, exit, qty, fee)."""
    out = []
    for symbol in dict.fromkeys(r[0] for r in rows):
        net, open_ = Decimal(0), []
        for r in sorted((r for r in rows if r[0] == symbol), key=lambda r: r[1]):
            after = round(net + Decimal(str(r[4])) * (1 if r[2] == "buy" else -1), 10)
            if net == 0 and after != 0:
                open_ = [r]
            elif net * after > 0:
                open_.append(r)
            else:
                if open_:
                    q = sum(o[4] for o in open_)
                    entry = sum(o[3] * o[4] for o in open_) / q if q else 0.0
                    out.append((symbol, "long" if open_[0][2] == "buy" else "short", round(entry, 6), float(r[3]) if r[4] else 0.0, round(q, 8), round(sum(o[5] for o in open_) + r[5], 6)))
                open_ = [] if net != 0 and after == 0 else [r]
            net = after
    return sorted(out)


def trips(df):
    return sorted(tuple(r) for r in netting.round_trips(df).select("symbol", "direction", "avg_entry_price", "avg_exit_price", "total_qty", "total_fee").collect())


def test_netting_cases(spark):
    part = [("P", 0, "buy", 100, 2, 0), ("P", 1, "sell", 110, 1, 0), ("P", 2, "sell", 120, 1, 0)]
    flip = [("F", 0, "buy", 10, 1, 1), ("F", 1, "sell", 11, 2, 1), ("F", 2, "buy", 12, 1, 1)]
    zero = [("Z", 0, "buy", 5, 0, 0), ("Z", 1, "buy", 5, 0, 0)]
    left = [("L", 0, "buy", 1, 1, 0)]
    same = [("S", 0, "buy", 10, 1, 0), ("S", 0, "sell", 11, 1, 0)]
    rows = part + flip + zero + left + same
    df = as_fills(spark, rows)
    assert trips(df) == fold(rows) == [
        ("F", "long", 10.0, 11.0, 1.0, 2.0), ("F", "short", 11.0, 12.0, 2.0, 2.0), ("P", "long", 103.333333, 120.0, 3.0, 0.0), ("S", "long", 10.0, 11.0, 1.0, 0.0), ("Z", "long", 0.0, 0.0, 0.0, 0.0),
    ]
    z = netting.round_trips(df).where("symbol = 'Z'").first()
    assert (z["realized_pnl_pct"], z["verdict"]) == (0.0, "SCRATCH")
    assert {(r["symbol"], float(r["net"])) for r in netting.open_positions(df).collect()} == {("L", 1.0)}
    alt = {r["symbol"]: r for r in netting.average_cost_trips(df).where("symbol <> 'F'").collect()}
    assert (alt["P"]["avg_entry_price"], alt["P"]["avg_exit_price"], alt["P"]["realized_pnl"]) == (100.0, 115.0, 30.0)
    flips = {r["direction"]: (r["total_qty"], r["realized_pnl"]) for r in netting.average_cost_trips(df).where("symbol = 'F'").collect()}
    assert flips == {"long": (1.0, pytest.approx(-0.5)), "short": (1.0, pytest.approx(-2.5))}


@pytest.mark.parametrize("parts", [1, 7])
def test_netting_against_fold(spark, parts):
    rng = random.Random(parts)
    rows = [(f"S{rng.randrange(12)}", rng.randrange(200), rng.choice(["buy", "sell"]), rng.randrange(1, 50), rng.choice([0, 1, 1, 2, 3]), 0.25) for _ in range(1500)]
    rows.sort(key=lambda r: r[1])
    assert trips(as_fills(spark, rows, parts)) == fold(rows)


def test_golden_round_trips(spark, tmp_path):
    path = tmp_path / "fills.csv"
    path.write_text(FILLS)
    fills, rejects = read_fills(spark, str(path))
    assert rejects.count() == 0
    seen = {r["symbol"]: r["seen_first"] for r in netting.first_seen(fills).collect()}
    assert sorted(seen, key=lambda s: seen[s]) == ["BTC/USDT", "ETH/USDT", "SOL/USDT"]
    got = [tuple(r) for r in netting.round_trips(fills).orderBy("symbol", "leg").select("symbol", "direction", "entry_time", "avg_entry_price", "avg_exit_price", "total_qty", "total_fee", "realized_pnl", "realized_pnl_pct", "holding_period_hours", "verdict").collect()]
    assert got == [
        ("BTC/USDT", "long", "2025-10-12T06:35:00+00:00", 61207.0, 63480.0, 0.123, 12.5, 267.079, 3.5476, 18.33, "WIN"),
        ("BTC/USDT", "long", "2025-11-22T07:10:00+00:00", 64800.071942, 68490.0, 0.139, 15.27, 497.63, 5.5248, 74.58, "WIN"),
        ("ETH/USDT", "short", "2025-10-18T09:20:00+00:00", 2429.333333, 2281.0, 1.86, 7.46, 268.44, 5.9408, 52.83, "WIN"),
        ("SOL/USDT", "long", "2025-11-02T14:05:00+00:00", 172.4, 185.2, 23.2, 6.84, 290.12, 7.2536, 45.42, "WIN"),
    ]
    both = netting.round_trips(fills, with_fills=True).where("symbol = 'ETH/USDT'").first()
    assert (len(both["fills_open"]), len(both["fills_close"])) == (2, 1)


def test_fill_rejects(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("timestamp,symbol,side,price,qty,fee\n2025-01-01,x,hold,1,1,0\n2025-01-01,x,buy,one,1,0\nnever,x,buy,1,1,0\n2025-01-01,x\n 2025-01-01T00:00:00 , btc/usdt ,BUY,1_0.5,1,0\n\n")
    fills, rejects = read_fills(spark, str(path))
    assert [(r["symbol"], r["side"], r["price"], r["order_type"], r["pnl_from_exchange"]) for r in fills.collect()] == [("BTC/USDT", "buy", 10.5, "market", 0.0)]
    assert sorted(r["reason"] for r in rejects.collect()) == ["price", "price", "side", "timestamp"]
    path.write_text("timestamp,symbol,side,price,qty\n")
    with pytest.raises(ValueError, match="fee"):
        read_fills(spark, str(path))


POSTS = [
    {"id": "1", "author": "A", "handle": "@a", "timestamp": "2025-10-12T06:30:00Z", "text": "liquidity sweep then up", "trade": {"symbol": "BTC/USDT", "direction": "long", "entry": 61200, "target": 63500, "stop": 60400, "size": 5.0}, "reasoning": "r" * 120, "media": []},
    {"id": "2", "handle": "@b", "timestamp": "2025-10-13T00:00:00Z", "text": "shorting doge, funding high", "trade": None, "reasoning": None},
    {"id": "3", "timestamp": "2025-10-13T00:00:00Z", "text": "no view", "trade": None},
    {"id": "4", "timestamp": "2025-10-14T00:00:00Z", "text": "zero", "trade": {"symbol": "XRP/USDT", "direction": "Bearish", "entry": 0, "target": 2, "stop": 1, "size": 3}, "reasoning": "x" * 81},
    {"id": "5", "timestamp": None, "text": "long btc", "trade": None},
    {"id": "6", "timestamp": "2025-10-15T00:00:00Z", "text": "empty", "trade": {}},
]


def test_posts_to_examples(spark, tmp_path):
    path = tmp_path / "posts.json"
    path.write_text(json.dumps(POSTS))
    ideas, rejects = trade_ideas(read_posts(spark, str(path)))
    assert {(r["tweet_id"], r["reason"]) for r in rejects.collect()} == {("3", "direction"), ("5", "timestamp")}
    rows = {r["ord"]["row"]: r for r in transform.ideas_to_examples(ideas).collect()}
    first, regex, zero, empty = rows[0], rows[1], rows[3], rows[5]
    assert first["decision"].asDict() == {"direction": "LONG", "entry_zone": [61200.0], "invalidation": 60400.0, "targets": [63500.0], "position_size_pct": 5.0, "confidence": 5}
    assert first["tags"] == ["bullish-bias", "structured-setup", "detailed-reasoning", "liquidity-grab"]
    assert "- R:R ratio: 2.88:1" in first["reasoning"] and "Position size: 5.0% of capital." in first["reasoning"] and "- Risk: $800 | Reward: $2,300" in first["reasoning"]
    assert first["context"].split("\n")[:9] == ["Asset: BTC/USDT", "Timestamp: 2025-10-12T06:30:00Z", "KOL setup posted by A (@a)", "Proposed direction: LONG", "Entry zone: $61,200", "Target: $63,500", "Stop / Invalidation: $60,400", "Proposed size: 5.0%", ""]
    assert (regex["instrument"], regex["decision"]["direction"], regex["decision"]["confidence"], regex["tags"]) == ("DOGE/USDT", "SHORT", 1, ["bearish-bias", "funding-rate"])
    assert "See tweet context" in regex["reasoning"] and "Position size: not specified." in regex["reasoning"] and "R:R" not in regex["reasoning"]
    # zero counts as a level of the decision, not of the confidence or the ratio
    assert (zero["decision"]["entry_zone"], zero["decision"]["confidence"], zero["decision"]["direction"]) == ([0.0], 4, "SHORT")
    assert "R:R" not in zero["reasoning"] and "Proposed size: 3%" in zero["context"]
    assert (empty["instrument"], empty["decision"]["direction"]) == ("", "WAIT")
    ids = [r["id"] for r in transform.ideas_to_examples(ideas).collect()]
    assert sorted(ids) == sorted(r["id"] for r in rows.values())
    path.write_text("{}")
    with pytest.raises(Exception, match="array"):
        read_posts(spark, str(path)).collect()


def test_expander(spark, tmp_path):
    path = tmp_path / "posts.json"
    path.write_text(json.dumps(POSTS[:2]))
    ideas, _ = trade_ideas(read_posts(spark, str(path)))
    told = transform.ideas_to_examples(ideas, lambda r: r["symbol"] + " expanded").collect()
    assert {r["reasoning"] for r in told} == {"BTC/USDT expanded", "DOGE/USDT expanded"}

    def broken(record):
        raise ConnectionError("no network")

    assert all("Market Structure" in r["reasoning"] for r in transform.ideas_to_examples(ideas, broken).collect())


def test_label_plan(spark, tmp_path):
    (tmp_path / "f.csv").write_text(FILLS)
    (tmp_path / "p.json").write_text(json.dumps(POSTS[:1]))
    rows = dataset.all_examples(dataset.post_examples(spark, str(tmp_path / "p.json")), dataset.fill_examples(spark, str(tmp_path / "f.csv")))
    labeled, stats_ = dataset.label(rows)
    assert {k: stats_[k] for k in ("total_input", "after_dedup", "final", "train", "val", "quality_mean")} == {"total_input": 5, "after_dedup": 5, "final": 5, "train": 4, "val": 1, "quality_mean": round((0.68 + 4 * 0.8167) / 5, 4)}
    assert stats_["sources"] == {"kol_post": 1, "on_chain": 4} and stats_["verdicts"] == {"WIN": 4, "none": 1}
    scores = {r["source"]: r["quality_score"] for r in labeled.collect()}
    assert scores == {"kol_post": 0.68, "on_chain": 0.8167}
    assert [r["timestamp_context"] for r in labeled.where("split = 'val'").collect()] == ["2025-11-22T07:10:00+00:00"]
    assert labeled.where(F.size(typed_errors()) > 0).count() == 0
    order = [r["instrument"] for r in labeled.orderBy("ord").collect()]
    assert order == ["BTC/USDT", "BTC/USDT", "BTC/USDT", "ETH/USDT", "SOL/USDT"]
    _, fewer = dataset.label(rows, dataset.LabelOptions(min_quality=0.7, min_r=1.5))
    assert (fewer["final"], fewer["after_outcome_filter"], fewer["total_input"]) == (4, 4, 5)
    audit = {r["source"]: r["leakage_audit"] for r in transform.leaks_outcome(labeled).collect()}
    assert audit == {"kol_post": False, "on_chain": True}
    card = dataset.run_export(labeled, str(tmp_path / "out"), dataset.ExportOptions("2025-10-15", "2025-11-10"))
    assert card["splits"] == {"test": 1, "train": 2, "val": 2} and card["total_examples"] == 5
    assert spark.read.json(str(tmp_path / "out" / "test.jsonl")).count() == 1


@pytest.mark.parametrize(("n", "fraction", "want"), [(0, 0.15, 0), (1, 0.15, 1), (6, 0.15, 1), (7, 0.15, 1), (20, 0.15, 3), (5, 0.0, 1), (4, 1.5, 4)])
def test_split_sizes(spark, n, fraction, want):
    df = spark.createDataFrame([(i, i // 2) for i in range(n)], "id int, t int")
    for top_k in (100, 0):
        got = {r["id"]: r["split"] for r in selection.time_split(df, F.col("t"), F.col("id"), fraction, top_k).collect()}
        assert sorted(i for i, s in got.items() if s == "val") == list(range(n - want, n)) if n else got == {}


def test_dedup(spark):
    rows = [(0, "btc", "2025-01-01T23:00:00+08:00", "LONG", "a"), (1, "BTC", "2025-01-01", "LONG", "a"), (2, "BTC", "2025-01-02T01:00Z", "LONG", "a"), (3, "BTC", "2025-01-01", "LONG", "b"), (4, None, None, None, None), (5, "", "", None, "")]
    df = spark.createDataFrame([(i, n, t, (d,), s) for i, n, t, d, s in rows], "ord int, instrument string, timestamp_context string, decision struct<direction:string>, source string").repartition(4)
    assert sorted(r["ord"] for r in selection.deduplicate(df).collect()) == [0, 2, 3, 4]
    assert sorted(r["ord"] for r in selection.deduplicate(df, "time").collect()) == [0, 1, 2, 3, 4]
    import hashlib

    key = df.where("ord = 0").select(selection.dedup_key(F.col("instrument"), F.col("timestamp_context"), F.col("decision.direction"), F.col("source"))).first()[0]
    assert key == hashlib.md5(b"BTC|2025-01-01|LONG|a").hexdigest()


def good():
    return {
        "id": "0" * 8 + "-0000-4000-8000-" + "0" * 12, "version": "1.0", "split": "train", "source": "kol_post", "instrument": "B", "timeframe": "4h", "timestamp_context": "2025-01-01T00:00:00Z",
        "system_prompt": "s" * 10, "context": "c" * 20, "reasoning": "r" * 50, "decision": {"direction": "LONG"},
    }


def test_json_rules(spark):
    def with_(**change):
        return {**good(), **change}

    d = lambda **k: with_(decision={"direction": "LONG", **k})
    ok = [good(), d(confidence=True), with_(outcome=None), d(confidence=5, entry_zone=["x"], targets=[1]), with_(quality_score=1, tags=[]), with_(extra=1), d(position_size_pct=100.0, invalidation=0.5), with_(outcome={"verdict": "WIN", "holding_period_hours": 0})]
    bad = {
        "id: not a UUID": with_(id="x"), "version: not N.N": with_(version="1"), "split: unknown": with_(split="x"), "source: unknown": with_(source=None),
        "timestamp_context: not ISO 8601": with_(timestamp_context="2025-01-01"), "context: shorter than 20": with_(context="c"), "reasoning: not a string": with_(reasoning=5), "instrument: shorter than 1": with_(instrument=""),
        "decision: not an object": with_(decision=[]), "decision.direction: unknown": with_(decision={}), "decision.entry_zone: not 1 or 2 numbers": d(entry_zone=[1, 2, 3]), "decision.invalidation: not a number": d(invalidation="x"),
        "decision.targets: empty": d(targets=[]), "decision.confidence: not in 1..5": d(confidence=2.5), "decision.position_size_pct: not in 0..100": d(position_size_pct=101), "outcome: not an object": with_(outcome=[]),
        "outcome.verdict: unknown": with_(outcome={"verdict": None}), "outcome.holding_period_hours: negative": with_(outcome={"holding_period_hours": -1}), "quality_score: not in [0, 1]": with_(quality_score=1.5), "tags: not a list": with_(tags="x"),
    }
    missing = {k: v for k, v in good().items() if k != "context"}
    got = column(spark, "string", [json.dumps(e) for e in [*ok, *bad.values(), missing]] + ["[]", "no json"], json_errors(F.col("x")))
    assert got == [[]] * len(ok) + [[k] for k in bad] + [["context: missing"], ["not an object"], ["not an object"]]


def test_schema_rules(spark):
    schema = {"required": ["a"], "additionalProperties": False, "type": "object", "properties": {"a": {"type": "string", "minLength": 2, "pattern": "^x"}, "n": {"type": "number", "minimum": 0, "maximum": 1}, "o": {"type": "object", "required": ["k"], "properties": {"k": {"enum": ["p", "q"]}}}, "l": {"type": "array", "minItems": 1, "maxItems": 2}}}
    texts = ['{"a": "xy"}', '{"a": "y"}', "{}", '{"a": "xx", "n": 2, "z": 1}', '{"a": "xx", "o": {"k": "r"}}', '{"a": "xx", "o": {}, "l": []}', "x"]
    got = column(spark, "string", texts, schema_errors(F.col("x"), schema))
    assert got == [[], ["a: pattern", "a: minLength"], ["a: required"], ["object: additional property", "n: maximum"], ["o.k: enum"], ["o.k: required", "l: minItems"], ["not JSON"]]


def test_json_schema_items_and_formats(spark):
    node = {"type": "object", "properties": {"k": {"type": "string"}, "g": {"type": "array", "items": {"type": "integer", "minimum": 0}}}, "required": ["k"]}
    schema = {"type": "object", "properties": {"id": {"format": "uuid"}, "t": {"format": "date-time"}, "d": {"format": "date"}, "e": {"format": "unheard-of"}, "z": {"type": "array", "items": {"type": "number", "maximum": 5}}, "o": {"type": "array", "items": node}}}
    good = '{"id": "0b5bfa7e-1111-4222-8333-444455556666", "t": "2025-01-01T10:00:00.5+02:00", "d": "2024-02-29", "e": "?", "z": [1, 2.5], "o": [{"k": "x", "g": [1]}, {"k": "y"}]}'
    texts = [good, "{}", '{"id": "x", "t": "2025-01-01", "d": "2025-02-29"}', '{"t": "2025-13-01T00:00:00Z", "z": [1, "2"]}', '{"z": [6, null, 7]}', '{"z": 3, "o": [1, {"g": [0, -1, "a"]}]}', '{"z": [], "o": [{"k": 1}]}', "[1]", None]
    got = column(spark, "string", texts, schema_errors(F.col("x"), schema))
    assert got == [[], [], ["id: format", "t: format", "d: format"], ["t: format", "z[]: type"], ["z[]: type", "z[]: maximum"], ["z: type", "o[]: type", "o[].k: required", "o[].g[]: type", "o[].g[]: minimum"], ["o[].k: type"], ["object: type"], ["not JSON"]]


def test_sinks_and_cli(spark, tmp_path, capsys):
    out = str(tmp_path / "run")
    assert cli.main(["--demo", "--out-dir", out], spark) == 0
    lines = [json.loads(x) for x in (tmp_path / "run" / "sft_dataset.jsonl").read_text(encoding="utf-8").splitlines()]
    val = (tmp_path / "run" / "sft_dataset.val.jsonl").read_text().splitlines()
    assert (len(lines), len(val)) == (4, 1)
    assert [x["source"] for x in lines[:2]] == ["kol_post", "kol_post"] and "outcome" not in lines[0] and list(lines[0])[:3] == ["id", "version", "split"]
    report = (tmp_path / "run" / "stats.md").read_text()
    assert "| on_chain | 3 |" in report and "**33.3%**" in report
    assert "Win rate" in capsys.readouterr().out
    assert cli.main([], spark) == 1
    assert cli.main(["--trades", str(tmp_path / "none.csv")], spark) == 1
    assert cli.main(["--demo", "--min-quality", "0.99", "--out-dir", out], spark) == 1
    assert cli.main(["--demo", "--no-keep-losers", "--out-dir", out], spark) == 0
    labeled, _ = dataset.label(dataset.fill_examples(spark, str(cli.SAMPLES / "fills.csv")))
    flagged = labeled.withColumn("flag_reason", selection.review_reason(F.col("source"), F.col("quality_score"), F.lit(None), F.lit(False)))
    files.write_review_queue(flagged, str(tmp_path / "queue"))
    assert spark.read.csv(str(tmp_path / "queue"), header=True).columns == files.REVIEW_COLUMNS
    shown = files.preview(labeled).first()
    assert len(shown["reasoning"]) == 123 and "system_prompt" not in shown.asDict()
    bad = labeled.withColumn("version", F.lit("x"))
    assert files.write_jsonl(bad, str(tmp_path / "bad.jsonl")) == (0, 3)
    assert cli.main(["--demo", "--shards", "--out-dir", str(tmp_path / "shards")], spark) == 0
    told = read_manifest(str(tmp_path / "shards" / "sft_dataset.jsonl"))
    assert (told["rows"], told["skipped"]) == (4, 0)


def test_collectors(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "2025-03-01.md").write_text("# BTC long\nplan\n# second 2025-03-02\nETH\n")
    journal = collectors.JournalCollector(str(tmp_path / "j")).collect(spark).orderBy("timestamp_context").collect()
    assert [(r["instrument"], r["timestamp_context"]) for r in journal] == [("BTC/USDT", "2025-03-01"), ("ETH/USDT", "2025-03-02")]
    pages = spark.createDataFrame([("u", "<style>x</style><h1>A &amp; B</h1><p>one<h2>C</h2>two")], "url string, html string")
    assert [r["raw_text"] for r in collectors.ResearchCollector(pages).collect(spark).collect()] == ["A & B one", "C two"]
    chats = spark.createDataFrame([(1, 1, "b", "late"), (1, 0, "a", "early btc")], "conv_id long, turn long, role string, text string")
    assert collectors.ChatLogCollector(chats).collect(spark).first()["raw_text"] == "a: early btc\nb: late"
    trips_ = spark.createDataFrame([("BTC", "long", "t0", "t1", 2.0, "WIN")], "symbol string, direction string, entry_time string, exit_time string, realized_pnl_pct double, verdict string")
    counts = collectors.run_collection(spark, [collectors.ChatLogCollector(chats), collectors.OnChainCollector(trips_)], str(tmp_path / "raw"))
    assert {r["source"]: r["records"] for r in counts.collect()} == {"chat_log": 1, "on_chain": 1}
    (tmp_path / "p.json").write_text(json.dumps(POSTS[:2]))
    assert collectors.PostCollector(["@a"], "twitter", str(tmp_path / "p.json")).collect(spark).count() == 1
    with pytest.raises(ValueError):
        collectors.PostCollector([], "pigeon", "")
    with pytest.raises(NotImplementedError):
        post_api.PostApiSource({"token": "t"}).fetch("a", "t")
    with pytest.raises(OSError):
        post_api.PostApiSource({}).reader(None)


def test_time_joins(spark):
    ts = lambda *rows: spark.createDataFrame([(*r[:-1], at(r[-1])[0]) for r in rows], "id int, instrument string, ts timestamp")
    records = ts((1, "B", 10), (2, "B", 100), (3, "E", 10))
    trades = spark.createDataFrame([("B", at(11)[0], 3.0), ("B", at(9.5)[0], -4.0), ("E", at(30)[0], 1.0)], "instrument string, ts timestamp, realized_pnl_pct double")
    got = {r["id"]: (r["realized_pnl_pct"], r["verdict"]) for r in label_outcomes(records, trades, 2 * 3600).collect()}
    assert got == {1: (-4.0, "LOSS"), 2: (None, "EXPIRED"), 3: (None, "EXPIRED")}
    back = {r["id"]: r["matched"] for r in as_of(records, trades, "instrument", F.col("realized_pnl_pct"), ["ts"]).collect()}
    assert back == {1: -4.0, 2: 3.0, 3: None}
    ideas = records.selectExpr("id", "instrument", "ts", "100d AS entry", "110d AS target", "95d AS stop")
    bars = spark.createDataFrame([("B", at(11)[0], 105.0, 96.0), ("B", at(12)[0], 111.0, 97.0), ("B", at(101)[0], 120.0, 90.0)], "instrument string, ts timestamp, high double, low double")
    assert {r["id"]: r["theoretical_pct"] for r in first_touch(ideas, bars, 5 * 3600).collect()} == {1: 10.0, 2: -5.0, 3: None}
    rows = spark.createDataFrame([(1, "WIN"), (2, "LOSS")], "id int, verdict string")
    seen = read_back_verdicts(rows, spark.createDataFrame([(2, "SCRATCH")], "id int, verdict string"))
    assert {r["id"]: r["verdict"] for r in seen.collect()} == {1: "WIN", 2: "SCRATCH"}
    assert written_before_outcome(records.withColumn("exit_ts", F.lit(at(50)[0]))).orderBy("id").select("authentic").collect() == [(True,), (False,), (True,)]


def test_semantic_and_reposts(spark):
    import math

    v = lambda deg: [math.cos(math.radians(deg)), math.sin(math.radians(deg))]
    rows = spark.createDataFrame([(1, v(0), 0, "B", "t", "L"), (2, v(20), 0, "E", "t", "L"), (3, v(45), 0, "S", "t", "L"), (4, v(1), 1, "X", "t", "L"), (5, v(200), 0, "B", "t", "L")], "vec_id int, embedding array<double>, label int, instrument string, timestamp_context string, direction string")
    assert {(r[0], r[1]) for r in semantic.similar_pairs(rows, "label", 0.92, block=2).collect()} == {(1, 2)}
    assert sorted(r["vec_id"] for r in semantic.exact_then_semantic(rows, "label").collect()) == [1, 3, 4]
    posts = spark.createDataFrame([(0, "Buy BTC now!"), (1, "RT @x: buy btc NOW https://t.co/1"), (2, "sell")], "i int, text string")
    assert sorted(r["i"] for r in semantic.drop_reposts(posts, [F.col("i")]).collect()) == [0, 2]


def test_planned_scores(spark):
    df = spark.createDataFrame([(1.0, 5, "own_journal", 1.0), (0.3, None, "x", 0.0)], "o double, c int, s string, p double")
    got = [r[0] for r in df.select(scoring.judged_quality(F.col("o"), F.col("c"), F.col("s"), F.col("p"))).collect()]
    assert got == [1.0, 0.145]
    with pytest.raises(ValueError):
        scoring.judged_quality(F.lit(1), F.lit(1), F.lit(""), F.lit(1), {"outcome": 2, "consistency": 0, "source_tier": 0, "specificity": 0})
    rows = spark.createDataFrame([("c", "r", ("LONG",))], "context string, reasoning string, decision struct<direction:string>")
    assert scoring.judge_scores(rows, lambda r: 4 if r["direction"] == "LONG" else None).first()["consistency"] == 4
    assert stats.distribution(df, F.col("o")).first()["n"] == 2


def test_streams_equal_batch(spark, tmp_path):
    from tracefoundry.streaming.netting import stream_dedup, stream_volume

    rows = [("P", 0, "buy", 100, 2, 0), ("P", 1, "sell", 110, 1, 0), ("P", 2, "sell", 120, 1, 0)]
    as_fills(spark, rows, 1).drop("ordinal").write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema

    def drain(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"c-{name}")).start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name)

    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    assert drain(stream_dedup(source, "ts", "1 day", ["symbol"]), "firsts").count() == 1
    assert drain(stream_volume(source), "volumes", "complete").agg(F.sum("volume")).first()[0] == 4.0


def test_stream_legs_equal_fold(spark, tmp_path):
    from tracefoundry.streaming.netting import stream_legs

    rng = random.Random(5)
    rows = [(f"S{rng.randrange(3)}", i, rng.choice(["buy", "sell"]), rng.randrange(1, 50), rng.choice([0, 1, 1, 2]), 0.25) for i in range(120)]
    fills = as_fills(spark, rows, 1).withColumn("fill_id", F.col("ordinal.row")).drop("ordinal", "ts_raw")
    for part in (0, 1):
        fills.where((F.col("fill_id") >= 60 * part) & (F.col("fill_id") < 60 * part + 60)).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        source = spark.readStream.schema(fills.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        q = stream_legs(source).writeStream.format("memory").queryName("legs").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
        q.processAllAvailable()
        q.stop()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = sorted((r["symbol"], r["direction"], round(r["avg_entry_price"], 6), r["avg_exit_price"], r["total_qty"], round(r["total_fee"], 6)) for r in spark.table("legs").collect())
    assert got == fold(rows)


def test_text_queries_answer_for_every_language(spark, tmp_path):
    import re

    from tracefoundry.plans.queries import QUERIES

    texts = ["The end", "Über der Straße", "weder noch", "où sont LES élèves", "señor, ¿qué? Que sí", "éthe the", "日本 der", "Größe! https://x.org/é @jö", "größe", "RT größe", "", None, "grösse", "ça va", "Ça, va!"]
    langs = ["en", "de", "de", "fr", "es", None, None, "de", "de", None, "en", "fr", "de", "fr", "fr"]
    rows = list(zip(range(len(texts)), texts, langs))
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    first = {i: re.search(r"(?i)\b(the|der|les|que)\b", t or "") for i, t, _ in rows}
    got = {r["doc_id"]: r["word"] for r in QUERIES["regex_first_keyword"](spark, str(tmp_path)).collect()}
    assert got == {i: m and m[1].lower() for i, m in first.items()}
    seen = {}
    for i, t, _ in rows:
        seen.setdefault(None if t is None else re.sub(r"[^\w]+", "", re.sub(r"https?://\S+|@\w+|\brt\b:?", " ", t.lower())), i)
    assert sorted(r["doc_id"] for r in QUERIES["repost_removal"](spark, str(tmp_path)).collect()) == sorted(seen.values())


def test_time_split_ties_and_missing_times(spark):
    """Equal rows at the border are no more and no fewer than asked for; a missing time has no split."""
    rows = spark.createDataFrame([(1, "a")] * 10 + [(2, "a")] * 7 + [(3, "b")] * 3, "t int, o string")
    got = selection.time_split(rows, F.col("t"), F.col("o"), 0.25)
    assert sorted((r["t"], r["split"]) for r in got.collect()) == sorted([(1, "train")] * 10 + [(2, "train")] * 5 + [(2, "val")] * 2 + [(3, "val")] * 3)
    days = spark.createDataFrame([("2024-01-01",), (None,), ("2030-01-01",)], "d string").select(F.col("d").cast("timestamp").alias("t"))
    assert [r[0] for r in days.select(selection.cutoff_split(F.col("t"), "2025-01-01", "2026-01-01")).collect()] == ["train", None, "test"]


def test_labels_are_written(spark, tmp_path):
    from tracefoundry.plans import dataset

    raw = spark.createDataFrame([("1", "own_journal", "BTC", "2024-01-01T00:00:00Z", "some text", None, {"k": "v"}), ("2", "kol_post", "BTC", "2024-03-01T00:00:00Z", "x", "long", {})], "id string, source string, instrument string, timestamp_context string, raw_text string, decision_raw string, metadata map<string,string>")
    trades = spark.sql("SELECT 'BTC' AS instrument, TIMESTAMP '2024-01-01 01:00:00' AS ts, 2.0D AS realized_pnl_pct")
    labeled = dataset.run_labeling(raw, trades, 3600)
    dataset.write_labels(labeled, str(tmp_path))
    back = {r["id"]: r for r in spark.read.json(f"{tmp_path}/labeled.jsonl").collect()}
    assert back["1"]["verdict"] == "WIN" and back["2"]["verdict"] == "EXPIRED" and back["1"]["metadata"] == '{"k":"v"}'
    queue = spark.read.option("header", True).csv(f"{tmp_path}/review_queue.csv").collect()
    assert {r["id"]: r["outcome_verdict"] for r in queue}["1"] == "WIN"


def test_review_sample_share(spark):
    """About 5 % of ids, the same in every run."""
    ids = spark.range(20_000).where(selection.sampled(F.col("id"), 5))
    first = {r["id"] for r in ids.collect()}
    assert 850 < len(first) < 1150 and first == {r["id"] for r in ids.repartition(3).collect()}
