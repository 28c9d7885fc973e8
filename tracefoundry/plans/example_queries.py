"""Queries over the path from posts and fills to labelled examples, each with its SQL.

Posts are built from ``events`` and round trips from ``orders``, with every
kind of gap that readers have to stand; the queries then run the library's
own extraction, templates, labels and validation on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import trading as T
from ..operators import chat_text, matching, netting, scoring, selection, semantic, stats, transform, validate
from ..schemas import TRADE
from ..sources.posts import trade_ideas
from . import dataset
from .queries import MARKED, WORDS, query, rated, table

TEXTS = (
    "Going long on BTC here, liquidity sits above 64200.5, target $70,000", "short ETH-PERP now at 3,100.25", "WAIT for the breakout of SOL/USDT; funding is high",
    "I SELL doge/usdt and stay bearish", "range day, no trade", "Bullish on $LINK since yesterday", "longing the dip of ARBITRUM", None,
)
SYMBOLS = ("BTC/USDT", "ETH/USDT", "SOL/USDT", "XRP/USDT", None)
WAYS = ("Long", "SHORT", "buy", "Sell", "wait", None)


def _sql_list(items) -> str:
    return "[" + ", ".join("NULL" if i is None else "'" + i.replace("'", "''") + "'" for i in items) + "]"


def _pick(items, key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, items)), (key % len(items) + 1).cast("int"))


def posts(spark, sf_dir) -> DataFrame:
    n, at = F.col("event_id"), lambda k: F.col("event_id") % k
    price = F.col("value").cast("decimal(12,2)")
    level = lambda shift: (price + shift.cast("int")).cast("string")
    trade = F.struct(
        _pick(SYMBOLS, n).alias("symbol"), _pick(WAYS, n).alias("direction"),
        F.when(at(4) == 1, F.lit("0")).when(at(4) > 1, level(F.lit(0))).alias("entry"),
        level(at(50) - 10).alias("target"),
        F.when(at(11) != 0, level(-at(20))).alias("stop"),
        _pick((None, "0", "2", "2.50"), n).alias("size"),
    ).cast(TRADE)
    user = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.struct(F.lit("events").alias("path"), n.alias("at")).alias("position"),
        F.when(at(97) != 0, n.cast("string")).alias("id"),
        F.when(at(5) != 0, F.concat(F.lit("user"), user)).alias("author"),
        F.when(at(7) != 0, F.concat(F.lit("@u"), user)).alias("handle"),
        F.when(at(89) != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp"),
        _pick(TEXTS, n).alias("text"),
        F.when(at(3) == 0, trade).alias("trade"),
        F.when(at(4) != 1, F.repeat(F.lit("because liquidity "), at(8).cast("int"))).alias("reasoning"),
    )


def _price(x: str) -> str:
    one = " OR ".join(f"contains(upper(symbol), '{a}')" for a in T.ONE_DECIMAL)
    return f"(CASE WHEN {x} IS NULL THEN 'N/A' WHEN contains(upper(symbol), 'BTC') THEN '$' || format('{{:,.0f}}', {x}) WHEN {one} THEN '$' || format('{{:,.1f}}', {x}) ELSE '$' || format('{{:,.4f}}', {x}) END)"


NL = " || chr(10) || "
_WAY = "CASE WHEN lower({0}) IN ('long','longing','buy','bullish') THEN 'long' WHEN lower({0}) IN ('short','shorting','sell','bearish') THEN 'short' END"
IDEAS = f"""posts AS (
  SELECT event_id AS place, CASE WHEN event_id % 97 <> 0 THEN event_id::VARCHAR END AS tweet_id, coalesce(CASE WHEN event_id % 5 <> 0 THEN 'user' || user_id END, 'unknown') AS author,
    coalesce(CASE WHEN event_id % 7 <> 0 THEN '@u' || user_id END, '') AS handle, CASE WHEN event_id % 89 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp, ts,
    coalesce(({_sql_list(TEXTS)})[1 + event_id % 8], '') AS text, event_id % 3 = 0 AS structured,
    coalesce(({_sql_list(SYMBOLS)})[1 + event_id % 5], '') AS given, coalesce(({_sql_list(WAYS)})[1 + event_id % 6], '') AS way,
    coalesce(CASE WHEN event_id % 4 <> 1 THEN repeat('because liquidity ', (event_id % 8)::INT) END, '') AS reasoning,
    CASE WHEN event_id % 3 = 0 AND event_id % 4 = 1 THEN 0.0::DOUBLE WHEN event_id % 3 = 0 AND event_id % 4 > 1 THEN value END AS entry,
    CASE WHEN event_id % 3 = 0 THEN (value::DECIMAL(12,2) + (event_id % 50 - 10)::INT)::DOUBLE END AS target,
    CASE WHEN event_id % 3 = 0 AND event_id % 11 <> 0 THEN (value::DECIMAL(12,2) - (event_id % 20)::INT)::DOUBLE END AS stop,
    CASE WHEN event_id % 3 = 0 THEN ([NULL, 0, 2, 2.5]::DOUBLE[])[1 + event_id % 4] END AS size
  FROM events
), named AS (
  SELECT *, nullif(regexp_extract(text, '(?i)\\b(long|short|longing|shorting|buy|sell|bullish|bearish)\\b', 1), '') AS said,
    nullif(regexp_extract(text, '(?i)\\b({'|'.join(T.TICKERS)})\\b', 1), '') AS ticker FROM posts
), judged AS (
  SELECT *, CASE WHEN structured THEN given ELSE coalesce(upper(ticker) || '/USDT', 'UNKNOWN') END AS symbol,
    CASE WHEN structured THEN coalesce({_WAY.format('way')}, way) ELSE {_WAY.format('said')} END AS direction FROM named
), ideas AS (
  SELECT *, least(1 + coalesce(entry <> 0, false)::INT + coalesce(target <> 0, false)::INT + coalesce(stop <> 0, false)::INT + (length(reasoning) > 80)::INT, 5) AS confidence
  FROM judged WHERE tweet_id IS NOT NULL AND timestamp IS NOT NULL AND direction IS NOT NULL
)"""
# fixed values: the lines that the examples have
CONTEXT = NL.join([
    "'Asset: ' || symbol", "'Timestamp: ' || timestamp", "'KOL setup posted by ' || author || ' (' || handle || ')'", "'Proposed direction: ' || upper(direction)",
    f"'Entry zone: ' || {_price('entry')}", f"'Target: ' || {_price('target')}", f"'Stop / Invalidation: ' || {_price('stop')}",
    "'Proposed size: ' || CASE WHEN size <> 0 THEN CASE size WHEN 2 THEN '2' ELSE size::VARCHAR END || '%' ELSE 'unspecified' END", "''", "'Tweet text: ' || text",
])
_MEASURED = "(coalesce(entry <> 0, false) AND coalesce(target <> 0, false) AND coalesce(stop <> 0, false))"
# fixed values: the lines that the examples have
REASONING = NL.join([
    "'**Market Structure Read:**'", f"'The setup is on ' || symbol || ', with a proposed ' || upper(direction) || ' bias at ' || {_price('entry')} || '.'", "''", "'**Catalyst / Trigger:**'",
    "CASE WHEN trim(reasoning) <> '' THEN trim(reasoning) ELSE 'See tweet context above for the stated rationale.' END", "''", "'**Risk / Reward Assessment:**'",
    f"'- Entry: ' || {_price('entry')}", f"'- Target: ' || {_price('target')}", f"'- Stop / Invalidation: ' || {_price('stop')}",
]) + f""" || CASE WHEN {_MEASURED} THEN chr(10) || '- Risk: ' || {_price('abs(entry - stop)')} || ' | Reward: ' || {_price('abs(target - entry)')} || chr(10)
  || '- R:R ratio: ' || format('{{:.2f}}', CASE WHEN abs(entry - stop) > 0 THEN abs(target - entry) / abs(entry - stop) ELSE 0.0::DOUBLE END) || ':1' ELSE '' END || chr(10) || """ + NL.join([
    "''", "'**Conviction and Sizing:**'",
    "CASE WHEN size <> 0 THEN 'Position size: ' || CASE size WHEN 2 THEN '2' ELSE size::VARCHAR END || '% of capital.' ELSE 'Position size: not specified.' END",
    "'Conviction: ' || confidence || '/5 — based on specificity of levels and stated reasoning.'",
])
_ID = "(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-' || substr('89ab', (('0x' || substr(h, 17, 1))::INT % 4) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12))"
TAGS = """list_filter([CASE WHEN direction = 'long' THEN 'bullish-bias' END, CASE WHEN direction = 'short' THEN 'bearish-bias' END, CASE WHEN structured THEN 'structured-setup' END,
  CASE WHEN length(reasoning) > 100 THEN 'detailed-reasoning' END, CASE WHEN contains(lower(text), 'liquidity') THEN 'liquidity-grab' END, CASE WHEN contains(lower(text), 'funding') THEN 'funding-rate' END,
  CASE WHEN contains(lower(text), 'breakout') THEN 'breakout' END, CASE WHEN contains(lower(text), 'range') THEN 'range-trade' END], lambda x: x IS NOT NULL)"""


def ideas(spark, sf_dir) -> DataFrame:
    return trade_ideas(posts(spark, sf_dir))[0]


@query(f"WITH {IDEAS} SELECT tweet_id, author, handle, symbol, direction, structured, CASE WHEN structured THEN entry IS NOT NULL ELSE false END AS has_entry FROM ideas")
def idea_extraction(spark, sf_dir):
    return ideas(spark, sf_dir).select("tweet_id", "author", "handle", "symbol", "direction", F.col("has_structured_trade").alias("structured"), F.col("entry").isNotNull().alias("has_entry"))


@query(f"WITH {IDEAS} SELECT place, tweet_id, CASE WHEN tweet_id IS NULL THEN 'id' WHEN timestamp IS NULL THEN 'timestamp' ELSE 'direction' END AS reason FROM judged WHERE tweet_id IS NULL OR timestamp IS NULL OR direction IS NULL")
def idea_rejects(spark, sf_dir):
    return trade_ideas(posts(spark, sf_dir))[1].select(F.col("position.at").alias("place"), "tweet_id", "reason")


@query(f"WITH {IDEAS} SELECT place, array_to_string(regexp_extract_all(text, '\\$?(\\d{{1,7}}(?:[.,]\\d{{1,4}})?)\\b', 1), ' ') AS prices FROM posts")
def price_mentions(spark, sf_dir):
    prices = F.array_join(T.prices_in(F.coalesce("text", F.lit(""))), " ")
    return posts(spark, sf_dir).select(F.col("position.at").alias("place"), prices.alias("prices"))


@query(f"WITH {IDEAS}, made AS (SELECT *, md5('kol_post' || chr(31) || 'events' || chr(31) || place || chr(31) || tweet_id) AS h FROM ideas) SELECT {_ID} AS id, symbol AS instrument, timestamp AS timestamp_context, {CONTEXT} AS context, {REASONING} AS reasoning FROM made")
def idea_examples(spark, sf_dir):
    return transform.ideas_to_examples(ideas(spark, sf_dir)).select("id", "instrument", "timestamp_context", "context", "reasoning")


@query(f"""WITH {IDEAS} SELECT place, CASE WHEN lower(direction) IN ('long','short','wait','flat') THEN upper(direction) ELSE 'WAIT' END AS direction, entry, stop AS invalidation, target,
  size AS position_size_pct, confidence, array_to_string({TAGS}, ',') AS tags FROM ideas""")
def idea_decisions(spark, sf_dir):
    d = F.col("decision")
    made = transform.ideas_to_examples(ideas(spark, sf_dir))
    return made.select(F.col("ord.row").alias("place"), d["direction"].alias("direction"), F.get(d["entry_zone"], F.lit(0)).alias("entry"), d["invalidation"].alias("invalidation"), F.get(d["targets"], F.lit(0)).alias("target"), d["position_size_pct"].alias("position_size_pct"), d["confidence"].alias("confidence"), F.array_join("tags", ",").alias("tags"))


@query(f"WITH {IDEAS} SELECT place, CASE WHEN symbol = 'UNKNOWN' THEN {REASONING} ELSE trim('read: ' || symbol) END AS reasoning FROM ideas")
def idea_expander(spark, sf_dir):
    """An injected expander's text, the template where it gives none."""
    made = transform.ideas_to_examples(ideas(spark, sf_dir), lambda r: None if r["symbol"] == "UNKNOWN" else f"read: {r['symbol']}")
    return made.select(F.col("ord.row").alias("place"), "reasoning")


PAIRS = ("BTC/USDT", "ETH/USDT", "XRP/USDT")


def trips(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    n = F.col("o_orderkey")
    pct = (n % 2001 - 1000) / 64.0
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    rows = table(spark, sf_dir, "orders").select(
        _pick(PAIRS, F.col("o_custkey")).alias("symbol"), n.alias("leg"), F.when(n % 2 == 0, F.lit("long")).otherwise(F.lit("short")).alias("direction"),
        stamp("o_orderdate").alias("entry_time"), stamp(F.date_add("o_orderdate", 2).cast("timestamp")).alias("exit_time"),
        F.col("o_totalprice").alias("avg_entry_price"), (F.col("o_totalprice") * 1.5).alias("avg_exit_price"), (n % 40 / 8.0).alias("total_qty"), (n % 300 / 4.0).alias("total_fee"),
        (n % 500 / 4.0).alias("holding_period_hours"), pct.alias("realized_pnl_pct"), T.verdict(pct).alias("verdict"), F.when(n % 3 != 0, pct / 4).alias("r_multiple"),
        F.col("o_orderdate").alias("ts"), F.struct(F.lit("fills").alias("path"), F.lit(0).alias("block"), n.alias("row")).alias("ordinal"),
    )
    return rows, netting.first_seen(rows)


TRIPS = f"""trips AS (
  SELECT ({_sql_list(PAIRS)})[1 + o_custkey % 3] AS symbol, o_orderkey AS leg, CASE WHEN o_orderkey % 2 = 0 THEN 'long' ELSE 'short' END AS direction, o_orderdate AS ts,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS entry_time, strftime(date_trunc('day', o_orderdate) + INTERVAL 2 DAY, '%Y-%m-%dT%H:%M:%S+00:00') AS exit_time,
    o_totalprice AS entry, o_totalprice * 1.5::DOUBLE AS exit, (o_orderkey % 40) / 8.0::DOUBLE AS qty, (o_orderkey % 300) / 4.0::DOUBLE AS fee, (o_orderkey % 500) / 4.0::DOUBLE AS hours,
    (o_orderkey % 2001 - 1000) / 64.0::DOUBLE AS pct FROM orders
), ended AS (SELECT *, CASE WHEN pct > 1 THEN 'WIN' WHEN pct < -1 THEN 'LOSS' ELSE 'SCRATCH' END AS verdict FROM trips)"""
# fixed values: the lines that the examples have
TRIP_CONTEXT = NL.join([
    "'Asset: ' || symbol", "'Entry timestamp: ' || entry_time", "'Exit timestamp: ' || exit_time", "'Direction: ' || upper(direction)", f"'Average entry price: ' || {_price('entry')}",
    f"'Average exit price: ' || {_price('exit')}", "'Position size (base qty): ' || qty::VARCHAR", "'Holding period: ' || format('{:.1f}', hours) || ' hours'", "'Total fees: $' || format('{:.2f}', fee)",
])
# fixed values: the lines that the examples have
TRIP_REASONING = NL.join([
    "'**Market Structure Read:**'", f"'Entered a ' || upper(direction) || ' position on ' || symbol || ' at ' || {_price('entry')} || '.'", "''", "'**Execution:**'",
    f"'The position was held for ' || format('{{:.1f}}', hours) || ' hours before being closed at ' || {_price('exit')} || '.'", "''", "'**Risk / Reward:**'",
    "'Realized PnL: ' || format('{:+.2f}', pct) || '% (net of fees). Outcome: ' || verdict || '.'", "''", "'**Post-trade Reflection:**'",
    "'This trade is included as a training example to demonstrate ' || CASE WHEN pct > 0 THEN 'disciplined execution of a profitable setup' ELSE 'loss management and process adherence despite an adverse outcome' END || '.'",
])


@query(f"WITH {TRIPS}, made AS (SELECT *, md5('on_chain' || chr(31) || symbol || chr(31) || leg || chr(31) || entry_time || chr(31) || exit_time) AS h FROM ended) SELECT {_ID} AS id, {TRIP_CONTEXT} AS context, {TRIP_REASONING} AS reasoning FROM made")
def trip_examples(spark, sf_dir):
    return transform.trips_to_examples(*trips(spark, sf_dir)).select("id", "context", "reasoning")


@query(f"""WITH {TRIPS} SELECT leg, upper(direction) AS direction, entry, exit AS target, 3 AS confidence, format('{{:.4f}}', pct)::DOUBLE AS pnl_pct, format('{{:.2f}}', hours)::DOUBLE AS hours, verdict, exit_time,
  'realized-trade,' || CASE verdict WHEN 'WIN' THEN 'winner' WHEN 'LOSS' THEN 'loser' ELSE 'scratch' END || ',' || CASE WHEN hours < 4 THEN 'scalp' WHEN hours < 48 THEN 'swing' ELSE 'position-trade' END AS tags FROM ended""")
def trip_decisions(spark, sf_dir):
    d, o = F.col("decision"), F.col("outcome")
    made = transform.trips_to_examples(*trips(spark, sf_dir))
    return made.select(
        F.col("ord.row").alias("leg"), d["direction"].alias("direction"), d["entry_zone"][0].alias("entry"), d["targets"][0].alias("target"), d["confidence"].alias("confidence"),
        o["realized_pnl_pct"].alias("pnl_pct"), o["holding_period_hours"].alias("hours"), o["verdict"].alias("verdict"), o["exit_timestamp"].alias("exit_time"), F.array_join("tags", ",").alias("tags"),
    )


def examples(spark, sf_dir) -> DataFrame:
    return dataset.all_examples(transform.ideas_to_examples(ideas(spark, sf_dir)), transform.trips_to_examples(*trips(spark, sf_dir)))


_DEPTH = "(CASE WHEN w < 20 THEN 0.1::DOUBLE WHEN w < 50 THEN 0.4::DOUBLE WHEN w <= 400 THEN 1.0::DOUBLE WHEN w <= 600 THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END)"
_COUNT = r"len(list_filter(regexp_split_to_array(reasoning, '\s+'), lambda x: x <> ''))"
EXAMPLES = f"""{IDEAS}, {TRIPS}, seen AS (SELECT symbol, min(ts) AS seen_ts, arg_min(leg, (ts, leg)) AS seen_row FROM trips GROUP BY symbol),
examples AS (
  SELECT 0 AS rank, NULL::TIMESTAMP AS seen_ts, 0 AS seen_row, place, 'kol_post' AS source, symbol AS instrument, timestamp AS stamp, date_trunc('second', ts) AS ts,
    CASE WHEN lower(direction) IN ('long','short','wait','flat') THEN upper(direction) ELSE 'WAIT' END AS direction, {REASONING} AS reasoning, NULL AS verdict, NULL::DOUBLE AS r,
    (entry IS NOT NULL)::INT + (stop IS NOT NULL)::INT + (target IS NOT NULL)::INT AS levels FROM ideas
  UNION ALL SELECT 1, seen_ts, seen_row, leg, 'on_chain', symbol, entry_time, ts, upper(direction), {TRIP_REASONING}, verdict, CASE WHEN leg % 3 <> 0 THEN pct / 4 END, 2 FROM ended JOIN seen USING (symbol)
), scored AS (
  SELECT *, {_COUNT} AS w, row_number() OVER (PARTITION BY upper(instrument), substr(stamp, 1, 10), direction, source ORDER BY rank, seen_ts, seen_row, place) = 1 AS first FROM examples
), rated_examples AS (
  SELECT *, CAST(round(least(greatest(0.35::DOUBLE * CASE verdict WHEN 'WIN' THEN 1.0::DOUBLE WHEN 'SCRATCH' THEN 0.6::DOUBLE WHEN 'LOSS' THEN 0.5::DOUBLE ELSE 0.3::DOUBLE END
    + 0.25::DOUBLE * CASE rank WHEN 0 THEN 0.7::DOUBLE ELSE 0.6::DOUBLE END + 0.25::DOUBLE * (levels / 3.0::DOUBLE) + 0.15::DOUBLE * {_DEPTH}, 0.0::DOUBLE), 1.0::DOUBLE) * 10000) AS BIGINT) AS score FROM scored
), kept AS (SELECT * FROM rated_examples WHERE first AND score >= 5000 AND verdict IS DISTINCT FROM 'LOSS' AND (r IS NULL OR r >= 0.5)
), split_examples AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY ts DESC, rank DESC, seen_ts DESC, seen_row DESC, place DESC) <= greatest(1, CAST(floor((SELECT count(*) FROM kept) * 0.15::DOUBLE) AS BIGINT)) THEN 'val' ELSE 'train' END AS split FROM kept
)"""
LABELS = dataset.LabelOptions(min_quality=0.5, keep_losers=False, min_r=0.5)


@query(f"WITH {EXAMPLES} SELECT source, place, instrument, direction, verdict, score AS score_e4, split FROM split_examples")
def example_labels(spark, sf_dir):
    """The whole plan: union, scores, dedup, filters, split by time."""
    labeled, _ = dataset.label(examples(spark, sf_dir), LABELS)
    return labeled.select("source", F.col("ord.row").alias("place"), "instrument", F.col("decision.direction").alias("direction"), F.col("outcome.verdict").alias("verdict"), F.round(F.col("quality_score") * 10000).cast("long").alias("score_e4"), "split")


@query(f"""WITH {EXAMPLES} SELECT (SELECT count(*) FROM examples)::BIGINT AS total_input, (SELECT count(*) FROM scored WHERE first)::BIGINT AS after_dedup, count(*)::BIGINT AS final,
  count(*) FILTER (split = 'val')::BIGINT AS val, count(*) FILTER (verdict = 'WIN')::BIGINT AS wins, count(*) FILTER (source = 'kol_post')::BIGINT AS posts, CAST(floor(avg(score) + 0.5) AS BIGINT) AS quality_e4 FROM split_examples""")
def example_statistics(spark, sf_dir):
    _, s = dataset.label(examples(spark, sf_dir), LABELS)
    row = (s["total_input"], s["after_dedup"], s["final"], s["val"], s["verdicts"].get("WIN", 0), s["sources"].get("kol_post", 0), round(s["quality_mean"] * 10000))
    return spark.createDataFrame([row], "total_input long, after_dedup long, final long, val long, wins long, posts long, quality_e4 long")


@query(f"""WITH {EXAMPLES} SELECT source, place, CASE WHEN instrument = '' THEN 'no instrument' WHEN length(reasoning) < 50 THEN 'no reasoning' WHEN rank = 1 THEN 'written after the fact' END AS reason FROM examples""")
def minimum_bar(spark, sf_dir):
    return examples(spark, sf_dir).select("source", F.col("ord.row").alias("place"), dataset.minimum_bar().alias("reason"))


#: Faults of typed examples by place and what the validator has to say.
FAULTS = (
    None, "id: not a UUID", "version: not N.N", "split: unknown", "source: unknown", "timestamp_context: not ISO 8601", "system_prompt: shorter than 10", "context: shorter than 20",
    "reasoning: shorter than 50", "instrument: shorter than 1", "timeframe: shorter than 1", "decision.direction: unknown", "decision.entry_zone: not 1 or 2 numbers",
    "decision.entry_zone: not 1 or 2 numbers", "decision.targets: empty", "decision.confidence: not in 1..5", "decision.position_size_pct: not in 0..100", "outcome.verdict: unknown",
    "outcome.holding_period_hours: negative", "quality_score: not in [0, 1]", "id: missing", "reasoning: missing|decision: missing", "version: not N.N|quality_score: not in [0, 1]",
)


@query(f"SELECT o_orderkey, coalesce(({_sql_list(FAULTS)})[1 + o_orderkey % {len(FAULTS)}], '') AS errors FROM orders")
def validate_examples(spark, sf_dir):
    """Each rule of the typed validator broken in turn, alone and in company."""
    k = F.col("o_orderkey") % len(FAULTS)
    bad = lambda good, *faults: _faulty(k, good, faults)
    text = lambda n: F.lit("a text that is long enough for the rule"[:n] * 2)
    numbers = lambda *x: F.array(*[F.lit(float(v)) for v in x]).cast("array<double>")
    decision = F.struct(
        bad(F.lit("LONG"), (11, F.lit("UP"))).alias("direction"), bad(numbers(1, 2), (12, numbers()), (13, numbers(1, 2, 3))).alias("entry_zone"), F.lit(1.0).alias("invalidation"),
        bad(numbers(3), (14, numbers())).alias("targets"), bad(F.lit(5.0), (16, F.lit(101.0))).alias("position_size_pct"), bad(F.lit(5), (15, F.lit(6))).alias("confidence"),
    )
    outcome = F.struct(F.lit(1.0).alias("realized_pnl_pct"), bad(F.lit(1.0), (18, F.lit(-1.0))).alias("holding_period_hours"), bad(F.lit("WIN"), (17, F.lit("DRAW"))).alias("verdict"), F.lit("x").alias("exit_timestamp"))
    uuid = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", bad(uuid, (1, F.lit("x")), (20, F.lit(None))).alias("id"), bad(F.lit("1.0"), (2, F.lit("v1")), (22, F.lit("1"))).alias("version"), bad(F.lit("val"), (3, F.lit("dev"))).alias("split"),
        bad(F.lit("kol_post"), (4, F.lit("blog"))).alias("source"), bad(F.lit("2024-01-01T00:00:00Z"), (5, F.lit("2024-01-01"))).alias("timestamp_context"),
        bad(text(40), (6, F.lit("short"))).alias("system_prompt"), bad(text(40), (7, F.lit("tiny"))).alias("context"), bad(text(40), (8, F.lit("brief")), (21, F.lit(None))).alias("reasoning"),
        bad(F.lit("BTC"), (9, F.lit(""))).alias("instrument"), bad(F.lit("4h"), (10, F.lit(""))).alias("timeframe"), F.when(k != 21, decision).alias("decision"), outcome.alias("outcome"),
        bad(F.lit(0.5), (19, F.lit(1.5)), (22, F.lit(-0.1))).alias("quality_score"),
    )
    return validate.with_errors(rows).select("o_orderkey", F.array_join("errors", "|").alias("errors"))


def _faulty(k: Column, good: Column, faults) -> Column:
    out = good
    for place, value in faults:
        out = F.when(k == place, value).otherwise(out)
    return out


#: A foreign JSON example, and what is changed in it with what the validator has to say.
JSON = (
    '{"id":"00000000-0000-4000-8000-000000000000","version":"1.0","split":"train","source":"kol_post","instrument":"BTC","timeframe":"4h","timestamp_context":"2024-01-01T00:00:00Z",'
    '"system_prompt":"a prompt long enough","context":"a context that is long enough","reasoning":"reasoning that is long enough to pass the rule of fifty characters",'
    '"decision":{"direction":"LONG","entry_zone":[1,2],"invalidation":0.5,"targets":[3],"confidence":4,"position_size_pct":2.5},"outcome":{"verdict":"WIN","holding_period_hours":3},"quality_score":0.7,"tags":["a"]}'
)
CHANGES = (
    ("", "", ""), ('"1.0"', '"1"', "version: not N.N"), ('"train"', '"dev"', "split: unknown"), ('"kol_post"', '"blog"', "source: unknown"), ('"2024-01-01T00:00:00Z"', '"yesterday"', "timestamp_context: not ISO 8601"),
    ('"id":"0', '"id":"z', "id: not a UUID"), ('"reasoning":', '"why":', "reasoning: missing"), ('"LONG"', '"UP"', "decision.direction: unknown"), ("[1,2]", "[]", "decision.entry_zone: not 1 or 2 numbers"),
    ("0.5,", '"low",', "decision.invalidation: not a number"), ("[3]", "[]", "decision.targets: empty"), ('"confidence":4', '"confidence":true', ""), ('"confidence":4', '"confidence":9', "decision.confidence: not in 1..5"),
    ("2.5}", "250}", "decision.position_size_pct: not in 0..100"), ('{"verdict":"WIN","holding_period_hours":3}', "null", ""), ('"WIN"', '"DRAW"', "outcome.verdict: unknown"),
    ("hours\":3", "hours\":-3", "outcome.holding_period_hours: negative"), ("0.7", "7", "quality_score: not in [0, 1]"), ('["a"]', '"a"', "tags: not a list"), ('{"id"', '["id"', "not an object"),
)


@query(f"SELECT o_orderkey, ({_sql_list(c[2] for c in CHANGES)})[1 + o_orderkey % {len(CHANGES)}] AS errors FROM orders")
def validate_json(spark, sf_dir):
    """Foreign JSON texts against the same rules, where absent and null differ."""
    k = F.col("o_orderkey")
    raw = F.replace(F.lit(JSON), _pick([c[0] for c in CHANGES], k), _pick([c[1] for c in CHANGES], k))
    return table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw")).select("o_orderkey", F.array_join(validate.json_errors(F.col("raw")), "|").alias("errors"))


_RISK = "(l_orderkey % 41 - 20) / 4.0::DOUBLE / (abs(100.0::DOUBLE - (100 - l_linenumber % 5)) / 100.0::DOUBLE * 100.0::DOUBLE)"


@query(f"SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 5 > 0 THEN format('{{:.2f}}', {_RISK})::DOUBLE END AS r, l_linenumber % 5 = 0 OR format('{{:.2f}}', {_RISK})::DOUBLE >= 0.5 AS kept FROM lineitem")
def r_multiple_floor(spark, sf_dir):
    n, line = F.col("l_orderkey"), F.col("l_linenumber")
    r = T.r_multiple((n % 41 - 20) / 4.0, F.lit(100.0), (100 - line % 5).cast("double"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", r.alias("r_multiple"), F.struct(F.lit("WIN").alias("verdict")).alias("outcome"))
    return rows.select("l_orderkey", "l_linenumber", F.col("r_multiple").alias("r"), selection.outcome_ok(True, 0.5).alias("kept"))


_FIRST = "(SELECT * FROM embeddings QUALIFY row_number() OVER (PARTITION BY 'V' || vec_id % 400, label % 2, label % 3 ORDER BY vec_id) = 1)"


@query(f"""WITH once AS {_FIRST} SELECT vec_id FROM once b WHERE NOT EXISTS (SELECT 1 FROM once a WHERE a.label = b.label AND a.vec_id < b.vec_id
  AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.4)""")
def exact_then_semantic(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("instrument", F.concat(F.lit("V"), (F.col("vec_id") % 400).cast("string")))
    rows = rows.withColumn("timestamp_context", F.col("label") % 2).withColumn("direction", F.col("label") % 3)
    return semantic.exact_then_semantic(rows, "label", 0.4).select("vec_id")


@query("""SELECT conv_id, count(*)::BIGINT AS n_turns, '<|begin_of_text|>' || string_agg('<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || coalesce(text, '') || '<|eot_id|>', '' ORDER BY turn) AS formatted_text
  FROM conversations GROUP BY conv_id""")
def chat_format_llama3(spark, sf_dir):
    return chat_text.conversation_text(table(spark, sf_dir, "conversations"), "llama3")


@query("""SELECT conv_id, count(*)::BIGINT AS n_turns, '<s>' || string_agg(CASE WHEN role = 'assistant' THEN ' ' || coalesce(text, '') || '</s>' ELSE '[INST] ' || coalesce(text, '') || ' [/INST]' END, '' ORDER BY turn) AS formatted_text
  FROM conversations GROUP BY conv_id""")
def chat_format_mistral(spark, sf_dir):
    return chat_text.conversation_text(table(spark, sf_dir, "conversations"), "mistral")


@query(f"WITH {MARKED} SELECT kind, CAST(floor(avg(CAST(round(raw * 10000) AS BIGINT)) + 0.5) AS BIGINT) AS mean_e4 FROM rated GROUP BY kind")
def mean_quality(spark, sf_dir):
    return rated(spark, sf_dir).groupBy("kind").agg(F.round(stats.mean_quality(F.col("quality_score")) * 10000).cast("long").alias("mean_e4"))


_JUDGE = "CASE WHEN doc_id % 7 BETWEEN 1 AND 5 THEN doc_id % 7 END"


@query(f"""WITH {MARKED}, judged AS (SELECT *, {_JUDGE} AS consistency FROM scored)
SELECT doc_id, consistency::INT AS consistency, coalesce(consistency >= 3, false) AS good, CAST(round(least(greatest(0.35::DOUBLE * outcome_score + 0.30::DOUBLE * coalesce((consistency - 1) / 4.0::DOUBLE, 0.0::DOUBLE)
  + 0.20::DOUBLE * CASE kind WHEN 'own_journal' THEN 1.0::DOUBLE WHEN 'research_note' THEN 0.8::DOUBLE WHEN 'kol_post' THEN 0.6::DOUBLE WHEN 'chat_log' THEN 0.4::DOUBLE ELSE 0.2::DOUBLE END
  + 0.15::DOUBLE * specificity, 0.0::DOUBLE), 1.0::DOUBLE) * 10000) AS BIGINT) AS score_e4 FROM judged""")
def judged_scores(spark, sf_dir):
    """An injected judge of single records, the planned score, and the judge's filter."""
    rows = rated(spark, sf_dir).withColumn("context", F.col("doc_id").cast("string")).withColumn("reasoning", F.lit("")).withColumn("decision", F.struct(F.lit("LONG").alias("direction")))
    rows = scoring.judge_scores(rows, lambda r: int(r["context"]) % 7)
    score = scoring.judged_quality(scoring.outcome_score(F.col("verdict")), F.col("consistency"), F.col("kind"), F.col("specificity"))
    good = dataset.good_judgement(rows).select("doc_id", F.lit(True).alias("good"))
    out = rows.select("doc_id", "consistency", F.round(score * 10000).cast("long").alias("score_e4")).join(good, "doc_id", "left")
    return out.select("doc_id", "consistency", F.coalesce("good", F.lit(False)).alias("good"), "score_e4")


@query(f"""WITH {MARKED} SELECT doc_id, CASE WHEN verdict IS NULL THEN 'keep' WHEN verdict = 'LOSS' AND w < 50 THEN 'drop' WHEN verdict = 'SCRATCH' AND w < 50 THEN 'drop' WHEN verdict = 'SCRATCH' THEN 'sampled' ELSE 'keep' END AS policy
  FROM (SELECT *, len(regexp_split_to_array(d.text, '\\s+')) AS pieces FROM marked m JOIN documents d USING (doc_id)) x""".replace("w < 50", "pieces < 50"))
def outcome_policy(spark, sf_dir):
    """What becomes of examples by outcome; scratches with long reasoning are drawn by a hash and shown as such."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("id"), F.col("text").alias("reasoning"))
    known = rated(spark, sf_dir).select("doc_id", F.struct("verdict").alias("outcome"))
    drawn = (F.col("outcome.verdict") == "SCRATCH") & (F.size(F.split("reasoning", r"\s+")) >= 50)
    return rows.join(known, "doc_id").select("doc_id", F.when(drawn, F.lit("sampled")).otherwise(selection.outcome_policy()).alias("policy"))


@query()
def review_sample(spark, sf_dir):
    """A fixed 5 % of ids, by a hash that DuckDB does not have; tested for its share."""
    return table(spark, sf_dir, "documents").where(selection.sampled(F.col("doc_id"), 5)).select("doc_id")


@query("SELECT l_orderkey, l_linenumber, o_orderdate < l_shipdate AS authentic FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def authenticity(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return matching.written_before_outcome(rows, "o_orderdate", "l_shipdate").select("l_orderkey", "l_linenumber", "authentic")


@query(f"WITH {MARKED} SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'LOSS' ELSE verdict END AS verdict FROM marked")
def reviewed_verdicts(spark, sf_dir):
    rows = rated(spark, sf_dir).select(F.col("doc_id").alias("id"), "verdict")
    reviews = table(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.col("doc_id").alias("id"), F.lit("LOSS").alias("verdict"))
    return matching.read_back_verdicts(rows, reviews).select(F.col("id").alias("doc_id"), "verdict")


@query(f"""WITH flagged AS (SELECT ({_sql_list(FAULTS)})[1 + o_orderkey % {len(FAULTS)}] AS error FROM orders)
SELECT CAST(round(avg((error IS NULL)::INT) * 1e6) AS BIGINT) AS format_e6, CAST(round(avg((error IS DISTINCT FROM 'reasoning: missing|decision: missing')::INT) * 1e6) AS BIGINT) AS specificity_e6 FROM flagged""")
def example_metrics(spark, sf_dir):
    rows = validate_examples(spark, sf_dir)
    k = F.col("o_orderkey") % len(FAULTS)
    three = F.struct(F.array(F.lit(1.0)).alias("entry_zone"), F.lit(1.0).alias("invalidation"), F.array(F.lit(1.0)).alias("targets"))
    rows = rows.select(F.when(F.col("errors") == "", F.array().cast("array<string>")).otherwise(F.split("errors", r"\|")).alias("errors"), F.when(k != 21, three).alias("decision"))
    return stats.dataset_metrics(rows).select(F.round(F.col("format_compliance") * 1e6).cast("long").alias("format_e6"), F.round(F.col("specificity_rate") * 1e6).cast("long").alias("specificity_e6"))


@query("""WITH t AS (SELECT *, o_orderkey % 6 AS k FROM orders) SELECT o_orderkey,
  CASE k WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00+00:00') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00+02:00') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00+00:00')
    WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00.250000+00:00') WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00+00:00') END AS iso,
  CASE k WHEN 1 THEN epoch_us(o_orderdate) - 7200000000 WHEN 3 THEN epoch_us(o_orderdate) + 250000 WHEN 5 THEN NULL ELSE epoch_us(o_orderdate) END AS micros FROM t""")
def iso_times(spark, sf_dir):
    """Texts with and without offset, fraction and clock, and one that is no time."""
    k, day = F.col("o_orderkey") % 6, F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.concat(day, _pick(("T00:00:00Z", "T00:00:00+02:00", "", " 00:00:00.25", "T00:00", " o'clock"), k))
    return table(spark, sf_dir, "orders").select("o_orderkey", E.iso_text(raw).alias("iso"), E.micros(E.parse_iso(raw)).alias("micros"))


@query(f"""WITH trades AS (SELECT event_id, user_id::VARCHAR AS instrument, ts, value - 250.0::DOUBLE AS pct FROM events WHERE event_type = 'purchase'),
records AS (SELECT event_id, user_id::VARCHAR AS instrument, date_trunc('second', ts) AS ts FROM events WHERE event_type = 'click'),
near AS (SELECT r.event_id, arg_min(t.pct, (abs(date_diff('microsecond', r.ts, t.ts)), t.ts)) AS pct FROM records r JOIN trades t ON r.instrument = t.instrument AND abs(date_diff('microsecond', r.ts, t.ts)) <= 21600000000 GROUP BY 1),
ended AS (SELECT r.event_id, pct, CASE WHEN pct IS NULL THEN 'EXPIRED' WHEN pct > 1 THEN 'WIN' WHEN pct < -1 THEN 'LOSS' ELSE 'SCRATCH' END AS verdict FROM records r LEFT JOIN near USING (event_id))
SELECT event_id::VARCHAR AS id, verdict, CAST(round((0.35::DOUBLE * CASE verdict WHEN 'WIN' THEN 1.0::DOUBLE WHEN 'SCRATCH' THEN 0.6::DOUBLE WHEN 'LOSS' THEN 0.5::DOUBLE ELSE 0.4::DOUBLE END
  + 0.20::DOUBLE * CASE WHEN event_id % 2 = 0 THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END) * 10000) AS BIGINT) AS score_e4,
  CASE WHEN event_id % 2 = 0 THEN 'always-review source' WHEN (0.35::DOUBLE * CASE verdict WHEN 'WIN' THEN 1.0::DOUBLE WHEN 'SCRATCH' THEN 0.6::DOUBLE WHEN 'LOSS' THEN 0.5::DOUBLE ELSE 0.4::DOUBLE END + 0.12::DOUBLE) >= 0.4 THEN 'borderline score'
    ELSE 'no judge score' END AS flag_reason FROM ended""")
def labelling_plan(spark, sf_dir):
    """Raw records with the nearest trade's verdict, the planned score and the review flag."""
    rows = table(spark, sf_dir, "events").withColumn("instrument", F.col("user_id").cast("string"))
    source = F.when(F.col("event_id") % 2 == 0, F.lit("own_journal")).otherwise(F.lit("kol_post"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = rows.where("event_type = 'click'").select(F.col("event_id").cast("string").alias("id"), source.alias("source"), "instrument", stamp.alias("timestamp_context"), F.lit("text").alias("raw_text"))
    trades = rows.where("event_type = 'purchase'").select("instrument", F.col("ts"), (F.col("value") - 250.0).alias("realized_pnl_pct"))
    out = dataset.run_labeling(raw, trades, 6 * 3600)
    return out.select("id", "verdict", F.round(F.col("quality_score") * 10000).cast("long").alias("score_e4"), "flag_reason")
