"""The engine's operators as queries over the driver's tables, each with its SQL.

``events`` stands in for fills (symbol = user, clicks and purchases buy,
errors and signups sell), ``documents`` with ``labels`` for examples.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import trading as T
from ..operators import matching, netting, scoring, selection, semantic, stats, transform
from ..operators.chat_text import conversation_text
from ..operators.validate import SOURCES, VERSION
from ..sources.collectors import ChatLogCollector, ResearchCollector, html_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
ORDER = ("ts", "event_id")


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fills(spark: SparkSession, sf_dir: str, flips: bool = False) -> DataFrame:
    kind = F.col("event_type")
    qty = (F.lit(1) + F.col("event_id") % 3).cast("double") if flips else F.lit(1.0)
    return table(spark, sf_dir, "events").where(kind.isin("click", "purchase", "error", "signup")).select(
        F.col("user_id").alias("symbol"), "ts", "event_id",
        F.when(kind.isin("click", "purchase"), F.lit("buy")).otherwise(F.lit("sell")).alias("side"),
        F.col("value").alias("price"), qty.alias("qty"), F.lit(0.01).alias("fee"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts_raw"),
    )


FILLS = """fills AS (
  SELECT user_id AS symbol, ts, event_id, CASE WHEN event_type IN ('click','purchase') THEN 'buy' ELSE 'sell' END AS side,
    value AS price, {qty} AS qty, 0.01::DOUBLE AS fee
  FROM events WHERE event_type IN ('click','purchase','error','signup')
), netted AS (
  SELECT *, sum(CASE WHEN side='buy' THEN qty ELSE -qty END) OVER (PARTITION BY symbol ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS net FROM fills
), lagged AS (
  SELECT *, coalesce(lag(net) OVER (PARTITION BY symbol ORDER BY ts, event_id), 0) AS prev FROM netted
), marked AS (
  SELECT *, CASE WHEN prev=0 AND net<>0 THEN 'O' WHEN prev<>0 AND net=0 THEN 'C' WHEN prev*net>0 THEN 'A' ELSE 'F' END AS ev FROM lagged
), leg_rows AS (
  SELECT *, sum(CASE WHEN ev IN ('O','F') THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS leg_id,
    last_value(CASE WHEN ev<>'A' THEN ev END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_turn
  FROM marked
)"""
LEGS = """, opens AS (
  SELECT symbol, leg_id AS leg, arg_min(side, (ts, event_id)) AS side, sum(qty) AS qty, sum(CAST(price*100 AS BIGINT)*CAST(qty AS BIGINT)) AS cents, sum(1) AS n, min(ts) AS entered
  FROM leg_rows WHERE ev <> 'C' GROUP BY ALL
), closes AS (
  SELECT symbol, CASE WHEN ev='C' THEN leg_id ELSE leg_id-1 END AS leg, price, ts AS closed_at FROM leg_rows WHERE ev='C' OR (ev='F' AND last_turn IN ('O','F'))
), legs AS (
  SELECT symbol, leg, CASE WHEN side='buy' THEN 'long' ELSE 'short' END AS direction, qty, cents, n, entered, price, closed_at FROM opens JOIN closes USING (symbol, leg)
)"""
ONE, FLIP = "1.0::DOUBLE", "(1 + event_id % 3)::DOUBLE"


def netted_sql(select: str, qty: str = ONE, with_legs: bool = True) -> str:
    return f"WITH {FILLS.format(qty=qty)}{LEGS if with_legs else ''} {select}"


@query(netted_sql("SELECT symbol, event_id, net::BIGINT AS net, prev::BIGINT AS prev FROM lagged", with_legs=False))
def net_position_running(spark, sf_dir):
    rows = netting.running_position(fills(spark, sf_dir), ORDER)
    return rows.select("symbol", "event_id", F.col("net").cast("long").alias("net"), F.col("prev").cast("long").alias("prev"))


@query(netted_sql("SELECT symbol, event_id, ev, leg_id FROM leg_rows", FLIP, with_legs=False))
def leg_events_ocaf(spark, sf_dir):
    return netting.leg_events(fills(spark, sf_dir, True), ORDER).select("symbol", "event_id", "ev", F.col("leg_id").cast("long").alias("leg_id"))


ROUND_TRIPS = "SELECT symbol, leg, direction, qty::BIGINT AS qty, cents::BIGINT AS cents, n::BIGINT AS n_open, CAST(price*100 AS BIGINT) AS close_cents, date_diff('microsecond', entered, closed_at) AS held_us FROM legs"


def _legs_in_cents(rows: DataFrame) -> DataFrame:
    made = netting.legs(rows, ORDER)
    counted = F.round(F.col("open_fee") * 100).cast("long")
    return made.select(
        "symbol", "leg", "direction", F.col("qty").cast("long").alias("qty"), F.round(F.col("value") * 100).cast("long").alias("cents"), counted.alias("n_open"),
        F.round(F.col("close_price") * 100).cast("long").alias("close_cents"), (E.micros(F.col("left.ts")) - E.micros(F.col("entered.ts"))).alias("held_us"),
    )


@query(netted_sql(ROUND_TRIPS))
def round_trips(spark, sf_dir):
    return _legs_in_cents(fills(spark, sf_dir))


@query(netted_sql(ROUND_TRIPS, FLIP))
def round_trips_flip(spark, sf_dir):
    return _legs_in_cents(fills(spark, sf_dir, True))


PCT = "CASE WHEN cents=0 THEN 0.0 ELSE ((CASE WHEN direction='long' THEN price*qty-cents/100.0::DOUBLE ELSE cents/100.0::DOUBLE-price*qty END) - 0.01::DOUBLE*(n+1)) / (cents/100.0::DOUBLE) * 100.0::DOUBLE END"
VERDICT = f"CASE WHEN {PCT} > 1 THEN 'WIN' WHEN {PCT} < -1 THEN 'LOSS' ELSE 'SCRATCH' END"


@query(netted_sql(f"SELECT {VERDICT} AS verdict, count(*)::BIGINT AS n FROM legs GROUP BY 1"))
def trade_verdicts(spark, sf_dir):
    legs = netting.legs(fills(spark, sf_dir), ORDER)
    return stats.count_by(legs, T.verdict(F.col("pct")), "verdict")


@query(netted_sql(f"SELECT symbol, count(*)::BIGINT AS legs, count(*) FILTER ({VERDICT} = 'WIN')::BIGINT AS wins, (count(*) FILTER ({VERDICT} = 'WIN') * 1000 // count(*))::BIGINT AS win_permille FROM legs GROUP BY symbol"))
def win_rate_by_symbol(spark, sf_dir):
    legs = netting.legs(fills(spark, sf_dir), ORDER).withColumn("verdict", T.verdict(F.col("pct")))
    wins, n = F.count_if(F.col("verdict") == "WIN"), F.count("*")
    return legs.groupBy("symbol").agg(n.alias("legs"), wins.alias("wins"), F.floor(stats.win_rate(wins, n) * 10 + 1e-9).alias("win_permille"))


HOURS = "date_diff('microsecond', entered, closed_at) / 3.6e9::DOUBLE"


@query(netted_sql(f"SELECT CASE WHEN {HOURS} < 4 THEN 'scalp' WHEN {HOURS} < 48 THEN 'swing' ELSE 'position-trade' END AS bucket, count(*)::BIGINT AS n FROM legs GROUP BY 1"))
def holding_bucket_tags(spark, sf_dir):
    return stats.count_by(netting.legs(fills(spark, sf_dir), ORDER), T.holding_bucket(F.col("hours")), "bucket")


@query(netted_sql("SELECT symbol, arg_max(net, (ts, event_id))::BIGINT AS net FROM netted GROUP BY symbol HAVING arg_max(net, (ts, event_id)) <> 0", FLIP, with_legs=False))
def open_positions(spark, sf_dir):
    return netting.open_positions(fills(spark, sf_dir, True), ORDER).select("symbol", F.col("net").cast("long").alias("net"))


@query()
def round_trip_report(spark, sf_dir):
    """Rounded report rows; their parity with Python's rounding is tested on fixtures."""
    rows = fills(spark, sf_dir, True).withColumn("symbol", F.concat(F.lit("S"), F.col("symbol").cast("string")))
    return netting.round_trips(rows, ORDER).drop("closed", "r_multiple")


@query("SELECT l_partkey, sum(CAST(l_quantity AS BIGINT))::BIGINT AS qty, CAST(floor(sum(CAST(round(l_extendedprice*100) AS BIGINT) * CAST(l_quantity AS BIGINT))::DOUBLE / sum(CAST(l_quantity AS BIGINT))::DOUBLE / 100) AS BIGINT) AS vwap FROM lineitem GROUP BY 1")
def vwap_by_symbol(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", F.round(F.col("l_extendedprice") * 100).alias("cents"), F.col("l_quantity").alias("q"))
    return rows.groupBy("l_partkey").agg(F.sum("q").cast("long").alias("qty"), F.floor(T.vwap(F.col("cents"), F.col("q")) / 100).alias("vwap"))


@query(f"""
WITH r AS (SELECT l_orderkey, l_linenumber, (l_tax - l_discount) * 100.0::DOUBLE AS pct, l_extendedprice AS entry, CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN l_extendedprice ELSE l_extendedprice * (1.0::DOUBLE - l_discount) END AS stop FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(floor(pct / nullif(abs(entry - stop) / nullif(entry, 0) * 100.0::DOUBLE, 0) * 100 + 0.25) AS BIGINT) AS r100 FROM r
""")
def r_multiple(spark, sf_dir):
    n = F.col("l_linenumber")
    price, off = F.col("l_extendedprice"), F.col("l_discount")
    stop = F.when(n % 3 == 0, F.lit(None)).when(n % 3 == 1, price).otherwise(price * (1.0 - off))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ((F.col("l_tax") - off) * 100.0).alias("pct"), price.alias("entry"), stop.alias("stop"))
    raw = F.col("pct") / F.nullif(F.abs(F.col("entry") - F.col("stop")) / F.nullif(F.col("entry"), F.lit(0.0)) * 100.0, F.lit(0.0))
    return rows.select("l_orderkey", "l_linenumber", F.floor(raw * 100 + 0.25).alias("r100"))


@query("SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY upper(coalesce(lang,'')), coalesce(source,''), n_chars // 500 ORDER BY doc_id) = 1")
def dedup_first_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.floor(F.col("n_chars") / 500).alias("size"))
    keys = [F.upper(F.coalesce("lang", F.lit(""))), F.coalesce("source", F.lit("")), F.col("size")]
    return selection.first_wins(rows, keys, [F.col("doc_id")]).drop("size")


@query("SELECT o_orderkey, md5(upper(o_orderpriority) || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || o_orderstatus || '|' || 'orders') AS key FROM orders")
def dedup_key_md5(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return rows.select("o_orderkey", selection.dedup_key(F.col("o_orderpriority"), day, F.col("o_orderstatus"), F.lit("orders")).alias("key"))


WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))"
DEPTH = "CASE WHEN w < 20 THEN 0.1::DOUBLE WHEN w < 50 THEN 0.4::DOUBLE WHEN w <= 400 THEN 1.0::DOUBLE WHEN w <= 600 THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END"


@query(f"SELECT doc_id, w::BIGINT AS words, {DEPTH} AS depth FROM (SELECT doc_id, {WORDS} AS w FROM documents)")
def word_count_depth(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", E.word_count(F.col("text")).cast("long").alias("words"), scoring.depth(F.col("text")).alias("depth"))


# fixed mapping of the tables' 20 sources and labels onto tiers and verdicts
KINDS = ("own_journal", "kol_post", "research_note", "chat_log", "on_chain", "synthetic", "elsewhere")
MARKED = f"""marked AS (
  SELECT d.doc_id, d.lang, ([{', '.join(repr(k) for k in KINDS)}])[1 + CAST(substr(d.source, 4) AS INT) % 7] AS kind,
    CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.toxic = 1 THEN 'LOSS' WHEN l.quality = 1 THEN 'WIN' ELSE 'SCRATCH' END AS verdict,
    {WORDS} AS w, d.n_chars
  FROM documents d LEFT JOIN labels l USING (doc_id)
), scored AS (
  SELECT *, CASE kind WHEN 'own_journal' THEN 1.0::DOUBLE WHEN 'kol_post' THEN 0.7::DOUBLE WHEN 'research_note' THEN 0.75::DOUBLE WHEN 'chat_log' THEN 0.45::DOUBLE WHEN 'on_chain' THEN 0.6::DOUBLE ELSE 0.2::DOUBLE END AS tier,
    CASE verdict WHEN 'WIN' THEN 1.0::DOUBLE WHEN 'SCRATCH' THEN 0.6::DOUBLE WHEN 'LOSS' THEN 0.5::DOUBLE ELSE 0.3::DOUBLE END AS outcome_score,
    ((n_chars % 2 = 0)::INT + (n_chars % 3 = 0)::INT + (n_chars % 5 = 0)::INT) / 3.0::DOUBLE AS specificity, {DEPTH} AS depth
  FROM marked
), rated AS (
  SELECT *, least(greatest(0.35::DOUBLE*outcome_score + 0.25::DOUBLE*tier + 0.25::DOUBLE*specificity + 0.15::DOUBLE*depth, 0.0::DOUBLE), 1.0::DOUBLE) AS raw FROM scored
)"""


def marked(spark, sf_dir) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.substring("source", 4, 9).cast("int") % 7 + 1)
    verdict = F.when(F.col("quality").isNull(), F.lit(None)).when(F.col("toxic") == 1, F.lit("LOSS")).when(F.col("quality") == 1, F.lit("WIN")).otherwise(F.lit("SCRATCH"))
    rows = docs.join(labels, "doc_id", "left").withColumn("kind", kind).withColumn("verdict", verdict)
    n = F.col("n_chars")
    return rows.withColumn("specificity", scoring.specificity(n % 2 == 0, n % 3 == 0, n % 5 == 0))


def rated(spark, sf_dir) -> DataFrame:
    score = scoring.composite(scoring.outcome_score(F.col("verdict")), scoring.tier(F.col("kind")), F.col("specificity"), scoring.depth(F.col("text")))
    return marked(spark, sf_dir).withColumn("quality_score", score)


@query(f"WITH {MARKED} SELECT doc_id, kind, tier, outcome_score FROM scored")
def source_tier_score(spark, sf_dir):
    return marked(spark, sf_dir).select("doc_id", "kind", scoring.tier(F.col("kind")).alias("tier"), scoring.outcome_score(F.col("verdict")).alias("outcome_score"))


@query(f"WITH {MARKED} SELECT doc_id, CAST(round(raw * 10000) AS BIGINT) AS score_e4 FROM rated")
def quality_score(spark, sf_dir):
    return rated(spark, sf_dir).select("doc_id", F.round(F.col("quality_score") * 10000).cast("long").alias("score_e4"))


@query(f"""WITH {MARKED}, flagged AS (
  SELECT *, row_number() OVER (PARTITION BY lang, kind, n_chars // 200 ORDER BY doc_id) = 1 AS d, CAST(round(raw * 10000) AS BIGINT) >= 5000 AS q, verdict IS DISTINCT FROM 'LOSS' AS o FROM rated)
SELECT count(*)::BIGINT AS total_input, count(*) FILTER (d)::BIGINT AS after_dedup, count(*) FILTER (d AND q)::BIGINT AS after_quality_filter,
  count(*) FILTER (d AND q AND o)::BIGINT AS after_outcome_filter, count(*) FILTER (d AND q AND o)::BIGINT AS final FROM flagged""")
def quality_filter_funnel(spark, sf_dir):
    rows = rated(spark, sf_dir).withColumn("outcome", F.struct("verdict"))
    first = F.row_number().over(Window.partitionBy("lang", "kind", F.floor(F.col("n_chars") / 200)).orderBy("doc_id")) == 1
    return stats.funnel(rows.withColumn("dedup_ok", first).withColumn("quality_ok", selection.quality_ok(0.5)).withColumn("outcome_ok", selection.outcome_ok(False, None)))


SPLIT = "SELECT o_orderkey, o_orderpriority, o_orderstatus, CASE WHEN row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) <= greatest(1, CAST(floor((SELECT count(*) FROM orders) * 0.15::DOUBLE) AS BIGINT)) THEN 'val' ELSE 'train' END AS split FROM orders"


@query(f"SELECT o_orderkey, split FROM ({SPLIT})")
def time_split(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return selection.time_split(rows, F.col("o_orderdate"), F.col("o_orderkey")).select("o_orderkey", "split")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1)::BIGINT AS at FROM orders")
def time_ordinal(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return selection.ordinal_of(rows, [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", F.col("at").cast("long").alias("at"))


@query("SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'val' ELSE 'test' END AS split FROM orders")
def cutoff_split(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", selection.cutoff_split(F.col("o_orderdate"), "1997-01-01", "1998-01-01").alias("split"))


@query(f"SELECT split, count(*)::BIGINT AS n FROM ({SPLIT}) GROUP BY split")
def split_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return stats.count_by(selection.time_split(rows, F.col("o_orderdate"), F.col("o_orderkey")), F.col("split"), "split")


@query("SELECT coalesce(source, 'unknown') AS source, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def source_counts(spark, sf_dir):
    return stats.source_counts(table(spark, sf_dir, "documents"))


@query(f"WITH {MARKED} SELECT coalesce(verdict, 'none') AS verdict, count(*)::BIGINT AS n FROM marked GROUP BY 1")
def verdict_counts(spark, sf_dir):
    return stats.verdict_counts(marked(spark, sf_dir).withColumn("outcome", F.struct("verdict")))


@query("SELECT doc_id, nullif(lower(regexp_extract(text, '(?i)(?:^|[^a-zA-Z0-9_À-ÿ])(the|der|les|que)(?:[^a-zA-Z0-9_À-ÿ]|$)', 1)), '') AS word FROM documents")
def regex_first_keyword(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.lower(T.first_word_of(F.col("text"), ("the", "der", "les", "que"))).alias("word"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN lang='en' THEN 'bullish-bias' END, CASE WHEN lang='de' THEN 'bearish-bias' END, CASE WHEN n_chars > 1000 THEN 'structured-setup' END, CASE WHEN length(source) > 100 THEN 'detailed-reasoning' END, CASE WHEN contains(lower(text),'liquidity') THEN 'liquidity-grab' END, CASE WHEN contains(lower(text),'funding') THEN 'funding-rate' END, CASE WHEN contains(lower(text),'breakout') THEN 'breakout' END, CASE WHEN contains(lower(text),'range') THEN 'range-trade' END], lambda x: x IS NOT NULL), ',') AS tags FROM documents")
def tags_contains(spark, sf_dir):
    way = F.when(F.col("lang") == "en", F.lit("long")).when(F.col("lang") == "de", F.lit("short")).otherwise(F.lit(""))
    tags = transform.tags_of(way, F.col("n_chars") > 1000, F.col("source"), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(tags, ",").alias("tags"))


@query("SELECT p_partkey, '$' || CASE p_size % 3 WHEN 0 THEN format('{:,.0f}', p_retailprice) WHEN 1 THEN format('{:,.1f}', p_retailprice) ELSE format('{:,.4f}', p_retailprice) END AS price FROM part")
def price_format(spark, sf_dir):
    symbol = F.element_at(F.array(F.lit("ETH/BTC"), F.lit("sol/USDT"), F.lit("XRP/USDT")), F.col("p_size") % 3 + 1)
    return table(spark, sf_dir, "part").select("p_partkey", T.format_price(F.col("p_retailprice"), symbol).alias("price"))


@query("SELECT event_id, list_sort(json_keys(props))::VARCHAR AS keys, json_array_length(json_keys(props)::JSON)::BIGINT AS n FROM events")
def json_props_scan(spark, sf_dir):
    keys = F.array_sort(F.json_object_keys("props"))
    return table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("["), F.array_join(keys, ", "), F.lit("]")).alias("keys"), F.size(keys).cast("long").alias("n"))


@query(f"""WITH {MARKED}, errs AS (
  SELECT doc_id, unnest(list_filter([CASE WHEN NOT regexp_matches(lang || '.0', '^\\d+\\.\\d+$') THEN 'version' END, CASE WHEN kind NOT IN ({', '.join(repr(s) for s in SOURCES)}) THEN 'source' END, CASE WHEN w < 20 THEN 'reasoning' END, CASE WHEN NOT CAST(round(raw*10000) AS BIGINT) BETWEEN 3000 AND 10000 THEN 'quality_score' END], lambda x: x IS NOT NULL)) AS error FROM rated)
SELECT error, count(*)::BIGINT AS n FROM errs GROUP BY 1""")
def validate_rules(spark, sf_dir):
    errors = E.present(
        F.when(~F.concat("lang", F.lit(".0")).rlike(VERSION), F.lit("version")),
        F.when(~F.col("kind").isin(*SOURCES), F.lit("source")),
        F.when(E.word_count(F.col("text")) < 20, F.lit("reasoning")),
        F.when(~F.round(F.col("quality_score") * 10000).between(3000, 10000), F.lit("quality_score")),
    )
    return stats.count_by(rated(spark, sf_dir).select(F.explode(errors).alias("error")), F.col("error"), "error")


@query("SELECT 0 AS rank, doc_id AS id, length(text)::BIGINT AS chars FROM documents UNION ALL SELECT 1, conv_id, length(text) FROM conversations")
def union_sources(spark, sf_dir):
    posts = table(spark, sf_dir, "documents").select(F.lit(0).alias("rank"), F.col("doc_id").alias("id"), F.length("text").cast("long").alias("chars"))
    chats = table(spark, sf_dir, "conversations").select(F.lit(1).alias("rank"), F.col("conv_id").alias("id"), F.length("text").cast("long").alias("chars"))
    return posts.unionByName(chats)


@query("SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg('<|im_start|>' || role || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn) AS formatted_text FROM conversations GROUP BY conv_id")
def chat_format(spark, sf_dir):
    return conversation_text(table(spark, sf_dir, "conversations"), "qwen")


@query("SELECT c.event_id, p.event_id AS matched FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON c.user_id = p.user_id AND c.ts <= p.ts")
def asof_outcome(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    clicks, bought = rows.where("event_type = 'click'"), rows.where("event_type = 'purchase'")
    return matching.as_of(clicks, bought, "user_id", F.col("event_id"), ["ts"], forward=True).select("event_id", "matched")


@query("""WITH c AS (SELECT * FROM events WHERE event_type = 'click'), p AS (SELECT * FROM events WHERE event_type = 'purchase'),
near AS (SELECT c.event_id, arg_min(p.event_id, (abs(date_diff('microsecond', c.ts, p.ts)), p.ts)) AS matched, arg_min(p.value, (abs(date_diff('microsecond', c.ts, p.ts)), p.ts)) AS v
  FROM c JOIN p ON c.user_id = p.user_id AND abs(date_diff('microsecond', c.ts, p.ts)) <= 21600000000 GROUP BY 1)
SELECT c.event_id, matched, CASE WHEN matched IS NULL THEN 'EXPIRED' WHEN v - 250.0::DOUBLE > 1 THEN 'WIN' WHEN v - 250.0::DOUBLE < -1 THEN 'LOSS' ELSE 'SCRATCH' END AS verdict FROM c LEFT JOIN near USING (event_id)""")
def outcome_match(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    clicks = rows.where("event_type = 'click'").select(F.col("event_id").alias("id"), F.col("user_id").alias("instrument"), "ts")
    trades = rows.where("event_type = 'purchase'").select("event_id", F.col("user_id").alias("instrument"), "ts", (F.col("value") - 250.0).alias("realized_pnl_pct"))
    met = matching.nearest_within(clicks, trades, "instrument", 6 * 3600, "id")
    pct = F.col("match.realized_pnl_pct")
    verdict = F.when(pct.isNull(), F.lit("EXPIRED")).otherwise(T.verdict(pct))
    return met.select(F.col("id").alias("event_id"), F.col("match.event_id").alias("matched"), verdict.alias("verdict"))


@query("SELECT a.vec_id AS left_id, b.vec_id AS right_id FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.4")
def semantic_dup_pairs(spark, sf_dir):
    return semantic.similar_pairs(table(spark, sf_dir, "embeddings"), "label", 0.4).select("left_id", "right_id")


@query("SELECT vec_id FROM embeddings b WHERE NOT EXISTS (SELECT 1 FROM embeddings a WHERE a.label = b.label AND a.vec_id < b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.4)")
def semantic_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return semantic.semantic_dedup(rows, semantic.similar_pairs(rows, "label", 0.4)).select("vec_id")


@query(f"WITH {MARKED} SELECT kind, count(*)::BIGINT AS n, CAST(round(avg(n_chars) * 1000) AS BIGINT) AS mean_e3, quantile_cont(n_chars, 0.25)::DOUBLE AS p25, quantile_cont(n_chars, 0.5)::DOUBLE AS p50, quantile_cont(n_chars, 0.75)::DOUBLE AS p75, min(n_chars) AS least, max(n_chars) AS most FROM marked GROUP BY kind")
def dataset_card(spark, sf_dir):
    rows = stats.distribution(marked(spark, sf_dir), F.col("n_chars"), [F.col("kind")])
    return rows.select("kind", "n", F.round(F.col("mean") * 1000).cast("long").alias("mean_e3"), *[F.col(c).cast("double").alias(c) for c in ("p25", "p50", "p75")], "least", "most")


@query(f"WITH {MARKED} SELECT doc_id, CASE WHEN kind = 'own_journal' THEN 'always-review source' WHEN CAST(round(raw*10000) AS BIGINT) BETWEEN 4000 AND 7000 THEN 'borderline score' WHEN verdict IS NULL THEN 'no judge score' WHEN doc_id % 20 = 0 THEN 'random sample' END AS reason FROM rated")
def review_queue(spark, sf_dir):
    reason = selection.review_reason(F.col("kind"), F.col("quality_score"), F.col("verdict"), F.col("doc_id") % 20 == 0)
    return rated(spark, sf_dir).select("doc_id", reason.alias("reason"))


@query(f"""WITH {MARKED} SELECT doc_id, CASE WHEN CAST(round(raw*10000) AS BIGINT) < 5000 THEN 'quality below minimum' WHEN lang IS NULL THEN 'missing instrument' WHEN verdict = 'LOSS' THEN 'loss excluded' WHEN w > 400 THEN 'too long' END AS reason FROM rated""")
def quality_rejections(spark, sf_dir):
    rows = rated(spark, sf_dir).select(
        "doc_id", "quality_score", F.col("lang").alias("instrument"), F.lit("t").alias("timestamp_context"), F.col("text").alias("reasoning"),
        F.lit("").alias("context"), F.struct(F.lit("LONG").alias("direction")).alias("decision"), F.struct("verdict").alias("outcome"),
    )
    # the decision adds one word
    return rows.select("doc_id", selection.rejection(0.5, False, 401).alias("reason"))


@query("SELECT doc_id, CASE WHEN length(text) > 120 THEN left(text, 120) || '...' ELSE text END AS text FROM documents ORDER BY doc_id LIMIT 2")
def preview_head(spark, sf_dir):
    from ..sinks.files import preview

    return preview(table(spark, sf_dir, "documents").select("doc_id", "text", F.col("doc_id").alias("ord")))


@query("SELECT conv_id::VARCHAR AS conv_id, count(*)::BIGINT AS n_lines, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id")
def chat_log_records(spark, sf_dir):
    rows = ChatLogCollector(table(spark, sf_dir, "conversations")).collect(spark)
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("conv_id")).agg(F.count("*").alias("n_lines"))
    return rows.select(F.col("metadata.conv_id").alias("conv_id"), F.md5("raw_text").alias("digest")).join(turns, "conv_id").select("conv_id", "n_lines", "digest")


@query()
def research_segments(spark, sf_dir):
    """Segments of HTML pages; tag stripping is tested on fixtures."""
    return ResearchCollector(table(spark, sf_dir, "pages")).collect(spark)


BARE = r"regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
for _entity, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    BARE = f"replace({BARE}, '{_entity}', '{_char}')"


@query(rf"SELECT page_id, trim(regexp_replace({BARE}, '\s+', ' ', 'g')) AS text FROM pages")
def page_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_text(F.col("html")).alias("text"))


@query(f"WITH {MARKED}, best AS (SELECT lang, n_chars // 1000 AS day, arg_max(doc_id, (CAST(round(raw*10000) AS BIGINT), doc_id)) AS chosen, max(CAST(round(raw*10000) AS BIGINT)) AS top FROM rated GROUP BY ALL) SELECT r.lang AS instrument, chosen, doc_id AS rejected FROM rated r JOIN best b ON r.lang = b.lang AND r.n_chars // 1000 = b.day WHERE CAST(round(raw*10000) AS BIGINT) < top")
def preference_pairs(spark, sf_dir):
    rows = rated(spark, sf_dir).select(F.col("lang").alias("instrument"), F.floor(F.col("n_chars") / 1000).alias("day"), F.col("doc_id").alias("id"), "quality_score")
    return selection.preference_pairs(rows, F.col("day")).select("instrument", "chosen", "rejected")


@query("""WITH ideas AS (SELECT event_id AS id, user_id, ts, value AS entry, value + 50 AS target, value - 50 AS stop FROM events WHERE event_type = 'click'),
bars AS (SELECT user_id, ts AS bts, value + 5 AS high, value - 5 AS low FROM events WHERE event_type = 'view'),
hit AS (SELECT id, arg_min(low <= stop, bts) AS stopped FROM ideas JOIN bars USING (user_id) WHERE bts > ts AND bts <= ts + INTERVAL 48 HOUR AND (low <= stop OR high >= target) GROUP BY id)
SELECT id, CASE WHEN stopped IS NULL THEN 'open' WHEN stopped THEN 'stop' ELSE 'target' END AS ended FROM ideas LEFT JOIN hit USING (id)""")
def theoretical_outcome(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumnRenamed("user_id", "instrument")
    v = F.col("value")
    ideas = rows.where("event_type = 'click'").select(F.col("event_id").alias("id"), "instrument", "ts", v.alias("entry"), (v + 50).alias("target"), (v - 50).alias("stop"))
    bars = rows.where("event_type = 'view'").select("instrument", "ts", (v + 5).alias("high"), (v - 5).alias("low"))
    # not by the sign of the result, which an entry at 0 has none of
    stopped = F.col("stopped")
    return matching.first_touch(ideas, bars, 48 * 3600).select("id", F.when(stopped.isNull(), F.lit("open")).when(stopped, F.lit("stop")).otherwise(F.lit("target")).alias("ended"))


@query(r"SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY md5(regexp_replace(regexp_replace(lower(text), 'https?://\S+', ' ', 'g'), '[^a-z0-9_À-ɏ]+', '', 'g')) ORDER BY doc_id) = 1")
def repost_removal(spark, sf_dir):
    return semantic.drop_reposts(table(spark, sf_dir, "documents").select("doc_id", "text"), [F.col("doc_id")]).select("doc_id")


@query(f"WITH {MARKED} SELECT coalesce(kind, 'all') AS kind, coalesce(lang, 'all') AS lang, count(*)::BIGINT AS n FROM marked GROUP BY ROLLUP (kind, lang)")
def counts_rollup(spark, sf_dir):
    rows = marked(spark, sf_dir).rollup("kind", "lang").agg(F.count("*").alias("n"))
    return rows.select(F.coalesce("kind", F.lit("all")).alias("kind"), F.coalesce("lang", F.lit("all")).alias("lang"), "n")


@query("SELECT user_id AS symbol, date_trunc('hour', ts) AS start, count(*)::BIGINT AS n, max(value) AS most FROM events GROUP BY 1, 2")
def hourly_windows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("symbol"), F.window("ts", "1 hour").alias("w"))
    return rows.agg(F.count("*").alias("n"), F.max("value").alias("most")).select("symbol", F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "most")
