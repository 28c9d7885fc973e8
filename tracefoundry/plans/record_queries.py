"""Queries over records: reply threads, pairings, answers kept by content, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import answers, matching, pairing, replies
from ..operators.validate import schema_errors
from ..shared import folder
from ..streaming import outcomes
from .queries import ORACLES, query, table

#: One message in eleven begins a thread, one in thirteen answers message 0, some answer what is not there.
REPLY_TO = """CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 97 = 5 THEN event_id + 1000000000
  WHEN event_id % 13 = 3 THEN 0 ELSE event_id - 1 - (event_id * 7919) % least(event_id, 40) END"""


@query(f"""
WITH RECURSIVE m AS (SELECT event_id AS id, ts, {REPLY_TO} AS reply_to FROM events
), r AS (SELECT m.id, m.ts, p.id AS parent, m.reply_to IS NOT NULL AND p.id IS NULL AS orphan FROM m LEFT JOIN m p ON p.id = m.reply_to
), walk(id, root, depth, path, orphan) AS (
  SELECT id, id, 0::BIGINT, [(ts, id)], orphan FROM r WHERE parent IS NULL
  UNION ALL SELECT r.id, w.root, w.depth + 1, list_append(w.path, (r.ts, r.id)), r.orphan FROM r JOIN walk w ON r.parent = w.id
)
SELECT id, root, depth, row_number() OVER (PARTITION BY root ORDER BY path) - 1 AS place, count(*) OVER (PARTITION BY root) AS size, orphan, false AS looped FROM walk
""")
def reply_threads(spark, sf_dir):
    messages = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "ts", F.expr(REPLY_TO).alias("reply_to"))
    return replies.threads(messages)


def _service(record: dict) -> str:
    """Stands in for a service: it refuses one status."""
    if record["o_orderstatus"] == "P":
        raise PermissionError("refused")
    return f"{record['o_orderpriority']} / {record['o_orderstatus']}"


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority || ' / ' || o_orderstatus END AS answer,
  CASE WHEN o_orderstatus = 'P' THEN 'PermissionError: refused' END AS answer_error FROM orders""")
def kept_answers(spark, sf_dir):
    """One call for each different request, whatever the number of its orders; a refused request is null in its own rows."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    limits = answers.Limits(attempts=2, pause=0.01)
    made = answers.ask(rows, ["o_orderpriority", "o_orderstatus"], _service, folder(spark, "kept-answers"), "service-1", limits=limits)
    return made.select("o_orderkey", "answer", "answer_error")


@query("""
WITH RECURSIVE lists AS (
  SELECT user_id % 40 AS symbol, list({'t': epoch_us(ts), 'side': CASE event_type WHEN 'purchase' THEN 0 ELSE 1 END, 'id': event_id} ORDER BY ts, event_type <> 'purchase', event_id) AS l
  FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1
), steps AS (
  SELECT symbol, l, NULL::BIGINT AS trade_id, NULL::BIGINT AS entry_id, NULL::BIGINT AS apart FROM lists
  UNION ALL
  SELECT symbol, list_concat(l[1:b.i - 1], l[b.i + 2:]), CASE l[b.i].side WHEN 0 THEN l[b.i].id ELSE l[b.i + 1].id END, CASE l[b.i].side WHEN 1 THEN l[b.i].id ELSE l[b.i + 1].id END, b.d
  FROM (SELECT symbol, l, list_min(list_transform(list_filter(range(1, len(l)), lambda i: l[i].side <> l[i + 1].side AND l[i + 1].t - l[i].t <= 3600000000), lambda i: {'d': l[i + 1].t - l[i].t, 'i': i})) AS b FROM steps)
  WHERE b IS NOT NULL
)
SELECT symbol, trade_id, entry_id, apart FROM steps WHERE apart IS NOT NULL
""")
def one_to_one_pairs(spark, sf_dir):
    """Purchases (trades) and errors (entries) of a group of users, each at most once."""
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 40).alias("symbol"), "ts", "event_type")
    trades = rows.where("event_type = 'purchase'").withColumnRenamed("event_id", "trade_id")
    entries = rows.where("event_type = 'error'").withColumnRenamed("event_id", "entry_id")
    return pairing.pair_one_to_one(trades, entries, "symbol", 3600, "trade_id", "entry_id")


@query(ORACLES["outcome_match"])
def stream_expired(spark, sf_dir):
    """The outcomes of ``outcome_match`` from a stream over the table, with a tick after its end that moves the watermark on.

    The path is a pattern, as a file stream takes a single file by no other.
    """
    events = table(spark, sf_dir, "events")
    base = folder(spark, "stream-expired")
    # it has a user, as rows that no join can meet may end before the watermark sees them
    given = {"ts": F.col("ts"), "user_id": F.lit(-1).cast("long").alias("user_id")}
    tick = events.agg((F.max("ts") + F.expr("interval 30 days")).alias("ts")).select(*(given.get(f.name, F.lit(None).cast(f.dataType).alias(f.name)) for f in events.schema))
    tick.write.parquet(f"{base}/tick")
    source = lambda: spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]").unionByName(spark.readStream.schema(events.schema).parquet(f"{base}/tick"))
    end = F.col("event_id").isNull()
    clicks = source().where((F.col("event_type") == "click") | end).select(F.col("event_id").alias("id"), F.col("user_id").alias("instrument"), "ts")
    trades = source().where((F.col("event_type") == "purchase") | end).select("event_id", F.col("user_id").alias("instrument"), "ts", (F.col("value") - 250.0).alias("realized_pnl_pct"))
    outcomes.run_available(outcomes.stream_outcomes(clicks, trades, 6 * 3600), f"{base}/out", f"{base}/checkpoint")
    done = spark.read.schema("id long, instrument long, ts timestamp, match struct<event_id:long>, verdict string").parquet(f"{base}/out")
    return done.where("id is not null").select(F.col("id").alias("event_id"), F.col("match.event_id").alias("matched"), "verdict")


#: A keyword of each sort, over rows of documents as JSON.
DOCUMENT_SCHEMA = {
    "type": "object",
    "required": ["id", "lang", "size"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 10},
        "lang": {"type": "string", "enum": ["en", "de"]},
        "tags": {"type": "array", "minItems": 1, "items": {"type": "string", "minLength": 3}},
        "seen": {"type": "string", "format": "date-time"},
        "size": {"type": "integer", "maximum": 2000},
    },
}


@query("""SELECT doc_id, array_to_string(list_filter([
  CASE WHEN lang IS NULL THEN 'lang: required' END, CASE WHEN n_chars IS NULL THEN 'size: required' END, CASE WHEN doc_id < 10 THEN 'id: minimum' END,
  CASE WHEN lang NOT IN ('en', 'de') THEN 'lang: enum' END, CASE WHEN source IS NULL OR lang IS NULL THEN 'tags[]: type' END,
  CASE WHEN length(source) < 3 OR length(lang) < 3 THEN 'tags[]: minLength' END, CASE WHEN doc_id % 3 <> 0 THEN 'seen: format' END, CASE WHEN n_chars > 2000 THEN 'size: maximum' END
], lambda x: x IS NOT NULL), '; ') AS errors FROM documents""")
def schema_faults(spark, sf_dir):
    """Rows of documents as JSON against a schema with items and formats."""
    seen = F.when(F.col("doc_id") % 3 == 0, F.lit("2025-01-01T00:00:00Z")).otherwise(F.lit("2025-01-01"))
    raw = F.to_json(F.struct(F.col("doc_id").alias("id"), "lang", F.array("source", "lang").alias("tags"), seen.alias("seen"), F.col("n_chars").alias("size")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(schema_errors(raw, DOCUMENT_SCHEMA), "; ").alias("errors"))


@query(ORACLES["theoretical_outcome"])
def theoretical_by_spans(spark, sf_dir):
    """``theoretical_outcome`` by way of a pyramid of spans."""
    rows = table(spark, sf_dir, "events").withColumnRenamed("user_id", "instrument")
    v = F.col("value")
    ideas = rows.where("event_type = 'click'").select(F.col("event_id").alias("id"), "instrument", "ts", v.alias("entry"), (v + 50).alias("target"), (v - 50).alias("stop"))
    bars = rows.where("event_type = 'view'").select("instrument", "ts", (v + 5).alias("high"), (v - 5).alias("low"))
    # not by the sign of the result, which an entry at 0 has none of
    stopped = F.col("stopped")
    ended = F.when(stopped.isNull(), F.lit("open")).when(stopped, F.lit("stop")).otherwise(F.lit("target"))
    return matching.first_touch_by_spans(ideas, bars, 48 * 3600, 900).select("id", ended.alias("ended"))
