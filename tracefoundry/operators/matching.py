"""Joins by time: nearest match in a window, as-of, first touch of price levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import micros
from ..functions.trading import verdict
from .netting import STRETCH, stretch_of


def _buckets(at: Column, width: int) -> Column:
    return F.floor(at / width).cast("long")


def nearest_within(left: DataFrame, right: DataFrame, key: str, seconds: int, left_id: str, left_ts: str = "ts", right_ts: str = "ts") -> DataFrame:
    """Each left row with the right row of its key nearest in time, at most ``seconds`` away.

    Time is cut into buckets as wide as the window, so the range condition
    becomes an equi-join on (key, bucket): a right row is put into its own
    and the two neighbouring buckets, a left row into its own.  A busy key is
    spread over its buckets.  Ties take the earlier row.
    """
    width = seconds * 1_000_000
    l = left.withColumn("__lt", micros(F.col(left_ts))).withColumn("__b", _buckets(F.col("__lt"), width))
    r = right.select(F.col(key), F.struct(*right.columns).alias("match"), micros(F.col(right_ts)).alias("__rt"))
    r = r.withColumn("__b", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: _buckets(F.col("__rt"), width) + i)))
    met = l.join(r, [key, "__b"]).where(F.abs(F.col("__lt") - F.col("__rt")) <= width)
    best = met.groupBy(left_id).agg(F.min_by("match", F.struct(F.abs(F.col("__lt") - F.col("__rt")), F.col("__rt"))).alias("match"))
    return left.join(best, left_id, "left")


def as_of(left: DataFrame, right: DataFrame, key: str, value: Column, order: list[str], forward: bool = False, seconds: int | None = STRETCH) -> DataFrame:
    """``left`` with ``matched``, ``value`` of the last right row at or before it (``forward``: first at or after).

    Both sides are merged in windows, so each row is sorted once and no pairs
    arise.  Right rows come first among equal times.  The first column of
    ``order`` is the time: windows are over a key's stretches of ``seconds``,
    and what a stretch has from those before it comes from a scan of one row
    for each, so a busy key is many tasks.  None: one window for each key.
    """
    kind = right.select(value).dtypes[0][1]
    cut = lambda rows: rows.withColumn("__stretch", F.lit(0).cast("long") if seconds is None else stretch_of(F.col(order[0]), seconds))
    both = cut(left).select(F.lit(1).alias("__side"), key, "__stretch", *order, F.struct(*left.columns).alias("__row"), F.lit(None).cast(kind).alias("__value"))
    other = cut(right).select(F.lit(0).alias("__side"), key, "__stretch", *order, F.lit(None).cast(both.schema["__row"].dataType).alias("__row"), value.alias("__value"))
    merged = both.unionByName(other)
    way = [F.desc(c) for c in order] if forward else list(order)
    w = Window.partitionBy(key, "__stretch").orderBy(*way, "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last(F.when(F.col("__side") == 0, F.col("__value")), ignorenulls=True).over(w)
    rows = merged.withColumn("matched", found)
    if seconds is not None:
        told = merged.where(F.col(key).isNotNull()).groupBy(key, "__stretch").agg((F.min_by if forward else F.max_by)("__value", F.when(F.col("__value").isNotNull(), F.struct(*order))).alias("__own"))
        along = Window.partitionBy(key).orderBy(F.desc("__stretch") if forward else "__stretch").rowsBetween(Window.unboundedPreceding, -1)
        past = told.select(key, "__stretch", F.last("__own", ignorenulls=True).over(along).alias("__past"))
        rows = rows.join(past, [key, "__stretch"], "left").withColumn("matched", F.coalesce("matched", "__past"))
    return rows.where("__side = 1").select("__row.*", "matched")


def label_outcomes(records: DataFrame, trades: DataFrame, seconds: int, win: float = 1.0, loss: float = -1.0) -> DataFrame:
    """Records (id, instrument, ts) with the verdict of the nearest trade (instrument, ts, realized_pnl_pct); EXPIRED without one."""
    met = nearest_within(records, trades, "instrument", seconds, "id")
    pct = F.col("match.realized_pnl_pct")
    return met.withColumn("realized_pnl_pct", pct).withColumn("verdict", F.when(pct.isNull(), F.lit("EXPIRED")).otherwise(verdict(pct, win, loss))).drop("match")


def _touches(low: Column, high: Column) -> tuple[Column, Column]:
    """Whether the stop and the target of an idea are within what prices went to."""
    up = F.col("target") >= F.col("entry")
    return F.when(up, low <= F.col("stop")).otherwise(high >= F.col("stop")), F.when(up, high >= F.col("target")).otherwise(low <= F.col("target"))


def _result(stopped: Column) -> Column:
    way = F.when(F.col("target") >= F.col("entry"), 1.0).otherwise(-1.0)
    return way * (F.when(stopped, F.col("stop")).otherwise(F.col("target")) - F.col("entry")) / F.nullif(F.col("entry"), F.lit(0)) * 100


def _ended(ideas: DataFrame, met: DataFrame) -> DataFrame:
    """``ideas`` with ``theoretical_pct`` and ``stopped`` of the first of the bars in ``met`` that end them; of bars of one time, the stop."""
    stopped = F.coalesce(_touches(F.col("low"), F.col("high"))[0], F.lit(False))
    first = F.min_by(F.struct(_result(stopped).alias("theoretical_pct"), stopped.alias("stopped")), F.struct("__rt", ~stopped))
    return ideas.join(met.groupBy("id").agg(first.alias("first")).select("id", "first.*"), "id", "left")


def first_touch(ideas: DataFrame, bars: DataFrame, horizon_seconds: int) -> DataFrame:
    """Theoretical result of ideas (id, instrument, ts, entry, target, stop) on bars (instrument, ts, high, low).

    The first bar after the idea that touches the stop or the target ends it;
    a bar that touches both counts as the stop.  ``stopped`` says which; it and
    ``theoretical_pct`` are null if none does in time, and the result of an
    entry at 0 is null too.
    An idea meets every bar of its horizon: :func:`first_touch_by_spans` does
    not, which pays where a horizon has more than some hundred bars.
    """
    width = horizon_seconds * 1_000_000
    l = ideas.withColumn("__lt", micros(F.col("ts"))).withColumn("__b", _buckets(F.col("__lt"), width))
    r = bars.select("instrument", "high", "low", micros(F.col("ts")).alias("__rt"))
    r = r.withColumn("__b", F.explode(F.array(_buckets(F.col("__rt"), width), _buckets(F.col("__rt"), width) - 1)))
    stopped, reached = _touches(F.col("low"), F.col("high"))
    met = l.join(r, ["instrument", "__b"]).where((F.col("__rt") > F.col("__lt")) & (F.col("__rt") <= F.col("__lt") + width) & (stopped | reached))
    return _ended(ideas, met)


#: Spans of one level in a span of the next.
FANOUT = 4


def span_table(bars: DataFrame, slot_seconds: int, levels: int) -> DataFrame:
    """(instrument, level, span, low, high): least and greatest price of spans of FANOUT**level slots."""
    slot = _buckets(micros(F.col("ts")), slot_seconds * 1_000_000)
    slots = bars.groupBy("instrument", slot.alias("slot")).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    up = slots.select("instrument", "slot", "low", "high", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"))
    span = F.floor(F.col("slot") / F.pow(F.lit(float(FANOUT)), "level")).cast("long")
    return up.groupBy("instrument", "level", span.alias("span")).agg(F.min("low").alias("low"), F.max("high").alias("high"))


def covering(begin: Column, end: Column, levels: int) -> Column:
    """Spans (level, span) that make up the slots [begin, end): at most 2 * (FANOUT - 1) of each level."""
    parts = []
    between = lambda k, a, b: F.transform(F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>")), lambda s: F.struct(F.lit(k).alias("level"), s.alias("span")))
    for k in range(levels + 1):
        size = float(FANOUT**k)
        low, high = F.ceil(begin / size).cast("long"), F.floor(end / size).cast("long")
        left, right = F.ceil(low / FANOUT).cast("long") * FANOUT, F.floor(high / FANOUT).cast("long") * FANOUT
        if k == levels:
            parts.append(between(k, low, high))
        else:
            parts += [between(k, low, F.least(left, high)), between(k, F.greatest(left, right), high)]
    return F.concat(*parts)


def first_touch_by_spans(ideas: DataFrame, bars: DataFrame, horizon_seconds: int, slot_seconds: int = 60) -> DataFrame:
    """:func:`first_touch`, where an idea meets a number of rows that grows with the logarithm of its horizon's bars.

    Bars are summed up in slots, and slots in a pyramid of spans.  Of the few
    spans that make up an idea's horizon, the first whose prices touch holds
    the end; from there one goes down by the first child that touches.  Bars
    are met in three slots: the idea's own, the one found, the horizon's last.
    """
    width, slot = horizon_seconds * 1_000_000, slot_seconds * 1_000_000
    levels = 0
    while FANOUT ** (levels + 1) * slot_seconds <= horizon_seconds:
        levels += 1
    spans = span_table(bars, slot_seconds, levels)
    own = ideas.select("id", "instrument", "entry", "target", "stop", micros(F.col("ts")).alias("__lt")).where("__lt is not null")
    own = own.withColumn("__first", _buckets(F.col("__lt"), slot)).withColumn("__last", _buckets(F.col("__lt") + width, slot))
    stopped, reached = _touches(F.col("low"), F.col("high"))
    touch = stopped | reached
    # FANOUT**level is exact in double precision
    start = F.col("span") * F.pow(F.lit(float(FANOUT)), "level").cast("long")
    facts = ["id", "instrument", "entry", "target", "stop", "__lt", "__first", "__last"]
    at = own.select(*facts, F.inline(covering(F.col("__first") + 1, F.col("__last"), levels)))
    at = at.join(spans, ["instrument", "level", "span"]).where(touch).groupBy("id").agg(F.min_by(F.struct(*facts[1:], "level", "span"), start).alias("f")).select("id", "f.*")
    for k in range(levels, 0, -1):
        # spans of lower levels wait for their turn
        down = at.withColumn("__high", F.col("level") == k)
        down = down.select(*facts, F.explode(F.when(F.col("__high"), F.sequence(F.col("span") * FANOUT, F.col("span") * FANOUT + FANOUT - 1)).otherwise(F.array("span"))).alias("span"), F.when(F.col("__high"), k - 1).otherwise(F.col("level")).alias("level"))
        at = down.join(spans, ["instrument", "level", "span"]).where(touch).groupBy("id").agg(F.min_by(F.struct(*facts[1:], "level", "span"), "span").alias("f")).select("id", "f.*")
    slots = own.select(*facts, F.explode(F.array_distinct(F.array("__first", "__last"))).alias("slot")).unionByName(at.select(*facts, F.col("span").alias("slot"))).distinct()
    rows = bars.select("instrument", "high", "low", micros(F.col("ts")).alias("__rt")).withColumn("slot", _buckets(F.col("__rt"), slot))
    met = slots.join(rows, ["instrument", "slot"]).where((F.col("__rt") > F.col("__lt")) & (F.col("__rt") <= F.col("__lt") + width) & touch)
    return _ended(ideas, met)


def read_back_verdicts(records: DataFrame, reviews: DataFrame) -> DataFrame:
    """Records with a person's verdict by id; the record's own where there is none."""
    return records.join(reviews.select("id", F.col("verdict").alias("reviewed")), "id", "left").withColumn("verdict", F.coalesce("reviewed", "verdict")).drop("reviewed")


def written_before_outcome(records: DataFrame, written: str = "ts", ended: str = "exit_ts") -> DataFrame:
    """``authentic``: whether a record was written before its trade ended; null if unknown."""
    return records.withColumn("authentic", F.col(written) < F.col(ended))
