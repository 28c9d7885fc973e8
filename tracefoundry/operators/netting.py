"""Round trips from fills: position netting with window functions.

Per symbol, in order of (ts, ordinal), the running position splits fills into
events: O opens a leg from flat, C closes it to flat, A stays on the same
side, F flips to the other side, which closes one leg and opens the next with
its full quantity.  A leg number is the running count of O and F.  An A fill
belongs to the leg it stays in, also when it reduces it.

Of a symbol with up to BUSY fills, one exchange by symbol serves the windows
and the aggregation by leg.  With a busier one, the same columns come from a
segmented scan: each symbol's time is cut into stretches, whose summaries
(quantity, legs begun, last turn) compose; a scan over a row per symbol and
stretch carries what was before each, and the stretches finish alone, so no
task gets all fills of a symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import iso_text, micros, rounded
from ..functions.trading import verdict
from ..shared import written

POSITION = "decimal(38,10)"
#: Fills of a symbol that one task sorts.
BUSY = 5_000_000
#: Seconds of a stretch of a busy symbol's time.
STRETCH = 86_400


def stretch_of(time: Column, seconds: int) -> Column:
    """Number of the stretch of time; rows without a time are before all others."""
    return F.coalesce(F.floor(micros(time) / (seconds * 1_000_000)), F.lit(-(2**63)).cast("long"))


def is_busy(fills: DataFrame) -> bool:
    """Whether a symbol has more fills than one task should sort.  It reads the symbols once."""
    return not fills.groupBy("symbol").agg(F.count("*").alias("n")).where(F.col("n") > BUSY).isEmpty()


def _signed() -> Column:
    return F.when(F.col("side") == "buy", F.col("qty")).otherwise(-F.col("qty")).cast(POSITION)


def _past(parts: DataFrame, **carried: Column) -> DataFrame:
    """For each symbol and stretch of ``parts``, what ``carried`` says of the symbol's stretches before it."""
    before = Window.partitionBy("symbol").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("symbol", "__stretch", *(c.over(before).alias(n) for n, c in carried.items()))


def running_position(fills: DataFrame, order: tuple[str, ...] = ("ts", "ordinal"), busy: bool | None = None, seconds: int = STRETCH) -> DataFrame:
    """``fills`` with ``net``, ``prev`` (positions after and before), exact to ten decimals.

    ``busy`` chooses the segmented scan (None: if a symbol has more than BUSY
    fills); the first column of ``order`` is the time.
    """
    if not (is_busy(fills) if busy is None else busy):
        w = Window.partitionBy("symbol").orderBy(*order)
        netted = fills.withColumn("net", F.sum(_signed()).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return netted.withColumn("prev", F.coalesce(F.lag("net").over(w), F.lit(0).cast(POSITION)))
    cut = fills.withColumn("__stretch", stretch_of(F.col(order[0]), seconds))
    sums = cut.groupBy("symbol", "__stretch").agg(F.sum(_signed()).cast(POSITION).alias("moved"))
    past = _past(sums, __past=F.sum("moved"))
    w = Window.partitionBy("symbol", "__stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast(POSITION)
    inside = cut.join(past, ["symbol", "__stretch"]).withColumn("net", (F.coalesce("__past", zero) + F.sum(_signed()).over(w)).cast(POSITION))
    return inside.withColumn("prev", (F.col("net") - F.coalesce(_signed(), zero)).cast(POSITION)).select(*fills.columns, "net", "prev")


def event_of(prev: Column, net: Column) -> Column:
    return (
        F.when((prev == 0) & (net != 0), F.lit("O"))
        .when((prev != 0) & (net == 0), F.lit("C"))
        .when(F.signum(prev) * F.signum(net) > 0, F.lit("A"))
        .otherwise(F.lit("F"))
    )


def leg_events(fills: DataFrame, order: tuple[str, ...] = ("ts", "ordinal"), busy: bool | None = None, seconds: int = STRETCH) -> DataFrame:
    """``fills`` with ``ev``, ``leg_id`` and ``last_turn``, the symbol's last event before that was no A.  ``busy``: as in :func:`running_position`."""
    busy = is_busy(fills) if busy is None else busy
    marked = running_position(fills, order, busy, seconds).withColumn("ev", event_of(F.col("prev"), F.col("net")))
    begins = F.when(F.col("ev").isin("O", "F"), 1).otherwise(0)
    turns = F.when(F.col("ev") != "A", F.col("ev"))
    if not busy:
        w = Window.partitionBy("symbol").orderBy(*order)
        turn = F.last(turns, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        return marked.withColumn("leg_id", F.sum(begins).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("last_turn", turn)
    # the positions are read twice, so they are written
    cut = written(marked.withColumn("__stretch", stretch_of(F.col(order[0]), seconds)), "netting-positions")
    sums = cut.groupBy("symbol", "__stretch").agg(F.sum(begins).alias("begun"), F.max_by("ev", F.when(turns.isNotNull(), F.struct(*order))).alias("turned"))
    past = _past(sums, __begun=F.sum("begun"), __turned=F.last("turned", ignorenulls=True))
    w = Window.partitionBy("symbol", "__stretch").orderBy(*order)
    met = cut.join(past, ["symbol", "__stretch"])
    leg = F.coalesce("__begun", F.lit(0)) + F.sum(begins).over(w.rowsBetween(Window.unboundedPreceding, 0))
    turn = F.coalesce(F.last(turns, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), "__turned")
    return met.withColumn("leg_id", leg).withColumn("last_turn", turn).select(*marked.columns, "leg_id", "last_turn")


def _roles(events: DataFrame) -> DataFrame:
    """A row per part that a fill plays: (role, leg)."""
    role = lambda name, leg: F.struct(F.lit(name).alias("role"), leg.cast("long").alias("leg"))
    ev, leg = F.col("ev"), F.col("leg_id")
    closes = F.col("last_turn").isin("O", "F")
    parts = (
        F.when(ev.isin("O", "A"), F.array(role("open", leg)))
        .when(ev == "C", F.array(role("close", leg)))
        .when((ev == "F") & F.coalesce(closes, F.lit(False)), F.array(role("open", leg), role("close", leg - 1)))
        .otherwise(F.array(role("open", leg)))
    )
    return events.select("*", F.inline(parts))


def legs(fills: DataFrame, order: tuple[str, ...] = ("ts", "ordinal"), with_fills: bool = False, busy: bool | None = None) -> DataFrame:
    """Unrounded measures of every closed leg; legs still open at the end give no row.  ``busy``: as in :func:`running_position`."""
    first = F.struct(*order)
    opens, closes = F.col("role") == "open", F.col("role") == "close"
    aggs = [
        F.min_by(F.when(opens, F.col("side")), F.when(opens, first)).alias("open_side"),
        F.sum(F.when(opens, F.col("qty"))).alias("qty"),
        F.sum(F.when(opens, F.col("price") * F.col("qty"))).alias("value"),
        F.sum(F.when(opens, F.col("fee"))).alias("open_fee"),
        F.max(F.when(closes, F.col("fee"))).alias("close_fee"),
        F.max(F.when(closes, F.col("qty"))).alias("close_qty"),
        F.max(F.when(closes, F.col("price"))).alias("close_price"),
        F.min(F.when(opens, F.struct("ts", *order[1:], "ts_raw"))).alias("entered"),
        F.max(F.when(closes, F.struct("ts", *order[1:], "ts_raw"))).alias("left"),
        F.count_if(closes).alias("closers"),
    ]
    if with_fills:
        fill = F.struct(*order, *[c for c in fills.columns if c not in order])
        aggs += [F.array_sort(F.collect_list(F.when(r, fill))).alias(n) for r, n in ((opens, "fills_open"), (closes, "fills_close"))]
    made = _roles(leg_events(fills, order, busy)).groupBy("symbol", "leg").agg(*aggs).where("closers = 1")
    entry = F.when(F.col("qty") == 0, 0.0).otherwise(F.col("value") / F.when(F.col("qty") != 0, F.col("qty")))
    # a single closing fill: its VWAP is price * qty / qty, zero without quantity
    closing = F.when(F.col("close_qty") == 0, 0.0).otherwise(F.col("close_price") * F.col("close_qty") / F.when(F.col("close_qty") != 0, F.col("close_qty")))
    made = made.withColumn("direction", F.when(F.col("open_side") == "buy", F.lit("long")).otherwise(F.lit("short")))
    made = made.withColumn("entry", entry).withColumn("exit", closing).withColumn("fees", F.col("open_fee") + F.col("close_fee"))
    gross = F.when(F.col("direction") == "long", (F.col("exit") - F.col("entry")) * F.col("qty")).otherwise((F.col("entry") - F.col("exit")) * F.col("qty"))
    basis = F.col("entry") * F.col("qty")
    made = made.withColumn("pnl", gross - F.col("fees"))
    made = made.withColumn("pct", F.when(basis == 0, 0.0).otherwise(F.col("pnl") / F.when(basis != 0, basis) * 100.0))
    return made.withColumn("hours", (micros(F.col("left.ts")) - micros(F.col("entered.ts"))) / 3.6e9)


def round_trips(fills: DataFrame, order: tuple[str, ...] = ("ts", "ordinal"), with_fills: bool = False) -> DataFrame:
    """One row per closed leg, rounded as it is reported; ``closed`` orders the legs of a symbol."""
    return legs(fills, order, with_fills).select(
        "symbol",
        "direction",
        iso_text(F.col("entered.ts_raw")).alias("entry_time"),
        iso_text(F.col("left.ts_raw")).alias("exit_time"),
        rounded(F.col("entry"), 6).alias("avg_entry_price"),
        rounded(F.col("exit"), 6).alias("avg_exit_price"),
        rounded(F.col("qty"), 8).alias("total_qty"),
        rounded(F.col("fees"), 6).alias("total_fee"),
        rounded(F.col("pnl"), 4).alias("realized_pnl"),
        rounded(F.col("pct"), 4).alias("realized_pnl_pct"),
        rounded(F.col("hours"), 2).alias("holding_period_hours"),
        F.lit(None).cast("double").alias("r_multiple"),
        verdict(F.col("pct")).alias("verdict"),
        F.lit("trade_history").alias("source"),
        F.col("leg"),
        F.col("left").alias("closed"),
        *(["fills_open", "fills_close"] if with_fills else []),
    )


def first_seen(fills: DataFrame, order: tuple[str, ...] = ("ts", "ordinal")) -> DataFrame:
    """Where each symbol comes first: reports list symbols in that order."""
    return fills.groupBy("symbol").agg(F.min(F.struct(*order)).alias("seen_first"))


def open_positions(fills: DataFrame, order: tuple[str, ...] = ("ts", "ordinal")) -> DataFrame:
    """Positions that are still open at the end, which :func:`round_trips` leaves out."""
    return fills.groupBy("symbol").agg(F.sum(_signed()).cast(POSITION).alias("net")).where("net <> 0")


def average_cost_trips(fills: DataFrame, order: tuple[str, ...] = ("ts", "ordinal")) -> DataFrame:
    """Closed legs by average cost: reductions close at their own price instead of joining the entry.

    Entry is the average over fills that add, exit that over fills that
    reduce; a flip is split at zero.  An alternative to :func:`round_trips`.
    """
    events = leg_events(fills, order)
    toward = F.signum("net") == F.signum(F.when(F.col("side") == "buy", F.lit(1)).otherwise(F.lit(-1)))
    part = lambda role, leg, qty: F.struct(F.lit(role).alias("role"), leg.cast("long").alias("leg"), qty.cast("double").alias("part"))
    leg, qty = F.col("leg_id"), F.col("qty")
    flip = F.array(part("open", leg, F.abs("net")), part("close", leg - 1, F.abs("prev")))
    parts = (
        F.when(F.col("ev") == "O", F.array(part("open", leg, qty)))
        .when(F.col("ev") == "C", F.array(part("close", leg, qty)))
        .when(F.col("ev") == "A", F.when(toward, F.array(part("open", leg, qty))).otherwise(F.array(part("close", leg, qty))))
        .otherwise(F.when(F.col("prev") != 0, flip).otherwise(F.array().cast("array<struct<role:string,leg:bigint,part:double>>")))
    )
    rows = events.select("*", F.inline(parts))
    opens, closes = F.col("role") == "open", F.col("role") == "close"
    share = F.col("fee") * F.col("part") / F.when(qty != 0, qty)
    made = rows.groupBy("symbol", "leg").agg(
        F.min_by(F.when(opens, F.col("side")), F.when(opens, F.struct(*order))).alias("open_side"),
        F.sum(F.when(opens, F.col("part"))).alias("qty"),
        F.sum(F.when(closes, F.col("part"))).alias("closed_qty"),
        F.sum(F.when(opens, F.col("price") * F.col("part"))).alias("value"),
        F.sum(F.when(closes, F.col("price") * F.col("part"))).alias("proceeds"),
        F.sum(share).alias("fees"),
    )
    done = made.where(F.abs(F.col("qty") - F.col("closed_qty")) < 1e-9)
    way = F.when(F.col("open_side") == "buy", 1.0).otherwise(-1.0)
    pnl = way * (F.col("proceeds") - F.col("value")) - F.col("fees")
    return done.select(
        "symbol", "leg",
        F.when(way > 0, F.lit("long")).otherwise(F.lit("short")).alias("direction"),
        (F.col("value") / F.col("qty")).alias("avg_entry_price"),
        (F.col("proceeds") / F.col("qty")).alias("avg_exit_price"),
        F.col("qty").alias("total_qty"),
        pnl.alias("realized_pnl"),
        (pnl / F.col("value") * 100).alias("realized_pnl_pct"),
    )
