"""One-to-one pairs in time: each trade with at most one journal entry, and the other way round.

Both sides propose to whom they would rather have: the nearest in time, of
equally near ones the earlier.  A round joins those who propose to each other
and takes them away; the others propose again among who is left, until no one
within reach is.  No pair would both rather have each other than what they got.

In the common order of a key's rows a proposal only goes to the next row of
the other side, before or after, so a round is a few windows and never a list
of pairs.  Windows are over stretches of time as wide as the reach; what lies
beyond a stretch is in the one beside it, which tells its first and last row
of each side.  A busy key is as many tasks as it has stretches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import micros, parse_iso
from ..shared import remove, written

_ORDER = ["t", "side", "id"]


def _neighbours(rows: DataFrame) -> DataFrame:
    """``rows`` (key, stretch, t, side, id) with ``before`` and ``after``: t and id of the next rows of the other side."""
    w = Window.partitionBy("key", "stretch").orderBy(*_ORDER)
    place = F.struct("t", "id")
    of = lambda side: F.when(F.col("side") == side, place)
    ahead, behind = w.rowsBetween(1, Window.unboundedFollowing), w.rowsBetween(Window.unboundedPreceding, -1)
    inside = rows
    for side in (0, 1):
        inside = inside.withColumn(f"last{side}", F.last(of(side), ignorenulls=True).over(behind)).withColumn(f"first{side}", F.first(of(side), ignorenulls=True).over(ahead))
    ends = rows.groupBy("key", "stretch").agg(*(f(of(side)).alias(f"{n}{side}") for side in (0, 1) for f, n in ((F.min, "min"), (F.max, "max"))))
    past = ends.select("key", (F.col("stretch") + 1).alias("stretch"), F.col("max0").alias("past0"), F.col("max1").alias("past1"))
    next_ = ends.select("key", (F.col("stretch") - 1).alias("stretch"), F.col("min0").alias("next0"), F.col("min1").alias("next1"))
    met = inside.join(past, ["key", "stretch"], "left").join(next_, ["key", "stretch"], "left")
    other = lambda own, far: F.when(F.col("side") == 0, F.coalesce(f"{own}1", f"{far}1")).otherwise(F.coalesce(f"{own}0", f"{far}0"))
    return met.select(*rows.columns, other("last", "past").alias("before"), other("first", "next").alias("after"))


def pair_one_to_one(left: DataFrame, right: DataFrame, key: str, seconds: int, left_id: str, right_id: str, left_ts: str = "ts", right_ts: str = "ts") -> DataFrame:
    """(key, left_id, right_id, apart): pairs at most ``seconds`` apart, ``apart`` in microseconds; each id at most once.

    Ids have to be unique on their side and of one type.  Rows with a null
    key, id or time are in no pair.  The number of rounds is that of the
    longest run of rows, each nearer to the next than to the one before.
    """
    reach = seconds * 1_000_000

    def side(rows: DataFrame, n: int, id: str, ts: str) -> DataFrame:
        t = micros(F.col(ts))
        return rows.select(F.col(key).alias("key"), F.floor(t / (reach + 1)).alias("stretch"), t.alias("t"), F.lit(n).alias("side"), F.col(id).alias("id")).where("key is not null and t is not null and id is not null")

    rows = written(side(left, 0, left_id, left_ts).unionByName(side(right, 1, right_id, right_ts)), "pairing-rows")
    done = None
    while True:
        told = _neighbours(rows)
        back, forth = F.col("t") - F.col("before.t"), F.col("after.t") - F.col("t")
        near = F.when(back <= F.coalesce(forth, back), F.col("before")).otherwise(F.coalesce("after", "before"))
        apart = F.abs(F.col("t") - near["t"])
        told = told.select(*rows.columns, F.when(apart <= reach, near["id"]).alias("to"), apart.alias("apart"))
        # whoever has no one in reach now never will
        told = written(told.where("to is not null"), "pairing-told")
        remove(rows)
        mine = told.where("side = 0").select("key", F.col("id").alias("l"), F.col("to").alias("r"), "apart")
        theirs = told.where("side = 1").select("key", F.col("to").alias("l"), F.col("id").alias("r"))
        pairs = written(mine.join(theirs, ["key", "l", "r"]), "pairing-pairs")
        if pairs.isEmpty():
            break
        done = pairs if done is None else done.unionByName(pairs)
        gone = pairs.select("key", F.inline(F.array(F.struct(F.lit(0).alias("side"), F.col("l").alias("id")), F.struct(F.lit(1).alias("side"), F.col("r").alias("id")))))
        rows = written(told.select("key", "stretch", "t", "side", "id").join(gone, ["key", "side", "id"], "left_anti").select("key", "stretch", "t", "side", "id"), "pairing-rows")
        remove(told)
    out = pairs if done is None else done
    return out.select(F.col("key").alias(key), F.col("l").alias(left_id), F.col("r").alias(right_id) if right_id != left_id else F.col("r").alias(f"right_{right_id}"), "apart")


def complete_records(trades: DataFrame, entries: DataFrame, seconds: int) -> DataFrame:
    """Raw records of trades (without text) with the text of the journal or chat entry that each is paired with.

    Both are raw records; a pair has one instrument and times at most
    ``seconds`` apart, and no entry serves two trades.  Trades without an
    entry, and entries without a trade, are left out.  The entry's id and
    source go to the metadata.
    """
    timed = lambda rows: rows.where("instrument is not null").withColumn("ts", parse_iso(F.col("timestamp_context")))
    pairs = pair_one_to_one(timed(trades), timed(entries), "instrument", seconds, "id", "id").select("id", F.col("right_id").alias("entry_id"), "apart")
    told = entries.select(F.col("id").alias("entry_id"), F.col("raw_text").alias("__text"), F.col("source").alias("__source"), F.col("decision_raw").alias("__decision"))
    met = trades.join(pairs, "id").join(told, "entry_id")
    facts = F.map_concat(F.coalesce("metadata", F.create_map().cast("map<string,string>")), _facts())
    return met.select("id", "source", "instrument", "timestamp_context", F.col("__text").alias("raw_text"), F.coalesce("decision_raw", "__decision").alias("decision_raw"), facts.alias("metadata"))


def _facts() -> Column:
    seconds = (F.col("apart") / 1_000_000).cast("string")
    return F.create_map(F.lit("entry_id"), F.col("entry_id"), F.lit("entry_source"), F.col("__source"), F.lit("entry_seconds_apart"), seconds)
