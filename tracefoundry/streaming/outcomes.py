"""Outcomes of records as a stream: the verdict of the nearest trade, EXPIRED once no trade can come any more.

The plan of the batch labels over two streams: a left outer join on instrument
and stretch of time, bounded in event time, then the nearest per record.  The
watermark is the timer: a record waits until it has passed the record's time
by the window, then leaves the state with what was found.  A busy instrument's
state is dealt by stretch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import micros
from ..functions.trading import verdict

RESULT = ["id", "instrument", "ts", "match", "realized_pnl_pct", "verdict"]


def stream_outcomes(records: DataFrame, trades: DataFrame, seconds: int, delay: str = "10 minutes", win: float = 1.0, loss: float = -1.0) -> DataFrame:
    """(id, instrument, ts, match, realized_pnl_pct, verdict) of records (id, instrument, ts) and trades (instrument, ts, realized_pnl_pct, ...), both streams.

    Rows later than ``delay`` behind the stream's latest time are late: such a
    trade labels no record that has been decided, and such a record is left
    out.  Ties in time go to the earlier trade.  A record without a time is
    EXPIRED at once; one without an instrument when its window ends.
    """
    width = seconds * 1_000_000
    stretch = lambda c: F.floor(micros(F.col(c)) / width).cast("long")
    left = records.select("id", "instrument", F.col("ts").cast("timestamp").alias("ts")).where("ts is not null").withWatermark("ts", delay).withColumn("b", stretch("ts"))
    right = trades.select(F.col("instrument").alias("of"), F.col("ts").cast("timestamp").alias("at"), F.struct(*trades.columns).alias("match")).where("at is not null").withWatermark("at", delay)
    right = right.withColumn("of_b", F.explode(F.array(*(stretch("at") + i for i in (-1, 0, 1)))))
    span = F.expr(f"interval {seconds} seconds")
    near = (F.col("instrument") == F.col("of")) & (F.col("b") == F.col("of_b")) & (F.col("at") >= F.col("ts") - span) & (F.col("at") <= F.col("ts") + span)
    met = left.join(right, near, "leftOuter")
    met = met.select("id", "instrument", "ts", "match", F.struct(F.abs(micros(F.col("ts")) - micros(F.col("at"))), micros(F.col("at"))).alias("apart"))
    best = met.groupBy("id", "instrument", "ts").agg(F.min_by("match", "apart").alias("match"))
    untimed = records.where("ts is null").select("id", "instrument", F.col("ts").cast("timestamp").alias("ts"), F.lit(None).cast(met.schema["match"].dataType).alias("match"))
    pct = F.col("match.realized_pnl_pct")
    told = best.unionByName(untimed).withColumn("realized_pnl_pct", pct)
    return told.withColumn("verdict", F.when(pct.isNull(), F.lit("EXPIRED")).otherwise(verdict(pct, win, loss))).select(*RESULT)


def run_available(rows: DataFrame, output: str, checkpoint: str) -> None:
    """Write what is there of a stream to Parquet, and end; the next run goes on from ``checkpoint``."""
    rows.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
