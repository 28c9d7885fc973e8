"""Netting and dedup over streams of fills.

Batch netting sorts all fills first, so a stream gives the same legs only if
fills of a symbol arrive in order, or late by no more than the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

LEG = "symbol string, direction string, avg_entry_price double, avg_exit_price double, total_qty double, total_fee double, entered timestamp, left timestamp"
STATE = "net decimal(38,10), qty double, value double, fee double, side string, entered timestamp"


class LegKeeper(StatefulProcessor):
    """State of one symbol: its position and the sums of the leg under way."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("leg", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        from decimal import Decimal

        held = self.state.get() if self.state.exists() else None
        net, qty, value, fee, side, entered = held or (Decimal(0), 0.0, 0.0, 0.0, None, None)
        done = []
        fills = pd.concat(list(rows)).sort_values(["ts", "fill_id"], kind="stable")
        for f in fills.itertuples():
            signed = Decimal(repr(f.qty)) * (1 if f.side == "buy" else -1)
            after = (net + signed).quantize(Decimal("1e-10"))
            stays = net * after > 0
            if net != 0 and not stays or (net == 0 and after == 0 and side):
                entry = value / qty if qty else 0.0
                done.append((key[0], "long" if side == "buy" else "short", entry, f.price if f.qty else 0.0, qty, fee + f.fee, entered, f.ts))
            if stays:
                qty, value, fee = qty + f.qty, value + f.price * f.qty, fee + f.fee
            elif net != 0 and after == 0:
                qty, value, fee, side, entered = 0.0, 0.0, 0.0, None, None
            else:
                qty, value, fee, side, entered = f.qty, f.price * f.qty, f.fee, f.side, f.ts
            net = after
        self.state.update((net, qty, value, fee, side, entered))
        yield pd.DataFrame(done, columns=["symbol", "direction", "avg_entry_price", "avg_exit_price", "total_qty", "total_fee", "entered", "left"])

    def close(self) -> None:
        pass


def stream_legs(fills: DataFrame) -> DataFrame:
    """Closed legs of a stream (symbol, ts, fill_id, side, price, qty, fee), in append mode."""
    return fills.groupBy("symbol").transformWithStateInPandas(LegKeeper(), outputStructType=LEG, outputMode="Append", timeMode="None")


def stream_dedup(examples: DataFrame, time: str, delay: str, keys: list[str]) -> DataFrame:
    """First arrival of each key within the watermark."""
    return examples.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def stream_volume(fills: DataFrame, window: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Volume and VWAP per symbol in tumbling or sliding windows, with a watermark for late fills."""
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    sums = fills.withWatermark("ts", delay).groupBy(span.alias("w"), "symbol").agg(F.sum("qty").alias("volume"), F.sum(F.col("price") * F.col("qty")).alias("value"))
    return sums.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "symbol", "volume", (F.col("value") / F.col("volume")).alias("vwap"))
