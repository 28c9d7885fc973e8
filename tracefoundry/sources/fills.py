"""Fills from CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import parse_float, parse_iso, strip
from ..schemas import FILL_COLUMNS, REQUIRED_FILL_COLUMNS


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_fills(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(fills, rejects) of CSV files with a header.

    A missing required column fails the whole read.  A row whose timestamp,
    number or side cannot be read goes to ``rejects`` with its reason and
    harms no other row.  ``ordinal`` keeps the file order of fills with equal
    times, also across file splits.
    """
    names = _header(spark, path)
    if not names:
        raise ValueError("the CSV is empty or has no header row")
    missing = sorted(set(REQUIRED_FILL_COLUMNS) - set(names))
    if missing:
        raise ValueError(f"the CSV lacks required columns: {missing}")
    raw = spark.read.schema(", ".join(f"`{c}` string" for c in names)).option("header", True).option("multiLine", False).csv(path)
    ordinal = F.struct(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    cell = {c: F.col(c) if c in names else F.lit(None).cast("string") for c in FILL_COLUMNS}
    pnl = parse_float(cell["pnl"]) if "pnl" in names else F.lit(0.0)
    kind = strip(F.lower(cell["order_type"])) if "order_type" in names else F.lit("market")
    parsed = raw.select(
        parse_iso(cell["timestamp"]).alias("ts"),
        strip(cell["timestamp"]).alias("ts_raw"),
        F.upper(strip(cell["symbol"])).alias("symbol"),
        F.lower(strip(cell["side"])).alias("side"),
        *[parse_float(cell[c]).alias(c) for c in ("price", "qty", "fee")],
        pnl.alias("pnl_from_exchange"),
        kind.alias("order_type"),
        ordinal.alias("ordinal"),
        F.struct(*[c.alias(n) for n, c in cell.items()]).alias("raw"),
    )
    reason = F.coalesce(
        F.when(F.col("ts").isNull(), F.lit("timestamp")),
        F.when(F.col("symbol").isNull(), F.lit("symbol")),
        *[F.when(F.col(c).isNull(), F.lit(c)) for c in ("price", "qty", "fee", "pnl_from_exchange")],
        F.when(~F.coalesce(F.col("side").isin("buy", "sell"), F.lit(False)), F.lit("side")),
        F.when(F.col("order_type").isNull(), F.lit("order_type")),
    )
    judged = parsed.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason", "raw"), judged.where("reason is not null").select("raw", "reason")
