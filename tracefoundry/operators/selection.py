"""Dedup, filters and splits of examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import parse_iso_or_2020

#: Validation rows up to which a top-k is planned; beyond, ranks come from a distributed sort.
TOP_K = 100_000


def dedup_parts(instrument: Column, timestamp: Column, direction: Column, source: Column) -> list[Column]:
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return [F.upper(text(instrument)), F.substring(text(timestamp), 1, 10), text(direction), text(source)]


def dedup_key(instrument: Column, timestamp: Column, direction: Column, source: Column) -> Column:
    """MD5 of instrument, the day as written, direction and source."""
    return F.md5(F.array_join(F.array(*dedup_parts(instrument, timestamp, direction, source)), "|"))


def first_wins(rows: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key; plans a partial and a final group limit, so hot keys shrink before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def deduplicate(examples: DataFrame, granularity: str = "day") -> DataFrame:
    """First example per instrument, day, direction and source; ``granularity="time"`` takes the whole timestamp."""
    parts = dedup_parts(F.col("instrument"), F.col("timestamp_context"), F.col("decision.direction"), F.col("source"))
    if granularity == "time":
        parts[1] = F.coalesce("timestamp_context", F.lit(""))
    elif granularity != "day":
        raise ValueError("granularity has to be 'day' or 'time'")
    return first_wins(examples, parts, [F.col("ord")])


def quality_ok(min_quality: float) -> Column:
    return F.col("quality_score") >= min_quality


def outcome_ok(keep_losers: bool, min_r: float | None) -> Column:
    """Null-safe: rows without an outcome or R multiple pass."""
    loser = F.coalesce(F.col("outcome.verdict") == "LOSS", F.lit(False))
    ok = F.lit(True) if keep_losers else ~loser
    return ok if min_r is None else ok & (F.col("r_multiple").isNull() | (F.col("r_multiple") >= min_r))


def validation_size(n: int, fraction: float) -> int:
    return max(1, int(n * fraction)) if n else 0


def ordinal_of(rows: DataFrame, order: list[Column], name: str = "at") -> DataFrame:
    """``rows`` with their place from 0 in ``order``, by a range exchange and counts per partition.

    No task holds more than its range, unlike a window without partitions.
    Rows and counts are two runs of one sort, so ``order`` has to be total.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    local = dealt.withColumn("__part", F.spark_partition_id())
    inside = Window.partitionBy("__part").orderBy(*order)
    ranked = local.withColumn("__in", F.row_number().over(inside) - 1).persist()
    counts = ranked.groupBy("__part").agg(F.count("*").alias("__n"))
    # one row per partition
    ahead = counts.withColumn("__ahead", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranked.join(ahead.select("__part", "__ahead"), "__part").withColumn(name, F.col("__in") + F.col("__ahead")).drop("__part", "__in", "__ahead")


def time_split(rows: DataFrame, time: Column, tie: Column, fraction: float = 0.15, top_k: int = TOP_K) -> DataFrame:
    """``rows`` with ``split``: the latest ``max(1, int(n * fraction))`` are val, the others train.

    Of rows that agree in time and tie at the border, as many are val as the size asks for.
    """
    n = rows.count()
    n_val = validation_size(n, fraction)
    if n_val >= n:
        return rows.withColumn("split", F.lit("val"))
    keyed = rows.withColumn("__t", time).withColumn("__o", tie)
    if n_val <= top_k:
        latest = keyed.select(F.struct("__t", "__o").alias("key")).orderBy(F.desc("key")).limit(n_val)
        border = latest.agg(F.min("key").alias("__border")).withColumn("__one", F.lit(1))
        wanted = latest.groupBy("key").agg(F.count("*").alias("__wanted")).withColumnRenamed("key", "__border").join(border, "__border")
        # one row: the border and how many rows on it are val
        met = keyed.withColumn("__one", F.lit(1)).join(F.broadcast(wanted), "__one")
        key = F.struct("__t", "__o")
        clear = met.where(key != F.col("__border")).withColumn("__split", F.when(key > F.col("__border"), F.lit("val")).otherwise(F.lit("train")))
        at = F.row_number().over(Window.partitionBy("__t", "__o").orderBy("__one"))
        edge = met.where(key == F.col("__border")).withColumn("__at", at).withColumn("__split", F.when(F.col("__at") <= F.col("__wanted"), F.lit("val")).otherwise(F.lit("train"))).drop("__at")
        return clear.union(edge).select(*rows.columns, F.col("__split").alias("split"))
    ranked = ordinal_of(keyed, [F.col("__t"), F.col("__o")], "__at")
    return ranked.withColumn("split", F.when(F.col("__at") >= n - n_val, F.lit("val")).otherwise(F.lit("train"))).drop("__t", "__o", "__at")


def assign_splits(examples: DataFrame, val_fraction: float = 0.15) -> DataFrame:
    return time_split(examples.drop("split"), parse_iso_or_2020(F.col("timestamp_context")), F.col("ord"), val_fraction)


def cutoff_split(time: Column, train_cutoff: str, val_cutoff: str) -> Column:
    """train before the first date, val before the second, test after; null without a time."""
    stamp = lambda s: F.lit(s).cast("timestamp")
    return F.when(time < stamp(train_cutoff), F.lit("train")).when(time < stamp(val_cutoff), F.lit("val")).when(time.isNotNull(), F.lit("test"))


def rejection(min_quality: float = 0.5, include_losses: bool = True, max_tokens: int = 4096) -> Column:
    """First reason against an example, null if none: score, fields, direction, loss, length."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in ("instrument", "timestamp_context", "reasoning", "decision")]
    text = F.concat_ws(" ", "context", "reasoning", F.to_json("decision"))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != F.lit("")))
    return F.coalesce(
        F.when(F.coalesce(F.col("quality_score") < min_quality, F.lit(True)), F.lit("quality below minimum")),
        *missing,
        F.when(F.col("decision.direction").isNull(), F.lit("no direction")),
        *([] if include_losses else [F.when(F.col("outcome.verdict") == "LOSS", F.lit("loss excluded"))]),
        F.when(words > max_tokens, F.lit("too long")),
    )


def sampled(id_: Column, percent: int) -> Column:
    """A fixed ``percent`` of ids, the same in every run."""
    return F.pmod(F.xxhash64(id_), F.lit(100)) < percent


def review_reason(source: Column, score: Column, judge: Column, drawn: Column, always=("own_journal",)) -> Column:
    """Why a person should look at a record; null if nothing asks for it."""
    return F.coalesce(
        F.when(source.isin(*always), F.lit("always-review source")),
        F.when((score >= 0.4) & (score <= 0.7), F.lit("borderline score")),
        F.when(judge.isNull(), F.lit("no judge score")),
        F.when(drawn, F.lit("random sample")),
    )


def outcome_policy() -> Column:
    """What becomes of an example by its outcome: keep, drop, or wait for an idea that expired."""
    v, deep = F.col("outcome.verdict"), F.size(F.split("reasoning", r"\s+")) >= 50
    return (
        F.when(v == "EXPIRED", F.lit("wait"))
        .when((v == "LOSS") & ~deep, F.lit("drop"))
        .when((v == "SCRATCH") & ~(deep & sampled(F.col("id"), 50)), F.lit("drop"))
        .otherwise(F.lit("keep"))
    )


def preference_pairs(examples: DataFrame, day: Column | None = None) -> DataFrame:
    """(instrument, day, chosen, rejected): the best example of an instrument and day against each worse one."""
    on = F.substring("timestamp_context", 1, 10) if day is None else day
    rows = examples.select("instrument", on.alias("day"), "id", "quality_score")
    best = rows.groupBy("instrument", "day").agg(F.max_by("id", F.struct("quality_score", "id")).alias("chosen"), F.max("quality_score").alias("top"))
    return rows.join(best, ["instrument", "day"]).where("quality_score < top").select("instrument", "day", "chosen", F.col("id").alias("rejected"))
