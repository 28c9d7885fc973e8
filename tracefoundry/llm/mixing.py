"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets the key -ln(u) / quality, an exponential variable whose
rate is its quality weight; ordered by key, the documents of a source are a
weighted sample without replacement of any length.  A source whose target is
more than its size is first taken whole (complete epochs); the rest of its
target is the prefix of that order whose running sum of words meets it.

The running sum goes in two levels, so a source with a third of all rows is
no single task: rows are range-partitioned by source and key, sums of a
partition are added up first, and only rows of one partition are sorted
together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut, unit, width

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2

def word_count(text: Column) -> Column:
    """Runs of bytes other than space and 0x09-0x0D; 0 for null."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}+|{SPACE}+$", "")
    return F.when(t == "", 0).otherwise(F.size(F.split(t, f"{SPACE}+"))).cast("long")


def letter_share(text: Column) -> Column:
    """Quality weight in [0.25, 1]: share of letters and white space among a text's characters."""
    kept = F.char_length(F.regexp_replace(text, r"[!-/:-@\[-`{-~0-9]", ""))
    share = kept / F.greatest(F.char_length(text), F.lit(1))
    return F.greatest(F.coalesce(share, F.lit(1.0)), F.lit(0.25))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size, ...) with the column ``target``.

    Sources by code point, null last, weigh ``weights``, repeating.  They
    share ``share`` times all words by weight, but none gets more than
    ``most`` times its size; what is too much is shared again by weight.
    In order of size / weight that is one running sum: the sources before
    some place stop at their most, those after it get the same per weight.
    One row per source goes through these windows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("at", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", most * F.col("source_size").cast("double"))
    everything = Window.partitionBy()
    tight = Window.orderBy(F.col("most") / F.col("w"), "at")
    before, after = tight.rowsBetween(Window.unboundedPreceding, -1), tight.rowsBetween(0, Window.unboundedFollowing)
    total = share * F.sum("source_size").over(everything)
    ranked = ranked.withColumn("level", (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(after))
    level = F.min(F.when(F.col("level") <= F.col("most") / F.col("w"), F.struct(F.col("most") / F.col("w"), "at", "level"))).over(everything)
    ranked = ranked.withColumn("level", level["level"])
    return ranked.withColumn("target", F.least("most", F.coalesce(F.col("level") * F.col("w"), F.col("most")))).drop("at", "w", "most", "level")


def mix(docs: DataFrame, quality: Column | None = None, weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source, ...): doc_id, the ``carry`` columns, size, source_size, target, taken.

    ``carry`` is nothing by default; the pipeline names its id of a row.
    ``quality`` is a column of positive sampling weights, by default
    :func:`letter_share`.  A document counts ``taken / size`` times in the
    mix.  The document on which the last epoch's running sum passes the
    target is taken if at least half of it fits.  Null and empty texts have
    size 0 and are never taken; a null source is a source.  Repeated rows
    are documents of their own with the same key, ordered among themselves
    by nothing that shows: they have equal size, and those that are taken
    come first in an order by position.  Keys depend on doc_id and text and
    nothing else, so reruns agree.  Other columns are ignored whatever their names.
    An empty table gives an empty result.
    """
    rate = letter_share(F.col("text")) if quality is None else quality
    carry = carry or []
    sized = docs.select("doc_id", *carry, "source", word_count(F.col("text")).alias("size"), (-F.log(unit(F.xxhash64("doc_id", "text"))) / rate).alias("key"))
    sized = cut(sized, "op4-sized")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes, weights, share, most)
    goals = goals.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goals = goals.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    goals = cut(goals.withColumnRenamed("source", "of"), "op4-goals")

    same = F.col("source").eqNullSafe(F.col("of"))
    # sampled bounds make the partitions even whatever the quality weights are
    # rows repeated whole are told apart by their place in the table: they are interchangeable, so reruns still agree
    ranged = sized.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(width(docs.sparkSession), "source", "key", "doc_id", "size", "place")
    ranged = cut(ranged.withColumn("bin", F.spark_partition_id()), "op4-ranged")
    binned = ranged.join(goals, same).drop("of")
    sums = ranged.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("of"), F.col("bin").alias("at"), F.coalesce(F.sum("words").over(run), F.lit(0)).alias("before"))
    placed = binned.join(sums, same & (F.col("bin") == F.col("at"))).drop("of", "at")
    inside = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size", "place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    more = (start + F.col("size") / 2 <= F.col("rest")).cast("long")
    return placed.select("doc_id", *carry, "size", "source_size", "target", (F.col("size") * (F.col("epochs") + more)).cast("long").alias("taken"))
