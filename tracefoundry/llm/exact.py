"""Exact document dedup over an extendible-hash index on shared files.

The index has three parts in the shared folder:

* ``keys``: one row per 64-bit hash key of a normalised text, with its number
  of rows, aggregated before any shuffle, so copies cost one row per task;
* a directory: 2**depth slots over the leading bits of a key.  A bucket that
  holds more than its capacity splits on its next bit; when its local depth
  is the directory's, the directory doubles.  The directory comes from counts
  per leading bits, at most 2**MAX_DEPTH of them, whatever the input's size;
  a bucket that is over capacity at that depth splits on as many further bits
  as its count asks for, in a directory of its own (keys are hashes, so their
  bits halve it);
* entries: the texts of keys with more than one row, dealt to owner tasks by
  bucket, that is by key range.  A key with more than CELL rows is dealt to
  several cells of its bucket, each with a copy of the chain's head.

An owner compares the bytes of each entry with the head of its key's chain;
entries that differ (a collision) are chained: they go through the same step
with the first of them as head, until none is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT, SPACE, cut, drop_cut, narrowed, spread_join, width

MAX_DEPTH = 14
#: Rows of a bucket before it splits, and rows of one key in one cell.
CAPACITY = 512
CELL = 200
#: Copies of a head that one task makes.
FAN = 64


def normalised(text: Column) -> Column:
    """Text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def hash_key(norm: Column) -> Column:
    """The 64-bit key that entries are indexed by."""
    return F.xxhash64(norm)


def directory(counts: dict[int, int], capacity: int, max_depth: int) -> list[tuple[int, int]]:
    """Slots (bucket, local depth) of an extendible-hash directory over ``counts``.

    ``counts`` has the number of rows by the leading ``max_depth`` bits of
    their keys.  A bucket that is over capacity at ``max_depth`` gets a local
    depth beyond it, enough for its parts to be within capacity on average.
    """
    prefix = [0] * (2**max_depth + 1)
    for i in range(2**max_depth):
        prefix[i + 1] = prefix[i] + counts.get(i, 0)

    def load(bits: int, depth: int) -> int:
        shift = max_depth - depth
        return prefix[(bits + 1) << shift] - prefix[bits << shift]

    depth, slots = 0, [(0, 0)]
    work = [(0, 0)]
    while work:
        bits, local = work.pop()
        if (n := load(bits, local)) <= capacity:
            continue
        if local == max_depth:
            more = min((-(-n // capacity) - 1).bit_length(), 62 - max_depth)
            slots[bits << (depth - local)] = (bits, local + more)
            continue
        if local == depth:
            slots = [slot for slot in slots for _ in range(2)]
            depth += 1
        span = 2 ** (depth - local - 1)
        for half in (2 * bits, 2 * bits + 1):
            name = half << (max_depth - local - 1)
            slots[half * span : (half + 1) * span] = [(name, local + 1)] * span
            work.append((half, local + 1))
    return slots


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same bytes once white space is deleted.
    The row with most code points in the original text stays, then that with
    the smallest doc_id.  Null, empty and blank texts are equal to each other.
    Of repeated rows with one doc_id all say the same, and ``group_size``
    counts each.  A null doc_id sorts last.  Other columns are ignored
    whatever their names.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    norm = normalised(F.col("text"))
    entries = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id",
        F.char_length("text").cast("long").alias("points"),
        norm.alias("norm"),
    )
    facts = cut(entries.select("doc_id", "points", hash_key(F.col("norm")).alias("key"), F.sha2("norm", 256).alias("text_sha256")), "op5-facts")
    keys = cut(facts.groupBy("key").agg(F.count("*").alias("rows")), "op5-keys")

    # the directory: at most 2**MAX_DEPTH counts reach the driver
    lead = F.shiftrightunsigned("key", 64 - MAX_DEPTH)
    counted = keys.where("rows > 1").groupBy(lead.alias("lead")).agg(F.sum(F.least("rows", F.lit(CELL))).alias("n")).collect()
    slots = directory({r["lead"]: r["n"] for r in counted}, capacity, MAX_DEPTH)
    depth = len(slots).bit_length() - 1
    slot = F.shiftrightunsigned("key", 64 - depth).cast("int") if depth else F.lit(0)
    table = spark.createDataFrame([(i, local) for i, (_, local) in enumerate(slots)], "slot int, local int")
    plan = keys.where("rows > 1").select("key", "rows", slot.alias("slot"), F.ceil(F.col("rows") / CELL).cast("int").alias("cells"))
    # 2**MAX_DEPTH slots at most, so the broadcast is bounded; a bucket is named by its leading bits with a 1 before them
    name = F.expr("if(local = 0, 1L, shiftrightunsigned(key, 64 - local) | shiftleft(1L, local))")
    plan = cut(plan.join(F.broadcast(table), "slot").select("key", "rows", "cells", name.alias("bucket")), "op5-directory")
    copies = narrowed(entries.withColumn("key", hash_key(F.col("norm"))), plan, ["key"], "op5-copies")
    held = spread_join(copies, plan, ["key"], "rows", copies.count(), "inner")
    # a cell for a row, not for its doc_id, which many rows may share
    cell = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.col("cells")).cast("int")
    open_ = cut(held.select("bucket", "key", "cells", cell.alias("cell"), "doc_id", "points", "norm"), "op5-entries")
    most = plan.agg(F.max("cells")).first()[0] or 0
    drop_cut(plan, copies)

    chained = None
    while not open_.isEmpty():
        # one text for each key and task goes to the shuffle
        first = F.min_by("norm", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "points", F.xxhash64("norm").alias("tie")))
        heads = open_.groupBy("bucket", "key", "cells").agg(first.alias("head"))
        owners = width(spark)
        heads = _fanned(heads, most, owners)
        left = open_.repartition(owners, "bucket", "cell")
        right = heads.repartition(owners, "bucket", "cell")
        met = cut(left.join(right, ["bucket", "cell", "key"]).withColumn("same", F.col("norm") == F.col("head")), "op5-met")
        same = met.where("same").select("key", "doc_id", "points", F.sha2("norm", 256).alias("text_sha256"))
        chained = same if chained is None else chained.union(same)
        rest = met.where("not same").select(open_.columns)
        drop_cut(open_)
        open_ = rest
    return _answers(facts, keys, chained)


def _fanned(heads: DataFrame, most: int, owners: int) -> DataFrame:
    """A row per cell of each head (bucket, key, cells, head); a head with more than FAN cells is copied by several tasks."""
    cells = lambda low, high: F.explode(F.sequence(low, high)).alias("cell")
    few = heads.where(F.col("cells") <= FAN).select("bucket", "key", "head", cells(F.lit(0), F.col("cells") - 1))
    if most <= FAN:
        return few
    fans = heads.where(F.col("cells") > FAN).select("*", F.explode(F.expr(f"sequence(0, (cells - 1) div {FAN})")).alias("fan"))
    fans = fans.withColumn("fan", F.col("fan").cast("int")).repartition(owners, "key", "fan")
    return few.union(fans.select("bucket", "key", "head", cells(F.col("fan") * FAN, F.least("cells", (F.col("fan") + 1) * FAN) - 1)))


def _answers(facts: DataFrame, keys: DataFrame, chained: DataFrame | None) -> DataFrame:
    order = F.struct(F.negative("points").alias("p"), F.col("doc_id").isNull().alias("none"), "doc_id")
    # rows of very common keys, which are few, end before the shuffle
    common = keys.where((F.col("rows") > 1) & (F.col("rows") * (HOT * width(facts.sparkSession)) > facts.count())).select("key")
    rare = facts.join(F.broadcast(common), "key", "left_anti")
    alone = rare.join(keys.where("rows = 1").select("key"), "key", "left_semi").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    if chained is None:
        return alone
    groups = chained.groupBy("key", "text_sha256").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    groups = cut(groups.select("key", "text_sha256", F.col("best.doc_id").alias("keep_id"), "group_size"), "op5-groups")
    copies = spread_join(chained, groups, ["key", "text_sha256"], "group_size", chained.count(), "inner").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return alone.union(copies)


ORACLE = r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM norm
)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
"""
