"""Threads of a reply forest: roots, depth and reading order, in a number of rounds that grows with the logarithm.

A message points at the one that it answers.  Pointers jump to the pointer of
their pointer, so each round doubles the way, and a message is done once it
points at a root; hubs are met through a join that deals very common targets
evenly.  A pointer to a message that is not there makes a root, and so does
the least id of a ring of messages that answer each other.

The order in a thread is that of reading it: a message, then its answers in
order, each with its own answers before the next.  Every message is entered
and left once in that walk, which is a list; jumping along the list counts
what comes after each message.  No join of the list has a common key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import remove, spread_join, written


def _jump(nodes: DataFrame, name: str) -> DataFrame:
    """(id, root, depth, looped) from (id, parent), parent null at roots; rings are opened at their least id."""
    state = written(nodes.select("id", F.coalesce("parent", "id").alias("ptr"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.least("id", F.coalesce("parent", "id")).alias("low"), F.col("parent").isNull().alias("done")), f"{name}-jumps")
    step, had = 1, -1
    while left := state.where("not done").count():
        # a round brings the next messages of any way to a root to it, so without progress only ways into rings are left
        if left == had and step >= left:
            # step steps on is in the ring, which is met there whole
            rings = state.where("not done").select(F.col("ptr").alias("id")).distinct()
            opened = written(state.where("not done").join(rings, "id", "left_semi").where("low = id").select("id"), f"{name}-rings")
            again = nodes.join(opened.withColumn("open", F.lit(True)), "id", "left").select("id", F.when(F.col("open").isNull(), F.col("parent")).alias("parent"))
            found = _jump(again, name)
            return found.join(opened.withColumn("open", F.lit(True)), "id", "left").select("id", "root", "depth", F.col("open").isNotNull().alias("looped"))
        target = state.select(F.col("id").alias("ptr"), F.struct("ptr", "depth", "low", "done").alias("next"))
        met = spread_join(state.where("not done"), target, "ptr")
        met = met.select("id", F.col("next.ptr").alias("ptr"), (F.col("depth") + F.col("next.depth")).alias("depth"), F.least("low", "next.low").alias("low"), F.col("next.done").alias("done"))
        after = written(state.where("done").unionByName(met), f"{name}-jumps")
        remove(state)
        state, step, had = after, 2 * step, left
    return state.select("id", F.col("ptr").alias("root"), "depth", F.lit(False).alias("looped"))


def _following(rows: DataFrame, group: str, order: list[str], bucket: Column) -> DataFrame:
    """``rows`` with ``after``, the id of the group's next row, and ``first``, whether none is before.

    A group is cut into buckets that ascend with its order; the windows are
    over buckets, and over a group's buckets with a row for each.
    """
    cut = rows.withColumn("__bucket", bucket)
    own = Window.partitionBy(group, "__bucket").orderBy(*order)
    inside = cut.withColumn("__next", F.lead("id").over(own)).withColumn("__place", F.row_number().over(own))
    heads = cut.groupBy(group, "__bucket").agg(F.min_by("id", F.struct(*order)).alias("__head"))
    along = Window.partitionBy(group).orderBy("__bucket")
    heads = heads.select(group, "__bucket", F.lead("__head").over(along).alias("__later"), (F.row_number().over(along) == 1).alias("__begin"))
    met = inside.join(heads, [group, "__bucket"])
    return met.select(*rows.columns, F.coalesce("__next", "__later").alias("after"), (F.col("__begin") & (F.col("__place") == 1)).alias("first"))


def _places(nodes: DataFrame) -> DataFrame:
    """(id, root, place): how many messages of its thread come before one, from (id, parent, root, at, bucket)."""
    answers = _following(nodes.where("parent is not null"), "parent", ["at", "id"], F.col("bucket"))
    answers = written(answers.select("id", "parent", "after", "first"), "replies-siblings")
    child = answers.where("first").select(F.col("parent").alias("id"), F.col("id").alias("child"))
    linked = nodes.select("id", "root", "parent").join(child, "id", "left").join(answers.select("id", "after"), "id", "left")
    # entering leads to the first answer or to leaving; leaving to the next answer of the same message or to leaving that
    enter = F.struct(F.col("id").alias("id"), F.lit(0).alias("side"), F.coalesce("child", "id").alias("to"), F.when(F.col("child").isNull(), 1).otherwise(0).alias("to_side"), F.lit(1).cast("long").alias("n"))
    leave = F.struct(F.col("id").alias("id"), F.lit(1).alias("side"), F.coalesce("after", "parent").alias("to"), F.when(F.col("after").isNull(), 1).otherwise(0).alias("to_side"), F.lit(0).cast("long").alias("n"))
    walk = written(linked.select(F.inline(F.array(enter, leave))), "replies-walk")
    while not walk.where("to is not null").isEmpty():
        ahead = walk.select(F.col("id").alias("to"), F.col("side").alias("to_side"), F.struct("to", "to_side", "n").alias("next"))
        met = walk.where("to is not null").join(ahead, ["to", "to_side"])
        met = met.select("id", "side", F.col("next.to").alias("to"), F.col("next.to_side").alias("to_side"), (F.col("n") + F.col("next.n")).alias("n"))
        after = written(walk.where("to is null").unionByName(met), "replies-walk")
        remove(walk)
        walk = after
    rest = walk.where("side = 0").select("id", "n")
    sizes = rest.withColumnRenamed("id", "root").withColumnRenamed("n", "size")
    named = nodes.select("id", "root").join(rest, "id")
    return spread_join(written(named, "replies-ranks"), sizes, "root").select("id", "root", (F.col("size") - F.col("n")).alias("place"), F.col("size"))


def threads(messages: DataFrame, id: str = "id", reply_to: str = "reply_to", at: str = "ts", seconds: int = 86_400) -> DataFrame:
    """(id, root, depth, place, size, orphan, looped), a row for each message.

    ``root`` is the message that its thread begins with, ``depth`` the answers
    between, ``place`` its place in reading order from 0 and ``size`` the
    messages of the thread.  Answers to one message are read by time, null
    first, then by id.  ``orphan`` answers a message that is not there;
    ``looped`` is the least id of a ring, opened there.  A message that
    answers itself is a root, not looped.  Of messages with one id the first
    by time counts; those without an id are left out.  A busy message's
    answers are ordered in windows of ``seconds``.  An empty table gives an
    empty result.
    """
    rows = messages.select(F.col(id).alias("id"), F.col(reply_to).alias("reply_to"), F.col(at).alias("at")).where("id is not null")
    rows = rows.groupBy("id").agg(F.min(F.struct("at", "reply_to")).alias("m")).select("id", "m.at", F.when(F.col("m.reply_to") != F.col("id"), F.col("m.reply_to")).alias("reply_to"))
    rows = written(rows, "replies-messages")
    there = rows.select(F.col("id").alias("reply_to"), F.lit(True).alias("there"))
    known = spread_join(rows, there, "reply_to", "left")
    answers, missing = F.col("reply_to").isNotNull(), F.col("there").isNull()
    known = written(known.select("id", "at", F.when(~missing, F.col("reply_to")).alias("parent"), (answers & missing).alias("orphan")), "replies-known")
    rooted = written(_jump(known, "replies"), "replies-rooted")
    # rows without a time are read first, in a bucket of their own
    bucket = F.coalesce(F.floor(F.unix_micros(F.col("at").cast("timestamp")) / (seconds * 1_000_000)), F.lit(-(2**63)).cast("long"))
    nodes = known.join(rooted, "id").select("id", F.when(~F.col("looped"), F.col("parent")).alias("parent"), "root", "depth", "at", bucket.alias("bucket"), "orphan", "looped")
    nodes = written(nodes, "replies-nodes")
    placed = _places(nodes)
    return nodes.select("id", "depth", "orphan", "looped").join(placed, "id").select("id", "root", "depth", "place", "size", "orphan", "looped")
