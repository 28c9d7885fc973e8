"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every end of ``edges`` (a, b): the smallest node reachable.

    Large-star and small-star rounds hook every neighbour to the smallest node
    known around it until nothing changes; once their number of edges stays,
    nodes jump to the parent of their parent, which halves what chains are
    left.  A round joins edges with one aggregated row per node, so a node
    with very many edges meets no collected list; edges stay in the shared
    folder, never on the driver.  Self-loops are ignored; an empty table gives
    an empty result.
    """

    def stars(now: DataFrame) -> DataFrame:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large, name)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = cut(small.union(least.select("a", F.col("m").alias("b"))).distinct(), name)
        drop_cut(large)
        return after

    def jumps(now: DataFrame) -> DataFrame:
        parents = now.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "of")
        return cut(now.join(parents, F.col("b") == F.col("of"), "left").select("a", F.coalesce("m", "b").alias("b")), name)

    def state(of: DataFrame) -> tuple:
        return tuple(of.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())

    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before, step = state(now), stars
    while before[0]:
        after = step(now)
        drop_cut(now)
        now, had, before = after, before, state(after)
        if had == before:
            if step is stars:
                break
            step = stars
        elif had[0] == before[0]:
            step = jumps
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def hooks(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the matrix ``hit`` of left and right nodes connects.

    At most one edge per row and column, however many hits there are:
    each node that has hits is hooked to the smallest node of its component.
    """
    none = np.iinfo(np.int64).max
    low_r = np.where(hit.any(axis=0), right, none)
    while True:
        low_l = np.where(hit, low_r[None, :], none).min(axis=1, initial=none)
        low_l = np.where(hit.any(axis=1), np.minimum(low_l, left), none)
        after = np.minimum(low_r, np.where(hit, low_l[:, None], none).min(axis=0, initial=none))
        if (after == low_r).all():
            break
        low_r = after
    nodes, lows = np.concatenate([left, right]), np.concatenate([low_l, low_r])
    use = (lows != none) & (lows != nodes)
    return lows[use], nodes[use]
