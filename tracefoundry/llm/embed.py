"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one vector kept per group.

Equal vectors of a label collapse first, with their number.  Centroids are
fitted on a bounded sample; every vector has the cell of its nearest centroid
as home and visits each other cell that can hold a vector at the threshold.
No link is lost: if y is at most an angle f from x and nearer to centroid b
than to x's own a, then x is at most sin f beyond the plane between a and b.
Of two cells only one visits the other, so a pair meets once.  Clustered
vectors visit few cells; for vectors without clusters the bound excludes
little, and the work nears that of all pairs of a label.  A label has as many
cells as its size asks for, two at least: the first ones of the common list of
centroids.

Cells hold vectors of one label and dimension only.  Cells are cut into
blocks of BLOCK rows; a task multiplies one block of residents by one block
of residents or visitors, in double precision, and returns only numbers of
links and the edges of a spanning forest: at most one row per row it read,
never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import cut, ship, spread_join, unit, width
from .components import connected_components, hooks

#: Vectors that centroids are fitted on, at most about this many.
SAMPLE = 16_384
#: Vectors of a label per centroid aimed at, and vectors of the sample that a centroid needs.
PER_CELL = 2_000
FITTED = 4
BLOCK = 2_048
ROUNDS = 8


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k unit centroids of the rows of ``x``, started from evenly spaced rows."""
    x = scaled(x)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = x[np.linspace(0, len(x) - 1, k).astype(np.int64)].copy()
    for _ in range(rounds):
        home = np.argmax(x @ centre.T, axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, home, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(size > 0, sums / np.where(size > 0, size, 1), centre)
    return centre


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so their squares neither overflow nor vanish; cosines stay as they are, to the bit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def visits_of(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home of each unit row of ``x``, and the matrix of cells it visits.

    For two rows at ``threshold`` with different homes, exactly one visits the other's.
    """
    near = x @ centres.T
    home = np.argmax(near, axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (centres[home] @ centres.T), 0))
    reach = np.sqrt(max(1 - threshold**2, 0)) if threshold > 0 else 1.0
    # the slack covers rounding
    may = near.max(axis=1)[:, None] - near <= reach * apart + 1e-6
    cell = np.arange(len(centres))
    own = home[:, None]
    return home, may & (cell != own) & ((own < cell) ^ ((own + cell) % 2 == 1))


def _assign(centres: np.ndarray, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            fits = np.diff(column.offsets.to_numpy()) == centres.shape[1]
            x = scaled(column.filter(pa.array(fits)).flatten().to_numpy().reshape(-1, centres.shape[1]))
            with np.errstate(all="ignore"):
                x = np.nan_to_num(x / np.sqrt((x * x).sum(axis=1, keepdims=True)))
            cells = np.minimum(batch.column("cells").to_numpy()[fits], len(centres))
            homes, near = np.full(len(fits), -1, np.int32), [np.zeros(0, np.int32)] * len(fits)
            rows = np.flatnonzero(fits)
            for k in np.unique(cells):
                own = np.flatnonzero(cells == k)
                for at in range(0, len(own), 500):
                    some = own[at : at + 500]
                    home, visits = visits_of(x[some], centres[:k], threshold)
                    homes[rows[some]] = home
                    for i, row in zip(rows[some], visits):
                        near[i] = np.flatnonzero(row).astype(np.int32)
            offsets = np.cumsum([0, *map(len, near)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *near])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(homes), lists], [*batch.schema.names, "home", "visits"])

    return run


def _products(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in tk.runs(batches, "task"):
            ids, copies, side = (group.column(c).to_numpy() for c in ("rep", "copies", "side"))
            x = scaled(group.column("embedding").combine_chunks().flatten().to_numpy().reshape(len(ids), -1))
            norm = np.sqrt((x * x).sum(axis=1))
            # side 0: residents that all others are compared with; 1: the other block; 2: both (a block with itself)
            a, b = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            if not len(a) or not len(b):
                continue
            with np.errstate(all="ignore"):
                hit = (x[a] @ x[b].T) / (norm[a][:, None] * norm[b][None, :]) >= threshold
            hit &= a[:, None] != b[None, :]
            links = np.zeros(len(ids), dtype=np.int64)
            both = side[b] == 2
            links[b] += (hit * copies[a][:, None]).sum(axis=0)
            # in a block with itself, the line above counts both directions
            one = hit & ~both[None, :]
            links[a] += (one * copies[b][None, :]).sum(axis=1)
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(links[found]), *(pa.nulls(len(found), pa.int64()),) * 2], ["rep", "links", "a", "b"])
            low, high = hooks(hit, ids[a], ids[b])
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(low), pa.int64()),) * 2, pa.array(low), pa.array(high)], ["rep", "links", "a", "b"])

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, per_cell: int = PER_CELL) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label, ...): vec_id, n_links, component_id, kept.

    Vectors link if their labels and dimensions are equal, their labels are
    not null, and their cosine is at least ``threshold``.  Vectors that are
    null, empty, zero or have null or non-finite components link with
    nothing.  Repeated rows are vectors of their own that link with each
    other; rows that share a vec_id but not the vector have the links of
    both.  Rows with a null vec_id stay
    unlinked and kept.  Other columns are ignored whatever their names.  An
    empty table gives an empty result.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold has to be above 0 and at most 1")
    spark = vectors.sparkSession
    ship(spark)
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(x, lambda v: v != 0)
    key = F.sha2(F.concat_ws(",", F.transform(x, lambda v: F.hex((v + 0.0).cast("string")))), 256)
    rows = cut(vectors.select("vec_id", "label", "embedding", F.when(good, key).alias("key")), "op6-rows")
    usable = rows.where("key is not null")
    classes = cut(usable.groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "op6-classes")
    total = rows.count()
    picked = spread_join(usable, classes, ["label", "key"], "copies", total, "inner").where("vec_id = rep")
    unique = cut(picked.select("label", "key", "rep", "copies", "embedding").dropDuplicates(["label", "key"]), "op6-unique")

    groups = unique.groupBy("label", F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    dims = groups.groupBy("dim").agg(F.sum("n").alias("n"), F.max("n").alias("most")).orderBy(F.desc("n"), "dim").first()
    among, dim, most = (dims["n"], dims["dim"], dims["most"]) if dims else (0, 1, 0)
    chosen = unique.where((F.size("embedding") == dim) & (unit(F.struct("label", "key"), 6) < SAMPLE / max(among, 1)))
    # in an order without meaning, as labels take the first centroids
    taken = [r["embedding"] for r in chosen.orderBy(unit(F.struct("label", "key"), 7), "label", "key").limit(2 * SAMPLE).select("embedding").collect()]
    # the bound of the sample bounds the centroids; fuller cells are cut into more blocks
    cells = max(2, min(most // per_cell, len(taken) // FITTED))
    centres = spherical_kmeans(np.array(taken, dtype=np.float64), min(cells, len(taken))) if taken else np.eye(1, dim)

    schema = f"label {vectors.schema['label'].dataType.simpleString()}, rep long, copies long, embedding array<double>, cells int, home int, visits array<int>"
    # a power of two, so that few numbers of cells are about
    asked = groups.select("label", "dim", F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(F.lit(2.0), F.col("n") / per_cell)))).cast("int").alias("cells"))
    sized = unique.withColumn("dim", F.size("embedding")).join(asked, ["label", "dim"])
    shaped = sized.select("label", "rep", "copies", F.transform("embedding", lambda v: v.cast("double")).alias("embedding"), "cells")
    placed = cut(shaped.mapInArrow(_assign(centres, threshold), schema), "op6-placed")

    cell = ["label", "dim", "cell"]
    placed = placed.withColumn("dim", F.size("embedding"))
    at_home = placed.withColumn("cell", F.col("home"))
    guests = placed.withColumn("cell", F.explode("visits"))
    # residents and guests of a cell fall into as many blocks as they need; guests alone meet nobody
    crowd = at_home.select(*cell, F.lit(1).alias("r")).union(guests.select(*cell, F.lit(0))).groupBy(*cell)
    crowd = crowd.agg(F.sum("r").alias("residents"), F.sum(1 - F.col("r")).alias("visitors"))
    blocks = [F.ceil(F.col(n) / BLOCK).cast("int").alias(b) for n, b in (("residents", "blocks"), ("visitors", "parties"))]
    crowd = cut(crowd.select("*", *blocks), "op6-crowd")
    most = crowd.agg(F.sum("residents").alias("r"), F.sum("visitors").alias("v")).first()
    residents = spread_join(at_home, crowd, cell, "residents", most["r"] or 0, "inner").withColumn("own", F.expr("cast(pmod(xxhash64(rep), blocks) as int)"))
    guests = spread_join(guests, crowd, cell, "visitors", most["v"] or 0, "inner").where("blocks > 0")
    guests = guests.withColumn("own", F.expr("cast(pmod(xxhash64(rep, 1), parties) as int)"))

    keep = ["rep", "copies", "embedding"]
    inner = residents.select(*keep, "label", "dim", "cell", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    inner = inner.select(
        *keep,
        F.xxhash64("label", "dim", "cell", F.least("own", "other"), F.greatest("own", "other"), F.lit(0)).alias("task"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    hosts = residents.where("parties > 0").select(*keep, "label", "dim", "cell", "own", F.explode(F.expr("sequence(0, parties - 1)")).alias("other"))
    hosts = hosts.select(*keep, F.xxhash64("label", "dim", "cell", "own", "other", F.lit(1)).alias("task"), F.lit(0).alias("side"))
    coming = guests.select(*keep, "label", "dim", "cell", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    coming = coming.select(*keep, F.xxhash64("label", "dim", "cell", "other", "own", F.lit(1)).alias("task"), F.lit(1).alias("side"))
    work = inner.union(hosts).union(coming).repartition(width(spark), "task").sortWithinPartitions("task", "rep")
    found = cut(work.mapInArrow(_products(threshold), "rep long, links long, a long, b long"), "op6-found")
    links = found.where("rep is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    edges = found.where("a is not null").select("a", "b")
    joined = cut(connected_components(edges, "op6-components"), "op6-joined")
    named = classes.join(links, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left")
    named = named.select("label", "key", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = spread_join(rows, cut(named, "op6-named"), ["label", "key"], "copies", total, idle=F.col("key").isNull())
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


ORACLE = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), found AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links, f.component_id, e.vec_id = f.component_id AS kept
FROM embeddings e JOIN found f ON f.node = e.vec_id
"""
