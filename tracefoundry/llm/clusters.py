"""Centroid clustering: Lloyd's rounds that compare and move only what can have changed.

Vectors become integers, so sums, distances and ties are exact and do not
depend on partitioning.  Two things persist between rounds: the assignments
(each vector's owner and distance, in the shared folder) and the global sums
(one per centroid, on the driver: clusters x components numbers, whatever the
input).  A round is one narrow pass over the vectors:

* every vector meets the centroids that changed;
* the others are met only by a vector whose owner moved away from it.  Its
  owner's old distance had already beaten them, and still does for all the
  other vectors;
* a vector that changes its owner adds itself to the new one's sum and takes
  itself from the old one's.  Each task folds these signed integers and writes
  a row per centroid at most, beside its vectors, so nothing is shuffled but
  these rows.

The rounds end early when no centroid changes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut, ship

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: Largest magnitude of an integer component: squared distances of 64 of them stay below 2**63.
MOST = 1 << 26
#: Up to this magnitude products of 64 components are exact in double precision.
EXACT = 1 << 22

STATE = "vec_id long, q array<int>, owner int, distance long, cluster int, moved long, sums array<long>"


def integers(embedding: Column) -> Column:
    """floor(SCALE * x) of each component, held to the range of MOST."""
    whole = F.transform(embedding, lambda x: F.greatest(F.least(F.floor(x.cast("double") * float(SCALE)), F.lit(MOST)), F.lit(-MOST)))
    return whole.cast("array<int>")


def usable(embedding: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, none of them null or non-finite."""
    odd = F.exists(embedding, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return F.coalesce((F.size(embedding) == dims) & ~odd, F.lit(False))


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows and centroids, exact."""
    if max(np.abs(x).max(initial=0), np.abs(centres).max(initial=0)) <= EXACT:
        a, b = x.astype(np.float64), centres.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centres], axis=1) if len(centres) else np.zeros((len(x), 0), np.int64)


def reassign(x: np.ndarray, owner: np.ndarray, distance: np.ndarray, centres: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners and distances of rows after the centroids ``changed`` have moved; owner -1 is none yet."""
    rows, none = np.arange(len(x)), np.iinfo(np.int64).max
    cost = np.full((len(x), len(centres)), none)
    cost[:, changed] = distances(x, centres[changed])
    kept = (owner >= 0) & ~changed[owner]
    cost[rows[kept], owner[kept]] = distance[kept]
    # an owner that came nearer, or stayed, still beats the centroids that did not change
    apart = np.flatnonzero((owner < 0) | (cost[rows, owner] > distance))
    cost[np.ix_(apart, ~changed)] = distances(x[apart], centres[~changed])
    best = cost.argmin(axis=1)
    return best.astype(np.int32), cost[rows, best]


def _round(centres: np.ndarray, changed: np.ndarray):
    k, dims = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, moved = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        names = ["vec_id", "q", "owner", "distance", "cluster", "moved", "sums"]
        wide = pa.list_(pa.int64())
        for batch in batches:
            n = batch.num_rows
            x = batch.column("q").flatten().to_numpy().reshape(n, dims).astype(np.int64)
            had = batch.column("owner").to_numpy()
            owner, distance = reassign(x, had, batch.column("distance").to_numpy(), centres, changed)
            left = owner != had
            for c in range(k):
                came, gone = left & (owner == c), left & (had == c)
                sums[c] += x[came].sum(0) - x[gone].sum(0)
                moved[c] += came.sum() - gone.sum()
            empty = [pa.nulls(n, t) for t in (pa.int32(), pa.int64(), wide)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("q"), pa.array(owner), pa.array(distance), *empty], names)
        told = np.flatnonzero(sums.any(axis=1) | (moved != 0))
        empty = [pa.nulls(len(told), t) for t in (pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int64())]
        lists = pa.array([sums[c].tolist() for c in told], wide)
        yield pa.RecordBatch.from_arrays([*empty, pa.array(told.astype(np.int32)), pa.array(moved[told]), lists], names)

    return run


def centroids(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS) -> tuple[DataFrame, list[list[int]]]:
    """Assignments (vec_id, owner, distance) after ``rounds`` rounds and one more assignment, and the final centroids."""
    spark = vectors.sparkSession
    ship(spark)
    q = integers(F.col("embedding"))
    fresh = vectors.where(usable(F.col("embedding"), dims)).select("vec_id", q.alias("q"), F.lit(-1).alias("owner"), F.lit(0).cast("long").alias("distance"))
    state = cut(fresh, "op13-vectors")
    named = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    first = state.where("vec_id is not null").orderBy(named, "q").limit(clusters).select("q").collect()
    if not first:
        return state.where("false").select("vec_id", "owner", "distance"), []
    centres = [list(r["q"]) for r in first]
    totals, counts = [[0] * dims for _ in centres], [0] * len(centres)
    changed = [True] * len(centres)
    for done in range(rounds + 1):
        rows = state.where("q is not null").select("vec_id", "q", "owner", "distance")
        after = cut(rows.mapInArrow(_round(np.array(centres, np.int64), np.array(changed)), STATE), "op13-state")
        drop_cut(state)
        state = after
        if done == rounds:
            break
        # the number of vectors comes last of a centroid's sums
        told = state.where("cluster is not null").select("cluster", F.posexplode(F.array_append("sums", F.col("moved"))).alias("i", "s"))
        for r in told.groupBy("cluster", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
            if r["i"] == dims:
                counts[r["cluster"]] += int(r["s"])
            else:
                totals[r["cluster"]][r["i"]] += int(r["s"])
        before = centres
        centres = [[s // n for s in sums] if n else have for sums, n, have in zip(totals, counts, centres)]
        changed = [a != b for a, b in zip(before, centres)]
        if not any(changed):
            break
    return state.where("q is not null").select("vec_id", "owner", "distance"), centres


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS) -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding, ...): vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Usable vectors have ``dims`` components, none null or non-finite; others
    give no row.  Components beyond 65,536 count as that.  Centroids start as
    the vectors whose seeded vec_id hashes least, of equal hashes the least
    vector; fewer vectors make fewer centroids.  Rows repeated whole are
    vectors of their own; rows without a vec_id are assigned and summed like
    others, but start no centroid (if none has a vec_id, the result is
    empty).  Equal distances go to the smaller number, and an empty cluster
    keeps its centroid.  Other columns are ignored whatever their names.  An
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows, centres = centroids(vectors, clusters, rounds, dims)
    found = {r["owner"]: int(r["s"]) for r in rows.groupBy("owner").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    # a row per centroid
    facts = [(c, Decimal(found.get(c, 0)), Decimal(sum(found.values())), digest[c]) for c in range(len(centres))]
    one = spark.createDataFrame(facts, "owner int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string")
    met = rows.join(F.broadcast(one), "owner")
    return met.select("vec_id", F.col("owner").alias("cluster"), "distance", F.col("cluster_inertia").cast("long").alias("cluster_inertia"), F.col("inertia").cast("long").alias("inertia"), "centroid_sha256")


def _oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS) -> str:
    away = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))::BIGINT"
    parts = [
        f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE}::DOUBLE * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1)::INT AS k, q FROM v ORDER BY k LIMIT {clusters})",
    ]
    for r in range(rounds + 1):
        parts.append(f"a{r} AS MATERIALIZED (SELECT v.vec_id, any_value(v.q) AS q, min({{'d': {away}, 'k': c.k}}) AS best FROM v, c{r} c GROUP BY v.vec_id)")
        if r < rounds:
            parts.append(f"s{r} AS (SELECT best.k AS k, i, sum(q[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, {dims + 1}) t(i) GROUP BY 1, 2)")
            parts.append(f"m{r} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS q FROM s{r} GROUP BY k)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT k, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m USING (k))")
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, a.best.k AS cluster, a.best.d AS distance, (sum(a.best.d) OVER (PARTITION BY a.best.k))::BIGINT AS cluster_inertia,
  (sum(a.best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.k = a.best.k"""


ORACLE = _oracle()
