"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

Method: every distinct shingle set gets a sketch of T coordinates.  In round r
each shingle is thrown into one hashed coordinate with a value in [r, r + 1);
coordinates keep their least value.  Rounds go on until every coordinate of a
set is filled; rounds T to 2T - 1 throw all shingles into coordinate r - T, so
that always happens.  Coordinates behave like sampling without replacement,
hence the concentration.  Bands of ROWS coordinates form buckets.

From candidates to links without all pairs of a bucket:

1. each bucket is compared with one pivot, the member that shares most
   buckets with others; pairs are confirmed on full sets;
2. members of buckets that are not yet connected are looked at again, in
   blocks of bounded rows and bytes.  A block's intersections are one product
   of incidence matrices; it returns at most one edge per document, between
   components of the first step.  Of very large sets that buckets connect,
   members without a shingle in common with another component among their
   rarest ones are left out first (:func:`_alive`).

Pairs already connected need no test: only components are returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .common import cut, drop_cut, narrowed, ship, spread_join, width
from .components import connected_components, hooks

Shingler = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Scheme(NamedTuple):
    """How sets are made and sketched: ``bands`` bands of ``rows`` coordinates."""

    name: str
    shingler: Shingler
    bands: int
    rows: int

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


def word_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tk.shingles(tk.words(data, offsets))


#: A pair at similarity 0.75 misses all 32 bands of 4 once in 190,000 times.
WORDS = Scheme("op7", word_shingles, 32, 4)

#: Bytes of texts compared with pivots at a time: arrays that stay in a processor's cache are faster.
CONFIRM_BYTES = 1 << 17
#: Members compared with a pivot in one task group.
CELL = 200
#: Cells that the task with a hub's text copies it to; beyond them, copies are copied.
FAN = 1024
#: Documents of a block's side, and bytes of their texts.
BLOCK_ROWS = 2048
BLOCK_BYTES = 2 << 20
#: Documents that buckets connect, up to which all blocks of them meet at once.
DIRECT = 4 * BLOCK_ROWS
#: Rows (bucket, document) sorted at a time where they arise, and rows of a range of buckets on average.
CHUNK = 1 << 19
MEET = 1 << 19
#: Rows of small blocks compared at a time.
TOGETHER = 128
#: Shingles thrown at a time by the later rounds of a sketch.
THROWS = 1 << 14
#: Columns of an incidence matrix multiplied at a time.
STRIP = 1024


def sketch(packed: np.ndarray, docs: int, scheme: Scheme = WORDS) -> np.ndarray:
    """(docs, coordinates) sketch of sets packed as in :func:`textkit.shingles`, repeats allowed; of an empty set, a constant."""
    T = scheme.coordinates
    owner = (packed >> np.uint64(tk.FP_BITS)).astype(np.int64)
    element = packed & np.uint64((1 << tk.FP_BITS) - 1)
    empty = np.uint64(2**64 - 1)
    best = np.full(docs * T, empty, dtype=np.uint64)
    r = 0
    while r < 2 * T and len(owner):
        # a later round never changes what an earlier one filled, so what few are left take many rounds at once
        n = min(max(1, THROWS // len(owner)), (T if r < T else 2 * T) - r)
        rounds = np.arange(r, r + n, dtype=np.uint64)[:, None]
        h = tk.mix(element + (rounds + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        place = ((h >> np.uint64(48)) * np.uint64(T) >> np.uint64(16)).astype(np.int64) if r < T else (rounds - np.uint64(T)).astype(np.int64)
        at, value = (owner * T + place).ravel(), ((rounds << np.uint64(48)) | (h & np.uint64((1 << 48) - 1))).ravel()
        if r:
            free = best[at] == empty
            at, value = at[free], value[free]
        np.minimum.at(best, at, value)
        r += n
        # rows are sorted by owner
        head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        open_ = (best.reshape(docs, T)[owner[head]] == empty).any(axis=1)
        open_ = np.repeat(open_, np.diff(np.append(head, len(owner))))
        owner, element = owner[open_], element[open_]
    return tk.mix(best).reshape(docs, T)


def banded(sig: np.ndarray, sizes: np.ndarray, scheme: Scheme = WORDS) -> pa.ListArray:
    """A list per document of its buckets, one of each band; empty sets have none."""
    own = sig[sizes > 0].reshape(-1, scheme.bands, scheme.rows)
    total = np.zeros(own.shape[:2], dtype=np.uint64)
    for j in range(scheme.rows):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + own[:, :, j]
    bucket = tk.mix(total + np.arange(scheme.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    offsets = np.concatenate([[0], np.cumsum((sizes > 0) * scheme.bands)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(bucket.view(np.int64).ravel()))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, whole = batch.column("doc_id"), batch.column("whole")
        for row, data, offsets in tk.slices(batch.column("text")):
            docs = len(offsets) - 1
            packed, sizes = word_shingles(data, offsets)
            first = np.concatenate([[0], np.cumsum(sizes)])
            element = packed & np.uint64((1 << tk.FP_BITS) - 1)
            keys = [tk.per_doc(tk.mix(element + np.uint64(s)), first) for s in (11, 12)]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(row, docs), whole.slice(row, docs), pa.array(sizes), *(pa.array(k.view(np.int64)) for k in keys), banded(sketch(packed, docs), sizes)],
                ["doc_id", "whole", "n_shingles", "k1", "k2", "buckets"],
            )


def _confirm(shingler: Shingler, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the set of the last hub, for members that a later slice has
        hub, hub_id, hub_cell = np.zeros(0, np.uint64), 0, None
        low = np.uint64((1 << tk.FP_BITS) - 1)
        for batch in batches:
            cells, all_ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "id"))
            members = batch.column("member").to_numpy(zero_copy_only=False)
            a, b = [], []
            for row, data, offsets in tk.slices(batch.column("text"), CONFIRM_BYTES):
                packed, sizes = shingler(data, offsets)
                rows = slice(row, row + len(sizes))
                cell, ids, member = cells[rows], all_ids[rows], members[rows]
                owner = (packed >> np.uint64(tk.FP_BITS)).astype(np.int64)
                of = np.maximum.accumulate(np.where(member, -1, np.arange(len(sizes))))
                # where each shingle would be in the sorted set of its document's hub
                here = of[owner] >= 0
                wanted = np.where(here, (np.maximum(of, 0)[owner].astype(np.uint64) << np.uint64(tk.FP_BITS)) | (packed & low), packed & low)
                found = np.zeros(len(packed), dtype=bool)
                for some, among in ((here, packed), (~here, hub)):
                    if some.any() and len(among):
                        keys = wanted[some]
                        found[some] = among[np.minimum(np.searchsorted(among, keys), len(among) - 1)] == keys
                both = np.bincount(owner, weights=found, minlength=len(sizes))
                n = np.where(of >= 0, sizes[np.maximum(of, 0)], len(hub))
                same = np.where(of >= 0, cell[np.maximum(of, 0)] == cell, cell == hub_cell)
                hit = member & same & (sizes > 0) & (n > 0) & (100 * both >= percent * (sizes + n - both))
                a.append(np.where(of >= 0, ids[np.maximum(of, 0)], hub_id)[hit])
                b.append(ids[hit])
                if of[-1] >= 0:
                    hub = packed[owner == of[-1]] & low
                    hub_id, hub_cell = ids[of[-1]], cell[of[-1]]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (a, b)], ["a", "b"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, shingler: Shingler, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b), those whose full shingle sets reach ``percent``.

    A hub ``a`` and up to CELL of its ``b`` form a cell; a hub with more is
    repeated in further cells, so no task holds more than two sets.
    """
    spark = pairs.sparkSession
    degree = cut(pairs.groupBy("a").agg(F.count("*").alias("n"), F.ceil(F.count("*") / CELL).alias("salts")), "degree")
    cells = spread_join(pairs, degree, ["a"], "n", pairs.count(), "inner").select("b", F.xxhash64("a", F.expr("pmod(xxhash64(b), salts)")).alias("cell"))
    hubs = degree.where(F.col("salts") <= FAN).select("a", F.explode(F.expr("sequence(0L, salts - 1)")).alias("s"))
    roles = cells.select(F.col("b").alias("id"), "cell", F.lit(True).alias("member")).union(hubs.select(F.col("a").alias("id"), F.xxhash64("a", "s").alias("cell"), F.lit(False)))
    texts = texts.select(F.col("doc_id").alias("id"), "text")
    placed = roles.join(texts, "id")
    large = degree.where(F.col("salts") > FAN)
    if not large.isEmpty():
        fans = large.join(texts, F.col("a") == F.col("id")).select("id", "salts", "text", F.explode(F.expr(f"sequence(0L, (salts - 1) div {FAN})")).alias("fan"))
        fans = fans.repartition(width(spark), "id", "fan").select("id", F.explode(F.expr(f"sequence(fan * {FAN}, least(salts, (fan + 1) * {FAN}) - 1)")).alias("s"), "text")
        placed = placed.union(fans.select("id", F.xxhash64("id", "s").alias("cell"), F.lit(False).alias("member"), "text"))
    dealt = placed.repartition(width(spark), "cell").sortWithinPartitions("cell", "member", "id")
    return dealt.mapInArrow(_confirm(shingler, percent), "a long, b long")


def _elements(shingler: Shingler):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, comp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "component"))
            for row, data, offsets in tk.slices(batch.column("text")):
                packed, sizes = shingler(data, offsets)
                owner = (packed >> np.uint64(tk.FP_BITS)).astype(np.int64)
                element = (packed & np.uint64((1 << tk.FP_BITS) - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[row + owner], comp[row + owner], element, sizes[owner])], ["doc_id", "component", "element", "n"])

    return run


def _shared(owner: np.ndarray, value: np.ndarray, left: np.ndarray, right: np.ndarray, rows: int) -> np.ndarray:
    """How many values each left row has in common with each right row, by products of incidence matrices."""
    _, place, times = np.unique(value, return_inverse=True, return_counts=True)
    met = times[place] > 1
    owner, place = owner[met], np.unique(place[met], return_inverse=True)[1]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    both = np.zeros((len(left), len(right)))
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, STRIP):
        lo, hi = np.searchsorted(place, [at, at + STRIP])
        part = np.zeros((rows, min(STRIP, int(place[-1]) + 1 - at)), dtype=np.float32)
        part[owner[lo:hi], place[lo:hi] - at] = 1
        both += part[left] @ part[right].T
    return both


def _together(groups: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """Blocks that meet themselves, several small ones at a time: rows of different groups share no bucket, so none links them."""
    held: list[pa.Table] = []
    for group in groups:
        small = group.num_rows <= TOGETHER and group.column("side")[0].as_py() == 2
        if held and (not small or sum(t.num_rows for t in held) + group.num_rows > TOGETHER or sum(t.nbytes for t in held) + group.nbytes > BLOCK_BYTES):
            yield pa.concat_tables(held)
            held = []
        if small:
            held.append(group)
        else:
            yield group
    if held:
        yield pa.concat_tables(held)


def _blocks(shingler: Shingler, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _together(tk.runs(batches, "pair")):
            comp, ids, side = (group.column(c).to_numpy() for c in ("component", "doc_id", "side"))
            owners, elements, n = [], [], []
            for row, data, offsets in tk.slices(group.column("text").combine_chunks()):
                packed, sizes = shingler(data, offsets)
                owners.append((packed >> np.uint64(tk.FP_BITS)).astype(np.int64) + row)
                elements.append(packed & np.uint64((1 << tk.FP_BITS) - 1))
                n.append(sizes)
            # side 0 meets side 1; a block that meets itself is side 2
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            n = np.concatenate(n)
            both = _shared(np.concatenate(owners), np.concatenate(elements), left, right, len(ids))
            hit = (100 + percent) * both >= percent * (n[left][:, None] + n[right][None, :])
            hit &= comp[left][:, None] != comp[right][None, :]
            if hit.any():
                lists = group.column("buckets").combine_chunks()
                owner = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
                hit &= _shared(owner, lists.flatten().to_numpy(), left, right, len(ids)) > 0
            low, high = hooks(hit, comp[left], comp[right])
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    return run


def _several(bucket: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct rows by bucket: those alone in theirs (two arrays), then the others, the size of their bucket and their place in it."""
    order = np.argsort(bucket)
    bucket, ids = bucket[order], ids[order]
    same = bucket[1:] == bucket[:-1]
    met = np.append(same, [False] * (len(bucket) > 0)) | np.append([False] * (len(bucket) > 0), same).astype(bool)
    lone, lone_ids = bucket[~met], ids[~met]
    bucket, ids = bucket[met], ids[met]
    order = np.lexsort((ids, bucket))
    bucket, ids = bucket[order], ids[order]
    fresh = np.ones(len(bucket), dtype=bool)
    fresh[1:] = (bucket[1:] != bucket[:-1]) | (ids[1:] != ids[:-1])
    bucket, ids = bucket[fresh], ids[fresh]
    head = np.ones(len(bucket), dtype=bool)
    head[1:] = bucket[1:] != bucket[:-1]
    head = np.flatnonzero(head)
    size = np.diff(np.append(head, len(bucket)))
    place = np.arange(len(bucket)) - np.repeat(head, size)
    size = np.repeat(size, size)
    one = size == 1
    lone, lone_ids = np.append(lone, bucket[one]), np.append(lone_ids, ids[one])
    return lone, lone_ids, bucket[~one], ids[~one], size[~one], place[~one]


def _deal(parts: int):
    """Deals rows (doc_id, buckets) to ranges of buckets, as arrays.

    Of rows that share a bucket where they arise, two tell the range of it;
    the others are in company anyway and go to it as they are, so a bucket that
    very many rows share is no heavy range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(p: int, bucket: np.ndarray, ids: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array([x.tobytes()], pa.binary()) for x in (bucket, ids, size.astype(np.int64))]
            return pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), *columns], ["p", "bucket", "ids", "size"])

        def dealt(held: list[tuple[np.ndarray, np.ndarray]], turn: int) -> Iterator[pa.RecordBatch]:
            lone, lone_ids, bucket, ids, size, at = _several(*(np.concatenate(x) for x in zip(*held)))
            for b, i, n in ((lone, lone_ids, np.ones(len(lone))), (bucket[at < 2], ids[at < 2], size[at < 2])):
                p = ((b >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(p, kind="stable")
                p, b, i, n = p[order], b[order], i[order], n[order]
                edges = [0, *(np.flatnonzero(p[1:] != p[:-1]) + 1).tolist(), len(p)] if len(p) else [0]
                for lo, hi in zip(edges, edges[1:]):
                    yield packed(int(p[lo]), b[lo:hi], i[lo:hi], n[lo:hi])
            if (rest := at >= 2).any():
                yield packed(-1 - turn % parts, bucket[rest], ids[rest], size[rest])

        held, n, turn = [], 0, TaskContext.get().partitionId()
        for batch in batches:
            lists = batch.column("buckets")
            ids = batch.column("doc_id").to_numpy()
            held.append((lists.flatten().to_numpy().view(np.uint64), np.repeat(ids, np.diff(lists.offsets.to_numpy()))))
            n += len(held[-1][0])
            if n >= CHUNK:
                yield from dealt(held, turn)
                held, n, turn = [], 0, turn + 1
        if n:
            yield from dealt(held, turn)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, doc_id, size) of a range of buckets that share theirs with others."""

    def read(column: pa.ChunkedArray) -> np.ndarray:
        return np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for chunk in column.chunks for x in chunk])

    for group in tk.runs(batches, "p"):
        bucket, ids, size = (read(group.column(c)) for c in ("bucket", "ids", "size"))
        if group.column("p")[0].as_py() >= 0:
            *_, bucket, ids, size, _ = _several(bucket, ids)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(ids), pa.array(size)], ["bucket", "doc_id", "size"])


def buckets_of(sketched: DataFrame, scheme: Scheme) -> DataFrame:
    """(bucket, doc_id, size) of the sketches in ``sketched`` (doc_id, buckets), without buckets of one doc_id.

    ``size`` says how many members of the bucket were seen together.  Rows of
    a doc_id may come repeatedly, and then do here.  Rows travel as arrays, some
    thousand to a row of Spark.
    """
    spark = sketched.sparkSession
    parts = max(width(spark), sketched.count() * scheme.bands // MEET)
    schema = "p long, bucket binary, ids binary, size binary"
    dealt = sketched.select("doc_id", "buckets").mapInArrow(_deal(parts), schema)
    dealt = dealt.repartition(width(spark), "p").sortWithinPartitions("p")
    return cut(dealt.mapInArrow(_meet, "bucket long, doc_id long, size long"), f"{scheme.name}-bands")


def _alive(members: DataFrame, texts: DataFrame, scheme: Scheme, percent: int) -> DataFrame:
    """Of ``members`` (doc_id, component), those that can have a partner in another component.

    Two sets that reach the threshold share one of their n - ceil(t * n) + 1
    rarest shingles, so only documents that share such a shingle with another
    component stay; a passage that very many documents share is never among
    their rarest shingles.
    """
    name = scheme.name
    parts = cut(texts.join(members, "doc_id").mapInArrow(_elements(scheme.shingler), "doc_id long, component long, element long, n long"), f"{name}-elements")
    seen = parts.groupBy("element").agg(F.count("*").alias("seen"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    rarest = Window.partitionBy("doc_id").orderBy("seen", "element")
    ranked = parts.join(seen, "element").withColumn("rare", F.row_number().over(rarest) <= F.expr(f"n - ceil({percent} * n / 100) + 1"))
    out = cut(ranked.where("rare and lo < hi").select("doc_id").distinct(), f"{name}-alive")
    drop_cut(parts)
    return out


def _meetings(unsettled: DataFrame, texts: DataFrame, scheme: Scheme, percent: int) -> DataFrame:
    """(group, doc_id, component, buckets) so that documents sharing a bucket of ``unsettled`` meet in a group.

    Documents that buckets connect are one group up to DIRECT of them.  Larger
    sets meet in the groups of their buckets, first without
    those that cannot have a partner.  Blocks compare documents that share a
    bucket and no others, so the grouping changes the cost and not the links.
    """
    name = scheme.name
    hubs = cut(unsettled.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.count("*").alias("members")), f"{name}-hubs")
    edges = spread_join(unsettled, hubs, ["bucket"], "members", unsettled.count(), "inner").where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    clusters = cut(connected_components(edges, f"{name}-clusters"), f"{name}-cluster")
    sizes = clusters.groupBy("component").agg(F.count("*").alias("docs"))
    named = clusters.join(sizes, "component").select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"), "docs")
    open_ = cut(unsettled.join(named, "doc_id"), f"{name}-open")
    drop_cut(clusters)
    meet = open_.where(f"docs <= {DIRECT}").select(F.xxhash64(F.lit(0), "cluster").alias("group"), "doc_id", "component", "bucket")
    large = open_.where(f"docs > {DIRECT}")
    if not large.isEmpty():
        alive = _alive(large.select("doc_id", "component").distinct(), texts, scheme, percent)
        large = large.join(alive, "doc_id", "left_semi")
        meet = meet.union(large.select(F.xxhash64(F.lit(1), "bucket").alias("group"), "doc_id", "component", "bucket"))
    # a document has as many buckets as there are bands at most
    return meet.groupBy("group", "doc_id", "component").agg(F.collect_list("bucket").alias("buckets"))


def components_of(rows: DataFrame, texts: DataFrame, scheme: Scheme, percent: int) -> DataFrame:
    """(node, component) of the documents that pairs in a bucket reaching ``percent`` connect, as a table.

    ``rows`` (bucket, doc_id, size) are those of :func:`buckets_of`, each
    once; ``texts`` (doc_id, text) has each document once.
    """
    spark, name = rows.sparkSession, scheme.name
    degree = rows.groupBy("doc_id").agg(F.sum("size").alias("degree"))
    ranked = rows.join(degree, "doc_id").select("bucket", F.struct("degree", F.negative("doc_id").alias("id")).alias("rank"))
    pivots = ranked.groupBy("bucket").agg(F.max("rank").alias("top"), F.count("*").alias("members")).select("bucket", "members", F.negative(F.col("top.id")).alias("pivot"))
    pivots = cut(pivots, f"{name}-pivots")
    met = spread_join(rows, pivots, ["bucket"], "members", rows.count(), "inner").where("doc_id <> pivot")
    stars = cut(met.select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct(), f"{name}-stars")
    links = cut(confirmed(stars, texts, scheme.shingler, percent), f"{name}-links")
    drop_cut(stars)

    # pairs with the pivot are settled; what is left to compare are the others of a bucket, if components differ
    labels = cut(connected_components(links, f"{name}-round1"), f"{name}-labels")
    tagged = met.where("members > 2").join(labels, F.col("doc_id") == F.col("node"), "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    tagged = cut(tagged, f"{name}-tagged")
    mixed = tagged.groupBy("bucket").agg(F.count("*").alias("others"), F.expr("min(component) < max(component)").alias("mixed"))
    mixed = cut(mixed, f"{name}-mixed")
    unsettled = spread_join(tagged, mixed, ["bucket"], "others", tagged.count(), "inner").where("mixed").select(tagged.columns)
    unsettled = cut(unsettled, f"{name}-unsettled")
    drop_cut(links, pivots, tagged, mixed)

    members = cut(_meetings(unsettled, texts, scheme, percent).join(texts, "doc_id"), f"{name}-members")
    load = members.groupBy("group").agg(
        F.greatest(F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES), F.ceil(F.count("*") / BLOCK_ROWS)).cast("int").alias("blocks"),
        F.expr("min(component) < max(component)").alias("mixed"), F.count("*").alias("docs"),
    )
    load = cut(load, f"{name}-load")
    dealt = spread_join(members, load, ["group"], "docs", members.count(), "inner").where("mixed").withColumn("own", F.expr("cast(pmod(xxhash64(doc_id), blocks) as int)"))
    spread = dealt.select("*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")).select(
        "doc_id", "component", "buckets", "text",
        F.xxhash64("group", F.least("own", "other"), F.greatest("own", "other")).alias("pair"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    placed = spread.repartition(width(spark), "pair").sortWithinPartitions("pair", "doc_id")
    more = cut(placed.mapInArrow(_blocks(scheme.shingler, percent), "a long, b long"), f"{name}-more")
    drop_cut(unsettled, members)

    # blocks found links between components, so the documents of a component need not be walked again
    joined = connected_components(more, f"{name}-all").withColumnRenamed("component", "whole")
    sizes = labels.groupBy(F.col("component").alias("node")).agg(F.count("*").alias("docs"))
    renamed = cut(joined.join(sizes, "node", "left").select(F.col("node").alias("component"), "whole", "docs"), f"{name}-renamed")
    found = spread_join(labels, renamed.where("docs is not null"), ["component"], "docs", labels.count())
    alone = renamed.where("docs is null").select(F.col("component").alias("node"), F.col("whole").alias("component"))
    out = cut(found.select("node", F.coalesce("whole", "component").alias("component")).union(alone), f"{name}-joined")
    drop_cut(labels, more, renamed)
    return out


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, n_shingles, component_id, kept.

    Null, empty and blank texts have no shingles and link with nothing; texts
    of one to four words have one shingle, the whole sequence.  Repeated
    doc_ids are one document, answered once per row; if their texts differ, the
    one with the greatest hash is compared.  Rows with a null doc_id come back
    unlinked and kept.  Other columns are ignored whatever their names.  An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("whole", F.xxhash64("text"))
    made = cut(texts.mapInArrow(_sketches, "doc_id long, whole long, n_shingles long, k1 long, k2 long, buckets array<long>"), "op7-sketch")
    held = made.where("n_shingles > 0 and doc_id is not null")
    classes = cut(held.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("times")), "op7-classes")
    unique = cut(held.join(classes.select("rep").distinct(), held.doc_id == F.col("rep"), "left_semi").groupBy("doc_id").agg(F.max_by("buckets", "whole").alias("buckets")), "op7-unique")
    rows = buckets_of(unique, WORDS)
    asked = cut(rows.select("doc_id").distinct(), "op7-asked")
    drop_cut(unique)
    texts = narrowed(texts, asked, ["doc_id"], "op7-near")
    once = cut(texts.groupBy("doc_id").agg(F.max_by("text", "whole").alias("text")), "op7-texts")
    drop_cut(texts, asked)
    joined = components_of(rows, once, WORDS, percent)
    drop_cut(rows, once)

    named = classes.join(joined, F.col("rep") == F.col("node"), "left").select("k1", "k2", "n_shingles", "times", F.coalesce("component", "rep").alias("component_id"))
    none = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    found = spread_join(made.drop("buckets", "whole"), cut(named, "op7-named"), ["k1", "k2", "n_shingles"], "times", made.count(), idle=none)
    component = F.when(~none, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM parts a JOIN parts b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), reach(node, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), found AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, f.component_id, s.doc_id = f.component_id AS kept
FROM sets s JOIN found f ON f.node = s.doc_id
"""
