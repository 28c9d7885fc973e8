"""Packing token sequences by non-negative least squares over a length histogram.

Every document is cut into whole windows and one shorter rest.  The rests'
histogram (at most ``window - 1`` numbers, whatever the corpus) goes to the
driver, which

1. enumerates combinations of two and three lengths that fill a window
   exactly,
2. solves for repeat counts x >= 0 that minimise |A x - histogram|^2,
3. rounds them to what the histogram can give,
4. packs the residual lengths greedily, the longest first and then always the
   longest that fits, whole runs of equal sequences at a time.

A run says: for each of its places, ranks r0 .. r0 + k - 1 among pieces of one
length go to sequences s0 .. s0 + k - 1 at one offset.  Pieces get their rank
from counts per task and length, so no task sorts or holds a length's pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship
from .tokens import tokenizer

WINDOW = 2048
END_ID = 1
#: Steps of the least-squares solver.
STEPS = 300


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Index triples into ``lengths`` (ascending) of all pairs and triples that sum to ``window``.

    A pair has -1 as third index.  There are at most window**2 / 12 of them.
    """
    at = np.full(window + 1, -1, dtype=np.int32)
    at[lengths] = np.arange(len(lengths))
    other = at[window - lengths]
    i = np.flatnonzero((other >= 0) & (lengths * 2 <= window))
    found = [np.stack([i, other[i], np.full(len(i), -1)], axis=1)]
    for a, shortest in enumerate(lengths[lengths * 3 <= window]):
        b = np.arange(a, np.searchsorted(lengths, (window - shortest) // 2, "right"))
        c = at[window - shortest - lengths[b]]
        found.append(np.stack([np.full(len(b), a), b, c], axis=1)[c >= 0])
    return np.concatenate(found)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradients."""
    n = len(histogram)
    flat = np.where(combos < 0, n, combos)
    goal = np.append(histogram.astype(float), 0.0)

    def product(x: np.ndarray) -> np.ndarray:
        out = np.bincount(flat.ravel(), weights=np.repeat(x, flat.shape[1]), minlength=n + 1)
        out[n] = 0.0
        return out

    v = np.ones(len(combos))
    for _ in range(20):
        v = (p := product(v))[flat].sum(axis=1)
        bound = np.linalg.norm(v)
        v /= bound or 1.0
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        step = np.maximum(0.0, y - (product(y) - goal)[flat].sum(axis=1) / (1.05 * bound))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = step + (t - 1) / t2 * (step - x)
        x, t = step, t2
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, one past the last, first sequence, offset) that place every piece."""
    lengths = np.array(sorted(n for n in histogram if n < window), dtype=np.int64)
    left = {int(n): int(histogram[n]) for n in lengths}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def place(pattern: list[int], k: int) -> None:
        nonlocal sequence
        offset = 0
        for n in pattern:
            runs.append((n, used[n], used[n] + k, sequence, offset))
            used[n] += k
            left[n] -= k
            offset += n
        sequence += k

    if whole := histogram.get(window, 0):
        runs.append((window, 0, whole, 0, 0))
        sequence = whole
    if len(lengths) and len(combos := combinations(lengths, window)):
        x = repeat_counts(combos, np.array([left[int(n)] for n in lengths]))
        for c in np.argsort(-x, kind="stable"):
            k = int(x[c] + 0.5)
            if not k:
                break
            pattern = [int(lengths[i]) for i in combos[c] if i >= 0]
            k = min([k, *(left[n] // pattern.count(n) for n in pattern)])
            if k:
                place(pattern, k)
    open_ = [n for n in sorted(left, reverse=True) if left[n]]
    while open_:
        space, need = window, {}
        for n in open_:
            if fit := min(space // n, left[n]):
                need[n] = fit
                space -= n * fit
        place([n for n, fit in need.items() for _ in range(fit)], min(left[n] // fit for n, fit in need.items()))
        open_ = [n for n in open_ if left[n]]
    return runs


def _pieces(path: str, window: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = tokenizer(path), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                flat, offsets = coder.encode(rows.column("text").to_pylist())
                out: list[list] = [[] for _ in range(7)]
                for doc, a, b in zip(rows.column("doc_id").to_pylist(), offsets[:-1], offsets[1:]):
                    ids = np.append(flat[a:b], np.uint32(END_ID)).astype("<u4")
                    for start in range(0, len(ids), window):
                        own = ids[start : start + window]
                        for column, x in zip(out, (doc, start, len(own), zlib.crc32(own.tobytes()), len(ids), seen[len(own)], own)):
                            column.append(x)
                        seen[len(own)] += 1
                columns = [*(pa.array(c, pa.int64()) for c in out[:6]), pa.array(np.full(len(out[0]), part), pa.int64())]
                if with_ids:
                    lens = np.concatenate([[0], np.cumsum(out[2])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(lens), pa.array(np.concatenate(out[6]).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "part", "ids"][: len(columns)])

    return run


def _runs(spark, planned: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The plan as a table with a row for each run and each ``cell`` it meets: ranks of a length in even steps."""
    of, first, past, sequence, offset = np.array(planned or [(0, 0, 1, 0, 0)], dtype=np.int64).T
    total, many = np.zeros(of.max() + 1, np.int64), np.bincount(of)
    np.maximum.at(total, of, past)
    step = (-(-total // np.maximum(many, 1)))[of]
    cells = (past - 1) // step - first // step + 1
    cell = np.repeat(first // step - np.cumsum(cells) + cells, cells) + np.arange(cells.sum())
    columns = {"of": of, "step": step, "first": first, "past": past, "sequence": sequence, "offset": offset}
    return spark.createDataFrame(pa.table({k: np.repeat(v, cells) for k, v in columns.items()} | {"cell": cell}))


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``ids`` are the piece's token ids, left out unless ``with_ids``; a
    document ends with id 1.  Pieces of a sequence are gapless from offset 0;
    what is left of the window is padding.  Null and empty texts are the end
    id alone.  Repeated rows are packed as often as they come.  Other columns
    are ignored whatever their names.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, rank long, part long" + ", ids array<int>" * with_ids
    pieces = cut(docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer_path, window, with_ids), schema), "op2-pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut(counts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))), "op2-counts")
    # one row per length, so at most ``window``
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # the plan follows the window, not the corpus: at most two rows for each run, and window**2 / 4 runs
    runs = F.broadcast(_runs(spark, plan(histogram, window)))
    steps = F.broadcast(runs.select(F.col("of").alias("length"), F.col("step").alias("ranked_step")).distinct())
    # counts grow with the tasks: never broadcast
    ranked = pieces.join(counts.select("part", "length", "ahead").hint("merge"), ["part", "length"]).withColumn("at", F.col("ahead") + F.col("rank"))
    ranked = ranked.join(steps, "length").withColumn("in", F.expr("at div ranked_step"))
    placed = ranked.join(runs, (F.col("length") == F.col("of")) & (F.col("in") == F.col("cell")) & (F.col("at") >= F.col("first")) & (F.col("at") < F.col("past")))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("sequence") + F.col("at") - F.col("first")).alias("sequence_id"), "offset", *["ids"] * with_ids)
