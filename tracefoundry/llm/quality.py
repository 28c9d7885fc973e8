"""Quality classifier from weak labels.

Heuristic labellers look at whole texts and vote good (1), bad (-1) or
nothing (0).  Expectation-maximisation over the counts of vote patterns (at
most 3**labellers of them) estimates, without true labels, how often each
labeller votes what for good and for bad documents, and the share of good
ones.  The posterior of its pattern labels a document; a linear scorer over
hashed features is fitted to the posteriors of a bounded sample, then scores
every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .common import ship, unit

LABELLERS = ("symbols", "capitals", "bare_words", "variety", "runs", "word_length", "sentences", "bigrams", "rare_marks", "mark_runs")
#: Documents that the scorer is fitted on, at most about this many.
SAMPLE = 8192
DIM = 4096
#: Bytes of text measured at a time; the arrays of a slice take some 60 times as much.
SLICE = 1 << 20
STEPS = 250
#: Words of a window in which distinct words and pairs are counted, so that a text's length alone says nothing.
WINDOW = 200

_CLASS = np.full(256, 1, dtype=np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4 + np.arange(32)
_CLASS[0:9] = _CLASS[14:32] = _CLASS[127] = 36
_KINDS = 37
_RARE = np.zeros(256, dtype=bool)
_RARE[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = True
_ALONE = np.zeros(256, dtype=bool)
_ALONE[list(b"!\"#$%&'()*+,/:;<=>?@[\\]^_`{|}~")] = True


class Measures:
    """Per-document measures and per-position features of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        w = tk.words(data, offsets)
        kinds = _CLASS[data]
        docs = len(offsets) - 1
        self.words = np.diff(w.first)
        n = np.maximum(self.words, 1)

        def over_bytes(hit: np.ndarray) -> np.ndarray:
            return tk.per_doc(hit.astype(np.int64), offsets)

        def over_words(hit: np.ndarray) -> np.ndarray:
            return tk.per_doc(hit.astype(np.int64), w.first)

        letters = over_bytes((kinds == 1) | (kinds == 2))
        solid = np.maximum(over_bytes(kinds != 0), 1)
        self.symbols = over_bytes(kinds >= 4) / solid
        self.capitals = over_bytes(kinds == 2) / np.maximum(letters, 1)
        lettered = np.concatenate([[0], np.cumsum((kinds >= 1) & (kinds <= 3))])
        self.bare = over_words(lettered[w.end] == lettered[w.start]) / n
        owner = np.repeat(np.arange(docs), self.words)
        place = np.arange(len(w.hash)) - w.first[:-1][owner]
        fresh = np.append(True, (owner[1:] != owner[:-1]) | (place[1:] % WINDOW == 0))[: len(owner)]
        window = np.cumsum(fresh) - 1
        home = owner[fresh]

        def distinct(hashes: np.ndarray, windows: np.ndarray) -> np.ndarray:
            """Distinct hashes of each window, added up by document."""
            own = (windows.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24))
            own.sort()
            own = own[np.append(True, own[1:] != own[:-1])[: len(own)]]
            return np.bincount(home[(own >> np.uint64(40)).astype(np.int64)], minlength=docs)

        self.variety = distinct(w.hash, window) / n
        follows = np.zeros(len(w.hash), dtype=bool)
        follows[1:] = (w.hash[1:] == w.hash[:-1]) & (owner[1:] == owner[:-1])
        self.runs = over_words(follows) / n
        self.length = over_bytes((kinds != 0) & (data & 0xC0 != 0x80)) / n
        last = data[w.end - 1] if len(w.end) else data[:0]
        self.sentences = over_words((last == 46) | (last == 63) | (last == 33)) / n
        inside = np.flatnonzero(window[1:] == window[:-1])
        pairs = np.bincount(owner[inside], minlength=docs)
        self.bigrams = distinct(tk.mix(w.hash[inside] * np.uint64(3) + w.hash[inside + 1]), window[inside]) / np.maximum(pairs, 1)
        self.rare_marks = over_bytes(_RARE[data]) / solid
        twice = np.zeros(len(data) + 1, dtype=np.int64)
        twice[2:] = np.cumsum(_ALONE[data[1:]] & (data[1:] == data[:-1])) if len(data) > 1 else 0
        self.mark_runs = over_words(twice[w.end] > twice[np.minimum(w.start + 1, w.end)]) / n

        # hashed features: trigrams of byte classes, and binned measures
        c = np.concatenate([kinds, [0, 0]])
        self.places = tk.mix((c[:-2] * _KINDS * _KINDS + c[1:-1] * _KINDS + c[2:]).astype(np.uint64)).astype(np.int64) & (DIM - 1)
        self.offsets, self.bytes = offsets, np.maximum(np.diff(offsets), 1)
        measures = (self.symbols, self.capitals, self.bare, self.variety, self.runs, self.length / 20, self.sentences, self.bigrams, self.rare_marks, self.mark_runs)
        binned = np.minimum((np.stack(measures) * 20).astype(np.int64), 40)
        code = (binned + 64 * np.arange(len(binned))[:, None] + (1 << 20)).astype(np.uint64)
        self.bins = tk.mix(code).astype(np.int64) & (DIM - 1)

    def votes(self) -> np.ndarray:
        """(docs, labellers) of -1, 0, 1; most need some words to vote at all."""
        some, many = self.words >= 10, self.words >= 40

        def vote(bad, good, may=some):
            return np.where(may & bad, -1, np.where(may & good, 1, 0))

        return np.stack([
            vote(self.symbols > 0.12, self.symbols < 0.07),
            vote(self.capitals > 0.5, self.capitals < 0.2),
            vote(self.bare > 0.15, self.bare < 0.05),
            vote(self.variety < 0.25, self.variety > 0.4, many),
            vote(self.runs > 0.25, self.runs < 0.10),
            vote((self.length < 2.5) | (self.length > 14), (self.length > 3.5) & (self.length < 9)),
            vote((self.sentences < 0.01) | (self.sentences > 0.5), (self.sentences > 0.02) & (self.sentences < 0.35), many),
            vote(self.bigrams < 0.4, self.bigrams > 0.7, many),
            vote(self.rare_marks > 0.02, self.rare_marks < 0.01),
            vote(self.mark_runs > 0.15, self.mark_runs < 0.05),
        ], axis=1).astype(np.int64)

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        trigrams = np.diff(np.concatenate([[0.0], np.cumsum(weights[self.places])])[self.offsets])
        z = trigrams / self.bytes * 4 + weights[self.bins].sum(axis=0) + bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Feature indexes and values of each document."""
        for i in range(len(self.words)):
            at, n = np.unique(self.places[self.offsets[i] : self.offsets[i + 1]], return_counts=True)
            yield np.concatenate([at, self.bins[:, i]]), np.concatenate([n / self.bytes[i] * 4, np.ones(len(self.bins))])


def _pattern(votes: np.ndarray) -> np.ndarray:
    return (votes + 1) @ (3 ** np.arange(votes.shape[1]))


def _votes(batches):
    for batch in batches:
        for _, data, offsets in tk.slices(batch.column("text"), SLICE):
            pattern, n = np.unique(_pattern(Measures(data, offsets).votes()), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pattern), pa.array(n)], ["pattern", "n"])


def _rows(batches):
    for batch in batches:
        for _, data, offsets in tk.slices(batch.column("text"), SLICE):
            m = Measures(data, offsets)
            at, value = zip(*m.rows())
            yield pa.RecordBatch.from_arrays([pa.array(_pattern(m.votes())), pa.array(at, pa.list_(pa.int64())), pa.array(value, pa.list_(pa.float64()))], ["pattern", "at", "value"])


def _scored(posterior: dict[int, float], weights: np.ndarray, bias: float, threshold: float):
    def run(batches):
        for batch in batches:
            for row, data, offsets in tk.slices(batch.column("text"), SLICE):
                m = Measures(data, offsets)
                score = np.where(m.words > 0, m.scores(weights, bias), 0.0)
                label = [posterior[p] for p in _pattern(m.votes()).tolist()]
                kept = score >= threshold
                columns = {"weak_label": pa.array(label), "score": pa.array(score), "kept": pa.array(kept)}
                own = batch.slice(row, len(kept))
                yield pa.RecordBatch.from_arrays([*own.columns, *columns.values()], [*own.schema.names, *columns])

    return run


class Estimate(NamedTuple):
    """What EM learns: the share of good documents, each labeller's accuracy on bad and good ones, the posterior of each pattern."""

    share: float
    accuracy: np.ndarray
    posterior: dict[int, float]


def estimate(counts: dict[int, int], labellers: int = len(LABELLERS), steps: int = 500) -> Estimate:
    """Expectation-maximisation over the counts of vote patterns.

    Labellers are taken as independent given the class, and a labeller that
    does not vote says nothing.  The start takes a bad vote as strong
    evidence, since a labeller has one kind of bad text in view and finds
    others good; the steps then learn from agreement how far each is right.
    One vote more of each kind is all the prior there is, so a labeller that
    misfires is found out by the others; what one labeller alone calls bad
    passes as its error, which is why labellers overlap.
    """
    patterns = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[int(p)] for p in patterns], dtype=float)
    votes = patterns[:, None] // 3 ** np.arange(labellers) % 3
    good = np.where((votes != 1).any(axis=1), 0.97 * 0.2 ** (votes == 0).sum(axis=1), 0.8)
    said = votes != 1
    for _ in range(steps):
        classes = np.stack([1 - good, good]) * n
        share = (classes.sum(axis=1) + 1) / (n.sum() + 2)
        table = np.stack([(classes[:, :, None] * (votes == v)).sum(axis=1) + 1.0 for v in (0, 2)], axis=-1)
        table /= table.sum(axis=-1, keepdims=True)
        told = np.log(table[:, np.arange(labellers)[None, :], votes // 2])
        like = np.log(share)[:, None] + (told * said).sum(axis=-1)
        after = 1 / (1 + np.exp(np.clip(like[0] - like[1], -700, 700)))
        moved, good = np.abs(after - good).max(), after
        if moved < 1e-9:
            break
    accuracy = np.stack([table[0, :, 0], table[1, :, 1]])
    return Estimate(float(share[1]), accuracy, dict(zip(patterns.tolist(), good.tolist())))


def fit(rows: list, posterior: dict[int, float], steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Logistic regression on hashed features against posterior labels, by Adam on all rows."""
    if not rows:
        return np.zeros(DIM), 3.0
    label = np.array([posterior[r["pattern"]] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r["at"]) for r in rows])
    at, value = np.concatenate([r["at"] for r in rows]).astype(np.int64), np.concatenate([r["value"] for r in rows])
    w, m, v = np.zeros(DIM + 1), np.zeros(DIM + 1), np.zeros(DIM + 1)
    bad = max(float((1 - label).sum()), 1.0)
    weight = np.where(label < 0.5, min(5.0, len(rows) / bad / 2), 1.0)
    for step in range(1, steps + 1):
        z = np.bincount(owner, weights=w[at] * value, minlength=len(rows)) + w[DIM]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label)
        grad = np.append(np.bincount(at, weights=error[owner] * value, minlength=DIM), error.sum()) / len(rows) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.05 * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:DIM], float(w[DIM])


def classify(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): the ``carry`` columns, weak_label, score, kept.

    ``carry`` is doc_id by default; the pipeline names all columns it needs.
    ``weak_label`` is the posterior of being good from the votes, ``score``
    the scorer's.  Null, empty and blank texts have score 0 and are not kept.
    Texts of one to four words get no votes, so their weak label is the
    estimated share of good documents; the scorer judges them like others.
    Repeated rows are judged alike, but for rounding of the score from its
    fifth decimal on, and are in the sample together or not at all; so are rows with a null doc_id of one text.  An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select("doc_id", "text")
    counts = texts.mapInArrow(_votes, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    counts = {r["pattern"]: r["n"] for r in counts.collect()}
    posterior = estimate(counts).posterior if counts else {}
    share = sample / max(sum(counts.values()), 1)
    # about ``sample`` rows, whatever the corpus
    chosen = texts.where(unit(F.xxhash64("doc_id", "text"), 77) < share).where(F.char_length(F.trim("text")) > 0)
    rows = chosen.mapInArrow(_rows, "pattern long, at array<long>, value array<double>").limit(2 * sample).collect()
    weights, bias = fit(rows, posterior)
    names = carry or ["doc_id"]
    had = docs.select(*names, *(["text"] if "text" not in names else []))
    schema = T.StructType([*had.schema.fields, T.StructField("weak_label", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    out = had.mapInArrow(_scored(posterior, weights, bias, threshold), schema)
    return out if "text" in names else out.drop("text")
