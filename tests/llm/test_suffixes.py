"""Suffix-array dedup against a table of all strings of 50 bytes; merging and common prefixes against sorting."""

import hashlib
import os
import random

import numpy as np
import pytest

from tracefoundry.llm import suffixes

from .cases import DOCS, documents, frame, prose


def brute(rows):
    key = lambda i: 2**63 - 1 if i is None else i
    docs = [(r[0], (r[1] or "").encode()) for r in rows]
    least = {}
    for i, d in docs:
        for p in range(len(d) - 49):
            least[d[p : p + 50]] = min(key(i), least.get(d[p : p + 50], 2**63))
    out = []
    for i, d in docs:
        covered = np.zeros(len(d), bool)
        for p in range(len(d) - 49):
            if least[d[p : p + 50]] < key(i):
                covered[p : p + 50] = True
        spans = covered & ~np.concatenate([[False], covered[:-1]])[: len(d)]
        out.append((i, len(d), int(covered.sum()), int(spans.sum()), hashlib.sha256(np.frombuffer(d, np.uint8)[~covered].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def with_passages(seed):
    rng = random.Random(seed)
    rows = [r for r in documents(seed, 25)]
    passage = prose(rng, 30)
    texts = [f"{prose(rng, rng.randint(0, 9))} {passage} {prose(rng, rng.randint(0, 9))}" for _ in range(60)]
    texts += ["x" * rng.randint(40, 300) for _ in range(6)] + ["ab" * 100, "ab" * 30, "\0" * 80, "\0" * 51 + "a", "é" * 60, "aé" * 40]
    texts += [passage[i : i + 49] for i in range(3)] + [passage[i : i + 50] for i in range(3)]
    rows += [(2000 + i // 2, t, "en", None, None, None, None, None) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def test_cut_repeats_meets_brute_force(spark):
    rows = with_passages(1)
    got = suffixes.cut_repeats(frame(spark, rows))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("op12")]


def test_one_passage_in_most_documents(spark):
    """Its inner contexts are the same everywhere; those at its ends are many, and are dealt window by window."""
    rng = random.Random(6)
    passage = prose(rng, 25)
    rows = [(i, f"{prose(rng, 2)} {passage}{prose(rng, 2)}", None, None, None, None, None, None) for i in range(2600)]
    assert suffixes.HOT < len(rows)
    assert sorted((tuple(r) for r in suffixes.cut_repeats(frame(spark, rows)).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, *[None] * 6)], [(None, "z" * 200, *[None] * 6), (3, "z" * 60, *[None] * 6)]])
def test_few_documents(spark, rows):
    got = suffixes.cut_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_windows_have_one_context_each(monkeypatch):
    """Contexts do not depend on where slices end, but for being cut there, and cover each window once."""
    texts = [r[1].encode() for r in with_passages(2) if r[1]]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    anchors = []
    for size in (1 << 19, 100):
        monkeypatch.setattr(suffixes, "SLICE", size)
        c = suffixes.contexts(data, offsets)
        of = {w: a for f, last, a in zip(c.first, c.last, c.anchor) for w in range(f, last + 1)}
        assert len(of) == sum(c.last - c.first + 1) == sum(max(len(t) - 49, 0) for t in texts)
        assert all(w <= a <= w + suffixes.BACK for w, a in of.items())
        anchors.append(of)
    assert anchors[0] == anchors[1]


@pytest.mark.parametrize("k", [1, 2, 5, 16])
def test_loser_tree_merges_and_compares_no_known_byte(k):
    rng = random.Random(k)
    runs = [sorted("".join(rng.choice("ab") for _ in range(10)).encode() for _ in range(rng.randint(0, 40))) for _ in range(k)]

    class Counted(bytes):
        read = 0

        def __getitem__(self, i):
            if isinstance(i, int):
                Counted.read += 1
            return bytes.__getitem__(self, i)

    strings = [Counted(s) for run in runs for s in run]
    known = [len(os.path.commonprefix([run[i - 1], s])) if i else 0 for run in runs for i, s in enumerate(run)]
    ends = np.cumsum([len(r) for r in runs]).tolist()
    order, shared = suffixes.merge(strings, known, [e - len(r) for e, r in zip(ends, runs)], ends)
    merged = [bytes(strings[i]) for i in order]
    assert merged == sorted(merged) and sorted(order) == list(range(len(strings)))
    assert shared == [len(os.path.commonprefix([merged[i - 1], s])) if i else 0 for i, s in enumerate(merged)]
    # each byte of a string is found equal at most once, and each comparison ends with one that differs
    assert Counted.read <= 2 * (sum(len(s) for s in strings) + len(strings) * (k.bit_length() + 1))


def test_front_coding_round_trip():
    rng = np.random.default_rng(3)
    n = 300
    after, before = rng.integers(20, 51, n), rng.integers(0, 31, n)
    suffix = rng.integers(0, 2, (n, 50)).astype(np.uint8)
    suffix[np.arange(50) >= after[:, None]] = 0
    order = suffixes.sorted_rows(suffixes.as_words(suffix), np.zeros(n, np.int64))
    assert [bytes(suffix[i]) for i in order] == sorted(map(bytes, suffix))
    left = rng.integers(1, 3, (n, 30)).astype(np.uint8)
    left[np.arange(30) >= before[:, None]] = 0
    run = suffixes.Run(None, suffix[order], left, after[order], before, np.arange(n), None, None, None)
    raw = [suffixes.encode(run, 0, 120), suffixes.encode(run, 120, n)]
    _, s, l, a, b, m = suffixes.decode(raw, [120, n - 120])
    assert (s == run.suffix).all() and (l == left).all() and (a == run.after_length).all() and (b == before).all() and (m == np.arange(n)).all()
