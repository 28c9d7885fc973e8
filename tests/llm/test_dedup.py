"""Exact, MinHash, embedding and line dedup against brute force."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracefoundry.llm import common, embed, exact, lines, minhash, mixing, textkit, trie
from tracefoundry.llm.components import connected_components

from .cases import DOCS, components, documents, frame, prose

SPACE = r"[\x20\x09-\x0D]+"


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(SPACE, "", r[1] or "")].append(r)
    out = []
    for text, own in groups.items():
        best = min(own, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        out += [(r[0], best, len(own), r[0] == best, hashlib.sha256(text.encode()).hexdigest()) for r in own]
    return sorted(out, key=repr)


@pytest.mark.parametrize("capacity", [1, 512])
def test_exact(spark, capacity, monkeypatch):
    monkeypatch.setattr(exact, "MAX_DEPTH", 3 if capacity == 1 else 14)
    rows = documents()
    got = exact.exact_duplicates(frame(spark, rows), capacity=capacity)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_exact(rows)


def test_exact_chains_collisions(spark, monkeypatch):
    """With one key for all texts every difference is a collision, found by comparing bytes."""
    monkeypatch.setattr(exact, "CELL", 3)
    monkeypatch.setattr(exact, "hash_key", lambda c: exact.F.lit(5).cast("long"))
    rows = documents(n=6)[:14]
    got = exact.exact_duplicates(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_exact(rows)


def test_exact_copies_a_common_head_in_many_tasks(spark, monkeypatch):
    """A key with 300 cells: no task copies more than a fan of its head, and the result is the same."""
    monkeypatch.setattr(exact, "CELL", 10)
    monkeypatch.setattr(exact, "FAN", 4)
    rows = [(i, "the same " * (1 + i % 2) if i % 3 else f"own {i}") for i in range(3000)]
    got = exact.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_exact(rows)
    heads = spark.range(3).selectExpr("1L AS bucket", "id AS key", "cast(if(id = 0, 300, id) AS int) AS cells", "'h' AS head")
    cells = exact._fanned(heads, 300, 8)
    assert sorted(map(tuple, cells.select("key", "cell").collect())) == sorted((k, c) for k, n in ((0, 300), (1, 1), (2, 2)) for c in range(n))
    assert max(r["count"] for r in cells.where("key = 0").groupBy(F.spark_partition_id()).count().collect()) < 150


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("times", [1, 5, 4000])
def test_spread_join_meets_a_plain_join(spark, tmp_path, how, times):
    """One key of ``times`` rows, keys without a partner, null keys, null values."""
    keys = ["hot"] * times + [f"k{i % 300}" for i in range(900)] + [None] * 700
    spark.createDataFrame(list(enumerate(keys)), "at long, key string").write.parquet(f"{tmp_path}/rows")
    one = [("hot", times, None), *((f"k{i}", 3, i if i % 2 else None) for i in range(0, 300, 4))]
    spark.createDataFrame(one, "key string, times long, value long").write.parquet(f"{tmp_path}/one")
    rows, one = spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/one")
    want = sorted(map(repr, rows.join(one, ["key"], how).select("at", "key", "times", "value").collect()))
    for idle in (None, F.col("key").isNull()):
        got = common.spread_join(rows, one, ["key"], "times", len(keys), how, idle)
        assert sorted(map(repr, got.select("at", "key", "times", "value").collect())) == want


def test_directory_splits_and_doubles():
    slots = exact.directory({0: 3, 1: 3, 7: 1}, capacity=3, max_depth=3)
    assert len(slots) == 8
    assert len({b for b, _ in slots}) == 4 and slots[0] != slots[1] and slots[4] == slots[7]
    assert exact.directory({}, 1, 3) == [(0, 0)]
    # beyond the directory's depth a bucket splits on as many bits as its count asks for
    assert exact.directory({5: 100}, 10, 3)[5] == (5, 3 + 4)


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_near(rows):
    sets = {r[0]: shingle_set(r[1]) for r in rows if r[0] is not None}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = components(ids, links)
    return sorted(((r[0], len(shingle_set(r[1])), comp.get(r[0]), comp.get(r[0]) == r[0]) for r in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_minhash(spark, seed):
    rows = documents(seed)
    got = minhash.near_duplicates(frame(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((i, n, c, True if i is None else k) for i, n, c, k in brute_near(rows)), key=repr)


@pytest.mark.parametrize("fan", [1, 3, 1024])
def test_minhash_hub_and_borderline_group(spark, monkeypatch, fan):
    """Copies of one text that reach the threshold with it but not with each other, more than a cell."""
    monkeypatch.setattr(minhash, "CELL", 4)
    monkeypatch.setattr(minhash, "FAN", fan)
    rng = random.Random(3)
    base = prose(rng, 100).split()
    rows = [(500, " ".join(base))]
    for i in range(20):
        w = list(base)
        for p in rng.sample(range(100), 2 + i % 3):
            w[p] = f"new{i}x{p}"
        rows.append((i, " ".join(w)))
    passage = prose(rng, 40)
    rows += [(1000 + i, passage + " " + prose(rng, 20)) for i in range(20)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_near(rows)


def test_sketch_estimates_similarity():
    rng = random.Random(5)
    a = prose(rng, 400).split()
    b = a[:300] + prose(rng, 100).split()
    texts = [" ".join(a), " ".join(b), "one", ""]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    packed, sizes = textkit.shingles(textkit.words(np.frombuffer(data, np.uint8), offsets))
    assert sizes.tolist() == [len(shingle_set(t)) for t in texts]
    sig = minhash.sketch(packed, 4)
    x, y = shingle_set(texts[0]), shingle_set(texts[1])
    assert abs((sig[0] == sig[1]).mean() - len(x & y) / len(x | y)) < 0.2
    assert len(set(sig[2].tolist())) > 100  # one element fills every coordinate


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    for f in (exact.exact_duplicates, minhash.near_duplicates, lines.fuzzy_lines, lines.drop_lines, mixing.mix, trie.token_counts):
        assert f(none).count() == 0
    assert embed.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(0, 5000 + i) for i in range(50)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components({x for e in edges for x in e}, edges)
    assert {k: v for k, v in want.items() if k in got} == got
    assert all(a == b for e in edges for a, b in [e] if a not in got)


def brute_vectors(rows, threshold=0.93):
    def ok(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n, links = defaultdict(int), []
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if ok(a) and ok(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    n[a[0]] += 1
                    n[b[0]] += 1
                    links.append((a[0], b[0]))
    comp = components({r[0] for r in rows if r[0] is not None}, links)
    return sorted(((r[0], n[r[0]] if ok(r) else 0, comp.get(r[0]), r[0] is None or comp[r[0]] == r[0]) for r in rows), key=repr)


@pytest.mark.parametrize("per_cell", [2000, 20])
def test_embeddings(spark, monkeypatch, per_cell):
    monkeypatch.setattr(embed, "BLOCK", 8)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(120):
        v = rng.normal(size=16)
        for j in range(rng.integers(1, 5)):
            rows.append((len(rows), (v + rng.normal(size=16) * 0.1 * (j > 1)).astype(np.float32).tolist(), int(i % 3)))
    k = len(rows)
    rows += [(k, None, 1), (k + 1, [], 1), (k + 2, [0.0] * 16, 1), (k + 3, [float("nan")] * 16, 1), (k + 4, [float("inf")] + [1.0] * 15, 1), (k + 5, rows[0][1], None), (k + 6, [1.0, None] + [1.0] * 14, 0), (k + 7, [1.0, 2.0], 0), (k + 8, [2.0, 4.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, links int").repartition(3)
    got = sorted((tuple(r) for r in embed.near_vectors(df, per_cell=per_cell).collect()), key=repr)
    assert got == brute_vectors(rows)


def test_embeddings_of_any_magnitude(spark):
    """Squares of the largest and the smallest numbers neither overflow nor vanish."""
    rows = [(0, [1e200, 1e200], 0), (1, [1e200, 1.01e200], 0), (2, [1e-200, 1e-200], 1), (3, [1.0, 0.0], 1), (4, [5e-300, 5e-300], 1), (5, [1e308, -1e308], 2), (6, [1e-308, 1e-308], 2)]
    got = embed.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 0, True), (1, 1, 0, False), (2, 1, 2, True), (3, 0, 3, True), (4, 1, 2, False), (5, 0, 5, True), (6, 0, 6, True)]
    with pytest.raises(ValueError):
        embed.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), threshold=0.0)


@pytest.mark.parametrize(("n", "sample", "fitted", "per_cell"), [(1000, 500, 2, 10), (550, 16_384, 1, 2)])
def test_embeddings_near_threshold_in_many_cells(spark, monkeypatch, n, sample, fitted, per_cell):
    """Pairs just above the threshold, without clusters, in 128 and in 512 cells, fitted on few or all of them: every link is found."""
    monkeypatch.setattr(embed, "SAMPLE", sample)
    monkeypatch.setattr(embed, "FITTED", fitted)
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(2, n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.931 * x + np.sqrt(1 - 0.931**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, y]))]
    rows += [(2 * n + i, v.tolist(), 1) for i, v in enumerate(y[:9])]
    # labels of any type
    got = embed.near_vectors(spark.createDataFrame([(i, v, f"l{k}") for i, v, k in rows], "vec_id long, embedding array<double>, label string"), per_cell=per_cell)
    assert sorted(map(tuple, got.collect())) == sorted((i, int(i < 2 * n), i % n if i < 2 * n else i, i < n or i >= 2 * n) for i, _, _ in rows)


def line_set(line):
    raw = line.strip(" ").lower()
    return {raw[i : i + 8] for i in range(len(raw) - 7)} if len(raw) >= 8 else ({raw} if raw else set())


def test_fuzzy_lines(spark):
    rng = random.Random(9)
    pool = [prose(rng, rng.randint(1, 30)) for _ in range(25)]
    rows = []
    for i in range(40):
        own = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(pool)
            if rng.random() < 0.5:
                at = rng.randrange(len(line) + 1)
                line = line[:at] + "#" + line[at:]
            own.append(rng.choice(["", " ", line, line.upper(), line + " "]))
        rows.append((i, "\n".join(own)))
    rows += [(40, None), (41, ""), (None, pool[0])]
    got = {(r[0], r[1]): tuple(r)[2:] for r in lines.fuzzy_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    places = {(i, n): line_set(x) for i, t in rows if i is not None for n, x in enumerate((t or "").split("\n"))}
    keys = sorted(places)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if places[a] and 100 * len(places[a] & places[b]) >= 75 * len(places[a] | places[b])]
    comp = components(keys, links)
    assert {k: (*v, v == k) for k, v in comp.items()} == {k: v for k, v in got.items() if k[0] is not None}
    assert got[(None, 0)] == (None, 0, True)
    kept = {r["doc_id"]: r["text"] for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all((kept[i] or "") == "\n".join(x for n, x in enumerate((t or "").split("\n")) if comp[(i, n)] == (i, n)) for i, t in rows if i is not None)


def test_lines_of_shared_doc_ids_and_a_very_long_line(spark):
    """Two texts under one doc_id keep their own lines; a line of 1 MB links with its near copy."""
    rng = random.Random(12)
    long = prose(rng, 200_000)
    rows = [(1, "alpha beta gamma delta\nsecond line of one"), (1, "other words stand here\nalpha beta gamma delta"), (2, "alpha beta gamma delta!\nown line"), (3, long), (4, long[:-9] + "!"), (5, "x" * 1_000_000)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, whole string")
    got = {(r["doc_id"], r["text"]) for r in lines.drop_lines(docs).collect()}
    first = [t for i, t in rows if i == 1]
    # of the two texts that hold the line, the one that comes first keeps it
    assert (2, "own line") in got and (3, long) in got and (4, "") in got and (5, "x" * 1_000_000) in got
    kept = {t for i, t in got if i == 1}
    assert kept in ({first[0], "other words stand here"}, {"second line of one", first[1]})


@pytest.mark.parametrize("chunk", [1 << 19, 64])
def test_buckets_meet_once(spark, monkeypatch, chunk):
    """Buckets with two documents or more, each row once, whether they share it where they arise or not."""
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rng = random.Random(5)
    rows = [(i, [rng.randrange(400) + 1000 * b for b in range(4)] + [7]) for i in range(300)]
    made = spark.createDataFrame(rows + rows[:20], "doc_id long, buckets array<long>").repartition(3)
    got = {(r["bucket"], r["doc_id"]) for r in minhash.buckets_of(made, minhash.Scheme("t", minhash.word_shingles, 5, 1)).collect()}
    by = defaultdict(set)
    for i, own in rows:
        for b in own:
            by[b].add(i)
    assert got == {(b, i) for b, own in by.items() if len(own) > 1 for i in own}


def test_many_short_near_equal_lines(spark, monkeypatch):
    """Members that fill many blocks, with and without the filter of very large sets, give the same components."""
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("ab") for _ in range(14))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, lines.fuzzy_lines(docs).collect()))
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 100)
    monkeypatch.setattr(minhash, "DIRECT", 50)
    assert sorted(map(tuple, lines.fuzzy_lines(docs).collect())) == want


def test_mix_deals_rows_repeated_whole(spark):
    """4,000 repeats of one row are in all ranges, and the mix still comes near its targets."""
    rows = [(7, "one two three", "a")] * 4000 + [(100 + i, f"w{i} x", "b") for i in range(1000)]
    bins = []
    real = mixing.cut

    def seen(df, name):
        out = real(df, name)
        if name == "op4-ranged":
            bins.extend(r["count"] for r in out.groupBy("bin").count().collect())
        return out

    mixing.cut = seen
    try:
        got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).collect()
    finally:
        mixing.cut = real
    assert len(bins) == 4 and max(bins) < 2 * 5000 / 4
    for source in ("a", "b"):
        own = [r for r in got if r["doc_id"] == 7] if source == "a" else [r for r in got if r["doc_id"] != 7]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3
