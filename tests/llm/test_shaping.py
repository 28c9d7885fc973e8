"""Mixing, chat formatting, packing, URL filters, token counts, classifier and pipeline."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracefoundry.llm import chat, mixing, packing, quality, tokens, trie, urls

from .cases import DOCS, documents, frame, prose

SPACE = r"[^\x20\x09-\x0D]+"


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix(spark, seed):
    rows = documents(seed)
    if seed == 3:
        rows = [(*r[:3], "only" if r[0] != rows[0][0] else None, *r[4:]) for r in rows]
    got = mixing.mix(frame(spark, rows)).collect()
    again = mixing.mix(frame(spark, rows[::-1])).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    size = {i: len(re.findall(SPACE, t or "")) for i, t, *_ in rows}
    by = defaultdict(int)
    for r in rows:
        by[r[3]] += size[r[0]]
    want = brute_targets(by)
    source = {r[0]: r[3] for r in rows}
    taken, most = defaultdict(int), defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], by[s])
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
        most[s] = max(most[s], r["size"])
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1 for s in by)


@pytest.mark.parametrize("quality", [None, 1000.0, 0.001])
def test_mix_takes_what_a_sampler_takes(spark, quality):
    """``taken`` row by row against keys sorted in Python: whole epochs, then the prefix that meets the target."""
    rows = [r for r in documents(5) if r[1] and r[0] is not None]
    df = frame(spark, rows)
    weight = mixing.letter_share(F.col("text")) if quality is None else F.lit(quality)
    keys = df.select("doc_id", (-F.log(mixing.unit(F.xxhash64("doc_id", "text"))) / weight).alias("key"))
    keys = {r["doc_id"]: r["key"] for r in keys.collect()}
    got = sorted((r["doc_id"], r["taken"]) for r in mixing.mix(df, quality=None if quality is None else weight).collect())
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((keys[r[0]], r[0], len(re.findall(SPACE, r[1]))))
    size = {s: sum(n for *_, n in own) for s, own in by.items()}
    target, want = brute_targets(size), []
    for s, own in by.items():
        epochs = int(target[s] // size[s]) if size[s] else 0
        at = 0
        for _, doc, n in sorted(own):
            want.append((doc, n * (epochs + (at + n / 2 <= target[s] - epochs * size[s]))))
            at += n
    assert got == sorted(want)


def test_mix_prefers_quality_and_follows_keys(spark):
    rows = [(i, "w " * 10, "a" if i % 2 else "b", 1.0 if i % 3 else 0.01) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, q double")
    got = {r["doc_id"]: r["taken"] for r in mixing.mix(df, quality=F.col("q"), weights=(1, 3), share=0.5).collect()}
    good, bad = ([got[i] > 0 for i in got if (i % 3 > 0) == g and i % 2 == 0] for g in (True, False))
    assert np.mean(good) > np.mean(bad) + 0.3


def unescape(s):
    return s.replace("\\b", "[").replace("\\a", "<").replace("\\e", "\\")


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "a\\b\\e\\\\a", "[ROLE]x[/ROLE]</s><s>", "[[ROLE]", "", "日本\n", None, "\\[INST]"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "</s>", None]), rng.choice(nasty)) for c in range(20) for t in range(rng.randint(1, 8))]
    rows += [(99, 0, "user", "twice"), (99, 0, "user", "twice"), (None, 1, "user", "x"), (98, None, "assistant", "late"), (98, 5, "user", "early")]
    rows += [(97, 2**62, "user", "x" * 2_000_000 + "</s>"), (97, 2**62 + 1, "assistant", "y[INST]" * 200_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    made = chat.format_chats(chat.conversation_events(df))
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    raw = {r["conv_id"]: r["formatted"] for r in made.collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is None, t, r or "", x or ""))
    assert set(back) == set(by)
    for c, own in by.items():
        own = sorted(own, key=lambda r: (r[0], r[1] or 0))
        loss = "".join(x for *_, r, x in own if r == "assistant")
        turns = hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in own).encode()).hexdigest()
        parts = [p[len("[ROLE]"):].split("[/ROLE]") for p in raw[c].split("</s>")[:-1]]
        assert [(unescape(a), unescape(b)) for a, b in parts] == [(r, x) for *_, r, x in own]
        assert tuple(back[c]) == (c, len(own), turns, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(raw[c]))


def test_read_back_counts_turns_of_the_text(spark):
    """A text that escapes nothing makes turns that its mask does not have."""
    bad = spark.createDataFrame([(1, "[ROLE]user[/ROLE]a</s>b</s>", [False])], "conv_id long, formatted string, loss_turns array<boolean>")
    with pytest.raises(Exception, match="turns of its mask"):
        chat.read_back(bad).collect()


def test_event_fold(spark):
    log = [
        (1, 1, "a", "message", "user", "hi"), (1, 2, "b", "message", "assistant", None), (1, 3, "b", "delta", None, "one "), (1, 5, "b", "delta", None, "two"),
        (1, 7, "b", "regenerate", None, None), (1, 8, "b", "delta", None, "three"), (1, 9, "a", "edit", None, "hello"), (1, 10, "c", "message", "user", "gone"),
        (1, 11, "c", "delete", None, None), (1, 12, "d", "delta", "tool", "x"), (1, 13, "d", "odd", None, "y"),
    ]
    df = spark.createDataFrame(log, "conv_id long, seq long, message string, kind string, role string, text string").repartition(4)
    got = [(r["role"], r["text"]) for r in chat.fold(df).orderBy("place").collect()]
    assert got == [("user", "hello"), ("assistant", "three"), ("tool", "x")]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_packing(spark):
    rows = documents(n=80)
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack(frame(spark, rows)).collect()
    ids = {r[0]: [*model.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    times = defaultdict(int)
    for r in rows:
        times[r[0]] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert own == list(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    for doc, own in by_doc.items():
        covered = sorted((r["start"], r["length"]) for r in own)
        want = [(s, min(2048, len(ids[doc]) - s)) for s in range(0, len(ids[doc]), 2048) for _ in range(times[doc])]
        assert covered == want
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    tokens_all = sum(r["length"] for r in got)
    assert len(by_sequence) <= -(-tokens_all // 2048) + 2
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


def test_plan_places_each_rank_once():
    rng = np.random.default_rng(2)
    lengths, counts = np.unique(np.minimum(rng.gamma(1.2, 500, 20_000).astype(int) + 1, 2047), return_counts=True)
    histogram = dict(zip(lengths.tolist(), counts.tolist())) | {2048: 7}
    runs = packing.plan(histogram)
    seen, fill = defaultdict(list), defaultdict(list)
    for n, a, b, s, o in runs:
        seen[n].append((a, b))
        for i in range(b - a):
            fill[s + i].append((o, n))
    for n, spans in seen.items():
        spans.sort()
        assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == histogram[n]
    total = 0
    for own in fill.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 2048
        total += at
    assert total == sum(n * c for n, c in histogram.items())
    assert total / (2048 * len(fill)) > 0.998


def test_word_cache_is_exact(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    own = tokens.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(3)
    texts = [None, "", "don't stop's 'ST x's.", "a<|endoftext|>b <|ENDOFTEXT|>", "end... a.b, x*** (ok). é. y.\tz-", "ΣΑΣ. ΟΔΟΣ İstanbul été x\u00a0y", "12ab34 $$$ ab### ''", "Á́ 日本語 テスド 가각", "x\x1cy z\x85w"]
    texts += [prose(rng, 200).replace("th", rng.choice(["TH", "é", "'", "3", "|"])) for _ in range(20)]
    for part in (texts[:5], texts[5:20], texts[20:], texts):
        ids, at = own.encode(part)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [own.model.encode(t or "", add_special_tokens=False).ids for t in part]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, "allow"))


@pytest.mark.parametrize("most", [100_000, 0])
def test_urls(spark, most):
    hosts = ["example.org", "www.EXAMPLE.org", "org", "a.org", "borg", "example.com", "com", "x.com", "example.net", "", "a..org", ".org", "notexample.org", "Ä.org"]
    paths = ["", "/", "/es", "/es/", "/es/x?y#z", "/en/1", "/en/12/", "/en/2", "/fr/1", "/de/", "/DE/", "?a=/es/", "#/de/", "/fr\n/", "/é"]
    all_urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no-scheme.org/es/", "://", "a://b://example.org/es/", "x\n://org/"]
    rows = [(i, u, "<p>", "h", "p") for i, u in enumerate(all_urls)]
    rows += [rows[3], rows[3], (None, "http://org/", None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string").repartition(3)
    got = urls.judge_urls(df, broadcast_rules=most)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((r[0], *judged(r[1])) for r in rows), key=repr)
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_token_counts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = trie.zipf_pieces(path)
    model = trie.Unigram(pieces)

    def brute(w):
        best = [0] * (len(w) + 1)
        for i in range(1, len(w) + 1):
            best[i] = max([best[i - 1] + model.odd, *(best[j] + pieces[w[j:i]] * trie.COUNT - 1 for j in range(max(0, i - 64), i) if w[j:i] in pieces)])
        return -best[-1] % trie.COUNT

    rows = documents(n=20)
    got = {(r[0], r[1], r[2]) for r in trie.token_counts(frame(spark, rows)).collect()}
    want = set()
    for i, t, *_ in rows:
        own = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        want.add((i, len(own), sum(brute(trie.MARK + w) for w in own) if len(own) < 5000 else None))
    assert {w for w in want if w[2] is not None} <= got and len(got) == len(want)


def test_token_counts_of_a_long_word(monkeypatch):
    """Values that start again every few bytes count the same tokens, also beyond what one value can hold."""
    pieces = {b"a": -10, b"ab": -15, b"bab": -18, b"c" * 9: -30}
    rng = random.Random(1)
    words = sorted({bytes(rng.choice(b"abcx") for _ in range(n)) for n in (1, 5, 40, 41, 300, 3_000)} | {b"c" * 2_000, b"ab" * 700})
    whole = trie.Unigram(pieces).counts(words)

    def brute(w):
        model, best = trie.Unigram(pieces), [0]
        for i in range(1, len(w) + 1):
            best.append(max([best[i - 1] + model.odd, *(best[j] + pieces[w[j:i]] * trie.COUNT - 1 for j in range(max(0, i - 9), i) if w[j:i] in pieces)]))
        return -best[-1] % trie.COUNT

    assert whole.tolist() == [brute(w) for w in words]
    monkeypatch.setattr(trie, "REBASE", 16)
    assert trie.Unigram(pieces).counts(words).tolist() == whole.tolist()
    monkeypatch.setattr(trie, "COUNT", 1 << 10)
    assert trie.Unigram(pieces).counts(words).tolist() == whole.tolist()


def test_classifier_learns_without_labels(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        text = ". ".join(prose(rng, 9).capitalize() for _ in range(rng.randint(2, 12))) + "."
        bad = i % 5 == 0
        if bad:
            text = rng.choice([lambda t: t.upper().replace(" ", "!! "), lambda t: t.replace(" ", "*** "), lambda t: t.replace(" ", " | "), lambda t: (t.split()[0] + " ") * 120])(text)
        rows.append((i, text, bad))
    rows += [(400, None, True), (401, "", True), (402, "two words", False), (403, "x" * 300_000, True)]
    df = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, score double").repartition(3)
    got = {r["doc_id"]: r for r in quality.classify(df).collect()}
    wrong = [i for i, _, bad in rows if got[i]["kept"] == bad]
    assert len(got) == len(rows) and len(wrong) <= 4
    assert quality.classify(df.limit(0)).count() == 0


def votes_of(truth, on_bad, on_good, rng, silent=0.2):
    """Votes that call bad documents bad and good ones good with the given accuracies."""
    right = rng.random((len(truth), len(on_bad))) < np.where(truth[:, None], on_good, on_bad)
    votes = np.where(right == truth[:, None], 1, -1)
    return np.where(rng.random(votes.shape) < silent, 0, votes)


@pytest.mark.parametrize("alarms", [0.05, 0.1, 0.2])
def test_em_recovers_accuracies(alarms):
    """Production setting: labellers that misfire on 5 to 20 % of good documents."""
    rng = np.random.default_rng(8)
    truth = rng.random(40_000) < 0.8
    k = len(quality.LABELLERS)
    on_bad, on_good = np.linspace(0.6, 0.95, k), 1 - alarms * np.linspace(0.8, 1.2, k)
    pattern = quality._pattern(votes_of(truth, on_bad, on_good, rng))
    p, n = np.unique(pattern, return_counts=True)
    got = quality.estimate(dict(zip(p.tolist(), n.tolist())))
    assert np.mean((np.array([got.posterior[x] for x in pattern.tolist()]) > 0.5) == truth) > 0.97
    assert abs(got.share - truth.mean()) < 0.02
    assert np.abs(got.accuracy - np.stack([on_bad, on_good])).max() < 0.03


def test_em_meets_brute_force_likelihood():
    """Three labellers: no point of a fine search around the estimate has a higher likelihood."""
    rng = np.random.default_rng(3)
    truth = rng.random(5_000) < 0.7
    votes = votes_of(truth, np.array([0.9, 0.8, 0.7]), np.array([0.85, 0.9, 0.95]), rng, silent=0.0)
    pattern = quality._pattern(votes)
    p, n = np.unique(pattern, return_counts=True)
    got = quality.estimate(dict(zip(p.tolist(), n.tolist())), labellers=3, steps=5_000)
    seen = (p[:, None] // 3 ** np.arange(3) % 3) == 2

    def likelihood(x):
        share, bad, good = x[0], x[1:4], x[4:7]
        return float((n * np.log(share * np.where(seen, good, 1 - good).prod(axis=1) + (1 - share) * np.where(seen, 1 - bad, bad).prod(axis=1))).sum())

    at = np.concatenate([[got.share], *got.accuracy])
    best = likelihood(at)
    near = [likelihood(np.clip(at + rng.normal(size=7) * s, 0.01, 0.99)) for s in (0.3, 0.1, 0.03, 0.01) for _ in range(2_000)]
    assert max(near) <= best + 0.5


def test_variety_does_not_follow_length():
    """A text's measures are those of its windows: ten times the text is no less varied."""
    rng = random.Random(2)
    one = prose(rng, 3_000)
    ten = " ".join(prose(rng, 3_000) for _ in range(10))
    data = (one + ten).encode()
    m = quality.Measures(np.frombuffer(data, np.uint8), np.array([0, len(one), len(data)]))
    assert abs(m.variety[0] - m.variety[1]) < 0.02 and abs(m.bigrams[0] - m.bigrams[1]) < 0.02
    w = one.split()
    assert m.variety[0] == pytest.approx(sum(len(set(w[i : i + 200])) for i in range(0, 3_000, 200)) / 3_000)


def test_held_out_labels(spark):
    import os

    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("no test data")
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs).join(labels, "doc_id").collect()
    clean, junk = ([r["kept"] for r in got if r["quality"] == q] for q in (1, 0))
    assert np.mean(clean) > 0.99 and np.mean(junk) < 0.05


def test_pipeline(spark):
    import corpus_pipeline as p

    rows = [(*r[:5],) for r in documents(n=40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = [df]
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, kept[-1], "")
        assert out.columns == p.COLUMNS, name
        kept.append(spark.createDataFrame(out.collect(), df.schema))
    original = {r[:2] for r in rows}
    assert all((r["doc_id"], r["text"]) in original for d in kept for r in d.collect())
    after = [re.sub(r"\s", "", r["text"] or "") for r in kept[2].dropDuplicates(["doc_id"]).collect()]
    assert len(after) == len(set(after))
    last = p.STAGES[-1][1](spark, kept[-1], "").collect()
    assert {r["doc_id"] for r in last} == {r["doc_id"] for r in kept[-1].collect()}


def test_pipeline_decides_by_row(spark):
    """Rows repeated whole, null doc_ids and shared doc_ids: one row per group, each as often as the mix takes it."""
    import corpus_pipeline as p

    rng = random.Random(4)
    a, b, c = (prose(rng, 60) for _ in range(3))
    near = a.split()
    near[-1] = "other"
    texts = [(1, a), (1, a), (None, a), (2, " ".join(near)), (None, " ".join(near)), (None, b), (None, b), (3, b + "  "), (None, c), (4, prose(rng, 50)), (4, prose(rng, 55))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], schema).repartition(3)
    once = p.exact_dedup(spark, docs, "").select("doc_id", "text").collect()
    assert sorted(map(tuple, once), key=repr) == sorted({(1, a), texts[3], (3, b + "  "), (None, c), *texts[9:]}, key=repr)
    one = p.near_dedup(spark, docs, "").select("doc_id", "text").collect()
    # two rows with doc_id 1 are one group, and its first
    assert sorted(map(tuple, one), key=repr) == sorted({(1, a), (3, b + "  "), (None, c), *texts[9:]}, key=repr)
    shared = [(7 if i % 2 else None, prose(rng, 10), "en", "s", 1) for i in range(40)]
    mixed = p.source_mix(spark, spark.createDataFrame(shared, schema), "").collect()
    assert len(mixed) == 60 and {r["text"] for r in mixed} == {r[1] for r in shared}


def test_pipeline_on_an_empty_table(spark):
    import corpus_pipeline as p

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, row long, points long, mark long, key string")
    for name, stage in p.STAGES:
        assert stage(spark, docs, "").count() == 0, name


def test_pipeline_ignores_other_columns(spark):
    """Columns with the names that stages use inside change nothing."""
    import corpus_pipeline as p

    rows = [r[:5] for r in documents(n=12)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    plain = spark.createDataFrame(rows, schema)
    more = spark.createDataFrame([(*r, 1, 2, 3, "k", 5, True) for r in rows], schema + ", row long, points long, mark long, key string, size long, kept boolean")
    for name, stage in p.STAGES[:-1]:
        a, b = (sorted(map(repr, stage(spark, d, "").collect())) for d in (plain, more))
        assert a == b, name
