"""Reply threads against a walk in Python."""

import json
import random
from datetime import datetime, timedelta

import pytest

from tracefoundry.operators.replies import threads
from tracefoundry.sources.collectors import ReplyChainCollector

BEGIN = datetime(2025, 1, 1)


def brute(rows):
    first = {}
    for id_, reply, at in rows:
        if id_ is not None:
            key = (at is not None, at or BEGIN, reply is not None, reply or 0)
            if id_ not in first or key < first[id_][0]:
                first[id_] = (key, reply, at)
    parent = {i: (r if r in first and r != i else None) for i, (_, r, _) in first.items()}
    orphan = {i: r is not None and r not in first for i, (_, r, _) in first.items()}
    looped = set()
    for start in sorted(first):
        seen, i = [], start
        while i is not None and i not in seen:
            seen.append(i)
            i = parent[i]
        if i is not None:
            ring = seen[seen.index(i) :]
            looped.add(min(ring))
            parent[min(ring)] = None
    answers = {i: [] for i in first}
    for i, p in parent.items():
        if p is not None:
            answers[p].append(i)
    out = []
    for root in (i for i, p in parent.items() if p is None):
        order, stack = [], [(root, 0)]
        while stack:
            i, depth = stack.pop()
            order.append((i, depth))
            own = sorted(answers[i], key=lambda x: (first[x][2] is not None, first[x][2] or BEGIN, x), reverse=True)
            stack += [(x, depth + 1) for x in own]
        out += [(i, root, depth, place, len(order), orphan[i], i in looped) for place, (i, depth) in enumerate(order)]
    return sorted(out)


def check(spark, rows, **options):
    got = threads(spark.createDataFrame(rows, "id long, reply_to long, ts timestamp").repartition(3), **options)
    assert got.columns == ["id", "root", "depth", "place", "size", "orphan", "looped"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("seed", range(2))
def test_random_forests(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(1000), 150)
    at = lambda: None if rng.random() < 0.1 else BEGIN + timedelta(hours=rng.randint(0, 90))
    rows = [(i, None if rng.random() < 0.2 else rng.choice(ids) if rng.random() < 0.9 else 5000 + i, at()) for i in ids]
    rows += [rows[0], rows[0], (ids[1], ids[2], at()), (None, ids[0], at()), (None, None, None), (7777, 7777, at())]
    check(spark, rows, seconds=7200)


def test_chain_hub_and_ring(spark):
    """A chain of 300, a message with 400 answers, a ring of 40 with tails, two rings of two."""
    day = lambda i: BEGIN + timedelta(hours=i)
    rows = [(i, i - 1 if i else None, day(i)) for i in range(300)]
    rows += [(1000, 7, day(1))] + [(1001 + i, 1000, day(i // 3)) for i in range(400)]
    rows += [(2000 + i, 2000 + (i + 1) % 40, day(i)) for i in range(40)] + [(2100 + i, 2000 + i, day(0)) for i in range(5)]
    rows += [(3000, 3001, None), (3001, 3000, None), (3003, 3002, None), (3002, 3003, None)]
    check(spark, rows)


def test_chat_exports_become_threads(spark, tmp_path):
    """Both platforms' files, parts of texts, service messages, one id in two chats."""
    telegram = [
        {"id": 1, "type": "message", "date": "2025-01-01T10:00:00", "from": "a", "text": ["BTC looks ", {"type": "bold", "text": "heavy"}]},
        {"id": 2, "type": "message", "date": "2025-01-01T10:05:00", "from": "b", "text": "why?", "reply_to_message_id": 1},
        {"id": 3, "type": "message", "date": "2025-01-01T10:06:00", "from": "a", "text": "funding", "reply_to_message_id": 2},
        {"id": 4, "type": "message", "date": "2025-01-01T10:01:00", "from": "c", "text": "agreed", "reply_to_message_id": 1},
        {"id": 5, "type": "service", "date": "2025-01-01T10:01:00"},
    ]
    for chat, messages in (("x", telegram), ("y", telegram[:1])):
        (tmp_path / "telegram" / chat).mkdir(parents=True)
        (tmp_path / "telegram" / chat / "result.json").write_text(json.dumps({"name": chat, "messages": messages}))
    got = ReplyChainCollector(export_path=str(tmp_path / "telegram")).collect(spark).collect()
    assert sorted(r["raw_text"] for r in got) == ["a: BTC looks heavy", "a: BTC looks heavy\n  c: agreed\n  b: why?\n    a: funding"]
    assert {(r["source"], r["instrument"], r["timestamp_context"][:19]) for r in got} == {("chat_log", "BTC/USDT", "2025-01-01T10:00:00")}
    (tmp_path / "d.json").write_text(json.dumps({"messages": [{"id": "9", "timestamp": "2025-01-01T10:00:00+00:00", "author": {"name": "d"}, "content": "ETH"}, {"id": "10", "timestamp": "2025-01-01T10:00:01+00:00", "author": {"name": "e"}, "content": "no", "reference": {"messageId": "9"}}]}))
    (one,) = ReplyChainCollector(export_path=str(tmp_path / "d.json"), platform="discord").collect(spark).collect()
    assert one["raw_text"] == "d: ETH\n  e: no" and one["metadata"] == {"root": "9", "messages": "2", "platform": "discord"}


@pytest.mark.parametrize("rows", [[], [(1, 2, None), (None, 1, None), (3, 3, None)]])
def test_few_messages(spark, rows):
    check(spark, rows)
