"""Conversation repair against a search over all edits of each conversation."""

import hashlib
import random
import re
import zlib
from functools import cache

import pyarrow as pa
import pytest

from tracefoundry.llm import repair
from tracefoundry.llm.common import setting

from .cases import prose

SCHEMA = "conv_id long, turn long, role string, text string, times string, mark string, kind long, cost string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def rank(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute_damage(rows):
    """conv_id -> (turn, role, text) after damage."""
    out = {r[0]: [] for r in rows}
    for conv, turn, role, text, *_ in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, rank(r[1], r[2])))
    faults, seen = [], set()
    for _, role, text in rows:
        solid = SOLID.findall(text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {r[0] for r in rows} - {None}
    initials = [r[1][:1] for r in rows]

    @cache
    def best(i, said):
        """(cost, audit, messages) of the rest; ``said``: initials so far, as one letter."""
        options = [(0, "", ())] if i == len(rows) and said in ("", "a") else []
        spoken = "a" if said == "u" else "u"
        if i < len(rows):
            c, a, m = best(i + 1, said)
            options.append((c + 2, "D" + a, m))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if initials[i] == spoken or (initials[i] == "s" and said == ""):
                    c, a, m = best(i + 1, initials[i])
                    options.append((c + more, "K" + a, (f"{rows[i][1]}:{rows[i][2]}", *m)))
                c, a, m = best(i + 1, spoken)
                options.append((c + more + 1, "R" + a, ({"u": "user", "a": "assistant"}[spoken] + ":" + rows[i][2], *m)))
        # two insertions in a row are enough; more come back to where they began
        if i == len(rows):
            if said == "u":
                options.append((5, "I", ("assistant:",)))
            if said == "s":
                options.append((10, "II", ("user:", "assistant:")))
        else:
            options += [(5 + c, "I" + a, (("user:" if spoken == "u" else "assistant:"), *m)) for c, a, m in best_but_insert(i, spoken)]
        return min(options)

    @cache
    def best_but_insert(i, said):
        """Of a row after one insertion: with and without a second one."""
        out = []
        for first, state in ((None, said), ("a" if said == "u" else "u", "a" if said == "u" else "u")):
            options = []
            c, a, m = best(i + 1, state)
            options.append((c + 2, "D" + a, m))
            spoken = "a" if state == "u" else "u"
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if initials[i] == spoken:
                    c, a, m = best(i + 1, spoken)
                    options.append((c + more, "K" + a, (f"{rows[i][1]}:{rows[i][2]}", *m)))
                c, a, m = best(i + 1, spoken)
                options.append((c + more + 1, "R" + a, ({"u": "user", "a": "assistant"}[spoken] + ":" + rows[i][2], *m)))
            word = {"u": "user:", "a": "assistant:"}.get(first)
            out += [o if first is None else (o[0] + 5, "I" + o[1], (word, *o[2])) for o in options]
        return out

    cost, audit, said = best(0, "")
    return (
        conv,
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        faults.count("blank"),
        faults.count("duplicate"),
        faults.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(said).encode()).hexdigest(),
    )


def conversations(seed=1, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        length, turn = rng.choice([1, 2, 2, 3, 4, 5, 8, 13]), rng.randint(-2, 3)
        texts = [prose(rng, rng.randint(1, 6)) + rng.choice([".", "!", "? \n", "", ","]) for _ in range(4)]
        for i in range(length):
            role = ["system", "user", "assistant"][0 if not i and rng.random() < 0.3 else 1 + i % 2] if rng.random() < 0.7 else rng.choice(["user", "assistant", "system", "tool", "", None, "agent", "ünder"])
            text = rng.choice(texts) if rng.random() < 0.5 else prose(rng, 5) + "." if rng.random() < 0.9 else rng.choice([None, "", " \t\n\x0b", "日本。", "ü!", "x" * 50_000 + "."])
            rows.append((conv, turn if rng.random() < 0.95 else None, role, text, "9", "m", 3, "c"))
            turn += rng.choice([1, 1, 1, 1, 0, 3])
    rows += [(None, 0, "user", "no id.", "1", None, None, None), (None, 1, "assistant", "still none.", "1", None, None, None), rows[0], rows[5], rows[5]]
    rng.shuffle(rows)
    return rows


def wanted(rows):
    return sorted((brute(c, own) for c, own in brute_damage(rows).items()), key=repr)


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_repair_meets_a_search(spark, batch):
    rows = conversations()
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", batch):
        got = repair.repair(repair.damage(spark.createDataFrame(rows, SCHEMA).repartition(3)))
        assert got.columns == ["conv_id", *repair.FACTS, "audit", "repaired_sha256"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == wanted(rows)


def test_empty_table_and_conversations_without_rows(spark):
    assert repair.repair(repair.damage(spark.createDataFrame([], SCHEMA))).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = repair.repair(repair.damage(spark.createDataFrame([(gone, 0, "user", "hello", None, None, None, None)], SCHEMA))).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_a_conversation_with_most_rows(spark):
    rng = random.Random(4)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"{prose(rng, 2)} {i}" + rng.choice([".", ""]), None, None, None, None) for i in range(300)]
    rows += [(c, 0, "user", "hi.", None, None, None, None) for c in range(100, 200)]
    got = repair.repair(repair.damage(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == wanted(rows)


def test_chunks_end_between_conversations(monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 5)
    ids = [None, None, 1, 1, 1, 1, 1, 1, 1, 2, 3, 3, 4, 4, 4, 5]
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[i : i + 2], pa.int64()), pa.array(range(i, i + 2))], ["conv_id", "x"]) for i in range(0, 16, 2)]
    chunks = [c.column("conv_id").to_pylist() for c in repair._chunks(iter(batches))]
    assert sum(chunks, []) == ids and len(chunks) > 2
    assert all(a[-1] != b[0] for a, b in zip(chunks, chunks[1:]))


def test_a_very_long_conversation_in_one_bucket():
    """Costs and letters of 3,000 turns agree: the letters cost what the table says."""
    rng = random.Random(9)
    import numpy as np

    code = np.array([[rng.randint(0, 3)] for _ in range(3000)], np.int8)
    gone = np.array([[rng.random() < 0.1] for _ in range(3000)])
    extra = np.array([[5 * (rng.random() < 0.2)] for _ in range(3000)], np.int64)
    cost = repair.backward(code, gone, extra, np.ones_like(gone))
    (letters,) = repair.trace(cost, code, gone, extra, np.array([3000]))
    at, spent = 0, 0
    for letter in letters.decode():
        spent += {"D": 2, "I": 5, "R": 1, "K": 0}[letter] + (extra[at, 0] if letter in "RK" else 0)
        at += letter != "I"
    assert at == 3000 and spent == cost[0, 0, 0]
