"""Conversation structure repair: time-major tensor dynamic programming over conversations of like length.

A conversation has to read ``(s?(ua)+)?`` by the initials of its roles.  Edits
go over its rows in order: Keep 0, Rerole to user or assistant 1, Delete 2,
Insert an empty message of the user or the assistant 5; a truncated row that
stays adds 5.  Blank and duplicate rows have to go.

1. Spark reduces each row to its faults, its initial and a digest, and deals
   these by conversation; texts stay where they are.
2. A task buckets whole conversations by the power of two of their length and
   lays a bucket out as tensors, turn by turn: one step of the dynamic program
   updates the costs of all states of all the bucket's conversations.  The
   costs from each turn to the end are stored, so the edits are traced
   forwards, also all conversations at once, by the ASCII-least letter that
   keeps the cost.
3. The letters meet the texts again: rows of a conversation stream past behind
   its audit, and its digest is taken as they come.

States: 0 nothing said, 1 after the system, 2 after the user, 3 after the
assistant.  A conversation may end in 0 or 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, ship, width

DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5
NEVER = 1 << 40
#: Rows that a task lays out at once, if no single conversation is longer.
CHUNK = 1 << 17
INITIALS = {"s": 1, "u": 2, "a": 3}
#: Where an inserted or reroled message leads from each state.
SPOKEN = np.array([2, 2, 3, 2])
FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults planted by a checksum of their place; ``times`` says how often a row is there.

    Null roles and texts, and null ids and turns in the checksum's key, count
    as one space.
    """
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(told("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def digest(role: Column, text: Column) -> Column:
    """32 bytes that tell (role, text) apart from others."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def backward(code: np.ndarray, gone: np.ndarray, extra: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Least costs (turns + 1, conversations, 4) from each turn and state to the end.

    ``code``: initials as INITIALS, 0 for others; ``gone``: rows that have to
    go; ``extra``: what a row costs that stays; ``real``: not padding.  All
    are (turns, conversations).
    """
    turns, n = code.shape
    cost = np.empty((turns + 1, n, 4), np.int64)
    cost[turns] = [0, 2 * INSERT, INSERT, 0]
    for t in range(turns - 1, -1, -1):
        ahead = cost[t + 1]
        stay = np.where(gone[t], NEVER, extra[t])
        now = np.minimum(ahead + DELETE, ahead[:, SPOKEN] + (stay + REROLE)[:, None])
        for state, initial, leads in ((0, 1, 1), (0, 2, 2), (1, 2, 2), (3, 2, 2), (2, 3, 3)):
            kept = np.where(code[t] == initial, ahead[:, leads] + stay, NEVER)
            now[:, state] = np.minimum(now[:, state], kept)
        now[:, 2] = np.minimum(now[:, 2], now[:, 3] + INSERT)
        others = [0, 1, 3]
        now[:, others] = np.minimum(now[:, others], now[:, [2]] + INSERT)
        cost[t] = np.where(real[t][:, None], now, ahead)
    return cost


def trace(cost: np.ndarray, code: np.ndarray, gone: np.ndarray, extra: np.ndarray, length: np.ndarray) -> list[bytes]:
    """The ASCII-least letters of edits that reach ``cost``, for each conversation."""
    n = len(length)
    at, state, every = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
    steps: list[np.ndarray] = []
    turns = len(code)
    while True:
        now = cost[at, every, state]
        active = (at < length) | (now > 0)
        if not active.any():
            break
        row = np.minimum(at, max(turns - 1, 0))
        has = at < length
        spoken = SPOKEN[state]
        after = np.where(has, at + 1, at)
        if turns:
            initial = code[row, every]
            stay = np.where(gone[row, every] | ~has, NEVER, extra[row, every])
        else:
            initial, stay = np.zeros(n, np.int8), np.full(n, NEVER)
        said = np.where((initial == 1) & (state == 0), 1, np.where((initial == 2) & (state != 2), 2, np.where((initial == 3) & (state == 2), 3, -1)))
        delete = has & (now == cost[after, every, state] + DELETE)
        insert = now == cost[at, every, spoken] + INSERT
        keep = (said >= 0) & (now == cost[after, every, np.maximum(said, 0)] + stay)
        letter = np.select([~active, delete, insert, keep], [0, ord("D"), ord("I"), ord("K")], ord("R")).astype(np.uint8)
        steps.append(letter)
        state = np.select([(letter == 0) | (letter == ord("D")), letter == ord("K")], [state, said], spoken)
        at = np.where((letter == 0) | (letter == ord("I")), at, after)
    if not steps:
        return [b""] * n
    letters = np.stack(steps, axis=1)
    return [row[row > 0].tobytes() for row in letters]


def _edges(ids: pa.Array) -> np.ndarray:
    """Where a run of equal ids (null is equal to null) begins, after the first."""
    a, b = ids.slice(0, len(ids) - 1), ids.slice(1)
    other = pc.fill_null(pc.not_equal(a, b), True)
    same = pc.and_(pc.is_null(a), pc.is_null(b))
    return np.flatnonzero(pc.and_not(other, same).to_numpy(zero_copy_only=False)) + 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole conversations, CHUNK rows or one conversation."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if size >= CHUNK:
            both = pa.concat_tables([*held, table]).combine_chunks()
            edges = _edges(both.column("conv_id").chunk(0))
            if len(edges):
                yield both.slice(0, edges[-1])
                held, size = [both.slice(edges[-1])], both.num_rows - edges[-1]
                continue
        held.append(table)
        size += batch.num_rows
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _chunks(batches):
        ids = table.column("conv_id").combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        first = np.concatenate([[0], _edges(ids)])
        n = len(first)
        times = table.column("times").to_numpy()
        there = np.repeat(np.arange(table.num_rows), times)
        conv = np.repeat(np.arange(n), np.diff([*first, table.num_rows]))[there]
        column = lambda c: table.column(c).to_numpy(zero_copy_only=False)[there]
        code, blank, cut_off = column("initial"), column("blank"), column("cut_off")
        marks = np.frombuffer(b"".join(table.column("mark").to_pylist()), dtype=np.uint8).reshape(-1, 32)[there]
        keyed = np.concatenate([conv.astype(">i8").view(np.uint8).reshape(-1, 8), marks], axis=1)
        seen = np.ones(len(there), bool)
        seen[np.unique(np.ascontiguousarray(keyed).view("V40").ravel(), return_index=True)[1]] = False
        again = seen & ~blank
        cut_off = cut_off & ~blank & ~again
        per = lambda mask: np.bincount(conv[mask], minlength=n)
        beside = conv[1:] == conv[:-1]
        pair = code[:-1] * 4 + code[1:]
        illegal = np.bincount(conv[1:][beside & ~np.isin(pair, (1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2))], minlength=n)

        known = ~pc.is_null(table.column("turn")).to_numpy()[there]
        turn, own = pc.fill_null(table.column("turn"), 0).to_numpy()[there][known], conv[known]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (turn[1:] != turn[:-1])])[: len(own)]
        low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
        low[own[::-1]], high[own] = turn[::-1], turn
        distinct = np.bincount(own[new], minlength=n)
        gaps = np.where(distinct > 0, high - low + 1 - distinct, 0)

        length = np.bincount(conv, minlength=n)
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])
        cost, audits = np.zeros(n, np.int64), [b""] * n
        bucket = np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64)
        for b in np.unique(bucket[length > 0]):
            own = np.flatnonzero((bucket == b) & (length > 0))
            turns = int(length[own].max())
            place = np.arange(turns)[:, None]
            real = place < length[own]
            at = np.where(real, begin[own] + place, 0)
            laid = code[at], (blank | again)[at], np.where(cut_off, CUT_OFF, 0)[at]
            table_ = backward(*laid, real)
            cost[own] = table_[0, :, 0]
            for c, letters in zip(own, trace(table_, *laid, length[own])):
                audits[c] = letters
        facts = [gaps, per(blank), per(again), per(cut_off), illegal, cost]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(first)), *(pa.array(f.astype(np.int64)) for f in facts), pa.array([a.decode() for a in audits])], ["conv_id", *FACTS, "audit"])


class _Reading:
    """One conversation's edits as its rows come: what is said, into a digest."""

    def __init__(self, facts: list, letters: str):
        self.facts, self.letters, self.at, self.state, self.lines = facts, letters, 0, 0, 0
        self.digest = hashlib.sha256()

    def say(self, role: str, text: str) -> None:
        self.digest.update(b"\n" * (self.lines > 0) + f"{role}:{text}".encode())
        self.lines += 1

    def inserted(self) -> None:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.speak("")

    def speak(self, text: str) -> None:
        self.state = int(SPOKEN[self.state])
        self.say("user" if self.state == 2 else "assistant", text)

    def row(self, role: str, text: str) -> None:
        self.inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.state = INITIALS[role[0]]
            self.say(role, text)
        elif letter == "R":
            self.speak(text)

    def done(self) -> list:
        self.inserted()
        return [*self.facts, self.letters, self.digest.hexdigest()]


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Reading | None = None
    names = ["conv_id", *FACTS, "audit", "repaired_sha256"]

    def sent(done: list[list], kind: pa.DataType) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * len(FACTS), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names)

    kind = None
    for batch in batches:
        done: list[list] = []
        kind = batch.schema.field("conv_id").type
        heads = [batch.column(c).to_pylist() for c in ("conv_id", *FACTS, "audit")]
        for i, (role, text, times) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("role", "text", "times")))):
            if times is None:
                if now:
                    done.append(now.done())
                now = _Reading([h[i] for h in heads[:-1]], heads[-1][i])
            else:
                for _ in range(times):
                    now.row(role, text)
        if done:
            yield sent(done, kind)
    if now:
        yield sent([now.done()], kind)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text, times): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are read by turn, null first; of one turn, by the digest of role and
    text, so equal rows stand together.  ``times`` 0 names a conversation
    whose row is not there; one without any rows has zeros, an empty audit
    and the digest of nothing.  Each row's first fault counts: blank,
    duplicate of an earlier row's role and text, or truncated.  Null roles
    and texts count as one space.  Rows with a null conv_id are one
    conversation.  Roles are known by their first letter; others never stay as
    they are.  A task holds some 50 bytes for each row of a conversation,
    and its texts stream.  Other columns are ignored whatever their names.
    An empty table gives an empty result.
    """
    spark = rows.sparkSession
    ship(spark)
    solid = SPACE.replace("[", "[^")
    filled = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), F.col("times").cast("int").alias("times"))
    facts = filled.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        digest(F.col("role"), F.col("text")).alias("mark"),
        "times",
        F.coalesce(*(F.when(F.col("role").startswith(c), n) for c, n in INITIALS.items()), F.lit(0)).alias("initial"),
        (~F.col("text").rlike(solid)).alias("blank"),
        (~F.col("text").rlike(rf"[.!?]{SPACE}*\z")).alias("cut_off"),
    )
    conv = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv}, {', '.join(f'{c} long' for c in FACTS)}, audit string"
    order = ["conv_id", "turn", "mark"]
    audits = cut(facts.repartition(width(spark), "conv_id").sortWithinPartitions(*order).mapInArrow(_audit, schema), "op11-audits")

    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("mark", "binary"), ("role", "string"), ("text", "string"), ("times", "int"))]
    heads = audits.select("conv_id", *nothing, *FACTS, "audit", F.lit(0).alias("kind"))
    empty = [*(F.lit(None).cast("long").alias(c) for c in FACTS), F.lit(None).cast("string").alias("audit")]
    texts = filled.where("times > 0").select("conv_id", F.col("turn").cast("long").alias("turn"), digest(F.col("role"), F.col("text")).alias("mark"), "role", "text", "times", *empty, F.lit(1).alias("kind"))
    met = heads.unionByName(texts).repartition(width(spark), "conv_id").sortWithinPartitions("conv_id", "kind", "turn", "mark")
    return met.mapInArrow(_apply, f"{schema}, repaired_sha256 string")


_BYTES = "list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)"
_CRC = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}), lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: 0::BIGINT)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT)"
ORACLE = rf"""
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), kinds AS (SELECT *, {_CRC} % 20 AS kind FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS nth
  FROM kinds
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text), nth) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text), nth) > 1 AS again,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut_off, left(role, 1) AS c
  FROM damaged
), faults AS MATERIALIZED (
  SELECT *, CASE WHEN blank THEN 'B' WHEN again THEN 'D' WHEN cut_off THEN 'T' ELSE '' END AS fault,
    lag(c) OVER (PARTITION BY conv_id ORDER BY pos) AS was, pos > 1 AS follows, (NOT blank AND NOT again)::INT AS stays FROM placed
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'B') AS blank,
    count(*) FILTER (fault = 'D') AS duplicate, count(*) FILTER (fault = 'T') AS truncated,
    count(*) FILTER (follows AND (was || c) NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM faults GROUP BY conv_id
), back(conv_id, pos, c0, c1, c2, c3) AS (
  SELECT conv_id, n, 0::BIGINT, 10::BIGINT, 5::BIGINT, 0::BIGINT FROM facts
  UNION ALL
  SELECT b.conv_id, b.pos - 1, least(x.c0, x.d2 + 5), least(x.c1, x.d2 + 5), x.d2, least(x.c3, x.d2 + 5)
  FROM back b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.pos = b.pos,
    LATERAL (SELECT CASE WHEN f.stays = 1 THEN CASE WHEN f.fault = 'T' THEN 5 ELSE 0 END ELSE 1000000000 END AS s) e,
    LATERAL (SELECT least(b.c0 + 2, b.c2 + s + 1, CASE WHEN f.c = 's' THEN b.c1 + s WHEN f.c = 'u' THEN b.c2 + s ELSE 1000000000 END) AS c0,
      least(b.c1 + 2, b.c2 + s + 1, CASE WHEN f.c = 'u' THEN b.c2 + s ELSE 1000000000 END) AS c1,
      least(b.c2 + 2, b.c3 + s + 1, CASE WHEN f.c = 'a' THEN b.c3 + s ELSE 1000000000 END) AS c2,
      least(b.c3 + 2, b.c2 + s + 1, CASE WHEN f.c = 'u' THEN b.c2 + s ELSE 1000000000 END) AS c3) w,
    LATERAL (SELECT w.c0, w.c1, w.c3, least(w.c2, w.c3 + 5) AS d2) x
), costs AS MATERIALIZED (SELECT conv_id, pos, [c0, c1, c2, c3] AS c FROM back
), walk(conv_id, pos, state, audit, said, lines) AS (
  SELECT conv_id, 0::BIGINT, 0, '', '', 0 FROM facts
  UNION ALL
  SELECT k.conv_id, CASE WHEN e = 'I' THEN k.pos ELSE k.pos + 1 END, to_, k.audit || e,
    CASE WHEN e = 'D' THEN k.said ELSE k.said || CASE WHEN k.lines > 0 THEN chr(10) ELSE '' END || CASE WHEN e = 'K' THEN f.role WHEN to_ = 2 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN e = 'I' THEN '' ELSE f.text END END,
    CASE WHEN e = 'D' THEN k.lines ELSE k.lines + 1 END
  FROM walk k JOIN costs h ON h.conv_id IS NOT DISTINCT FROM k.conv_id AND h.pos = k.pos
    LEFT JOIN costs g ON g.conv_id IS NOT DISTINCT FROM k.conv_id AND g.pos = k.pos + 1
    LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM k.conv_id AND f.pos = k.pos + 1,
    LATERAL (SELECT h.c[k.state + 1] AS now, CASE WHEN k.state = 2 THEN 3 ELSE 2 END AS spoken, CASE WHEN f.fault = 'T' THEN 5 ELSE 0 END AS s,
      CASE WHEN f.c = 's' AND k.state = 0 THEN 1 WHEN f.c = 'u' AND k.state <> 2 THEN 2 WHEN f.c = 'a' AND k.state = 2 THEN 3 END AS kept) q,
    LATERAL (SELECT CASE WHEN g.pos IS NOT NULL AND now = g.c[k.state + 1] + 2 THEN 'D' WHEN now = h.c[spoken + 1] + 5 THEN 'I'
      WHEN f.stays = 1 AND kept IS NOT NULL AND now = g.c[kept + 1] + s THEN 'K' ELSE 'R' END AS e) l,
    LATERAL (SELECT CASE e WHEN 'D' THEN k.state WHEN 'K' THEN kept ELSE spoken END AS to_) z
  WHERE g.pos IS NOT NULL OR now > 0
), ends AS (SELECT w.conv_id, arg_max(audit, length(audit)) AS audit, arg_max(said, length(audit)) AS said FROM walk w GROUP BY w.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(h.c[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN costs h ON h.conv_id IS NOT DISTINCT FROM o.conv_id AND h.pos = 0 LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
