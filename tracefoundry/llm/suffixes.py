"""Suffix-array dedup: sorted runs of suffixes, front-coded, merged by loser trees that know common prefixes.

A byte goes if a string of SPAN bytes that covers it also starts in a
document with a smaller doc_id.  Sorting every suffix would move some forty
bytes for each byte of text, so suffixes are sorted at anchors only.  The
anchor of a window of SPAN bytes is the place of its leftmost least hashed
string of GRAM bytes, so equal windows have equal anchors and every window
belongs to one; consecutive windows of one anchor make a context: at most
SPAN bytes from the anchor on (the suffix) and SPAN - GRAM before it.

1. Documents are packed into blocks of some MB, in a table bucketed by block:
   later joins by block move the small side and never a text.
2. Each block's distinct anchor strings, as 48-bit hashes, are counted over all
   blocks.  Anchors that one document has for itself end here; an anchor
   string with more than HOT contexts is dissolved into its windows, which
   are suffixes of SPAN bytes of their own, so that no task gets its contexts.
3. A block's contexts that are left, one for each distinct text with its least
   doc_id, make a run: sorted by suffix, front-coded (bytes in common with the
   one before, then the rest), and dealt by a hash of what an anchor's
   contexts have in common.
4. A task merges the segments of its part from all runs in a loser tree whose
   nodes keep the common prefix with the last winner, so bytes known to be
   equal are never compared again; what comes out has its common prefixes
   (the part's LCP array).  A window that begins ``o`` bytes before its anchor
   equals those in the LCP interval of SPAN - o bytes whose ``o`` bytes before
   the anchor are the same, by a sorted array of these with common prefixes
   too.  Each context gets a bit for each window that a smaller doc_id has.
5. The bits go back to the blocks, whose documents are cut.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk
from .common import cut, drop_cut, setting, shared_dir, ship, width

SPAN = 50
GRAM = 20
BACK = SPAN - GRAM
BLOCK = 1 << 20
#: Windows that are hashed at once.
SLICE = 1 << 17
#: Contexts of an anchor string beyond which its windows are dealt one by one.
HOT = 2_000
#: Anchors, and contexts, aimed at for one part.
GRAM_PART = 1_000_000
PART = 200_000
HASH_BITS = 48
_PLACE = np.uint64((1 << 20) - 1)
#: Blocks that a scan decodes and that go to a Python worker at once.
BATCH = "4"


class Contexts(NamedTuple):
    """Contexts of a block: anchor, first and last window, document, hash of the anchor's string and of the whole."""

    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray
    doc: np.ndarray
    gram: np.ndarray
    whole: np.ndarray


def contexts(data: np.ndarray, offsets: np.ndarray) -> Contexts:
    """All windows of SPAN bytes of the documents [offsets[i], offsets[i+1]), grouped by anchor."""
    found: list[tuple[np.ndarray, ...]] = []
    n = len(data)
    wide = np.flatnonzero(np.diff(offsets) >= SPAN)
    begin, end = offsets[wide], offsets[wide + 1]
    for low in range(0, max(n - SPAN + 1, 0), SLICE):
        high = min(low + SLICE, n - SPAN + 1)
        total = tk.running(data[low : high + SPAN - 1])
        m = high - low + BACK
        place = np.arange(m)
        gram = tk.spans(total, place, place + GRAM)
        least = (gram & ~_PLACE) | place.astype(np.uint64)
        for step in (1, 2, 4, 8):
            least = np.minimum(least[:-step], least[step:])
        # 16 strings from a window's first on and 16 up to its last
        least = np.minimum(least[: high - low], least[BACK - 15 : BACK - 15 + high - low])
        anchor = (least & _PLACE).astype(np.int64)
        edge = np.zeros(high - low + 1, np.int32)
        np.add.at(edge, np.clip(begin - low, 0, high - low), 1)
        np.add.at(edge, np.clip(end - SPAN + 1 - low, 0, high - low), -1)
        # windows that end in the document they begin in
        inside = np.cumsum(edge)[:-1] > 0
        new = np.ones(high - low, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        starts = np.flatnonzero(new & inside)
        stops = np.flatnonzero(inside & np.concatenate([new[1:] | ~inside[1:], [True]]))
        at = anchor[starts]
        whole = tk.spans(total, starts, stops + SPAN) ^ tk.mix((at - starts).astype(np.uint64) + np.uint64(1))
        doc = np.searchsorted(offsets, starts + low, "right") - 1
        # anchors have small hashes, so these are mixed again
        found.append((at + low, starts + low, stops + low, doc, tk.mix(gram[at]) >> np.uint64(64 - HASH_BITS), whole))
    if not found:
        none = np.zeros(0, np.int64)
        return Contexts(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Contexts(*(np.concatenate(c) for c in zip(*found)))


def part_of(hashed: np.ndarray, parts: int) -> np.ndarray:
    """Parts of 48-bit hashes, ascending with them."""
    return ((hashed >> np.uint64(HASH_BITS - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: list = []
    texts: list[bytes] = []
    size = 0

    def sent() -> pa.RecordBatch:
        lists = pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*lists, pa.array([b"".join(texts)], pa.binary())], ["ids", "sizes", "data"])

    for batch in batches:
        # one document at a time, as views of the batch's bytes
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            if texts and (size + len(data) > BLOCK or len(texts) >= tk.SLICE_DOCS):
                yield sent()
                ids, texts, size = [], [], 0
            ids.append(doc_id.as_py())
            texts.append(data)
            size += len(data)
    if texts:
        yield sent()


class Block(NamedTuple):
    block: int
    ids: list
    offsets: np.ndarray
    data: np.ndarray
    #: What doc_ids are compared by; null is the largest.
    order: np.ndarray


def _read(batch: pa.RecordBatch) -> Iterator[tuple[Block, int]]:
    for i in range(batch.num_rows):
        ids = batch.column("ids")[i].values
        sizes = batch.column("sizes")[i].values.to_numpy()
        order = pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy()
        data = np.frombuffer(batch.column("data")[i].as_buffer(), np.uint8)
        yield Block(batch.column("block")[i].as_py(), ids.to_pylist(), np.concatenate([[0], np.cumsum(sizes)]), data, order), i


def _grams(parts: int):
    """A block's distinct anchor strings, by part: hashes, and the number of their contexts with a bit for several documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, _ in _read(batch):
                c = contexts(b.data, b.offsets)
                if not len(c.gram):
                    continue
                by = np.lexsort((c.whole, c.gram))
                gram, whole, doc = c.gram[by], c.whole[by], b.order[c.doc[by]]
                new = np.concatenate([[True], gram[1:] != gram[:-1]])
                first = np.flatnonzero(new)
                other = new.copy()
                other[1:] |= whole[1:] != whole[:-1]
                several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                number = np.minimum(np.add.reduceat(other.astype(np.int64), first), (1 << 15) - 1)
                facts = (number | several.astype(np.int64) << 15).astype("<u2")
                unique = gram[first]
                hashes = unique.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8]
                part = part_of(unique, parts)
                edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
                rows = [(part[i], hashes[i:j].tobytes(), facts[i:j].tobytes()) for i, j in zip(edges, edges[1:])]
                p, h, f = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array([b.block] * len(rows)), pa.array(p, pa.int64()), pa.array(h, pa.binary()), pa.array(f, pa.binary())], ["block", "part", "hashes", "facts"])

    return run


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block's anchor strings of a part: 0 alone, 1 in several documents, 2 the same with very many contexts."""
    for group in tk.runs(batches, "part"):
        raw = group.column("hashes").to_pylist()
        size = np.array([len(x) // (HASH_BITS // 8) for x in raw])
        wide = np.zeros((size.sum(), 8), np.uint8)
        wide[:, : HASH_BITS // 8] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, HASH_BITS // 8)
        facts = np.frombuffer(b"".join(group.column("facts").to_pylist()), "<u2").astype(np.int64)
        _, which, blocks = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
        number, several = facts & ((1 << 15) - 1), facts >> 15
        total = np.bincount(which, weights=number)
        shared = (blocks > 1) | (np.bincount(which, weights=several) > 0)
        code = np.where(shared, np.where(total > HOT, 2, 1), 0)[which]
        work = number * np.where(code == 2, BACK // 2, code)
        ends = np.cumsum(size)
        out = [(code[e - s : e].astype(np.uint8).tobytes(), int(work[e - s : e].sum())) for s, e in zip(size, ends)]
        yield pa.RecordBatch.from_arrays([group.column("block").combine_chunks(), group.column("part").combine_chunks(), pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64())], ["block", "part", "codes", "work"])


def sorted_rows(words: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Order of rows by part, then words; a word is looked at only where all before it are equal."""
    order = np.lexsort((words[:, 0], part))
    new = np.ones(len(order), bool)
    new[1:] = (part[order][1:] != part[order][:-1]) | (words[order, 0][1:] != words[order, 0][:-1])
    for j in range(1, words.shape[1]):
        tied = ~new
        tied[:-1] |= ~new[1:]
        tied = np.flatnonzero(tied)
        if not len(tied):
            break
        rows, group = order[tied], np.cumsum(new)[tied]
        by = np.lexsort((words[rows, j], group))
        order[tied] = rows[by]
        word = words[order[tied], j]
        new[tied[1:]] |= (word[1:] != word[:-1]) | (group[1:] != group[:-1])
    return order


def as_words(rows: np.ndarray) -> np.ndarray:
    """Byte rows as big-endian words, which sort like them."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view(">u8").astype(np.uint64)


def common(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the one before; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    differ = rows[1:] != rows[:-1]
    out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


class Run(NamedTuple):
    """Sorted distinct contexts of a block, and where each occurs: (entry, anchor, document) for every occurrence."""

    part: np.ndarray
    suffix: np.ndarray
    before: np.ndarray
    after_length: np.ndarray
    before_length: np.ndarray
    least: np.ndarray
    entry: np.ndarray
    anchor: np.ndarray
    doc: np.ndarray


def sorted_run(b: Block, codes: np.ndarray, parts: int) -> Run:
    c = contexts(b.data, b.offsets)
    code = codes[np.unique(c.gram, return_inverse=True)[1]] if len(c.gram) else np.zeros(0, np.uint8)
    some, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
    # windows of very common anchors stand for themselves
    size = (c.last - c.first + 1)[hot]
    window = np.repeat(c.first[hot] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    anchor = np.concatenate([c.anchor[some], window])
    before = np.concatenate([(c.anchor - c.first)[some], np.zeros(len(window), np.int64)])
    after = np.concatenate([(c.last + SPAN - c.anchor)[some], np.full(len(window), SPAN)])
    doc = np.concatenate([c.doc[some], np.repeat(c.doc[hot], size)])
    own = _window_hashes(b.data, window)
    whole, dealt = np.concatenate([c.whole[some], own]), np.concatenate([c.gram[some], own >> np.uint64(64 - HASH_BITS)])

    _, pick, entry = np.unique(whole, return_index=True, return_inverse=True)
    least = np.full(len(pick), np.iinfo(np.int64).max)
    np.minimum.at(least, entry, b.order[doc])
    at, before_length, after_length = anchor[pick], before[pick], after[pick]
    padded = np.concatenate([np.zeros(BACK, np.uint8), b.data, np.zeros(SPAN, np.uint8)])
    suffix = sliding_window_view(padded[BACK:], SPAN)[at]
    suffix[np.arange(SPAN) >= after_length[:, None]] = 0
    ahead = np.ascontiguousarray(sliding_window_view(padded, BACK)[at][:, ::-1])
    ahead[np.arange(BACK) >= before_length[:, None]] = 0
    part = part_of(dealt[pick], parts)
    order = sorted_rows(as_words(suffix), part)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return Run(part[order], suffix[order], ahead[order], after_length[order], before_length[order], least[order], rank[entry], anchor, doc)


def _window_hashes(data: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Hashes of the SPAN bytes from each place of ``window``, ascending."""
    out = np.zeros(len(window), np.uint64)
    for low in range(0, len(data), SLICE):
        i, j = np.searchsorted(window, [low, low + SLICE])
        if i < j:
            total = tk.running(data[low : low + SLICE + SPAN])
            out[i:j] = tk.spans(total, window[i:j] - low, window[i:j] - low + SPAN) ^ np.uint64(1)
    return out


def encode(run: Run, i: int, j: int) -> bytes:
    """Entries [i, j) front-coded."""
    suffix, after, before = run.suffix[i:j], run.after_length[i:j], run.before_length[i:j]
    known = np.minimum(common(suffix), after)
    column = np.arange(SPAN)
    rest = suffix[(column >= known[:, None]) & (column < after[:, None])]
    ahead = run.before[i:j][np.arange(BACK) < before[:, None]]
    return b"".join([known.astype(np.uint8).tobytes(), after.astype(np.uint8).tobytes(), before.astype(np.uint8).tobytes(), run.least[i:j].astype("<i8").tobytes(), rest.tobytes(), ahead.tobytes()])


def decode(segments: list[bytes], sizes: list[int]) -> tuple[np.ndarray, ...]:
    """Common prefixes, suffixes, bytes before (nearest first), both lengths and least doc_ids of all entries."""
    parts: list[list[np.ndarray]] = [[] for _ in range(6)]
    for raw, n in zip(segments, sizes):
        known, after, before = np.frombuffer(raw, np.uint8, 3 * n).astype(np.int64).reshape(3, n)
        rest = 11 * n + int((after - known).sum())
        for to, what in zip(parts, (known, after, before, np.frombuffer(raw, "<i8", n, 3 * n), np.frombuffer(raw, np.uint8, rest - 11 * n, 11 * n), np.frombuffer(raw, np.uint8, -1, rest))):
            to.append(what)
    known, after, before, least, rest, ahead = (np.concatenate(p) for p in parts)
    column, place = np.arange(SPAN), np.arange(len(known))
    suffix = np.zeros((len(known), SPAN), np.uint8)
    suffix[(column >= known[:, None]) & (column < after[:, None])] = rest
    for j in range(SPAN):
        # a byte in common comes from the last entry that spelt it out
        suffix[:, j] = suffix[np.maximum.accumulate(np.where(known <= j, place, 0)), j]
    left = np.zeros((len(known), BACK), np.uint8)
    left[np.arange(BACK) < before[:, None]] = ahead
    return known, suffix, left, after, before, least


def merge(strings: list[bytes], known: list[int], starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Places of all ``strings`` in order, with the bytes each has in common with the one before.

    Runs are [starts[i], ends[i]), sorted, with ``known`` bytes in common.  A
    node of the loser tree holds the run that lost there and the bytes that it
    has in common with the last winner that came by.  Of two runs the one with
    more in common with the last output is less; only where both have the same
    number are bytes compared, from that number on.
    """
    k = len(starts)
    leaves = 1 << max(k - 1, 0).bit_length()
    at, loser, held = list(starts), [0] * leaves, [-1] * leaves

    def less(a: int, b: int, h: int) -> tuple[bool, int]:
        x, y = strings[at[a]], strings[at[b]]
        n = len(x)
        while x[h : h + 8] == y[h : h + 8] and h < n:
            h += 8
        while h < n and x[h] == y[h]:
            h += 1
        return (h >= n or x[h] < y[h]), min(h, n)

    def play(node: int) -> tuple[int, int]:
        if node >= leaves:
            run = node - leaves
            return (run, 0) if run < k and at[run] < ends[run] else (0, -1)
        (a, ha), (b, hb) = play(2 * node), play(2 * node + 1)
        if ha < 0 or hb < 0:
            loser[node], held[node] = (a, ha) if ha < 0 else (b, hb)
            return (b, hb) if ha < 0 else (a, ha)
        first, h = less(a, b, 0)
        loser[node], held[node] = (b, h) if first else (a, h)
        return (a, 0) if first else (b, 0)

    run, h = play(1)
    out, shared = [], []
    while h >= 0:
        out.append(at[run])
        shared.append(h)
        at[run] += 1
        h = known[at[run]] if at[run] < ends[run] else -1
        node = (run + leaves) >> 1
        while node:
            other = held[node]
            if other > h:
                loser[node], run = run, loser[node]
                held[node], h = h, other
            elif other == h and h >= 0:
                first, held[node] = less(run, loser[node], h)
                if not first:
                    loser[node], run = run, loser[node]
            node >>= 1
    return out, shared


def windows_seen(shared: np.ndarray, left: np.ndarray, after: np.ndarray, before: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Bits of windows, by bytes before the anchor, that an entry of a smaller doc_id has too.  Entries are in order."""
    bits = np.zeros(len(shared), np.uint32)
    near = shared >= GRAM
    near[:-1] |= shared[1:] >= GRAM
    some = np.flatnonzero(near)
    if not len(some):
        return bits
    shared, left, after, before, least = shared[some], left[some], after[some], before[some], least[some]
    order = sorted_rows(as_words(left), np.zeros(len(some), np.int64))
    apart = common(left[order])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    for o in range(BACK + 1):
        has = np.flatnonzero((before >= o) & (after >= SPAN - o))
        if not len(has):
            continue
        interval = np.cumsum(shared < SPAN - o)[has]
        same = np.cumsum(apart < o)[rank[has]] if o else np.zeros(len(has), np.int64)
        key = interval * (len(some) + 1) + same
        by = np.argsort(key, kind="stable")
        key = key[by]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        low = np.repeat(np.minimum.reduceat(least[has[by]], first), np.diff([*first, len(by)]))
        rows = has[by][low < least[has[by]]]
        bits[some[rows]] |= np.uint32(1 << o)
    return bits


def _segments(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, i in _read(batch):
                made = sorted_run(b, _joined(batch.column("codes")[i]), parts)
                edges = np.flatnonzero(np.concatenate([[True], made.part[1:] != made.part[:-1], [True]])) if len(made.part) else np.zeros(1, int)
                for at in range(0, len(edges) - 1, 64):
                    own = list(zip(edges[at : at + 65], edges[at + 1 : at + 65]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b.block] * len(own)), pa.array([int(made.part[x]) for x, _ in own], pa.int64()), pa.array([int(y - x) for x, y in own], pa.int64()), pa.array([encode(made, x, y) for x, y in own], pa.binary())],
                        ["block", "part", "entries", "coded"],
                    )

    return run


def _joined(codes: pa.Scalar) -> np.ndarray:
    """The bytes of all parts of a block, in order of the parts."""
    return np.frombuffer(b"".join(x["bytes"] for x in codes.as_py() or []), np.uint8)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in tk.runs(batches, "part"):
        sizes = group.column("entries").to_pylist()
        known, suffix, left, after, before, least = decode(group.column("coded").to_pylist(), sizes)
        ends = np.cumsum(sizes)
        raw = suffix.tobytes()
        strings = [raw[i : i + SPAN] for i in range(0, len(raw), SPAN)]
        order, shared = merge(strings, known.tolist(), (ends - sizes).tolist(), ends.tolist())
        order = np.array(order)
        bits = np.zeros(len(order), "<u4")
        bits[order] = windows_seen(np.array(shared), left[order], after[order], before[order], least[order])
        told = [bits[e - s : e].tobytes() for s, e in zip(sizes, ends)]
        yield pa.RecordBatch.from_arrays([group.column("block").combine_chunks(), group.column("part").combine_chunks(), pa.array(told, pa.binary())], ["block", "part", "bits"])


def _cut_texts(parts: int):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, i in _read(batch):
                made = sorted_run(b, _joined(batch.column("codes")[i]), parts)
                bits = _joined(batch.column("bits")[i]).view("<u4")
                covered = covered_bytes(b, made, bits)
                inner = covered[:-1] & covered[1:]
                inner[b.offsets[(b.offsets > 0) & (b.offsets < len(covered))] - 1] = False
                removed = tk.per_doc(covered.astype(np.int64), b.offsets)
                spans = removed - tk.per_doc(np.concatenate([inner, [False]]).astype(np.int64)[: len(covered)], b.offsets)
                digests = []
                for k, (low, high) in enumerate(zip(b.offsets, b.offsets[1:])):
                    own = b.data[low:high]
                    digests.append(hashlib.sha256(own[~covered[low:high]] if removed[k] else own).hexdigest())
                yield pa.RecordBatch.from_arrays([pa.array(b.ids, pa.int64()), pa.array(np.diff(b.offsets)), pa.array(removed), pa.array(spans), pa.array(digests)], names)

    return run


def covered_bytes(b: Block, made: Run, bits: np.ndarray) -> np.ndarray:
    """Which bytes of the block a window covers that a smaller doc_id has."""
    edge = np.zeros(len(b.data) + SPAN + 1, np.int8)
    starts = np.zeros(len(b.data) + 1, np.int8)
    before, after = made.before_length[made.entry], made.after_length[made.entry]
    # all windows of a context whose least doc_id is smaller than the occurrence's
    later = b.order[made.doc] > made.least[made.entry]
    np.add.at(starts, (made.anchor - before)[later], 1)
    np.add.at(starts, (made.anchor + after - SPAN + 1)[later], -1)
    starts = np.cumsum(starts, dtype=np.int8)[:-1] > 0
    for o in range(BACK + 1):
        starts[made.anchor[~later & (bits[made.entry] >> np.uint32(o) & np.uint32(1)).astype(bool)] - o] = True
    at = np.flatnonzero(starts)
    edge[at] += 1
    edge[at + SPAN] -= 1
    return np.cumsum(edge, dtype=np.int8)[: len(b.data)] > 0


def _bucketed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a table bucketed by block in the shared folder, and its name."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.option("path", path).option("compression", "zstd").bucketBy(width(spark), "block").saveAsTable(table, format="parquet")
    out = spark.table(table)
    out._cut_path = path
    return out, table


def _of_block(rows: DataFrame, value: str) -> DataFrame:
    """A row per block: ``value`` of its parts, in their order.  A block has a few MB, and so have its bytes here."""
    return rows.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", F.col(value).alias("bytes")))).alias(value))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes, null is empty.  A byte is removed if a string of
    SPAN bytes that covers it also starts in a document with a smaller
    doc_id; what is removed elsewhere does not matter.  Rows that share a
    doc_id remove nothing from each other, and a null doc_id counts as the
    largest long.  Repeats within one document stay.  Texts shorter than SPAN
    bytes stay whole.  Equal contexts within one block are told by 64-bit
    hashes, all others by their bytes.  Other columns are ignored whatever
    their names.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_blocks, "ids array<long>, sizes array<long>, data binary")
    blocks, table = _bucketed(packed.withColumn("block", F.monotonically_increasing_id()), "op12-blocks")
    batches = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
    try:
        with setting(spark, batches[0], BATCH), setting(spark, batches[1], BATCH):
            return _cut_blocks(spark, blocks)
    finally:
        spark.sql(f"DROP TABLE {table}")
        drop_cut(blocks)


def _cut_blocks(spark: SparkSession, blocks: DataFrame) -> DataFrame:
    size = blocks.select(F.sum(F.octet_length("data"))).first()[0] or 0
    parts = max(width(spark), size // (BACK // 2 * GRAM_PART))
    grams = blocks.mapInArrow(_grams(parts), "block long, part long, hashes binary, facts binary")
    grams = grams.repartition(parts, "part").sortWithinPartitions("part")
    codes = cut(grams.mapInArrow(_judge, "block long, part long, codes binary, work long"), "op12-codes")
    work = codes.select(F.sum("work")).first()[0] or 0
    parts = max(2 * width(spark), work // PART)
    coded = blocks.join(_of_block(codes, "codes").hint("shuffle_hash"), "block", "left")
    runs = coded.mapInArrow(_segments(parts), "block long, part long, entries long, coded binary")
    runs = runs.repartition(parts, "part").sortWithinPartitions("part")
    bits = cut(runs.mapInArrow(_merge, "block long, part long, bits binary"), "op12-bits")
    told = coded.join(_of_block(bits, "bits").hint("shuffle_hash"), "block", "left")
    return cut(told.mapInArrow(_cut_texts(parts), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "op12-cut")


ORACLE = f"""
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT doc_id, coalesce(doc_id, 9223372036854775807) AS k, hex(encode(coalesce(text, ''))) AS h, md5(h) AS whole FROM documents
), pieces AS MATERIALIZED (
  SELECT k, doc_id, whole, c, substr(h, 512 * c + 1, {512 + 2 * SPAN - 2}) AS piece FROM texts, range(0, strlen(h) // 512 + 1) t(c)
), windows AS MATERIALIZED (
  SELECT k, doc_id, whole, 256 * c + i AS p, md5(substr(piece, 2 * i + 1, {2 * SPAN})) AS s FROM pieces, range(0, least(256, greatest(strlen(piece) // 2 - {SPAN - 1}, 0))) t(i)
), least AS (SELECT s, min(k) AS m FROM windows GROUP BY s
), hits AS (SELECT w.k, w.doc_id, w.whole, w.p FROM windows w JOIN least USING (s) WHERE m < w.k
), steps AS (
  SELECT *, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id, whole ORDER BY p) + {SPAN} OR lag(p) OVER (PARTITION BY doc_id, whole ORDER BY p) IS NULL THEN 1 ELSE 0 END AS new FROM (SELECT DISTINCT doc_id, whole, p FROM hits)
), runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, whole ORDER BY p) AS run FROM steps
), spans AS (SELECT doc_id, whole, run, min(p) AS a, max(p) + {SPAN} AS b FROM runs GROUP BY ALL
), gaps AS (
  SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id, whole ORDER BY a), 0) AS since FROM spans
), kept AS (
  SELECT doc_id, whole, sum(b - a)::BIGINT AS removed, count(*) AS n, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest
  FROM gaps JOIN (SELECT DISTINCT doc_id AS d, h, whole AS w FROM texts) t ON gaps.doc_id IS NOT DISTINCT FROM d AND whole = w GROUP BY doc_id, whole
)
SELECT t.doc_id, (strlen(t.h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, t.h))) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id IS NOT DISTINCT FROM t.doc_id AND k.whole = t.whole
"""
