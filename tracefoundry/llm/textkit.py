"""Vectorised words and shingles of Arrow text batches.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased.
Word hashes are polynomials over random byte codes modulo 2**64, read off one
running sum and finished by a mixer, so a batch needs no per-word Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
SLICE_DOCS = 4096
#: Bits of a shingle's fingerprint; the document's place in the slice takes the others.
FP_BITS = 52

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_CODES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES_LOWER = _CODES[_LOWER]
_SOLID = np.ones(256, dtype=bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest so far is kept up to the slice size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, dtype=np.uint64)
        have[:1] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 2 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of pieces of a string column; null counts as empty.

    A piece ends at ``most`` bytes or SLICE_DOCS; one document is never divided.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = max(row + 1, min(end, row + SLICE_DOCS, n))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def running(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Running sum of byte codes times powers, from which :func:`spans` reads hashes."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_CODES_LOWER if lower else _CODES)[data] * powers(_BASE, len(data)), out=total[1:])
    return total


def spans(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end): equal for equal bytes, wherever they are."""
    hashes = (total[end] - total[start]) * powers(_INVERSE, len(total))[start]
    return mix(hashes + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


class Words(NamedTuple):
    """Words of a slice: byte range, hash, and per document the range of its words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    n = len(data)
    solid = np.zeros(n + 1, dtype=bool)
    solid[:n] = _SOLID[data]
    head = solid[:n].copy()
    head[1:] &= ~solid[: max(n - 1, 0)]
    tail = solid[:n] & ~solid[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    head[cuts] = solid[cuts]
    tail[cuts - 1] = solid[cuts - 1]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return Words(start, end, spans(running(data, lower), start, end), np.searchsorted(start, offsets))


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each document, as sorted ``doc << FP_BITS | fingerprint``, and their number.

    Fewer than k words make one shingle of them all; no word makes none.
    """
    docs = len(w.first) - 1
    counts = np.diff(w.first)
    m = len(w.hash)
    if m == 0:
        return np.zeros(0, np.uint64), np.zeros(docs, np.int64)
    weight = powers(0xC2B2AE3D27D4EB4F, k)
    doc = np.repeat(np.arange(docs), counts)
    last = w.first[1:][doc]
    place = np.arange(m)
    whole = place + k <= last
    sums = np.zeros(m, dtype=np.uint64)
    for i in range(k):
        sums[: m - i] += w.hash[i:] * weight[i]
    made = [mix(sums[whole] + np.uint64(k)) ]
    owner = [doc[whole]]
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        take = np.minimum(w.first[few][:, None] + np.arange(k), m - 1)
        real = np.arange(k) < counts[few][:, None]
        made.append(mix((w.hash[take] * weight * real).sum(axis=1, dtype=np.uint64) + counts[few].astype(np.uint64)))
        owner.append(few)
    packed = (np.concatenate(owner).astype(np.uint64) << np.uint64(FP_BITS)) | (np.concatenate(made) >> np.uint64(64 - FP_BITS))
    packed.sort()
    packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])]
    return packed, np.bincount((packed >> np.uint64(FP_BITS)).astype(np.int64), minlength=docs)


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over consecutive ranges [first[i], first[i+1])."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Groups of consecutive rows with one key, from a partition sorted by it.

    Holds one group at a time; callers bound the size of a group.
    """
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        k = table.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        if held and held[-1].column(key)[0].as_py() != k[0]:
            yield pa.concat_tables(held)
            held = []
        for a, b in zip(edges, edges[1:]):
            held.append(table.slice(a, b - a))
            if b < len(k):
                yield pa.concat_tables(held)
                held = []
    if held:
        yield pa.concat_tables(held)
