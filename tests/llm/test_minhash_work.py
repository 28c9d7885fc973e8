"""How much work sketches and blocks take, and that less of it gives the same."""

import numpy as np
import pyarrow as pa

from tracefoundry.llm import lines, minhash
from tracefoundry.llm import textkit as tk


def _by_rounds(packed, docs, scheme):
    """A sketch one round and one set at a time."""
    T, out = scheme.coordinates, []
    for d in range(docs):
        element = packed[(packed >> np.uint64(tk.FP_BITS)) == d] & np.uint64((1 << tk.FP_BITS) - 1)
        best = [2**64 - 1] * T
        for r in range(2 * T if len(element) else 0):
            for h in tk.mix(element + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % 2**64)).tolist():
                at = (h >> 48) * T >> 16 if r < T else r - T
                best[at] = min(best[at], r << 48 | h & (1 << 48) - 1)
            if 2**64 - 1 not in best:
                break
        out.append(best)
    return tk.mix(np.array(out, dtype=np.uint64))


def test_sketch_takes_late_rounds_together(monkeypatch):
    rng = np.random.default_rng(5)
    sizes = [1, 0, 2, 300, 7, 64, 1, 1000, 30, 5]
    owner = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint64)
    packed = owner << np.uint64(tk.FP_BITS) | rng.integers(0, 1 << tk.FP_BITS, len(owner), dtype=np.uint64)
    packed = np.append(packed, packed[-3:])  # repeats are allowed
    for scheme in (lines.SCHEME, minhash.WORDS):
        want, calls, mix = _by_rounds(packed, len(sizes), scheme), [], tk.mix
        with monkeypatch.context() as m:
            m.setattr(tk, "mix", lambda x: calls.append(x.size) or mix(x))
            got = minhash.sketch(packed, len(sizes), scheme)
        assert (got == want).all()
        # a set of one shingle takes more rounds than there are coordinates
        assert len(calls) < 12


def test_small_blocks_are_compared_together(monkeypatch):
    """Equal texts of one bucket link by their components; a group's twins in another group do not, as they share no bucket."""
    groups, calls, shared = 300, [], minhash._shared
    rows = [{"doc_id": 10 * g + i, "component": 1000 + 10 * g + i, "buckets": [b], "text": text, "pair": g, "side": 2} for g in range(groups) for i, (b, text) in enumerate([(g, "one long line of words"), (g, "one long line of words"), (g, "another with nothing shared"), (-g - 1, "one long line of words")])]
    schema = pa.schema([(c, pa.string() if c == "text" else pa.list_(pa.int64()) if c == "buckets" else pa.int64()) for c in rows[0]])
    monkeypatch.setattr(minhash, "_shared", lambda *a: calls.append(1) or shared(*a))
    made = pa.Table.from_pylist(rows, schema)
    got = {(a, b) for batch in minhash._blocks(lines.char_shingles, 75)(iter(made.to_batches(max_chunksize=101))) for a, b in zip(*(batch.column(c).to_pylist() for c in ("a", "b")))}
    assert got == {(1000 + 10 * g, 1001 + 10 * g) for g in range(groups)}
    assert len(calls) <= 2 * (4 * groups // minhash.TOGETHER + 1)
