"""Token ids of whole texts, with every distinct word encoded once per worker.

The tokenizer's rules never reach across ASCII white space: it collapses white
space, and its pre-token pattern, its special tokens and NFC composition stay
within a run of other bytes.  So a text's ids are those of its words, one
after the other, and a cache of words gives them exactly.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Sequence
from itertools import repeat

import numpy as np

CACHE_WORDS = 700_000

#: Marks that the pattern keeps together after a run of letters, so that they are a pre-token of their own.
#: No apostrophe, which can begin a contraction, and no sign of a special token.
MARKS = b".,!?;:*$%&#()-"
TAIL_BITS = 32


def _letters(word: bytes) -> bool:
    """Whether a word is one run of letters for the tokenizer, also once composed and lower-cased."""
    if word.isascii():
        return word.isalpha()
    text = word.decode("utf-8")
    return text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


class WordTokenizer:
    """Word-cached ids of a ``tokenizers`` file with ``</w>`` word ends."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.ends = np.array([(self.model.id_to_token(i) or "").endswith("</w>") for i in range(self.model.get_vocab_size())])
        self._clear()

    def _clear(self) -> None:
        #: word -> code of its letters and code of its marks; codes are places in starts and lens
        self.code: dict[bytes, int] = {}
        self.part: dict[bytes, int] = {b"": 0}
        self.flat, self.starts, self.lens = array("I"), array("q", [0]), array("q", [0])

    def _add(self, parts: Sequence[bytes], ids: np.ndarray, lens: np.ndarray) -> None:
        first = len(self.starts)
        self.starts.frombytes((len(self.flat) + np.cumsum(lens) - lens).astype(np.int64).tobytes())
        self.lens.frombytes(lens.astype(np.int64).tobytes())
        self.flat.frombytes(ids.astype(np.uint32).tobytes())
        self.part.update(zip(parts, range(first, first + len(parts))))

    def _add_each(self, parts: list[bytes]) -> None:
        found = [e.ids for e in self.model.encode_batch_fast([w.decode("utf-8") for w in parts], add_special_tokens=False)]
        self._add(parts, np.array([i for ids in found for i in ids]), np.array([len(ids) for ids in found], dtype=np.int64))

    def _learn(self, new: set[bytes]) -> None:
        split, part = [], self.part
        tails, letters, others = set(), set(), set()
        for w in new:
            core = w.rstrip(MARKS)
            if core and _letters(core):
                tail = w[len(core) :]
                letters.add(core)
                tails.add(tail)
            else:
                core, tail = w, b""
                others.add(w)
            split.append((w, core, tail))
        self._add_each(sorted(t for t in tails if t not in part))
        plain = [c for c in letters if c not in part]
        # runs of letters are one pre-token each: many are encoded as one text and told apart by word ends
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            ids = np.array(self.model.encode(b" ".join(some).decode("utf-8"), add_special_tokens=False).ids)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                self._add(some, ids, np.diff(ends, prepend=0))
            else:
                self._add_each(some)
        self._add_each([c for c in others if c not in part])
        self.code.update((w, part[c] << TAIL_BITS | part[t]) for w, c, t in split)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text among them); null counts as empty."""
        words: list[bytes] = []
        counts = []
        for t in texts:
            raw = (t or "").encode("utf-8")
            own = (raw if b"<|" in raw else raw.lower()).split()
            counts.append(len(own))
            words += own
        codes = np.fromiter(map(self.code.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        if len(miss := np.flatnonzero(codes < 0)):
            new = {words[i] for i in miss}
            if len(self.code) + len(new) > CACHE_WORDS:
                self._clear()
                new, miss = set(words), np.arange(len(words))
            self._learn(new)
            codes[miss] = [self.code[words[i]] for i in miss]
        pairs = np.stack([codes >> TAIL_BITS, codes & ((1 << TAIL_BITS) - 1)], axis=1)
        n = np.frombuffer(self.lens, dtype=np.int64)[pairs].ravel()
        ends = np.cumsum(n)
        source = np.repeat(np.frombuffer(self.starts, dtype=np.int64)[pairs].ravel() - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(self.flat, dtype=np.uint32)[source] if len(source) else np.zeros(0, np.uint32)
        ends = ends[1::2]
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]


_made: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for ``path``; it lives as long as the worker."""
    if path not in _made:
        _made[path] = WordTokenizer(path)
    return _made[path]
