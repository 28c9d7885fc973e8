"""Token counts under a unigram model, by dynamic programming shared over a trie.

Pre-tokens are words (runs of bytes other than white space) with the word
mark in front.  The distinct pre-tokens of a batch form a trie of bytes; the
best unigram score of every prefix is computed once, at the trie node of that
prefix, from the nodes of its shorter prefixes.  A pre-token's number of
tokens is stored at its terminal node, and documents add up terminal counts.

Scores are those of a Zipf law over the ranks of a public vocabulary's
pieces: -ln(rank + 2), in units of 1e-4.  A byte that no piece covers is a
token of its own at a score below all pieces'.  The best segmentation has the
highest score, and among those of equal score the fewest tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textkit as tk
from .common import ship

MARK = "▁".encode()
UNIT = 1e-4
#: A node's value is score * COUNT - tokens, so one comparison ranks both.
COUNT = 1 << 22
#: Bytes of a word after which values count from where they are, so they fit 64 bits however long it is.
REBASE = 1 << 16
#: Distinct pre-tokens in a trie at a time.
TRIE_WORDS = 200_000


def zipf_pieces(path: str) -> dict[bytes, int]:
    """Pieces of a sentencepiece file with integer scores by rank; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {p.encode("utf-8"): round(-math.log(rank + 2) / UNIT) for rank, p in enumerate(pieces)}


class Unigram:
    """Pieces as an automaton over bytes: state * 256 + byte -> state, and a state's score."""

    def __init__(self, pieces: dict[bytes, int]):
        step: dict[int, int] = {}
        scores: list[int | None] = [None]
        for piece, score in pieces.items():
            state = 0
            for byte in piece:
                key = state * 256 + byte
                if key not in step:
                    step[key] = len(scores)
                    scores.append(None)
                state = step[key]
            scores[state] = score
        self.next = np.zeros(len(scores) * 256, dtype=np.int32)
        self.next[list(step)] = list(step.values())
        self.ends = np.array([s is not None for s in scores])
        self.value = np.array([(s or 0) * COUNT - 1 for s in scores], dtype=np.int64)
        self.odd = (min(pieces.values(), default=0) - round(10 / UNIT)) * COUNT - 1

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each of ``words``, which are distinct, sorted and not empty."""
        n = len(words)
        lens = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
        tokens = np.zeros(n, dtype=np.int64)
        spent = np.zeros(1, dtype=np.int64)  # tokens of each node that its value leaves out
        # words from one below to here share a prefix of this many bytes
        alive = np.arange(n)
        node = np.zeros(n, dtype=np.int64)  # of each word alive, among the nodes of the level above
        forward = np.zeros(1, dtype=np.int64)
        # automaton states under way at each node: (node, state, value before the piece)
        at, state, before = (np.zeros(0, dtype=np.int64) for _ in range(3))
        depth = 0
        while len(alive):
            byte = data[starts[alive] + depth].astype(np.int64)
            key = node * 256 + byte
            new = np.concatenate([[True], key[1:] != key[:-1]])
            child = np.cumsum(new) - 1
            parent, label = node[new], byte[new]
            # pieces that begin at the parent join those under way there
            at = np.concatenate([at, np.arange(len(forward))])
            state = np.concatenate([state, np.zeros(len(forward), np.int64)])
            before = np.concatenate([before, forward])
            order = np.argsort(at, kind="stable")
            at, state, before = at[order], state[order], before[order]
            lo, hi = np.searchsorted(at, parent), np.searchsorted(at, parent, "right")
            many = hi - lo
            owner = np.repeat(np.arange(len(parent)), many)
            source = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
            moved = self.next[state[source] * 256 + label[owner]].astype(np.int64)
            value = forward[parent] + self.odd
            on = moved > 0
            owner, moved, source = owner[on], moved[on], source[on]
            whole = self.ends[moved]
            np.maximum.at(value, owner[whole], before[source[whole]] + self.value[moved[whole]])
            at, state, before, forward, spent = owner, moved, before[source], value, spent[parent]
            depth += 1
            done = lens[alive] == depth
            tokens[alive[done]] = self.tokens(forward[child[done]]) + spent[child[done]]
            alive, node = alive[~done], child[~done]
            if depth % REBASE == 0:
                spent = spent + self.tokens(forward)
                before, forward = before - forward[at], np.zeros_like(forward)
        return tokens

    @staticmethod
    def tokens(value: np.ndarray) -> np.ndarray:
        """Tokens of a value; just after a rebase a path may have a few less than the one it counts from."""
        return (COUNT // 2 - value) % COUNT - COUNT // 2


_made: dict[str, Unigram] = {}


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _made:
            _made[path] = Unigram(zipf_pieces(path))
        model = _made[path]
        for batch in batches:
            ids = batch.column("doc_id")
            for row, data, offsets in tk.slices(batch.column("text")):
                raw = data.tobytes()
                own = [raw[a:b].split() for a, b in zip(offsets[:-1], offsets[1:])]
                distinct = sorted({w for words in own for w in words})
                tokens: dict[bytes, int] = {}
                for i in range(0, len(distinct), TRIE_WORDS):
                    part = distinct[i : i + TRIE_WORDS]
                    tokens.update(zip(part, model.counts([MARK + w for w in part]).tolist()))
                total = [sum(map(tokens.__getitem__, words)) for words in own]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(own)), pa.array([len(w) for w in own], pa.int64()), pa.array(total, pa.int64())],
                    ["doc_id", "n_words", "n_tokens"],
                )

    return run


def token_counts(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, n_words, n_tokens.

    Null, empty and blank texts have no words and no tokens.  Texts are taken
    as they are, without normalisation.  Repeated rows are counted alike.
    A trie holds the words of one slice of a task's rows, so memory follows
    the slice and the longest word, never the corpus.  Other columns are
    ignored whatever their names.  An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    return docs.select("doc_id", "text").mapInArrow(_count(model_path), "doc_id long, n_words long, n_tokens long")
