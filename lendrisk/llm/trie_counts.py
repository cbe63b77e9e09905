"""Token counts under a unigram model, by dynamic programming over a trie of distinct pre-tokens (operator 8).

The forward score of a prefix, that of its best split into vocabulary pieces, is the same in every word that begins with it.
Distinct pre-tokens are therefore sorted into a trie, whose nodes are scored once each, level by level: a node's open pieces
are its parent's, moved on by one byte in a trie of the vocabulary. A word's count stands at its terminal node. Pieces have the
probability of their rank in the vocabulary under Zipf's law.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from lendrisk.llm.bpe import WordStore
from lendrisk.llm.pretokens import pretokens, slices, spread


@dataclass(frozen=True)
class Pieces:
    """A trie of the vocabulary: sorted keys node * 256 + byte, the nodes they lead to, and each node's score (-inf: no piece)."""

    keys: np.ndarray
    to: np.ndarray
    score: np.ndarray

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Where ``byte`` leads from ``node``, or -1."""
        key = node * 256 + byte
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.to[at], -1)


def zipf_scores(n: int) -> np.ndarray:
    """Log probabilities of ranks 0 to n - 1 under Zipf's law."""
    weight = 1 / np.arange(1, n + 1)
    return np.log(weight / weight.sum())


@functools.cache
def pieces(path: str) -> Pieces:
    """Read a rank file of the tiktoken library."""
    with open(path, "rb") as f:
        ranked = sorted((int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, f))
    return piece_trie([piece for _, piece in ranked])


def piece_trie(ranked: list[bytes]) -> Pieces:
    """The trie of pieces given in order of rank."""
    edges: dict[int, int] = {}
    ends = []
    for piece in ranked:
        node = 0
        for byte in piece:
            node = edges.setdefault(node * 256 + byte, len(edges) + 1)
        ends.append(node)
    keys = np.array(list(edges), np.int64)
    order = np.argsort(keys)
    score = np.full(len(edges) + 1, -np.inf)
    score[ends] = zipf_scores(len(ranked))
    return Pieces(keys[order], np.array(list(edges.values()), np.int64)[order], score)


def count_words(model: Pieces, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct word's number of pieces and score in its best split; of equal scores the split of fewer pieces.

    All single bytes must be pieces, so that every word has a split.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    length = np.array([len(words[k]) for k in order], np.int64)
    flat = np.frombuffer(b"".join(words[k] for k in order), np.uint8).astype(np.int64)
    first = np.cumsum(length) - length
    shared = _shared_prefix(flat, first, length)
    n_out, score_out = np.zeros(len(words), np.int64), np.zeros(len(words))
    active = np.flatnonzero(length > 0)
    node_of = np.zeros(len(words), np.int64)
    best, least = np.zeros(1), np.zeros(1, np.int64)
    open_piece, open_score, open_n = (np.zeros(0, x) for x in (np.int64, np.float64, np.int64))
    open_first = np.zeros(2, np.int64)
    depth = 0
    while len(active):
        depth += 1
        opens = shared[active] < depth
        opens[0] = True
        parent = node_of[active[opens]]
        byte = flat[first[active[opens]] + depth - 1]
        node_of[active] = np.cumsum(opens) - 1
        # the parent's open pieces, and one that begins here
        n_open = open_first[parent + 1] - open_first[parent]
        moved = spread(open_first[parent], n_open)
        child = np.r_[np.repeat(np.arange(len(parent)), n_open), np.arange(len(parent))]
        at = model.step(np.r_[open_piece[moved], np.zeros(len(parent), np.int64)], byte[child])
        score = np.r_[open_score[moved], best[parent]]
        n = np.r_[open_n[moved], least[parent]]
        go = at >= 0
        child, at, score, n = child[go], at[go], score[go], n[go]
        by_child = np.argsort(child, kind="stable")
        child, open_piece, open_score, open_n = child[by_child], at[by_child], score[by_child], n[by_child]
        open_first = np.searchsorted(child, np.arange(len(parent) + 1))
        total = open_score + model.score[open_piece]
        best = np.maximum.reduceat(total, open_first[:-1])
        fewest = np.where(total == best[child], open_n + 1, np.iinfo(np.int64).max)
        least = np.minimum.reduceat(fewest, open_first[:-1])
        done = active[length[active] == depth]
        n_out[done], score_out[done] = least[node_of[done]], best[node_of[done]]
        active = active[length[active] > depth]
    back = np.empty(len(words), np.int64)
    back[order] = np.arange(len(words))
    return n_out[back], score_out[back]


def _shared_prefix(flat: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of sorted words: how many bytes each shares with the one before it."""
    out = np.zeros(len(length), np.int64)
    live, depth = np.arange(1, len(length)), 0
    while len(live):
        live = live[np.minimum(length[live], length[live - 1]) > depth]
        live = live[flat[first[live] + depth] == flat[first[live - 1] + depth]]
        out[live] += 1
        depth += 1
    return out


@functools.cache
def word_counts(path: str) -> WordStore:
    """The counts of words under a vocabulary, kept for the life of a Python worker."""
    model = pieces(path)

    def work(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return count_words(model, words)[0], np.ones(len(words), np.int64)

    return WordStore(work)


def token_counts(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(``id_col``, n_pretokens, n_tokens) of every whole text; null and empty texts have none. Repeated rows are kept.

    ``path`` is a rank file whose pieces include all bytes.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = word_counts(path)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                cut = pretokens(part.column(1))
                row = store.places(cut.words)
                n = store.flat[store.start[row]][cut.index] if len(row) else np.zeros(0, np.int64)
                tokens = np.diff(np.r_[0, np.cumsum(n)][cut.first])
                yield pa.record_batch([part.column(0), pa.array(np.diff(cut.first), pa.int64()), pa.array(tokens, pa.int64())], names=[id_col, "n_pretokens", "n_tokens"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(rows, f"`{id_col}` {kind}, n_pretokens bigint, n_tokens bigint")
