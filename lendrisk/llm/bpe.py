"""Byte-pair encoding and decoding in batched merge rounds (operator 1).

All distinct words of a batch lie in one flat array of symbols. A round looks up the merge rank of every new neighbour pair by
binary search over the sorted pair keys, finds each word's lowest rank, and merges all its occurrences, left to right. Words
without a mergeable pair leave the array. Decoding gathers the tokens' bytes the same way.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from lendrisk.llm.pretokens import SMALL_SLICE_BYTES, pretokens, slices, spread
from lendrisk.llm.words import mix

NO_RANK = np.int64(1) << 40
#: Bytes above which a word is merged by a queue, whose cost doesn't grow with the square of the word.
LONG_WORD = 1024
#: Words kept from earlier batches, per Python worker; slots to find them by, of which a word tries some; bytes that tell short words apart.
KEPT_WORDS, SLOTS, PROBES, KEY_BYTES = 400_000, 1 << 20, 4, 24
#: The lowest 0 to 8 bytes of a number.
LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _byte_symbols() -> dict[str, int]:
    """The vocabulary file's printable stand-in for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """Sorted pair keys with their ranks and products, and the bytes of every token id."""

    size: int
    byte_ids: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    products: np.ndarray
    token_bytes: np.ndarray
    token_first: np.ndarray
    special: tuple[bytes, int] | None

    @functools.cached_property
    def byte_pairs(self) -> np.ndarray:
        """The place of each pair of bytes, the first one times 256 plus the second."""
        return self.pair(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair among the keys, or -1."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, -1)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids, of = spec["model"]["vocab"], _byte_symbols()
    added = [(x["content"].encode(), x["id"]) for x in spec["added_tokens"]]
    size = max([*ids.values(), *(k for _, k in added)]) + 1
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
    order = np.argsort(keys)
    content = {k: bytes(of[c] for c in token) for token, k in ids.items()} | {k: token for token, k in added}
    tokens = [content.get(k, b"") for k in range(size)]
    return Vocabulary(
        size=size,
        byte_ids=np.array([ids[c] for c, _ in sorted(of.items(), key=lambda x: x[1])], np.int64),
        keys=keys[order],
        ranks=order.astype(np.int64),
        products=np.array([ids[a + b] for a, b in pairs], np.int64)[order],
        token_bytes=np.frombuffer(b"".join(tokens), np.uint8),
        token_first=np.cumsum([0, *map(len, tokens)]),
        special=added[0] if added else None,
    )


def _queued(vocab: Vocabulary, symbols: list[int]) -> list[int]:
    """One word's merges in order of rank and place, by a queue over linked symbols."""
    n = len(symbols)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    queue: list[tuple[int, int, int, int, int]] = []

    def offer(places: list[int]) -> None:
        places = [k for k in places if k >= 0 and after[k] >= 0]
        left, right = np.array([symbols[k] for k in places], np.int64), np.array([symbols[after[k]] for k in places], np.int64)
        for k, a, b, p in zip(places, left.tolist(), right.tolist(), vocab.pair(left, right).tolist(), strict=True):
            if p >= 0:
                heapq.heappush(queue, (int(vocab.ranks[p]), k, a, b, int(vocab.products[p])))

    offer(list(range(n)))
    while queue:
        _, k, a, b, product = heapq.heappop(queue)
        j = after[k]
        if symbols[k] != a or j < 0 or symbols[j] != b:
            continue
        symbols[k], symbols[j] = product, -1
        after[k] = after[j]
        if after[k] >= 0:
            before[after[k]] = k
        offer([before[k], k])
    return [s for s in symbols if s >= 0]


def merge_words(vocab: Vocabulary, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of words ``data[first[k]:first[k + 1]]``, in one array, and each word's number of them."""
    length = np.diff(first)
    n = len(length)
    done_word: list[np.ndarray] = []
    done_symbol: list[np.ndarray] = []
    for k in np.flatnonzero(length > LONG_WORD):
        ids = _queued(vocab, vocab.byte_ids[data[first[k] : first[k + 1]]].tolist())
        done_word.append(np.full(len(ids), k))
        done_symbol.append(np.array(ids, np.int64))
    short = np.flatnonzero((length > 0) & (length <= LONG_WORD))
    word = np.repeat(short, length[short])
    byte = data[spread(first[short], length[short])].astype(np.int64)
    symbol = vocab.byte_ids[byte]
    place = np.full(len(symbol), -1, np.int64)
    inner = np.flatnonzero(word[1:] == word[:-1])
    place[inner] = vocab.byte_pairs[byte[inner] * 256 + byte[inner + 1]]
    while len(word):
        rank = np.where(place >= 0, vocab.ranks[place], NO_RANK)
        opens = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        low = np.repeat(np.minimum.reduceat(rank, opens), np.diff(np.r_[opens, len(word)]))
        over = low == NO_RANK
        if over.any():
            done_word.append(word[over])
            done_symbol.append(symbol[over])
            left = np.flatnonzero(~over)
            word, symbol, place, rank, low = (x[left] for x in (word, symbol, place, rank, low))
            if not len(word):
                break
        hit = np.flatnonzero(rank == low)
        chain = np.r_[True, np.diff(hit) != 1]  # equal neighbours overlap: take every other one
        offset = np.arange(len(hit)) - np.flatnonzero(chain)[np.cumsum(chain) - 1]
        hit = hit[offset % 2 == 0]
        symbol[hit] = vocab.products[place[hit]]
        keep = np.ones(len(word), bool)
        keep[hit + 1] = False
        moved = hit - np.arange(len(hit))  # places after the merged-in symbols have gone
        word, symbol, place = word[keep], symbol[keep], place[keep]
        touched = np.zeros(len(word), bool)
        touched[moved] = True
        touched[moved[moved > 0] - 1] = True
        stale = np.flatnonzero(touched)
        place[stale] = -1
        stale = stale[stale < len(word) - 1]
        stale = stale[word[stale] == word[stale + 1]]
        place[stale] = vocab.pair(symbol[stale], symbol[stale + 1])
    if not done_word:
        return np.zeros(0, np.int64), np.zeros(n, np.int64)
    word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
    return symbol[np.argsort(word, kind="stable")], np.bincount(word, minlength=n)


class WordStore:
    """Values of words seen so far: a flat array and each word's part of it. ``work`` gives those of new words.

    A word of at most ``KEY_BYTES`` bytes is known by these bytes and its size, as numbers, and found for all words of a batch at
    once through a table of slots; a longer one by a dictionary.
    """

    def __init__(self, work: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], known: dict[bytes, list[int]] | None = None):
        self.work, self.known = work, known or {}
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(SLOTS, -1, np.int32)
        self.key = np.zeros((KEY_BYTES // 8 + 1, 0), np.uint64)
        self.at = np.zeros(0, np.int32)  # each row's first slot
        self.long: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.start, self.length = np.zeros(0, np.int32), np.zeros(0, np.int32)
        if self.known:
            key, at = _word_keys(*_word_bytes(pa.array(list(self.known), pa.binary())))
            values = list(self.known.values())
            self._add(key, at, list(self.known), np.array([x for v in values for x in v]), np.array([len(v) for v in values]))

    def _add(self, key: np.ndarray, at: np.ndarray, words: list[bytes], flat: np.ndarray, length: np.ndarray) -> None:
        """Rows for ``words``, which have none."""
        row = np.arange(len(self.at), len(self.at) + len(at), dtype=np.int32)
        size = key[-1]
        self.long.update((words[k], int(row[k])) for k in np.flatnonzero(size > KEY_BYTES).tolist())
        self.start = np.concatenate([self.start, (len(self.flat) + np.cumsum(length) - length).astype(np.int32)])
        self.length = np.concatenate([self.length, length.astype(np.int32)])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.key, self.at = np.concatenate([self.key, key], axis=1), np.concatenate([self.at, at])
        left = np.flatnonzero(size <= KEY_BYTES)
        for turn in range(PROBES):  # a word without a free slot is worked out again when it comes again
            slot = (at[left] + turn) & (SLOTS - 1)
            free = self.slots[slot] < 0
            self.slots[slot[free]] = row[left[free]]
            left = left[self.slots[slot] != row[left]]

    def _found(self, key: np.ndarray, at: np.ndarray, words: pa.Array) -> np.ndarray:
        """Each word's row, or -1."""
        found = np.full(len(at), -1, np.int64)
        for k in np.flatnonzero(key[-1] > KEY_BYTES).tolist():
            found[k] = self.long.get(words[k].as_py(), -1)
        left = np.flatnonzero(key[-1] <= KEY_BYTES)
        for turn in range(PROBES):
            row = self.slots[(at[left] + turn) & (SLOTS - 1)]
            left, row = left[row >= 0], row[row >= 0]
            same = np.ones(len(row), bool)
            for mine, theirs in zip(self.key, key, strict=True):
                same &= mine[row] == theirs[left]
            found[left[same]] = row[same]
            left = left[~same]
        return found

    def keep(self, rows: np.ndarray) -> None:
        """Forget all words but those of ``rows``, which needn't be worked out again."""
        rows = np.setdiff1d(rows[rows >= len(self.known)], [])
        names = {row: word for word, row in self.long.items()}
        words = [names.get(k, b"") for k in rows.tolist()] if names else [b""] * len(rows)
        key, at, length = self.key[:, rows], self.at[rows], self.length[rows]
        flat = self.flat[spread(self.start[rows], length)]
        self.clear()
        self._add(key, at, words, flat, length)

    def places(self, words: pa.Array) -> np.ndarray:
        """Each word's row in ``start`` and ``length``; ``words`` are distinct."""
        key, at = _word_keys(*_word_bytes(words))
        found = self._found(key, at, words)
        if len(self.at) > KEPT_WORDS:
            self.keep(found)
            found = self._found(key, at, words)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = words.take(pa.array(missing)).to_pylist()
            flat, length = self.work(new)
            found[missing] = np.arange(len(self.at), len(self.at) + len(new))
            self._add(key[:, missing], at[missing], new, flat, length)
        return found


def _word_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of binary ``words`` and the places where they begin, plus the end."""
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int32)
    words = words.cast(pa.binary())
    first = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), first


def _word_keys(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's first ``KEY_BYTES`` bytes as numbers, with its size in a last row, and its slot."""
    size = np.diff(first).astype(np.int64)
    padded = np.concatenate([data, np.zeros(KEY_BYTES + 8, np.uint8)])
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))  # at every byte, it and the seven after it
    key = np.empty((KEY_BYTES // 8 + 1, len(size)), np.uint64)
    key[-1] = size
    mixed = key[-1].copy()
    for k in range(KEY_BYTES // 8):
        inside = np.clip(size - 8 * k, 0, 8)
        key[k] = eights[np.minimum(first[:-1] + 8 * k, len(data))] & LOW_BYTES[inside]
        mixed = mix(mixed * GOLDEN + key[k])
    return key, (mixed & np.uint64(SLOTS - 1)).astype(np.int32)


@functools.cache
def word_ids(path: str) -> WordStore:
    """The ids of words under a vocabulary, kept for the life of a Python worker."""
    vocab = vocabulary(path)

    def work(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return merge_words(vocab, np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)]))

    return WordStore(work, {vocab.special[0]: [vocab.special[1]]} if vocab.special else None)


def _encoded(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all pre-tokens in ``word_ids``, and each text's first id plus the end."""
    store, vocab = word_ids(path), vocabulary(path)
    cut = pretokens(texts, vocab.special[0] if vocab.special else None)
    place = store.places(cut.words)[cut.index]
    return place, np.r_[0, np.cumsum(store.length[place])][cut.first]


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (null: empty) in one array, and each text's first id plus the end."""
    place, first = _encoded(texts, path)
    store = word_ids(path)
    return store.flat[spread(store.start[place], store.length[place])], first


def id_counts(texts: pa.Array, path: str) -> np.ndarray:
    """How many ids ``encode`` gives each text."""
    return np.diff(_encoded(texts, path)[1])


def decode(ids: np.ndarray, first: np.ndarray, path: str) -> list[str]:
    """The texts of id runs ``ids[first[k]:first[k + 1]]``; bytes that aren't UTF-8 become replacement characters."""
    vocab = vocabulary(path)
    start = vocab.token_first[ids]
    length = vocab.token_first[ids + 1] - start
    data = vocab.token_bytes[spread(start, length)].tobytes()
    at = np.r_[0, np.cumsum(length)][first]
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def encode_documents(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """Each document's token ids: (``id_col``, ids array<int>).

    Null and empty texts have no ids. Repeated rows and null ids are kept as they are. Other columns are not read.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), SMALL_SLICE_BYTES):
                part = batch.slice(a, b - a)
                ids, first = encode(part.column(1), path)
                yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))], names=[id_col, "ids"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(rows, f"`{id_col}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """The texts of token ids: (``id_col``, text). Null and empty lists give the empty text."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]
            yield pa.record_batch([batch.column(0), pa.array(decode(ids, first, path), pa.string())], names=[id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(rows, f"`{id_col}` {kind}, text string")


def round_trip_digests(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Encode, decode again, and return (``id_col``, n_tokens, ids_sha256, decoded_sha256), ids joined by commas.

    Both steps run on the same slice of rows, so that no ids are moved between tasks.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = np.array([str(k) for k in range(vocabulary(path).size)], object)

        def sha(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()

        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                ids, first = encode(part.column(1), path)
                named = spelt[ids]
                ids_sha = [sha(",".join(named[x:y])) for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                text_sha = [sha(text) for text in decode(ids, first, path)]
                yield pa.record_batch(
                    [part.column(0), pa.array(np.diff(first), pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return documents.select(id_col, text_col).mapInArrow(rows, schema)
