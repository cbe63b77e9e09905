"""Words of a batch of texts: runs of bytes other than ASCII white space, with the distinct ones found once."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lendrisk.llm.pretokens import string_bytes

#: The bytes that part words.
BREAKS = np.zeros(256, bool)
BREAKS[[32, *range(9, 14)]] = True


@dataclass(frozen=True)
class Words:
    """``distinct[index[k]]`` is the k-th word; text i owns words ``first[i]`` to ``first[i + 1]``.

    ``begin`` and ``end`` are the words' places in ``raw``, where text i is ``raw[bounds[i]:bounds[i + 1]]``.
    """

    distinct: pa.Array
    index: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    raw: np.ndarray
    bounds: np.ndarray


def words_of(texts: pa.Array, breaks: np.ndarray = BREAKS, fold: np.ndarray | None = None) -> Words:
    """Cut ``texts`` (null: empty) at the bytes that ``breaks`` marks; ``fold`` replaces each byte first."""
    raw, bounds = string_bytes(texts)
    if fold is not None:
        raw = fold[raw]
    n = len(raw)
    blank = breaks[raw]
    edge = np.zeros(n, bool)
    edge[bounds[:-1][bounds[:-1] < n]] = True
    if n:
        edge[0] = True
        edge[1:] |= blank[1:] != blank[:-1]
    tile = np.flatnonzero(edge)
    offsets = np.append(tile, n).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(tile), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())]).dictionary_encode()
    word = ~blank[tile]
    index = coded.indices.to_numpy()[word].astype(np.int64)
    # only the tiles that are words stay among the distinct ones
    used = np.zeros(len(coded.dictionary), bool)
    used[index] = True
    new = np.cumsum(used) - 1
    begin, end = tile[word], np.append(tile[1:], n)[word]
    return Words(coded.dictionary.filter(pa.array(used)), new[index], np.searchsorted(begin, bounds), begin, end, raw, bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: An odd factor, its inverse modulo 2**64, and a number for each byte.
FACTOR = 0xD6E8FEB86659FD93
INVERSE = np.uint64(pow(FACTOR, -1, 1 << 64))
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    return np.r_[np.uint64(1), np.cumprod(np.full(n, base, np.uint64))]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of ``texts`` (null: empty), and each text's first word plus the end.

    A word's hash is a polynomial in its bytes, taken for all words at once from differences of one running sum.
    """
    raw, bounds = string_bytes(texts)
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~BREAKS[raw]
    begins = inside[1:] & ~inside[:-1]
    cut = bounds[:-1][(bounds[:-1] > 0) & (bounds[:-1] < n)]
    begins[cut] = inside[cut + 1]  # a word ends with its text
    begin = np.flatnonzero(begins)
    # up to the next break, or the next word where texts touch
    breaks = np.append(np.flatnonzero(~inside[1:-1]), n)
    end = np.minimum(breaks[np.searchsorted(breaks, begin)], np.append(begin[1:], n))
    size = 1 << max(n - 1, 1).bit_length()
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[raw] * _powers(FACTOR, size)[:n], out=total[1:])
    value = (total[end] - total[begin]) * _powers(int(INVERSE), size)[begin]
    return mix(value + (end - begin).astype(np.uint64)), np.searchsorted(begin, bounds)
