"""Texts cut into pre-tokens, a batch at a time, with the distinct ones found once.

The cut is that of the byte-level vocabularies' pattern (``public_tokenizers.PATTERN``). It is taken over one array of code
points for a whole batch: classes by table, runs of a class by comparison, and the pattern's rules on spaces and
contractions as corrections to the runs' borders.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LETTER, NUMBER, SPACE, OTHER = range(4)
#: The code points of Unicode's White_Space property.
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: What may follow an apostrophe as a pre-token of its own, in the pattern's order.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Text bytes taken at a time; and where a worker holds much besides, beyond which larger slices save little time.
SLICE_BYTES, SMALL_SLICE_BYTES = 2 << 20, 512 << 10


@functools.cache
def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LN":
            table[cp] = LETTER if kind == "L" else NUMBER
    table[list(WHITE_SPACE)] = SPACE
    return table


@dataclass(frozen=True)
class Pretokens:
    """``words[index[k]]`` is the k-th pre-token of the batch; text i owns pre-tokens ``first[i]`` to ``first[i + 1]``."""

    words: pa.Array
    index: np.ndarray
    first: np.ndarray


def string_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and each text's first byte plus the end."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes of text, or of one row."""
    _, bounds = string_bytes(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield at, min(end, len(texts))
        pa.default_memory_pool().release_unused()
        at = min(end, len(texts))


def _borders(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A mask of the code points at which a pre-token begins; ``starts`` are those at which a new text begins."""
    n = len(points)
    kind = _classes()[points]
    fresh = np.zeros(n, bool)
    fresh[starts] = True
    border = fresh.copy()
    border[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(border)
    end = np.append(run[1:], n)
    inner = np.append(~fresh[run[1:]], False)  # another run of the same text follows
    space = (kind[run] == SPACE) & inner
    last = end[space] - 1
    border[last] = True  # a space run leaves its last character to what follows
    glued = last[points[last] == 32] + 1
    border[glued] = False
    quote = run[(end - run == 1) & (points[run] == 39) & inner]
    quote = quote[border[quote] & (kind[np.minimum(quote + 1, n - 1)] == LETTER)]
    if len(quote):
        run_end = end[np.searchsorted(run, quote + 1)]
        open_ = np.ones(len(quote), bool)
        for tail in CONTRACTIONS:
            hit = open_ & (run_end - quote > len(tail))
            for k, c in enumerate(tail):
                hit &= points[np.minimum(quote + 1 + k, n - 1)] == ord(c)
            at = quote[hit]
            border[at + 1] = False
            after = at + 1 + len(tail)
            border[after[after < n]] = True
            open_ &= ~hit
    return border


def pretokens(texts: pa.Array, special: bytes | None = None) -> Pretokens:
    """Cut ``texts`` (null: empty); occurrences of ``special`` are whole pre-tokens and part the text around them."""
    raw, bounds = string_bytes(texts)
    data = raw.tobytes()
    points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    at_byte = np.flatnonzero((raw & 0xC0) != 0x80)
    filled = bounds[:-1][bounds[1:] > bounds[:-1]]
    starts = np.searchsorted(at_byte, filled)
    found = []
    if special:
        hit = data.find(special)
        while hit >= 0:
            text = np.searchsorted(bounds, hit, "right") - 1
            inside = hit + len(special) <= bounds[text + 1]
            if inside:
                found.append(int(np.searchsorted(at_byte, hit)))
            hit = data.find(special, hit + (len(special) if inside else 1))
    if found:
        opens = np.array(found)
        closes = opens + len(special)
        starts = np.unique(np.concatenate([starts, opens, closes[closes < len(points)]]))
    border = _borders(points, starts) if len(points) else np.zeros(0, bool)
    for k in found:
        border[k + 1 : k + len(special)] = False
    cut = at_byte[border]
    offsets = np.append(cut, len(raw)).astype(np.int32)
    tiles = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = tiles.dictionary_encode()
    return Pretokens(coded.dictionary, coded.indices.to_numpy(), np.searchsorted(cut, bounds))


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions ``start[k] .. start[k] + length[k]`` of all k, one after another."""
    ends = np.cumsum(length)
    if len(ends) == 0 or ends[-1] == 0:
        return np.zeros(0, np.int64)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1])
