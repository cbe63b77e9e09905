"""Latent-semantic vectors of texts: hashed byte trigrams, damped counts, weighted and projected by a truncated SVD."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendrisk.llm.pretokens import slices, string_bytes

#: Hashed features, and texts counted at a time.
FEATURES, BLOCK = 4096, 512


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """An (n, ``FEATURES``) array: how often each hashed run of three bytes occurs in each whole text (null: empty)."""
    raw, bounds = string_bytes(texts)
    n = len(bounds) - 1
    if len(raw) < 3:
        return np.zeros((n, FEATURES), np.float32)
    key = raw[:-2].astype(np.uint32) * np.uint32(0x9E3779B1)
    key += raw[1:-1].astype(np.uint32) * np.uint32(0x85EBCA77)
    key += raw[2:].astype(np.uint32) * np.uint32(0xC2B2AE3D)
    key = ((key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(20)).astype(np.int64)
    text = np.repeat(np.arange(n), np.diff(bounds))
    inside = text[2:] == text[:-2]
    cell = (text[:-2] * FEATURES + key)[inside]
    return np.bincount(cell, minlength=n * FEATURES).astype(np.float32).reshape(n, FEATURES)


@dataclass(frozen=True)
class Projection:
    """Weights of the features and their directions; ``rows`` maps texts to unit vectors, empty texts to zero."""

    weight: np.ndarray
    directions: np.ndarray

    def rows(self, counts: np.ndarray) -> np.ndarray:
        return unit((np.log1p(counts) * self.weight) @ self.directions)

    def of_texts(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first row, end row, vectors) of consecutive blocks."""
        for a, b in slices(texts):
            for at in range(a, b, BLOCK):
                end = min(at + BLOCK, b)
                yield at, end, self.rows(trigram_counts(texts.slice(at, end - at)))


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def fit(counts: np.ndarray, size: int) -> Projection:
    """Weigh features by their rarity among the sample's texts and keep the ``size`` leading directions."""
    present = (counts > 0).sum(axis=0)
    weight = np.where(present > 0, np.log((1 + len(counts)) / (1 + present)) + 1, 0).astype(np.float32)
    x = unit(np.log1p(counts) * weight)
    values, vectors = np.linalg.eigh(x @ x.T)
    lead = np.argsort(values)[::-1][:size]
    lead = lead[values[lead] > 1e-6]
    directions = x.T @ (vectors[:, lead] / np.sqrt(values[lead]))
    return Projection(weight, np.ascontiguousarray(directions, np.float32))


def sampled(labelled: DataFrame, label: str, most: int, key: Column) -> DataFrame:
    """At most ``most`` rows of each value of ``label`` (which has few), those of least hash of ``key``.

    Values are counted first and rows thinned by hash to about twice the wanted number, so that few reach the ranking.
    """
    counts = {r[0]: r[1] for r in labelled.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    spot = F.pmod(F.xxhash64(key), F.lit(1 << 20)).cast("double") / (1 << 20)
    parts = []
    for value, n in sorted(counts.items()):
        mine = labelled.where((F.col(label) == value) & (spot < 2.0 * most / n + 64.0 / n))
        parts.append(mine.orderBy(F.xxhash64(key), key).limit(most))
    out = parts[0] if parts else labelled.limit(0)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def collected_counts(
    sample: DataFrame, text: str, label: str, beside: Callable[[pa.Array], np.ndarray] | None = None
) -> tuple[np.ndarray, list[object], np.ndarray]:
    """The sample's trigram counts, made on the executors and sent sparse, its labels, and what ``beside`` gives per text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, more = [], []
            for a, b in slices(batch.column(0)):
                for at in range(a, b, BLOCK):
                    texts = batch.column(0).slice(at, min(BLOCK, b - at))
                    for row in trigram_counts(texts):
                        place = np.flatnonzero(row).astype(np.uint16)
                        cells.append(place.tobytes() + row[place].astype(np.float32).tobytes())
                    more += [x.tobytes() for x in beside(texts)] if beside else [b""] * len(texts)
            yield pa.record_batch([pa.array(cells, pa.binary()), batch.column(1), pa.array(more, pa.binary())], names=["cells", "label", "more"])

    kind = sample.schema[label].dataType.simpleString()
    found = sample.select(F.col(text), F.col(label)).mapInArrow(work, f"cells binary, label {kind}, more binary").collect()
    counts = np.zeros((len(found), FEATURES), np.float32)
    for k, row in enumerate(found):
        n = len(row.cells) // 6
        counts[k, np.frombuffer(row.cells, np.uint16, n)] = np.frombuffer(row.cells, np.float32, n, 2 * n)
    more = np.array([np.frombuffer(r.more, np.float32) for r in found], np.float32) if found else np.zeros((0, 0), np.float32)
    return counts, [r.label for r in found], more
