"""Quality scores by nearest-neighbour voting over latent-semantic vectors (operator 9).

Labelled texts become unit vectors: a truncated SVD of their trigrams, and beside it shares that a bag of trigrams hides (words
said again at once, capitals, symbols). They are few (a documented bound) and go to every task. Each document's cosines with
all of them are exact, block by block as matrix products. Its nearest neighbours vote with their labels, each weighted by its
similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendrisk.llm import latent
from lendrisk.llm.words import words_of


#: Length of a share of 1 beside the latent vector's length of 1.
SHARE_LENGTH = 2.0


def shares(texts: pa.Array) -> np.ndarray:
    """Per text: the shares of words equal to the word before, and to the one before that, of capitals and of symbols."""
    w = words_of(texts)
    n = len(w.first) - 1
    text = np.repeat(np.arange(n), np.diff(w.first))
    out = np.zeros((n, 4), np.float32)
    for lag in (1, 2):
        again = (w.index[lag:] == w.index[:-lag]) & (text[lag:] == text[:-lag])
        out[:, lag - 1] = np.bincount(text[lag:][again], minlength=n) / np.maximum(np.diff(w.first), 1)
    size = np.maximum(np.diff(w.bounds), 1)
    capital = (w.raw >= 65) & (w.raw <= 90)
    symbol = (w.raw > 32) & (w.raw < 127) & ~capital & ~((w.raw >= 97) & (w.raw <= 122)) & ~((w.raw >= 48) & (w.raw <= 57))
    for k, of in ((2, capital), (3, symbol)):
        out[:, k] = np.diff(np.r_[0, np.cumsum(of)][w.bounds]) / size
    return out


def vectors(projection: latent.Projection, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, unit vectors) of consecutive blocks; a text without trigrams is the zero vector."""
    for a, b, rows in projection.of_texts(texts):
        beside = SHARE_LENGTH * shares(texts.slice(a, b - a))
        yield a, b, latent.unit(np.c_[rows, np.where(rows.any(axis=1, keepdims=True), beside, 0)].astype(np.float32))


@dataclass(frozen=True)
class Voters:
    """The labelled vectors, their labels (0 or 1), and the score of a text that resembles none of them."""

    projection: latent.Projection | None
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int
    sharpness: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if self.projection is None:
            return out
        k = min(self.neighbours, len(self.labels))
        for a, b, rows in vectors(self.projection, texts):
            cosine = rows @ self.vectors.T
            near = nearest(cosine, k)
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** self.sharpness
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1)
            out[a:b] = np.where(total > 0, np.divide(vote, total, out=np.zeros_like(vote), where=total > 0), self.prior)
        return out


def nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """The columns of the ``k`` largest values of each row; of those equal to the least of them the first ones."""
    n = cosine.shape[1]
    near = np.argpartition(cosine, n - k, axis=1)[:, n - k :]
    least = np.take_along_axis(cosine, near, 1).min(axis=1, keepdims=True)
    tied = (cosine >= least).sum(axis=1) > k
    near[tied] = np.argsort(-cosine[tied], axis=1, kind="stable")[:, :k]
    return near


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text has the remainder 1 by 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    """``held_out`` for one id, outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def fit_voters(
    documents: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most: int = 1024,
    dimensions: int = 64,
    neighbours: int = 15,
    sharpness: float = 8.0,
) -> Voters:
    """Learn from labelled documents that aren't held out: at most ``most`` of each label, spread by a hash of the id.

    Repeated labels of an id count once if they agree, and not at all if they differ. Null labels, labels other than 0 and 1, and
    labels of ids without a document are left out. Without any labelled text every score is 0.5. Voters stand by id, and of
    neighbours equally near the one of lesser id votes.
    """
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    marks = marks.where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    marks = marks.groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most")).where("_label = _most")
    chosen = latent.sampled(marks.select("_id", "_label"), "_label", most, F.col("_id"))
    # the chosen ids are at most 2 x most
    texts = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    counts, found, beside = latent.collected_counts(rows.orderBy("_id"), "_text", "_label", shares)
    filled = counts.any(axis=1) if len(found) else np.zeros(0, bool)
    counts, y = counts[filled], np.array(found, np.float64)[filled]
    if not len(y):
        return Voters(None, np.zeros((0, 0), np.float32), y, 0.5, neighbours, sharpness)
    projection = latent.fit(counts, dimensions)
    known = latent.unit(np.c_[projection.rows(counts), SHARE_LENGTH * beside[filled]].astype(np.float32))
    return Voters(projection, known, y, float(y.mean()), neighbours, sharpness)


def scored(documents: DataFrame, voters: Voters, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``documents`` with ``score_col`` from 0 to 1, higher where label 1 is likelier; only the text enters it.

    Null, empty and very short texts (under three bytes) get the labels' mean.
    """
    shared = documents.sparkSession.sparkContext.broadcast(voters)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(shared.value.scores(texts), pa.float64())

    return documents.withColumn(score_col, score(F.col(text_col)))
