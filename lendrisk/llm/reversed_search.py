"""Ranked lexical search by reversed roles: the queries are indexed and the documents stream past (operator 11).

The items' terms make an inverted index, term to (item, times), which is small and broadcast. Every document's term counts run
through the postings of its own terms, and each item keeps a bounded heap of its best documents. A task hands on no more than its
heaps, and heaps merge in two steps, so neither a corpus-wide index nor a document's terms are ever shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendrisk.llm.pretokens import slices, spread
from lendrisk.llm.scratch import written
from lendrisk.llm.words import words_of

#: The bytes that part terms (ASCII but digits and letters), and A-Z lower-cased.
TERM_BREAKS = np.zeros(256, bool)
TERM_BREAKS[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Most scores and posting steps held at a time.
MOST_CELLS = 1 << 22
#: Tasks' heaps are merged in so many parts first.
MERGES = 64


@dataclass(frozen=True)
class Index:
    """Inverted index of one block of items: ``terms`` distinct and numbered; term t owns postings ``first[t]`` to ``first[t + 1]``."""

    terms: pa.Array
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray
    n_items: int

    @classmethod
    def of(cls, texts: pa.Array) -> Index:
        """The index of items numbered by their place in ``texts``."""
        words = words_of(texts, TERM_BREAKS, LOWER)
        item = np.repeat(np.arange(len(texts)), np.diff(words.first))
        key, times = np.unique(words.index * max(len(texts), 1) + item, return_counts=True)
        term, item = np.divmod(key, max(len(texts), 1))
        return cls(words.distinct, np.searchsorted(term, np.arange(len(words.distinct) + 1)), item, times, len(texts))

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, times) of the indexed terms in each text, by text, and the number of all terms of each text."""
        words = words_of(texts, TERM_BREAKS, LOWER)
        number = pc.fill_null(pc.index_in(words.distinct, value_set=self.terms), -1).to_numpy()
        length = np.diff(words.first)
        term = number[words.index]
        known = term >= 0
        text = np.repeat(np.arange(len(texts)), length)[known]
        key, times = np.unique(text * max(len(self.terms), 1) + term[known], return_counts=True)
        return *np.divmod(key, max(len(self.terms), 1)), times, length


@dataclass(frozen=True)
class Corpus:
    """What a score needs of all documents: their number, their terms with repeats, and a weight per indexed term."""

    n: int
    terms: int
    weight: np.ndarray

    def damping(self, length: np.ndarray) -> np.ndarray:
        """100 - 25 + (25 * length * n) div terms, per document; Python's integers, as the product may pass 64 bits."""
        return np.array([75 + 25 * x * self.n // self.terms for x in length.tolist()], np.int64)


class Heaps:
    """The ``k`` best (score, document id) of each item: highest score first, then least id, null last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.ones(n_items, np.int64)  # what a document must score to enter
        self.item = self.score = self.id = np.zeros(0, np.int64)
        self.unnamed = np.zeros(0, bool)

    def offer(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        """Take in documents (rows of ``scores``, a column per item)."""
        bar = self.least
        if len(scores) > self.k:
            bar = np.maximum(bar, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        row, item = np.nonzero(scores >= bar)
        if not len(row):
            return
        item, score = np.r_[self.item, item], np.r_[self.score, scores[row, item]]
        ids, unnamed = np.r_[self.id, ids[row]], np.r_[self.unnamed, unnamed[row]]
        order = np.lexsort((ids, unnamed, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, place = order[place < self.k], item[place < self.k], place[place < self.k]
        self.item, self.score, self.id, self.unnamed = item, score[order], ids[order], unnamed[order]
        full = place == self.k - 1
        self.least[item[full]] = self.score[full]


def _corpus(texts: DataFrame, index: Index) -> Corpus:
    """Counts over all ``texts``; a task sends a row per indexed term that it met."""
    there = texts.sparkSession.sparkContext.broadcast(index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = there.value
        n = terms = 0
        held = np.zeros(len(index.terms), np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                _, term, _, length = index.counts(batch.column(0).slice(a, b - a))
                held += np.bincount(term, minlength=len(held))
                n, terms = n + int((length > 0).sum()), terms + int(length.sum())
        met = np.flatnonzero(held)
        yield pa.record_batch([pa.array(np.r_[-2, -1, met], pa.int32()), pa.array(np.r_[n, terms, held[met]], pa.int64())], names=["term", "n"])

    sums = dict(texts.mapInArrow(work, "term int, n bigint").groupBy("term").agg(F.sum("n")).collect())  # a row per indexed term
    n, terms = sums.get(-2) or 0, sums.get(-1) or 0
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * sums.get(t, 0) + 1))) for t in range(len(index.terms))]
    return Corpus(n, terms, np.array(weight, np.int64))


def _best(rows: DataFrame, index: Index, corpus: Corpus, k: int) -> DataFrame:
    """(item, score, id) of each task's heaps over ``rows`` (id, text)."""
    there = rows.sparkSession.sparkContext.broadcast((index, corpus))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, corpus = there.value
        heaps = Heaps(index.n_items, k)
        steps = np.diff(index.first)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                ids, texts = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
                text, term, times, length = index.counts(texts)
                if not len(text):
                    continue
                m = corpus.damping(length)
                value = corpus.weight[term] * ((1_000_000_000 * times) // (1000 * times + 12 * m[text]))
                unnamed = np.asarray(ids.is_null())
                ids = ids.fill_null(0).to_numpy()
                # blocks of documents, so that neither their scores nor their posting steps are too many at a time
                opens = np.searchsorted(text, np.arange(len(texts) + 1))
                before = np.r_[0, np.cumsum(steps[term])][opens]
                at = 0
                while at < len(texts):
                    end = int(np.searchsorted(before, before[at] + MOST_CELLS, "right")) - 1
                    end = max(at + 1, min(end, at + max(1, MOST_CELLS // index.n_items), len(texts)))
                    mine = slice(opens[at], opens[end])
                    post = spread(index.first[term[mine]], steps[term[mine]])
                    doc = np.repeat(text[mine] - at, steps[term[mine]])
                    scores = np.zeros((end - at) * index.n_items, np.int64)
                    np.add.at(scores, doc * index.n_items + index.item[post], np.repeat(value[mine], steps[term[mine]]) * index.times[post])
                    heaps.offer(scores.reshape(end - at, index.n_items), ids[at:end], unnamed[at:end])
                    at = end
        found = pa.array(heaps.id, pa.int64(), mask=heaps.unnamed)
        yield pa.record_batch([pa.array(heaps.item, pa.int32()), pa.array(heaps.score), found], names=["item", "score", "id"])

    return rows.mapInArrow(work, "item int, score bigint, id bigint")


def _item_blocks(items: DataFrame, k: int, most: int) -> Iterator[DataFrame]:
    """``items`` (item_id, text) in blocks whose texts and heaps take ``most`` bytes at most, or of one item."""
    load = F.octet_length("text") + 64 * k
    spot = F.xxhash64("item_id", "text")
    total = items.agg(F.sum(load)).first()[0] or 0
    n = max(1, -(-total // most))
    while n > 1:
        sizes = items.groupBy(F.pmod(spot, F.lit(n)).alias("block")).agg(F.sum(load).alias("load"), F.count(F.lit(1)).alias("rows"))
        if sizes.where((F.col("load") > most) & (F.col("rows") > 1)).isEmpty():
            break
        n *= 2
    for block in range(n):
        yield items.where(F.pmod(spot, F.lit(n)) == block) if n > 1 else items


def ranked(
    spark: SparkSession,
    items: DataFrame,
    documents: DataFrame,
    *,
    k: int = 20,
    item_col: str = "item_id",
    id_col: str = "doc_id",
    text_col: str = "text",
    most_block_bytes: int = 16 << 20,
) -> DataFrame:
    """The ``k`` best documents of each item: (``item_col``, rank, ``id_col``, score), highest score first, ties by least id.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased, in the whole text (null: none). A
    document's score sums over the item's terms, repeats included, the term's weight times its damped count, in whole numbers;
    documents that score 0 aren't returned, so an item whose terms no document has, or without terms, has no rows.

    Every row of ``documents`` is a document: rows that repeat an id are ranked apart, and a null id comes last among equal scores.
    Rows of ``items`` that are equal in id and text count once; different texts under one id, null included, are ranked apart
    under it. Other columns are ignored, whatever their names. Empty tables give no rows. Texts are read 2 MB at a time, or one
    text; an item may be of any length.

    Items are broadcast in blocks of ``most_block_bytes``; each block reads the documents twice, once for the counts that
    weights need, once for the scores, and keeps ``k`` documents an item and task. With more blocks than one the blocks' results are
    stored before the next begins.
    """
    asked = items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).where("text is not null").distinct()
    kind = asked.schema["item_id"].dataType
    rows = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    parts: list[DataFrame] = []
    blocks = list(_item_blocks(asked, k, most_block_bytes))
    for block in blocks:
        own = block.toArrow().combine_chunks()
        index = Index.of(own.column("text").combine_chunks() if own.num_rows else pa.array([], pa.string()))
        corpus = _corpus(rows.select("text"), index) if len(index.terms) else None
        if corpus is None or not corpus.terms:
            continue
        names = spark.createDataFrame([(n, x) for n, x in enumerate(own.column("item_id").to_pylist())], f"item int, item_id {kind.simpleString()}")
        heaps = _best(rows, index, corpus, k)
        order = F.desc("score"), F.asc_nulls_last("id")
        part = Window.partitionBy("item", F.pmod(F.xxhash64("id"), F.lit(MERGES))).orderBy(*order)
        merged = heaps.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
        whole = Window.partitionBy("item").orderBy(*order)
        best = merged.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
        # no more names than the block's items
        out = best.join(F.broadcast(names), "item").select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        parts.append(written(out) if len(blocks) > 1 else out)
    if not parts:
        return spark.createDataFrame([], f"`{item_col}` {kind.simpleString()}, rank int, `{id_col}` bigint, score bigint")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
