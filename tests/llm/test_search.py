"""Ranked lexical search against brute force, and on awkward tables."""

from __future__ import annotations

import collections
import math
import random
import re

import pytest

from lendrisk.llm import reversed_search
from lendrisk.llm.scratch import importable

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, score double, rank int, item_id string"


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


def _terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def brute(items, documents, k=20):
    bags = [(d, collections.Counter(_terms(t))) for d, t in documents]
    n = sum(bool(b) for _, b in bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for d, bag in bags:
            score = 0
            for t in _terms(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 75 + 25 * sum(bag.values()) * n // total
                    score += w * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                found.append((score, d))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r, d, s) for r, (s, d) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def _tables(spark, items, documents, parts=3):
    docs = spark.createDataFrame([(*d, 0.5, 7, "x") for d in documents], DOCS).repartition(parts)
    return spark.createDataFrame([(*x, 1, 2) for x in items], "item_id long, text string, doc_id int, score int"), docs


def _random(seed, n_docs=120):
    draw = random.Random(seed)
    words = ["a", "B", "é", "中文", "x1", "Über", "İ", "foo_bar", "it's", "the", "the", "The", "42", "\x00z", "naïve"]
    text = lambda most: draw.choice([" ", ".", "\n", "-"]).join(draw.choices(words, k=draw.randint(0, most)))
    documents = [(k, text(60)) for k in range(n_docs)]
    documents += [(3, None), (None, "the a"), (None, "the a"), (7, ""), *documents[:20]]  # nulls, repeated rows, ties
    items = [(k, text(12)) for k in range(9)] + [(100, None), (101, ""), (102, "nowhere"), (3, "the the é"), (None, "x1 b"), (0, "a a")]
    return items + items[:2], documents


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    items, documents = _random(seed)
    found = reversed_search.ranked(spark, *_tables(spark, items, documents), k=5)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(items, documents, 5)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_blocks_of_items_and_of_documents_change_nothing(spark, monkeypatch):
    items, documents = _random(4)
    tables = _tables(spark, items, documents)
    monkeypatch.setattr(reversed_search, "MOST_CELLS", 40)
    found = reversed_search.ranked(spark, *tables, k=5, most_block_bytes=1000)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(items, documents, 5)


def test_blocks_keep_their_bound(spark):
    items = spark.createDataFrame([(k, "w" * (k % 50)) for k in range(400)], "item_id long, text string")
    sizes = [b.selectExpr("sum(length(text) + 64)", "count(*)").first() for b in reversed_search._item_blocks(items, 1, 2000)]
    assert all(load is None or load <= 2000 or rows == 1 for load, rows in sizes) and sum(rows for _, rows in sizes) == 400


def test_scores_past_64_bits_in_between():
    corpus = reversed_search.Corpus(10**11, 10**14, reversed_search.np.zeros(0, int))
    assert corpus.damping(reversed_search.np.array([10**9])).tolist() == [75 + 25 * 10**9 * 10**11 // 10**14]


def test_very_long_text(spark):
    documents = [(1, "needle " + "hay " * 700_000), (2, "needle hay"), (3, "x" * 3_000_000)]
    items = [(1, "needle"), (2, "x" * 3_000_000)]
    found = reversed_search.ranked(spark, *_tables(spark, items, documents))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(items, documents)


def test_empty_tables(spark):
    items, documents = _random(5)
    full_items, full_documents = _tables(spark, items, documents)
    assert reversed_search.ranked(spark, full_items.limit(0), full_documents).count() == 0
    assert reversed_search.ranked(spark, full_items, full_documents.limit(0)).count() == 0
    assert reversed_search.ranked(spark, full_items, full_documents.selectExpr("doc_id", "cast(null as string) text")).count() == 0
