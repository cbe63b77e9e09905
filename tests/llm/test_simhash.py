"""SimHash near copies against brute force, and on awkward tables."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lendrisk.llm import sliced_simhash
from lendrisk.llm.scratch import importable

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


def brute_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(rows, prints=None):
    prints = prints or [brute_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    part = {f: f for f in distinct}

    def root(f):
        while part[f] != f:
            f = part[f]
        return f

    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= 3:
                part[root(a)] = root(b)
    least = {}
    for (i, _), f in zip(rows, prints, strict=True):
        known = least.get(root(f))
        least[root(f)] = i if known is None else known if i is None else min(i, known)
    return sorted(((i, f"{f:016x}", least[root(f)]) for (i, _), f in zip(rows, prints, strict=True)), key=repr)


def _texts(seed):
    draw = random.Random(seed)
    words = ["alpha", "Beta", "é", "中文", "x1", "ÀB", "it's", "the", " ", " z", "g\x00h", "I"]
    base = [" ".join(draw.choices(words, k=draw.randint(3, 400))) for _ in range(25)]
    texts = list(base)
    for text in base:
        for _ in range(6):
            w = text.split(" ")
            for _ in range(draw.randint(0, 3)):
                w[draw.randrange(len(w))] = draw.choice(words)
            texts.append(draw.choice([" ", "\n", " \t "]).join(w))
    texts += ["", None, "  \n", "one", "one two", "One TWO", "a b c", *base[:5]]
    rows = [(k, t) for k, t in enumerate(texts)]
    return [*rows, (None, "one"), (None, "nobody else says this"), (3, texts[3]), (3, "another text"), (900, " ".join(words * 30_000))]


def _found(spark, rows):
    table = spark.createDataFrame([(*r, "f", 1, 2) for r in rows], "doc_id long, text string, fingerprint string, fp int, component_id int")
    return sorted(map(tuple, sliced_simhash.near_copies(table.repartition(3)).collect()), key=repr)


@pytest.mark.parametrize("cell", [4096, 3])
def test_equals_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(sliced_simhash, "CELL_ROWS", cell)
    rows = _texts(cell)
    assert _found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert sliced_simhash.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fingerprints_over_many_slices(monkeypatch):
    monkeypatch.setattr(sliced_simhash, "COUNTED", 7)
    texts = [t for _, t in _texts(9)][:-1]
    assert sliced_simhash.fingerprints(pa.array(texts)).tolist() == [brute_print(t) for t in texts]


def _near(draw, n, spread):
    """Random fingerprints and others a few bits away, chains among them."""
    out = [draw.getrandbits(64) for _ in range(n)]
    for _ in range(spread):
        f = draw.choice(out)
        for bit in draw.sample(range(64), draw.randint(1, 5)):
            f ^= 1 << bit
        out.append(f)
    return sorted(set(out))


@pytest.mark.parametrize(("seed", "cell"), [(1, 4096), (2, 4)])
def test_links_join_all_within_the_radius(spark, monkeypatch, seed, cell):
    monkeypatch.setattr(sliced_simhash, "CELL_ROWS", cell)
    prints = _near(random.Random(seed), 60, 400)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    found = sliced_simhash.links(spark.createDataFrame(signed, "fp long").repartition(5)).collect()
    joined = sliced_simhash.Forest(len(prints))
    place = {f: k for k, (f,) in enumerate(signed)}
    assert all(((a ^ b) != 0) for a, b in found)
    joined.join(np.array([place[a] for a, _ in found]), np.array([place[b] for _, b in found]))
    rows = [(k, None) for k in range(len(prints))]
    assert sorted(((k, f"{f:016x}", int(joined.roots[k])) for k, f in enumerate(prints)), key=repr) == brute(rows, prints)


def test_sliced_comparison_equals_single_ones(monkeypatch):
    monkeypatch.setattr(sliced_simhash, "MOST_WORDS", 9)
    prints = np.array(_near(random.Random(5), 100, 500), np.uint64)
    n = len(prints)
    opens, closes = np.zeros(n, np.int64), np.arange(n)
    opens[200:300] = 150
    closes[250:260] = 0  # nobody
    found = {(int(a), int(b)) for x, y in sliced_simhash.close_pairs(prints, opens, closes, np.zeros(n, np.uint64)) for a, b in zip(x, y, strict=True)}
    values = prints.tolist()
    assert found == {(i, j) for i in range(n) for j in range(opens[i], closes[i]) if (values[i] ^ values[j]).bit_count() <= 3}


def test_any_pair_within_the_radius_meets():
    draw = random.Random(6)
    masks = [sum(1 << int(b) for g in groups for b in sliced_simhash.GROUPS[g]) for groups in sliced_simhash.MEETINGS]
    assert sorted(b for g in sliced_simhash.GROUPS for b in g) == list(range(64))
    for _ in range(2000):
        differ = sum(1 << b for b in draw.sample(range(64), 3))
        assert any(differ & m == 0 for m in masks)
