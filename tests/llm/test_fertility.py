"""Fertility measures, bands and verdicts against plain Python."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lendrisk.llm import bpe, fertility
from lendrisk.llm.scratch import importable

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _measures(text, tokenizer, model):
    text = text or ""
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    n = len(ids)
    pieces = [p for w in WORD.findall(text) for p in model.encode(w)]
    single = sum(model.is_byte(p) or model.is_unknown(p) for p in pieces)
    entropy = -sum(c / n * math.log(c / n) for c in collections.Counter(ids).values()) if n else 0.0
    return n, len(text) / max(n, 1), single / max(len(pieces), 1), entropy / math.log(n) if n > 1 else 1.0


def _at(values, p):
    """The least value that at least the share ``p`` of all values doesn't exceed."""
    return sorted(values)[max(math.ceil(p * len(values)) - 1, 0)]


def _line(rows):
    x, y = [math.log(r[0]) for r in rows], [r[3] for r in rows]
    mx, my = sum(x) / len(x), sum(y) / len(y)
    square = sum((a - mx) ** 2 for a in x)
    return sum((a - mx) * (b - my) for a, b in zip(x, y, strict=True)) / square if square else 0.0


def _spread(values, floor):
    return max((_at(values, 0.75) - _at(values, 0.25)) / 1.349, floor)


def _band(rows):
    mids = [_at([r[k] for r in rows], 0.5) for k in (1, 2)]
    return mids, _line(rows)


def _verdicts(docs, min_texts=30):
    """kept per (lang, measures, base_failed) by the rules as the docstrings state them."""
    passed = collections.defaultdict(set)
    for lang, m, failed in docs:
        if not failed:
            passed[lang].add(m)
    everyone = [(lang, m) for lang, rows in passed.items() for m in rows]
    all_mids, all_slope = _band([m for _, m in everyone])
    own, strays = {}, []
    for lang, rows in passed.items():
        own[lang] = _band(rows) if len(rows) >= min_texts else (all_mids, all_slope)
        strays += [(lang, *(math.sqrt(m[0]) * (m[k] - own[lang][0][k - 1]) for k in (1, 2)), m[3] - own[lang][1] * math.log(m[0]), m[3] - all_slope * math.log(m[0])) for m in rows]
    floors = [fertility.FLOOR[m] for m in fertility.MEASURES]
    out = []
    for lang, m, failed in docs:
        if failed or lang not in own:
            out.append(not failed)
            continue
        few = len(passed[lang]) < min_texts
        mine = strays if few else [s for s in strays if s[0] == lang]
        level = 4 if few else 3
        spreads = [_spread([s[1] for s in mine], floors[0]), _spread([s[2] for s in mine], floors[1]), _spread([s[level] for s in mine], floors[2])]
        middle = _at([s[level] for s in mine], 0.5)
        mids, slope = own[lang]
        away = [math.sqrt(m[0]) * abs(m[k] - mids[k - 1]) for k in (1, 2)] + [abs(m[3] - slope * math.log(max(m[0], 1)) - middle)]
        out.append(all(a <= fertility.REACH[name] * s for a, name, s in zip(away, fertility.MEASURES, spreads, strict=True)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_measures_bands_and_verdicts(spark, seed):
    importable(spark)
    draw = random.Random(seed)
    words = {"en": "the of and house water running under bridges seven times again".split(), "de": "der und Wasser läuft unter Brücken siebenmal wieder Häuser".split(),
             "xx": ["中文字", "漢字", "日本語", "ok"]}
    rows = []
    for k in range(150):
        lang = draw.choice(["en", "en", "en", "de", "de", "xx", None])
        rows.append((k, " ".join(draw.choices(words[lang or "en"], k=draw.randint(40, 260))), lang))
    rows += [(500, " ".join(f"zq{draw.randrange(10**6)}x" for _ in range(200)), "en"), (501, "\x01͸" * 300 + " a" * 60, "de"), (502, None, "en"), (503, "", None)]
    rows += rows[:20]  # repeated rows don't narrow the bands
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {}
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for r in fertility.fertility_rules(table).collect():
        found[r.doc_id] = r
    docs = []
    for i, text, lang in rows:
        r, m = found[i], _measures(text, tokenizer, model)
        assert r.n_tokens == m[0]
        assert all(abs(r[name] - x) < 1e-9 for name, x in zip(fertility.MEASURES, m[1:], strict=True))
        docs.append((lang, (r.n_tokens, r.chars_per_token, r.byte_share, r.entropy_share), r.base_failed))
    kept = _verdicts(docs)
    assert [found[i].kept for i, _, _ in rows] == kept
    assert 0 < sum(kept) < len(kept)


def test_words_at_hand_outlive_a_full_store(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 4)
    asked = []

    def work(words):
        asked.extend(words)
        return np.array([c for w in words for c in w], np.int64), np.array([len(w) for w in words], np.int64)

    store = bpe.WordStore(work, {b"<s>": [7]})
    for words in ([b"a", b"bb", b"ccc"], [b"bb", b"dddd", b""], [b"bb", b"<s>", b"ee"], [b"ee", b"a", b"bb"]):
        place = store.places(pa.array(words, pa.binary()))
        got = [store.flat[store.start[k] : store.start[k] + store.length[k]].tolist() for k in place]
        assert got == [[7] if w == b"<s>" else list(w) for w in words]
    assert asked.count(b"bb") == asked.count(b"ee") == 1 and len(store.at) <= 4 + 3


def test_piece_counts_of_many_words_at_once():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    words = ["word", "日本語", "\U0001f600", "x", "antidisestablishmentarianism", "é"]
    store = fertility._piece_counts(path)
    place = store.places(pa.array([w.encode() for w in words], pa.binary()))
    for w, at in zip(words, store.start[place].tolist(), strict=True):
        ids = model.encode(w)
        assert store.flat[at : at + 2].tolist() == [len(ids), sum(model.is_byte(k) or model.is_unknown(k) for k in ids)]


def test_workers_take_arrows_memory_from_their_heap(spark):
    importable(spark)

    def pools(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([pa.default_memory_pool().backend_name] * batch.num_rows)], names=["pool"])

    assert {r.pool for r in spark.range(8).mapInArrow(pools, "pool string").collect()} == {"system"}


def test_a_store_tells_words_apart_by_all_their_bytes():
    """Words of any bytes and sizes, long ones included, with values that their bytes fix; asked in parts, sliced and again."""
    draw = np.random.default_rng(2)
    asked = []

    def work(words):
        asked.extend(words)
        return np.array([zlib.crc32(w) >> 1 for w in words], np.int64), np.ones(len(words), np.int64)

    words = [b"", b"\0", b"\0\0", b"a", b"a\0", b"x" * 24, b"x" * 25, b"x" * 2000, b"x" * 24 + b"\0"]
    words += [bytes(draw.integers(0, 3, k % 40, dtype=np.uint8)) for k in range(3000)]
    words = list(dict.fromkeys(words))
    store = bpe.WordStore(work)
    for part in (words[:500], words[300:], words[::-1]):
        place = store.places(pa.array([b"before", *part], pa.binary()).slice(1))
        assert store.flat[store.start[place]].tolist() == [zlib.crc32(w) >> 1 for w in part]
    assert len(asked) == len(words)


def test_a_store_forgets_what_it_cannot_keep(monkeypatch):
    """Slots for 64 words: the others are worked out again, with the same values."""
    monkeypatch.setattr(bpe, "SLOTS", 64)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 300)
    store = bpe.WordStore(lambda words: (np.array([int(w) for w in words]), np.ones(len(words), np.int64)))
    for a in (0, 100, 0, 250, 400):
        place = store.places(pa.array([str(k).encode() for k in range(a, a + 200)], pa.binary()))
        assert store.flat[store.start[place]].tolist() == [*range(a, a + 200)]
        assert len(store.at) <= 300 + 200


def test_a_full_store_takes_little_memory():
    store = bpe.WordStore(lambda words: (np.zeros(3 * len(words), np.int64), np.full(len(words), 3)))
    for a in range(0, 400_000, 50_000):
        store.places(pa.array([b"word-%d" % k for k in range(a, a + 50_000)], pa.binary()))
    held = (store.slots, store.key, store.at, store.flat, store.start, store.length)
    assert len(store.at) == 400_000 and sum(x.nbytes for x in held) < 40e6 and not store.long
