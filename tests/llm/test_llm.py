"""The training-data operators against brute force, round trips, held-out labels and awkward tables."""

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
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendrisk.llm import bagminhash, bpe, fertility, keyed_ids, multi_index, neighbour_vote, queries, scratch, soft_mixing, tag_paths, trie_counts, url_filter
from lendrisk.llm.components import components
from lendrisk.llm.scratch import importable, shared_folder

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, an id of two texts, and clashing extra columns."""
    long = " ".join(f"wörd{k % 977}" for k in range(30_000)) + "x" * 5000
    rows = [
        (1, "a b c d e f g h", "en", "s"), (1, "a b c d e f g h", "en", "s"), (2, "", "en", "s"), (3, None, None, None),
        (None, "a b c d e f g h", "de", "s"), (4, long, "en", "s"), (5, "   \n\t ", "en", "s"), (6, "one", "fr", "s"),
        (7, "it's <|endoftext|> x", "en", "s"), (8, "a b c d e f g h i", "en", "s"), (8, "other text under the same id", "en", "s"),
    ]
    df = spark.createDataFrame([(*r, 0.5, "k", 9, "r") for r in rows], "doc_id long, text string, lang string, source string, score double, kept string, rate int, digest string")
    return df.repartition(3).persist()


def test_bpe_equals_the_library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    draw = random.Random(7)
    parts = ["'", "s", "re", "ll", " ", "  ", "\n", "a", "B", "é", "中", "1", "!", "<|endoftext|>", "<|", "\u0301", "😀", "\x1c", "x" * 30]
    texts = ["", None, "it's", "a" * 3000 + "b", " " * 60, *("".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(3000))]
    ids, first = bpe.encode(pa.array(texts), VOCABULARY)
    texts = [t or "" for t in texts]
    for k, expected in enumerate(tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[first[k] : first[k + 1]].tolist() == expected.ids, texts[k]
    assert bpe.decode(ids, first, VOCABULARY) == texts


def test_bpe_long_words_equal_the_library(monkeypatch):
    monkeypatch.setattr(bpe, "LONG_WORD", 3)
    words = [b"entertainment", b"aaaaaaaa", "ünïcödé".encode(), b"x"]
    ids, length = bpe.merge_words(bpe.vocabulary(VOCABULARY), np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)]))
    expected = [Tokenizer.from_file(VOCABULARY).encode(w.decode()).ids for w in words]
    assert ids.tolist() == sum(expected, []) and length.tolist() == [len(x) for x in expected]


def test_bpe_round_trip_on_awkward_tables(spark, awkward):
    encoded = bpe.encode_documents(awkward)
    texts = sorted(r.text for r in bpe.decode_documents(encoded).collect())
    assert texts == sorted(r.text or "" for r in awkward.collect())
    assert bpe.round_trip_digests(awkward).count() == awkward.count()
    assert bpe.encode_documents(awkward.limit(0)).count() == 0


def _brute_classes(rows):
    texts = sorted({t or "" for _, t in rows})
    bags = {}
    for t in texts:
        w = WORD.findall(t)
        bags[t] = collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else collections.Counter()
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for k, x in enumerate(texts):
        for y in texts[:k]:
            both = sum((bags[x] & bags[y]).values())
            if both and both >= 0.8 * sum((bags[x] | bags[y]).values()):
                parent[root(x)] = root(y)
    least = {}
    for i, t in rows:
        r = root(t or "")
        least[r] = min((v for v in (least.get(r), i) if v is not None), default=None)
    return sorted(((i, least[root(t or "")]) for i, t in rows), key=str)


def test_signatures_are_unbiased():
    draw, off = np.random.default_rng(1), []
    for turn in range(200):  # words of their own, as equal words draw equal points
        base = [f"w{turn}-{k}" for k in draw.integers(0, 40, 200)]
        other = [f"z{turn}-{draw.integers(5)}" if draw.random() < 0.3 else w for w in base]
        x, y = collections.Counter(base), collections.Counter(other)
        found = bagminhash.windows(pa.array([" ".join(base), " ".join(other)]), 1)
        s = bagminhash.signatures(*found, 2, 1024)
        off.append((s[0] == s[1]).mean() - sum((x & y).values()) / sum((x | y).values()))
    assert abs(np.mean(off)) < 0.004


def test_near_copies_equal_brute_force(spark):
    draw = random.Random(3)
    vocabulary = [f"t{k}" for k in range(300)]
    rows, n = [], 0
    for _ in range(12):  # families that drift: many texts share a bucket without being similar
        text = draw.choices(vocabulary, k=draw.randint(4, 90))
        for _ in range(8):
            rows.append((n, " ".join(text)))
            n += 1
            text = [draw.choice(vocabulary) if draw.random() < 0.02 else w for w in text]
    rows += [(n, None), (n + 1, ""), (n + 2, "one two"), (n + 3, "one two"), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bagminhash.near_copies(df)
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == _brute_classes(rows)


def test_near_copies_on_awkward_tables(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = bagminhash.near_copies(awkward)
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == _brute_classes(rows)
    assert bagminhash.near_copies(awkward.limit(0)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 61)} | {100 + k: 100 for k in range(40)} | {200: 200, 201: 200}


def test_components_store_little_of_few_links(spark, monkeypatch):
    """Stars are settled as they come, and few links lie in few parts, however many Spark shuffles them to."""
    parts = []

    def written(df):
        out = scratch.written(df)
        parts.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr("lendrisk.llm.components.written", written)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(before, ("50", "false"), strict=True):
            spark.conf.set(k, v)
        stars = components(spark.createDataFrame([(k, k % 5) for k in range(5, 100)], "a long, b long"))
        assert len(parts) == 1 and {r.node: r.component for r in stars.collect()} == {k: k % 5 for k in range(100)}
        parts.clear()
        path = components(spark.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long"))
        assert len(parts) > 3 and max(parts[1:]) == 1 and {r.component for r in path.collect()} == {0} and path.count() == 201
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_unsettled_components_stop_the_run(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(edges, most_rounds=1)


PAGE = """<html><head><title>T</title></head><body class="no-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">We use
cookies. OK?</div><ul id=menu><li>A<li>B</ul>%s<form>Search <input></form><div id="comments"><p>Nice, I think. Really.</p></div>
<aside>side. text</aside><footer>&copy; 2020</footer><script>var t="</p>";</script></body>"""


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>cut &am", "cut &am"), ("<p>a<p cla", "a"),
        (PAGE % "<article><h1>Head</h1><p>First <b>bold.</b><br><p>Sec\n ond&nbsp;one</article>", "Head First bold. Sec ond one"),
        (PAGE % "<div class=x><h1>Head</h1><p>First para, with <i>some</i> text. It goes on.</p><p>Second para. More, too.</p></div>",
         "Head First para, with some text. It goes on. Second para. More, too."),
        ("<article><header><h1>T</h1><p>by x</p></header><p>Body</p><section class=comments><p>c</p></section></article>", "T Body"),
        ("<nav>only a menu</nav>", ""),
    ],
)
def test_main_text(html, text):
    assert tag_paths.main_text(html) == text


def test_main_text_of_deep_and_hostile_markup():
    assert tag_paths.main_text("<div>" * 20_000 + "deep" + "</span>" * 20_000) == "deep"
    assert tag_paths.main_text("<p title=\"open>text" * 50) is not None


def test_pages_of_the_provided_table(spark):
    pages = queries.table(spark, SF, "pages")
    found = {r.page_id: r.text for r in tag_paths.extract_pages(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        from html import unescape

        assert found[r.page_id] == " ".join(unescape(re.sub(r"<[^>]*(>|\Z)", "\n", article)).split())


def test_url_rules_and_aliases(spark):
    rows = [
        (1, None, None), (2, "abc", None), (3, "HTTP://A.Example.ORG/es/x?y#z", '<link rel="canonical" href="https://q.net/1">'),
        (4, "http://q.net/1/", ""), (5, "http://x.y?z://k/l", ""), (6, "https://www.q.net/1.html?utm_source=b", ""),
        (7, "http://k.com/fr/1", "<link rel=canonical href='http://r.net/9'>"), (8, "http://k.com/de/1", "<link rel=canonical href='http://r.net/9'>"),
        (9, "https://r.net/9", ""), (9, "https://r.net/9", ""), (10, "http://org/", ""), (11, "http://borg/x", ""), (12, "http://org", ""),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id int, url string, html string, verdict string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.url_verdicts(pages, queries.URL_RULES).collect())
    assert got == sorted([
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.example.org", "/es/x", "example.org/es/", "block"),
        (4, "q.net", "/1/", None, "block"), (5, "x.y", "", None, "allow"), (6, "www.q.net", "/1.html", None, "block"),
        (7, "k.com", "/fr/1", "com/fr/", "allow"), (8, "k.com", "/de/1", "com/de/", "block"), (9, "r.net", "/9", None, "allow"),
        (9, "r.net", "/9", None, "allow"), (10, "org", "/", "org/", "allow"), (11, "borg", "/x", None, "allow"), (12, "org", "", None, "allow"),
    ])
    assert url_filter.url_verdicts(pages.limit(0), queries.URL_RULES).count() == 0


def test_nearest_against_brute_force(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(400, 8)).round(3)
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(1000 + k, x[0].tolist()) for k in range(20)]
    rows += [(50, x[50].tolist()), (2000, None), (2050, [0.0] * 8), (2001, [1.0, None] * 4), (2002, [math.inf] * 8), (2003, [1.0, 2.0]), (None, x[3].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in multi_index.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ids = np.array([*range(400), *range(1000, 1020)])
    unit = np.r_[x, np.repeat(x[:1], 20, axis=0)]
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    asked = [k for k in ids if k % 50 == 0]
    assert sorted(got) == asked
    for q in asked:
        score = np.round(unit @ unit[list(ids).index(q)], 12)
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:5]
        assert [v for v, _ in got[q]] == ids[order].tolist()
        assert np.allclose([s for _, s in got[q]], score[order])
    assert multi_index.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_recall_with_few_cells_read(spark):
    centres = np.random.default_rng(2).normal(size=(30, 16))
    x = np.repeat(centres, 40, axis=0) + np.random.default_rng(3).normal(size=(1200, 16)) * 0.1
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = multi_index.nearest(df, F.col("vec_id") % 20 == 0, least=100, share=0.1)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for r in found.collect():
        score = unit @ unit[r.query_id]
        score[r.query_id] = -2
        hits += r.vec_id in np.argsort(-score)[:5]
    assert hits / (60 * 5) >= 0.9


def _exact(ids, x, asked, k=5):
    """The k nearest of each asked id, by brute force, and their cosines."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in asked:
        score = np.round(unit @ unit[list(ids).index(q)], 12)
        out[q] = [int(ids[j]) for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_recall_of_the_query(spark, sf):
    """The query's own parameters on the provided tables, against brute force; no table is read whole."""
    path = f"/root/testdata/sf{sf}"
    found = collections.defaultdict(set)
    for r in queries.op5_nearest(spark, path).collect():
        found[r.query_id].add(r.vec_id)
    table = queries.table(spark, path, "embeddings").toPandas()
    ids, x = table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy()).astype(float)
    exact = _exact(ids, x, [i for i in ids if i % 50 == 0])
    assert found.keys() == exact.keys() and all(len(f) == 5 for f in found.values())
    hits = sum(len(found[q] & set(best)) for q, best in exact.items())
    assert hits / (5 * len(exact)) >= 0.9


def test_nearest_of_mixed_lengths(spark):
    """The usual length is that of most rows, whatever most queries have; one component is a length like any other."""
    rows = [(k, [float(k % 7 + 1), 1.0, -2.0]) for k in range(1, 40)] + [(50 * k, [1.0, 2.0]) for k in range(1, 9)] + [(0, [3.0, 1.0, -2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = multi_index.nearest(df, F.col("vec_id") % 50 == 0, share=1.0).collect()
    ids = np.array([i for i, v in rows if len(v) == 3])
    exact = _exact(ids, np.array([v for _, v in rows if len(v) == 3]), [0])
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank)] == exact[0] and {r.query_id for r in found} == {0}
    single = spark.createDataFrame([(k, [float(k - 25)]) for k in range(101)], "vec_id long, embedding array<double>")
    found = multi_index.nearest(single, F.col("vec_id") % 50 == 0, share=1.0).collect()
    assert {r.query_id: [] for r in found} == {0: [], 50: [], 100: []}
    assert sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == 0) == [(k, k, 1.0) for k in range(1, 6)]


def test_rates_meet_targets(spark):
    draw = np.random.default_rng(0)
    p = draw.dirichlet([0.3, 0.3, 0.3], 300)
    n = draw.integers(0, 100, 300)
    rows = [(k, int(n[k]), p[k].tolist()) for k in range(300)]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, posterior array<double>")
    rated, shares = soft_mixing.fit_rates(members, [0.6, 0.3, 0.1], ridge=1e-4, tolerance=1e-5, most_steps=100)
    rate = {r.doc_id: r.rate for r in rated.collect()}
    expected = sum(n[k] / n.sum() * rate[k] * p[k] for k in range(300))
    assert min(rate.values()) >= 0 and np.allclose(expected, [0.6, 0.3, 0.1], atol=2e-3) and np.allclose(expected, shares)


def test_rates_equal_brute_force_least_squares(spark):
    """The same objective, minimised over all rates at once by many plain steps in numpy."""
    draw = np.random.default_rng(8)
    n, p = draw.integers(0, 400, 60), draw.dirichlet([0.2, 0.4, 0.6], 60)
    target, ridge = np.array([0.7, 0.25, 0.05]), 0.3
    share = n / n.sum()
    now = share @ p
    a = (share[:, None] * p / np.sqrt(now)).T  # a domain's share in units of the root of its present one
    rate = np.ones(60)
    for _ in range(60_000):
        slope = a.T @ (a @ rate - target / np.sqrt(now)) + ridge * share * (rate - 1)
        rate = np.maximum(0, rate - np.where(share > 0, slope / np.maximum(share, 1e-12), 0) * 0.2)
    rows = [(k, int(n[k]), p[k].tolist()) for k in range(60)]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, posterior array<double>")
    rated, _ = soft_mixing.fit_rates(members, target.tolist(), ridge=ridge, tolerance=1e-8, most_steps=120, stored_every=8)
    found = {r.doc_id: r.rate for r in rated.collect()}
    used = n > 0
    assert np.allclose([found[k] for k in np.flatnonzero(used)], rate[used], atol=2e-3)


def test_mixing_counts_tokens_and_draws_by_text(spark):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = ["a word here", "漢字" * 200, "x" * 400, "", None] + [f"text number {k}" for k in range(400)]
    df = spark.createDataFrame([(None if k > 4 else k, t, "d") for k, t in enumerate(texts)], "doc_id long, text string, expected_share string")
    labelled = spark.createDataFrame([(0, "one"), (1, "two")], "doc_id long, domain string")
    rows = soft_mixing.mixed(df, labelled, {"one": 3, "two": 1}).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_tokens == len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
    drawn = [r.copies - math.floor(r.rate) for r in rows if r.doc_id is None]
    fraction = np.mean([r.rate - math.floor(r.rate) for r in rows if r.doc_id is None])
    assert abs(np.mean(drawn) - fraction) < 0.12  # and not the same for all
    assert {r.domain: r.target_share for r in rows}["one"] == 0.75


def test_posteriors_equal_the_model_in_plain_python():
    texts = pa.array(["the cat sat on the mat", "der Hund lief weg", "", None, "le chat"])
    counts = soft_mixing.latent.trigram_counts(texts)
    projection = soft_mixing.latent.fit(counts[:2], 2)
    weights = np.random.default_rng(1).normal(size=(projection.directions.shape[1] + 1, 3))
    model = soft_mixing.DomainModel(("a", "b", "c"), projection, weights)
    for k, p in enumerate(model.posteriors(texts)):
        v = (np.log1p(counts[k]) * projection.weight) @ projection.directions
        norm = math.sqrt(sum(x * x for x in v.tolist()))
        z = [sum(w * x for w, x in zip(weights[:, d].tolist(), [*(v / norm if norm else v).tolist(), 1.0], strict=True)) for d in range(3)]
        e = [math.exp(x - max(z)) for x in z]
        assert np.allclose(p, np.array(e) / sum(e), atol=1e-5)


def test_votes_equal_plain_python():
    draw = np.random.default_rng(4)
    words = ["good", "prose", "here", "SPAM", "!!!", "buy", "now", "and", "then"]
    known = [" ".join(draw.choice(words, 12)) for _ in range(60)]
    known += known[:10]  # equal neighbours
    y = draw.integers(0, 2, len(known)).astype(float)
    counts = neighbour_vote.latent.trigram_counts(pa.array(known))
    projection = neighbour_vote.latent.fit(counts, 16)
    vectors = np.concatenate([v for _, _, v in neighbour_vote.vectors(projection, pa.array(known))])
    voters = neighbour_vote.Voters(projection, vectors, y, float(y.mean()), 15, 8.0)
    asked = pa.array([*known[:5], "good prose and then", "", None, "zz"])
    mine = np.concatenate([v for _, _, v in neighbour_vote.vectors(projection, asked)])
    for score, v in zip(voters.scores(asked), mine, strict=True):
        near = sorted(((-float(np.float32(v @ w)), k) for k, w in enumerate(vectors)))[:15]
        weight = [max(-c, 0.0) ** 8 for c, _ in near]
        expected = sum(w * y[k] for w, (_, k) in zip(weight, near, strict=True)) / sum(weight) if sum(weight) else y.mean()
        assert abs(score - expected) < 0.05 if len(set(np.round([c for c, _ in near], 5))) < 15 else abs(score - expected) < 1e-4


def test_ties_go_to_the_first():
    cosine = np.array([[0.5, 0.9, 0.5, 0.5, 0.1], [0.1, 0.2, 0.3, 0.4, 0.5]])
    assert [sorted(r) for r in neighbour_vote.nearest(cosine, 3).tolist()] == [[0, 1, 2], [2, 3, 4]]


def test_mixing_of_the_provided_and_awkward_tables(spark, awkward):
    documents = queries.table(spark, SF, "documents")
    domains = documents.select("doc_id", F.col("lang").alias("domain"))
    got = soft_mixing.mixed(documents, domains).collect()
    assert len(got) == documents.count()
    assert np.mean([r.domain == r.lang for r in got]) > 0.95
    total = collections.Counter()
    for r in got:
        total[r.domain] += r.n_tokens * r.rate
    assert max(total.values()) < 1.2 * min(total.values())
    labelled = awkward.select("doc_id", F.col("lang").alias("domain"))
    assert soft_mixing.mixed(awkward, labelled).count() == awkward.count()
    assert soft_mixing.mixed(awkward.limit(0), labelled.limit(0)).count() == 0
    with pytest.raises(ValueError):
        soft_mixing.mixed(awkward, labelled, {"nowhere": 1.0})


@pytest.mark.parametrize("shard_ids", [1, 500, 1 << 20])
def test_keyed_ids_against_the_library(spark, awkward, shard_ids):
    tokenizer, folder = Tokenizer.from_file(VOCABULARY), shared_folder(spark)
    keyed_ids.write_ids(awkward, folder, shard_ids=shard_ids)
    rows = sorted(((r.doc_id, r.text or "") for r in awkward.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, expected, by_key = 0, [], collections.defaultdict(list)
    for key, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        expected.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        by_key[key].append(ids)
        start += len(ids)
    assert sorted(map(tuple, keyed_ids.read_ids(spark, folder).collect()), key=lambda r: r[1]) == expected
    asked = spark.createDataFrame([(1,), (1,), (8,), (4,), (99,), (-5,), (None,)], "doc_id long")
    found = collections.defaultdict(list)
    for r in keyed_ids.lookup(spark, folder, asked).collect():
        found[r.doc_id].append(r.ids)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(by_key[k]) for k in (1, 4, 8)}


def test_keyed_ids_of_an_empty_table(spark, awkward):
    folder = shared_folder(spark)
    keyed_ids.write_ids(awkward.limit(0), folder)
    assert keyed_ids.read_ids(spark, folder).count() == 0
    assert keyed_ids.lookup(spark, folder, awkward.select("doc_id")).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(4).integers(0, 1 << 63, 5000).astype(np.uint64)
    index = keyed_ids.PerfectHash.of(keys)
    assert sorted(index.numbers(keys)) == list(range(5000))


def test_trie_counts_against_brute_force(spark, awkward):
    import base64

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    score = trie_counts.zipf_scores(len(rank))

    def best(word):
        at = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            at.append(max(((at[k][0] + score[rank[word[k:end]]], at[k][1] - 1) for k in range(end) if word[k:end] in rank)))
        return -at[-1][1]

    texts = [r.text for r in queries.table(spark, SF, "documents").limit(30).collect()]
    words = sorted({w.encode() for t in texts for w in t.split()})[:1500] + [b"a" * 50, "ünïcödé".encode(), b" the"]
    assert trie_counts.count_words(trie_counts.pieces(path), words)[0].tolist() == [best(w) for w in words]
    got = sorted((r.doc_id or 0, r.n_pretokens, r.n_tokens) for r in trie_counts.token_counts(awkward).collect())
    assert (2, 0, 0) in got and (3, 0, 0) in got and len(got) == awkward.count()
    assert trie_counts.token_counts(awkward.limit(0)).count() == 0


def test_quality_on_held_out_labels(spark):
    documents, labels = queries.table(spark, "/root/testdata/sf0.01", "documents"), queries.table(spark, "/root/testdata/sf0.01", "labels")
    found = queries.op9_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    for label in (0, 1):
        mine = [r for r in held if r.quality == label]
        assert np.mean([r.predicted == label for r in mine]) >= 0.9
    assert documents.count() == queries.op9_quality(spark, "/root/testdata/sf0.01").count()


def test_quality_learns_nothing_from_held_out_rows_and_takes_awkward_tables(spark, awkward):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 0), (4, 1), (None, 1), (7, 5), (77, 0)], "doc_id long, quality int")
    held = [i for i in range(1, 9) if neighbour_vote.is_held_out(i)]
    voters = neighbour_vote.fit_voters(awkward, labels)
    assert len(voters.labels) <= 2 and (1 in held or voters.labels.tolist() == [1.0])
    got = neighbour_vote.scored(awkward, voters).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    none = neighbour_vote.fit_voters(awkward.limit(0), labels.limit(0))
    assert {r.score for r in neighbour_vote.scored(awkward, none).collect()} == {0.5}


def _base(text):
    words = WORD.findall(text)
    seen = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered)


def test_base_counts_against_brute_force(spark, awkward):
    more = spark.createDataFrame([(20, "x x x x y\nx x\n \nx x|", "en"), (21, "a b c a b c d a b", "en"), (22, "ß #é*\x0b\x0c<>\nß", "en")], "doc_id long, text string, lang string")
    for df in (awkward, more, queries.table(spark, SF, "documents")):
        for r in fertility.fertility_rules(df).collect():
            n = _base(r.text or "")
            assert tuple(r[c] for c in fertility.BASE) == n
            failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
            assert r.base_failed == failed and not (failed and r.kept)
    assert fertility.fertility_rules(awkward.limit(0)).count() == 0


def test_fertility_rejects_a_strange_text_and_keeps_the_rest(spark):
    documents = queries.table(spark, SF, "documents").where("lang = 'en'").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(-1, " ".join("\u0e01\u0e33\u4e2d" + chr(0x4E00 + k) for k in range(400)), "en")], documents.schema)
    got = {r.doc_id: r for r in fertility.fertility_rules(documents.unionByName(strange)).collect()}
    assert not got[-1].base_failed and not got[-1].kept
    passed = [r for r in got.values() if not r.base_failed and r.doc_id != -1]
    assert np.mean([r.kept for r in passed]) > 0.97


def test_entropy_band_rejects_poor_texts_of_usual_length(spark):
    sf = "/root/testdata/sf0.01"
    documents, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    wide = {m: 1e9 for m in fertility.MEANS}
    stored = fertility.with_base_verdict(fertility.measured(documents.select("doc_id", "text", "lang"))).drop("text").join(labels, "doc_id").persist()
    got = [r for r in fertility.judged(stored, fertility.bands(stored), reach=wide).collect() if not r.base_failed]
    for label, low, high in ((0, 0.5, 1.0), (1, 0.0, 0.01)):
        assert low <= np.mean([not r.kept for r in got if r.quality == label]) <= high


def test_keyed_ids_of_one_id_fill_several_shards_and_tasks(spark, setting):
    setting(adaptive__coalescePartitions__enabled="false")
    rows = [(k, f"text {k}") for k in range(40)] + [(7, f"hot text {k}") for k in range(300)] + [(None, "a copy without an id")] * 300
    folder = shared_folder(spark)
    keyed_ids.write_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), folder, shard_ids=50)
    store = spark.read.parquet(folder)
    assert store.agg(F.max("n_ids")).first()[0] < 50 + 20
    for hot in (F.col("first").eqNullSafe(7), F.col("first").isNull()):
        assert store.where(hot).select("part").distinct().count() > 1
    got = collections.Counter((r.doc_id, r.n_tokens) for r in keyed_ids.read_ids(spark, folder).collect())
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert got == collections.Counter((i, len(tokenizer.encode(t, add_special_tokens=False).ids) + 1) for i, t in rows)
    found = keyed_ids.lookup(spark, folder, spark.createDataFrame([(7,), (0,), (39,), (99,), (None,)], "doc_id long")).collect()
    texts = sorted((r.doc_id, tokenizer.decode(r.ids[:-1])) for r in found)
    assert texts == sorted(r for r in rows if r[0] in (7, 0, 39))


BODY = "<h1>Head</h1>" + "<p>A long sentence, with some words in it. Another one follows; it is long, too.</p>" * 5
BODY_TEXT = "Head" + " A long sentence, with some words in it. Another one follows; it is long, too." * 5


@pytest.mark.parametrize(
    "html",
    [
        f"<div class=story>{BODY}</div><article><h2>More</h2><p>Read this</p></article>",
        f"<article>{BODY}<div class=x><span>Buy now</span></div></article>",
    ],
)
def test_marks_compete_by_their_ratios(html):
    assert tag_paths.main_text(html) == BODY_TEXT


@pytest.mark.parametrize(
    "html",
    [
        f"<article class='post comments-open category-social'>{BODY}</article><div class=comments><p>Nice, I think.</p></div>",
        f"<div class='layout sidebar-right'>{BODY}<div class=sidebar><p>Latest, best.</p></div></div><div class=ad>Buy, now.</div>",
        f"<div class='elementor-widget-container'>{BODY[:13]}</div><div class='elementor-widget-container'>{BODY[13:]}</div><div class=ad>Buy, now.</div>",
        f"<div class='layout header-fixed'>{BODY}</div>",
    ],
)
def test_names_are_outweighed_by_most_of_the_text(html):
    assert tag_paths.main_text(html).startswith(BODY_TEXT) and "Buy" not in tag_paths.main_text(html)


def test_resolved_addresses_equal_the_standard_library(spark):
    from urllib.parse import urljoin

    bases = ["https://a.net/b/c/d.html?x=1#f", "http://a.net", "http://a.net/"]
    links = ["/new", "?id=2", "//host/x", "e", "../e?y", "./", "../../../e", "#g", "e/./f/../g", "http://q.org/z?u=http://r.org", "/go?u=http://r.org", "/a/.."]
    pairs = spark.createDataFrame([(b, x) for b in bases for x in links], "url string, link string")
    for r in pairs.withColumn("v", url_filter.resolved(F.col("url"), F.col("link"))).collect():
        assert r.v == urljoin(r.url, r.link), (r.url, r.link)
    odd = spark.createDataFrame([("http://a.net", "mailto:x"), ("http://a.net", ""), ("abc", "/x"), (None, "/x")], "url string, link string")
    assert [r[0] for r in odd.select(url_filter.resolved(F.col("url"), F.col("link"))).collect()] == [None] * 4


def test_all_declared_links_carry_verdicts(spark):
    def canonical(x):
        return f"<link rel=canonical href='{x}'>"

    def refresh(x):
        return f"<meta http-equiv='refresh' content='0; url={x}'>"

    blocked = "http://example.org/es/"
    rows = [
        (1, "http://p.net/1", canonical("http://p.net/1") + refresh(f"{blocked}1")), (2, "http://p.net/2", canonical("http://z.net/2") + canonical(f"{blocked}2")),
        (3, "http://p.net/3", canonical("//example.org/es/3")), (4, "http://p.net/4", refresh("/es/4")), (5, "http://p.net/es/4", canonical(f"{blocked}4")),
        (6, "http://p.net/6", refresh("?id=2")), (7, "http://p.net/6?id=2", canonical(f"{blocked}6")), (8, "http://p.net/8", refresh("/9")),
    ]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(pages, queries.URL_RULES).collect()}
    assert got == dict.fromkeys(range(1, 8), "block") | {8: "allow"}


@pytest.mark.parametrize("sides", [1, 2])
def test_a_cell_of_near_copies_gives_a_forest(sides):
    draw = np.random.default_rng(5)
    held = []
    for _ in range(5):  # similar within a family, some texts drifting out of reach of others
        text = draw.integers(1 << 60, size=60, dtype=np.uint64)
        for _ in range(24):
            held.append(np.unique(text))
            text = text.copy()
            text[draw.integers(60)] = draw.integers(1 << 60, dtype=np.uint64)
    n = len(held)
    t, second = draw.permutation(n) + 1000, np.arange(n) % 2 >= 3 - sides
    class_ = np.where(np.arange(n) % 3 == 0, t // 2, t)

    def similar(i, j):
        both = len(np.intersect1d(held[i], held[j]))
        return both >= 0.8 * (len(held[i]) + len(held[j]) - both)

    def classes(links):
        forest = {c: c for c in class_.tolist()}

        def root(c):
            while forest[c] != c:
                c = forest[c]
            return c

        of = dict(zip(t.tolist(), class_.tolist(), strict=True))
        for a, b in links:
            forest[root(of[a])] = root(of[b])
        groups = collections.defaultdict(set)
        for c in forest:
            groups[root(c)].add(c)
        return sorted(map(sorted, groups.values()))

    order = np.argsort(second, kind="stable")
    place = {int(x): k for k, x in enumerate(t)}
    each = np.concatenate([held[k] for k in order])
    a, b = bagminhash.cell_links(t[order], class_[order], second[order], each, np.cumsum([0, *(len(held[k]) for k in order)]), 0.8)
    links = list(zip(a.tolist(), b.tolist(), strict=True))
    pairs = [(int(t[i]), int(t[j])) for i in range(n) for j in range(i) if (sides == 1 or second[i] != second[j]) and similar(i, j)]
    assert all(similar(place[x], place[y]) for x, y in links)
    assert classes(links) == classes(pairs)
    assert len(links) == len(set(class_.tolist())) - len(classes(pairs)) < len(pairs) / 2


def test_near_copies_of_buckets_in_parts(spark, monkeypatch):
    """Every bucket falls into parts, and no link of different texts is lost between them."""
    monkeypatch.setattr(bagminhash, "CELL_ELEMENTS", 256)
    test_near_copies_equal_brute_force(spark)


def test_counts_of_ids_are_those_of_the_encoder():
    texts = pa.array([None, "", "one two  three", "<|endoftext|>x", "é日本 \n\n 12.5", "word " * 3000])
    assert bpe.id_counts(texts, VOCABULARY).tolist() == np.diff(bpe.encode(texts, VOCABULARY)[1]).tolist()
