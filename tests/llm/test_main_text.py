"""What belongs to an article and what doesn't, on pages of other templates than the provided ones."""

from __future__ import annotations

import pytest

from lendrisk.llm import tag_paths
from lendrisk.llm.scratch import importable

PARAGRAPHS = [f"Paragraph number {k} has a sentence, and another one. It goes on for a while, as paragraphs do." for k in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
COMMENTS = "".join(f"<p>I think this is comment {k}, a long one. It says much, and then more. Really, it does!</p>" for k in range(10))
POSTS = "".join(f"<li><b>Anna {k}</b> <time>12.03.2021, 14:0{k}</time><div>Das sehe ich anders, wirklich. Und noch etwas, das lang ist.</div></li>" for k in range(9))


@pytest.mark.parametrize(
    ("extra", "kept"),
    [
        ("<ul><li>one</li><li>two</li><li>three</li></ul>", "one two three"),
        ("<table><tr><th>Name</th><th>Size</th></tr><tr><td>a</td><td>12</td></tr></table>", "Name Size a 12"),
        ("<dl><dt>term</dt><dd>what it means</dd></dl>", "term what it means"),
        ("<section><p>Short end.</p></section>", "Short end."),
        ("<figure><img src=x><figcaption>A caption</figcaption></figure>", "A caption"),
        ("<div class=share-buttons>Tweet Post Pin</div>", ""),
        ("<ul><li><a href=1>Other story here</a></li><li><a href=2>Second other story</a></li></ul>", ""),
        ("<section id=comments>" + COMMENTS + "</section>", ""),
    ],
)
def test_inside_an_article(extra, kept):
    text = tag_paths.main_text(f"<body><nav>Home</nav><article><h1>Title</h1>{BODY}{extra}</article></body>")
    assert text == " ".join(["Title", *PARAGRAPHS, *([kept] if kept else [])])


@pytest.mark.parametrize("n", [1, 2, 6])
@pytest.mark.parametrize("beside", [f"<section id=comments>{COMMENTS}</section>", f"<div class='comment-list'><article>{COMMENTS}</article></div>", f"<ol class=leserbriefe>{POSTS}</ol>"])
def test_comments_beside_an_article(n, beside):
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS[:n])
    assert tag_paths.main_text(f"<body><article>{body}</article>{beside}</body>") == " ".join(PARAGRAPHS[:n])


def test_bare_words_in_a_container_are_no_part_of_an_article():
    extra = "<div class=y>Then a short remark, unnamed.</div><div class=x><span>Get it here</span></div><ul><li>one</li></ul>"
    text = tag_paths.main_text(f"<article><h1>Title</h1>{BODY}{extra}</article>")
    assert text == " ".join(["Title", *PARAGRAPHS, "Then a short remark, unnamed.", "one"])


def test_a_state_is_no_name():
    html = f"<body class='comments-open'><div class='layout comments-closed'><article class='post comments-open'>{BODY}</article></div></body>"
    assert tag_paths.main_text(html) == " ".join(PARAGRAPHS)


def test_dated_sections_of_an_article_stay():
    sections = "".join(f"<section><h2>{k}:15</h2><p>{p}</p></section>" for k, p in enumerate(PARAGRAPHS))
    assert all(p in tag_paths.main_text(f"<article>{sections}</article>") for p in PARAGRAPHS)


def test_awkward_tables(spark):
    importable(spark)
    long = "<article><p>" + "word, and " * 100_000 + "</p></article>"
    rows = [(1, "u", "<p>Text.</p>"), (1, "u", "<p>Text.</p>"), (None, None, None), (2, None, ""), (3, "v", long)]
    pages = spark.createDataFrame([(*r, "clash", 7) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = tag_paths.extract_pages(pages.repartition(2))
    assert dict(got.dtypes) == {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}
    found = sorted(((r.page_id, r.url, r.text[:9], r.n_chars) for r in got.collect()), key=str)
    assert found == sorted([(1, "u", "Text.", 5), (1, "u", "Text.", 5), (None, None, "", 0), (2, None, "", 0), (3, "v", "word, and", 999_999)], key=str)
    assert tag_paths.extract_pages(pages.limit(0)).count() == 0
