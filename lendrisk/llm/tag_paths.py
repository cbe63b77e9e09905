"""Main text of HTML pages by tag-path ratios (operator 3).

Each text node belongs to the path of tags from the root to it. Per path the page's text length and punctuation are summed and
divided by the path's nodes; the two ratios are fused, smoothed over neighbouring paths, and paths below a share of the best are
dropped. Elements that are something else by tag or role (menus, footers, forms, ...) take no part. Names of classes and ids
(adverts, comments, ...) lower the ratios below them, unless what bears the name holds most of the page's text and punctuation.
Paths inside a marked article count ``MARKED`` times their own ratio against the page's best, and compete with all others; where a
mark's unnamed paths win, its other unnamed paths stay too, unless they are mostly links or a few bare words in a ``div``. Beside a marked article comments are left out
however long they are, known by name or by short dated texts that repeat. Headings in a mark count as much as its best path;
else headings and quotes count as much as the paths beside them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, up to their end tag.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are never part of an article.
APART = frozenset("head nav footer aside form button select option datalist menu dialog svg math canvas audio video object applet map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Parts of class names and ids by which elements name themselves as something beside the article. "header" and "heading" spare headings.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice"
    " popup modal overlay toast paywall sidebar aside rail nav navbar navigation menu submenu breadcrumb breadcrumbs pager"
    " pagination footer footnav masthead topbar toolbar share sharing social related recommended recommendations teaser"
    " header heading newsletter subscribe subscription signup login comment comments commentlist respond disqus reply replies widget".split()
)
#: Those of them that name reader comments.
COMMENTS = frozenset("comment comments commentlist respond disqus reply replies".split())
#: A part after one of these, or before one of those, says that something is there or not, elsewhere.
SAYING, STATE = frozenset("no has with without".split()), frozenset("open closed enabled disabled allowed on off".split())
#: A short text with a date or a time of day, as posts of readers bear.
DATED = re.compile(r"\b\d{1,2}:\d\d\b|\b\d{4}-\d\d-\d\d\b|\b\d{1,2}[./]\s?\d{1,2}[./]\s?\d{2,4}\b|\b(?:19|20)\d\d\b|\b\d+\s+\w+\s+ago\b")
SHORT_TEXT, POSTS, POST_TEXTS = 60, 3, 6
#: Mean length up to which texts without punctuation that lie in a ``div`` itself aren't an article's by its mark alone.
LOOSE_TEXT = 20
#: A start tag of the first kind ends an open element of the second.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BLOCKS_END_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Tags whose text belongs with the paths of the same parent.
BESIDE = HEADINGS | frozenset("blockquote dd dt figcaption pre td th".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
#: Path ratios below this share of the page's best are dropped; weight of each neighbouring path in the smoothing.
LEAST_SHARE, NEIGHBOUR = 0.2, 0.25
#: What a mark multiplies a path's ratio by, and the least that a name does.
MARKED, NAMED = 2.0, 0.01


class _Open:
    """An open element: its tag, path, and what holds below it."""

    __slots__ = ("tag", "path", "apart", "region", "header", "linked", "names")

    def __init__(self, tag: str, path: tuple[int, str, int], apart: bool, region: int, header: bool, linked: bool, names: frozenset[str]):
        self.tag, self.path, self.apart, self.region, self.header, self.linked, self.names = tag, path, apart, region, header, linked, names


def _names(attributes: dict[str, str]) -> set[str]:
    found = set()
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        for word in value.split():
            parts = [p.lower() for p in NAME_PART.findall(word)]
            found |= {p for k, p in enumerate(parts) if (not k or parts[k - 1] not in SAYING) and parts[k + 1 : k + 2] not in ([x] for x in STATE)}
    return found


def _set_apart(tag: str, attributes: dict[str, str]) -> bool:
    if tag in APART:
        return True
    if tag in ("html", "body", "main"):
        return False
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes:
        return True
    return "style" in attributes and bool(re.search(r"display\s*:\s*none", attributes["style"], re.I))


def _is_mark(tag: str, attributes: dict[str, str]) -> bool:
    return tag in ("article", "main") or attributes.get("role") in ("main", "article") or attributes.get("itemprop") == "articleBody"


#: (block, path, region, names, linked, text) of a text node, as ``text_nodes`` yields it.
Node = tuple[int, tuple[int, str, int], int, frozenset[str], bool, str]
#: (path, region, names), under which a page's text nodes are summed.
Key = tuple[tuple[int, str, int], int, frozenset[str]]


def text_nodes(html: str) -> Iterator[Node]:
    """Every text node outside elements that are set apart, in page order.

    A path is (number, last tag, parent's number), numbered by its chain of tags and classes of other than inline elements.
    The region is 0 outside, and else numbers the outermost ``article`` or ``main`` element that holds the node. The names are
    those of ``NAMES`` that elements around the node bear; marks and the page itself are never named so.
    """
    root = _Open("", (0, "", -1), False, 0, False, False, frozenset())
    stack, opened, paths = [root], Counter(), {}
    block = regions = at = 0

    def pop_to(depth: int) -> None:
        for x in stack[depth:]:
            opened[x.tag] -= 1
        del stack[depth:]

    def end(tags: tuple[str, ...], stop: frozenset[str]) -> None:
        if any(opened[t] for t in tags):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in tags:
                    return pop_to(k)
                if stack[k].tag in stop:
                    return None
        return None

    size = len(html)
    while at <= size:
        m = TOKEN.search(html, at)
        upto = m.start() if m else size
        if upto > at:
            top = stack[-1]
            if not top.apart and not (top.header and not any(x.tag in HEADINGS for x in stack[1:])):
                spared = top.names - {"header", "heading"} if top.names and any(x.tag in HEADINGS for x in stack[1:]) else top.names
                yield block, top.path, top.region, spared, top.linked, unescape(html[at:upto])
        if not m:
            return
        at = m.end()
        if not m[2]:
            at = max(at, upto + 1)
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in INLINE:
                block += 1
            if opened[tag]:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                pop_to(depth)
            continue
        if tag not in INLINE:
            block += 1
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close else size
            if at == size:
                return
            continue
        if tag in BLOCKS_END_P:
            end(("p",), frozenset(("table", "td", "th", "button", "object")))
        if tag in ENDS:
            end(ENDS[tag], frozenset(("ul", "ol", "dl", "table")))
        attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(m[3])} if m[3] else {}
        top = stack[-1]
        apart = top.apart or _set_apart(tag, attributes)
        region = top.region
        mark = _is_mark(tag, attributes)
        if not apart and not region and mark:
            regions += 1
            region = regions
        header = top.header or tag == "header"
        if tag == "header" and not top.region:
            apart = True
        names = top.names
        if not mark and tag not in ("html", "body") and tag not in HEADINGS and ("class" in attributes or "id" in attributes):
            names = names | (NAMES & _names(attributes))
        path = top.path
        if tag not in INLINE:
            path = paths.setdefault((path[0], tag, attributes.get("class", "")), (len(paths) + 1, tag, path[0]))
        stack.append(_Open(tag, path, apart, region, header, top.linked or tag == "a", names))
        opened[tag] += 1


def _weights(nodes: list[Node]) -> dict[frozenset[str], float]:
    """What each set of names leaves of a ratio: all of it if the elements that bear them hold the whole page, little below half of it.

    A name's share is the mean of its shares of the page's text outside links and of its punctuation, where what is marked counts ``MARKED`` times.
    """
    length, marks = Counter(), Counter()
    for _, _, region, names, link, text in nodes:
        n, m = (0, 0) if link else (len(text.strip()), len(PUNCTUATION.findall(text)))
        if region:
            n, m = MARKED * n, MARKED * m
        for name in ("", *names):
            length[name] += n
            marks[name] += m
    # where an article is marked apart from the comments, they are comments however long
    told = any(region and not names & COMMENTS for _, _, region, names, _, _ in nodes)
    share = {x: ((length[x] / length[""]) + (marks[x] / marks[""] if marks[""] else length[x] / length[""])) / 2 if length[""] else 0.0 for x in length}
    least = {names: max(NAMED, min((max(2 * share[x] - 1, 0.0) ** 2 for x in names), default=1.0)) for names in {node[3] for node in nodes}}
    return {names: 0.0 if told and names & COMMENTS else value for names, value in least.items()}


def _posts(nodes: list[Node]) -> set[int]:
    """The paths that repeat short dated texts ``POSTS`` times or more, outside marks on a page with one: posts of readers, whatever
    their names. A path is given by the number of what its texts lie in; it holds no more than ``POST_TEXTS`` texts for each date.
    """
    if not any(node[2] for node in nodes):
        return set()
    dated, others = Counter(), Counter()
    for _, path, region, _, _, text in nodes:
        if not region:
            short = len(text) <= SHORT_TEXT and DATED.search(text)
            (dated if short else others).update({path[0], path[2]})
    return {inside for inside, n in dated.items() if n >= POSTS and others[inside] <= POST_TEXTS * n}


def _kept_paths(nodes: list[Node]) -> set[Key]:
    """The (path, region, names) whose score reaches ``LEAST_SHARE`` of the page's best, or a mark's share of that."""
    length, marks, linked, count = Counter(), Counter(), Counter(), Counter()
    for _, path, region, names, link, text in nodes:
        key, n = (path, region, names), len(text.strip())
        length[key] += n
        linked[key] += n * link
        marks[key] += len(PUNCTUATION.findall(text))
        count[key] += 1
    order = list(length)
    weight, posts = _weights(nodes), _posts(nodes)
    fused = [(length[k] - linked[k]) / count[k] * (1 + marks[k] / count[k]) for k in order]
    score = {}
    for at, (key, value) in enumerate(zip(order, fused, strict=True)):
        beside = [fused[j] for j in (at - 1, at + 1) if 0 <= j < len(fused) and order[j][1:] == key[1:]]
        smooth = (1 - NEIGHBOUR * len(beside)) * value + NEIGHBOUR * sum(beside)
        post = not key[1] and (key[0][2] in posts or key[0][0] in posts)
        score[key] = 0.0 if post else math.sqrt(value * smooth) * weight[key[2]]  # a path without any ratio of its own stays out
    best_of: dict[object, float] = {}
    for (path, region, names), value in score.items():
        for shared in (region, ("beside", path[2]), ("beside", path[2], names)):
            best_of[shared] = max(best_of.get(shared, 0.0), value)
    for (path, region, names), value in score.items():
        if path[1] in BESIDE:
            value = max(value, best_of["beside", path[2], names])
        if path[1] in HEADINGS:
            value = max(value, best_of[region if region else ("beside", path[2])] * weight[names])
        score[path, region, names] = value
    best = max(score.values(), default=0.0)
    marked = any(region for _, region, _ in order)
    kept = {
        key for key, value in score.items()
        if value * (MARKED if key[1] else 1.0) >= LEAST_SHARE * best and (value > 0 or best == 0 and bool(key[1]) == marked)
    }
    # within a chosen mark all that isn't named or mostly linked is the article's: lists, tables, short sections
    chosen = {region for _, region, names in kept if region and not names}
    # but short texts without punctuation that stand in a bare container, as buttons and adverts do, have to win by their ratio
    loose = {key for key in order if key[0][1] == "div" and not marks[key] and length[key] <= LOOSE_TEXT * count[key]}
    return kept | {key for key in order if key[1] in chosen and not key[2] and 2 * linked[key] <= length[key] and key not in loose}


def main_text(html: str | None) -> str:
    """The article's text: blocks in page order, white space made one space, joined by one space. Empty if there is none."""
    nodes = [x for x in text_nodes(html or "") if x[5]]
    kept = _kept_paths([x for x in nodes if x[5].strip()])
    blocks: dict[int, list[str]] = {}
    for block, path, region, names, _, text in nodes:
        if (path, region, names) in kept:
            blocks.setdefault(block, []).append(text)
    return " ".join(s for s in (" ".join("".join(parts).split()) for parts in blocks.values()) if s)


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(``id_col``, ``url_col``, text, n_chars) for every row of ``pages``.

    Null and empty html give the empty text; null ids and urls stay as they are, repeated rows give repeated results, an empty table
    none, and other columns are ignored, whatever their names. Pages are read whole, however long.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[id_col, url_col, "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars bigint"
    return pages.select(id_col, url_col, html_col).mapInArrow(rows, schema)
