"""URL verdicts by rules and redirect equivalence (operator 4), in DataFrame functions alone.

A rule names a host and a path prefix; it fits the host and its subdomains, and the longest fitting rule decides. URLs without a
rule take the decision of their aliases: redirect and canonical links join URLs into components, and a component with an
allowed member is allowed, else one with a blocked member is blocked, else the default holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendrisk.llm.components import components
from lendrisk.llm.scratch import discard, written

ALLOW, BLOCK = "allow", "block"
#: Query parameters that say where a visit came from, not what is shown.
TRACKING = r"(?:utm_\w+|fbclid|gclid)"
#: A host's first label under which sites serve the same pages again.
MIRROR = r"^(?:www|m)\."


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting (verdict, host, path) rule, as text and verdict; null where none fits. Ties go to the first."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2]), reverse=True)[::-1]:
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def canonical_of(url: Column) -> Column:
    """The address to which a site redirects a URL's variants: https, without ``www.`` or ``m.``, an end slash, ``.html``,
    fragment and tracking parameters. Null for a URL without a host.
    """
    host = F.regexp_replace(host_of(url), MIRROR, "")
    path = F.regexp_replace(path_of(url), r"(?:\.html?|/(?:index\.html?)?)$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^#?]*\?([^#]*)", 1)
    query = F.regexp_replace(F.concat(F.lit("&"), query), rf"&{TRACKING}=[^&]*", "")
    query = F.regexp_replace(query, r"^&+", "")
    plain = F.concat(F.lit("https://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(host_of(url) != "", plain)


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, with its ``.`` and ``..`` parts carried out."""
    parts = F.split(F.substring(path, 2, 1 << 30), "/")
    none = F.array().cast("array<string>")
    up = lambda found: F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0)))
    found = F.aggregate(parts, none, lambda a, x: F.when(x == ".", a).when(x == "..", up(a)).otherwise(F.concat(a, F.array(x))))
    ends = F.element_at(parts, -1).isin(".", "..") & (F.size(found) > 0)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(found, "/"), F.when(ends, "/").otherwise(""))).otherwise(path)


def resolved(url: Column, link: Column) -> Column:
    """The address that ``link`` means on the page ``url``; null for other schemes, and for relative links if ``url`` has no host."""
    scheme, authority = F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    root, path = F.concat(scheme, F.lit("://"), authority), path_of(url)
    own = F.regexp_extract(link, r"(?s)^([^?#]*)", 1)
    rest = F.substring(link, F.length(own) + 1, F.lit(1 << 30))
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    query = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when((link == "") | link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (authority == ""), F.lit(None))
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, _without_dots(own), rest))
        .when(link.startswith("?"), F.concat(root, path, link))
        .when(link.startswith("#"), F.concat(query, link))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, own)), rest))
    )


#: What markup holds that isn't read as tags: comments, and elements whose content is text.
UNREAD = r"(?is)<!--.*?(?:-->|$)|<(script|style|template|noscript|textarea|title|xmp|iframe)\b.*?(?:</\1\s*>|$)"
#: The inside of a tag, quoted values whole, and one attribute in it with or without a value.
INSIDE = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
ATTRIBUTE = r"[^\s\"'>/=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?"


def _tags(html: Column, name: str) -> Column:
    """The insides of all tags of a name, as they stand there."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{name}(?=[\s/])({INSIDE})>"), F.lit(1))


def _attribute(tag: Column, name: str) -> Column:
    """The first value of an attribute, without quotes and blanks around it; null if there is none."""
    given = F.filter(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0)), lambda x: x.rlike(rf"(?is)^{name}\s*="))
    value = F.regexp_replace(F.get(given, F.lit(0)), r"(?is)^[^=]*=\s*", "")
    return F.trim(F.regexp_replace(F.regexp_replace(value, "^[\"']|[\"']$", ""), "&amp;", "&"))


def declared_links(html: Column) -> Column:
    """What a page's canonical links and refresh redirects name, all of them, as they stand there.

    Attributes are read by name, ``rel`` as a list of words; comments, scripts, styles and other elements of text aren't markup.
    """
    live = F.regexp_replace(html, UNREAD, " ")
    canonical = F.filter(
        _tags(live, "link"), lambda x: F.array_contains(F.split(F.lower(F.coalesce(_attribute(x, "rel"), F.lit(""))), r"\s+"), "canonical")
    )
    refresh = F.filter(_tags(live, "meta"), lambda x: F.lower(F.coalesce(_attribute(x, "http-equiv"), F.lit(""))) == "refresh")
    to = F.transform(refresh, lambda x: F.trim(F.regexp_extract(_attribute(x, "content"), r"(?is)\burl\s*=\s*[\"']?([^\"']+)", 1)))
    return F.array_compact(F.concat(F.transform(canonical, lambda x: _attribute(x, "href")), to))


def alias_edges(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct links (a, b) from a page's URL to its canonical address, and to every address that its page declares.

    Relative addresses start from the page's first ``base`` with an ``href``, else from its own. What a page declares is stored before
    it is resolved, so that markup is read once.
    """
    url, html = F.col(url_col), F.col(html_col)
    none = F.array().cast("array<string>")
    declares = html.rlike("(?i)canonical|refresh")
    bases = F.transform(_tags(F.regexp_replace(html, UNREAD, " "), "base"), lambda x: _attribute(x, "href"))
    read = written(
        pages.where(url.isNotNull()).select(
            url.alias("u"),
            F.when(declares, F.get(F.array_compact(bases), F.lit(0))).alias("base"),
            F.when(declares, declared_links(html)).otherwise(none).alias("declared"),
        )
    )
    base = F.when(F.col("base").isNull(), F.col("u")).otherwise(F.coalesce(resolved(F.col("u"), F.col("base")), F.col("u")))
    based = written(read.select("u", base.alias("base"), F.explode(F.concat(F.array(canonical_of(F.col("u"))), "declared")).alias("link")))
    links = written(based.select("u", resolved(F.col("base"), F.col("link")).alias("v")))
    ends = links.select(F.col("u").alias("a"), F.col("v").alias("b"))
    # a declared address is itself a variant of its canonical one
    both = ends.unionByName(links.select(F.col("v").alias("a"), canonical_of(F.col("v")).alias("b")))
    edges = written(both.where("a is not null and b is not null and a != b").distinct())
    discard(read, based, links)
    return edges


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    *,
    edges: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    default: str = ALLOW,
) -> DataFrame:
    """(``id_col``, host, path, rule, verdict) for every row of ``pages``.

    ``edges`` (a, b) are redirects between URLs; without them they are taken from the pages (``alias_edges``). A URL that a rule
    fits has the rule's verdict. Any other has that of its component, where explicit allows go before blocks and every URL of
    the graph counts, also one that is no page. Null URLs and URLs without ``://`` have an empty host and path, no rule and the
    default verdict. Repeated rows are kept; the graph holds each URL once, however many pages share it.
    """
    edges = alias_edges(pages, url_col=url_col, html_col=html_col) if edges is None else edges.select("a", "b")
    label = written(components(edges))
    own = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)[1]
    decided = label.withColumn("own", own).groupBy("component").agg(
        F.bool_or(F.col("own") == ALLOW).alias("allowed"), F.bool_or(F.col("own") == BLOCK).alias("blocked")
    )
    spread = decided.select(
        "component", F.when(F.col("allowed"), ALLOW).when(F.col("blocked"), BLOCK).alias("alias_verdict")
    ).where("alias_verdict is not null")
    named = written(label.join(written(spread), "component").select(F.col("node").alias("_node"), "alias_verdict"))
    url = F.col(url_col)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_col), url.alias("_url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("rule", name).withColumn("_own", verdict)
    return rows.join(named, F.col("_url") == F.col("_node"), "left").select(
        id_col, "host", "path", "rule", F.coalesce("_own", "alias_verdict", F.lit(default)).alias("verdict")
    )
