"""DuckDB SQL for the operators that SQL can express."""



def _canonical(of: str) -> str:
    host = f"translate(regexp_extract({of}, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = f"regexp_extract({of}, '^.*?://[^/?#]*([^?#]*)', 1, 's')"
    query = f"regexp_replace('&' || regexp_extract({of}, '^[^#?]*\\?([^#]*)', 1, 's'), '&(?:utm_\\w+|fbclid|gclid)=[^&]*', '', 'g')"
    query = f"regexp_replace({query}, '^&+', '')"
    return f"""CASE WHEN {host} <> '' THEN 'https://' || regexp_replace({host}, '^(?:www|m)\\.', '')
        || regexp_replace({path}, '(?:\\.html?|/(?:index\\.html?)?)$', '')
        || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END"""


def _attribute(tag: str, name: str) -> str:
    given = f"""list_filter(regexp_extract_all({tag}, '[^\\s"''>/=]+(?:\\s*=\\s*(?:"[^"]*"|''[^'']*''|[^\\s"''>]+))?', 0),
        lambda g: regexp_matches(g, '(?is)^{name}\\s*='))[1]"""
    return f"""trim(replace(regexp_replace(regexp_replace({given}, '(?is)^[^=]*=\\s*', ''), '^["'']|["'']$', '', 'g'), '&amp;', '&'))"""


def _tags(name: str) -> str:
    return f"""regexp_extract_all(live, '(?is)<{name}([\\s/](?:[^>"'']|"[^"]*"|''[^'']*'')*)>', 1)"""


def _without_dots(path: str) -> str:
    """A path with its ``.`` and ``..`` parts carried out: parts are appended to a text and cut off again."""
    parts = f"string_split(substr({path}, 2), '/')"
    done = f"""list_reduce(list_prepend('', {parts}), lambda x, y:
        CASE y WHEN '.' THEN x WHEN '..' THEN regexp_replace(x, '/[^/]*$', '') ELSE x || '/' || y END)"""
    ends = f"CASE WHEN {parts}[-1] IN ('.', '..') AND {done} <> '' THEN '/' ELSE '' END"
    return f"CASE WHEN regexp_matches({path}, '/\\.\\.?(?:/|$)') THEN coalesce(nullif({done}, ''), '/') || {ends} ELSE {path} END"


def _resolved(url: str, link: str) -> str:
    root = f"regexp_extract({url}, '(?s)^(.*?://[^/?#]*)', 1)"
    path = f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    own = f"regexp_extract({link}, '(?s)^([^?#]*)', 1)"
    rest = f"substr({link}, length({own}) + 1)"
    folder = f"CASE {path} WHEN '' THEN '/' ELSE regexp_replace({path}, '[^/]*$', '') END"
    return f"""CASE WHEN regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {link}
        WHEN {link} = '' OR regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.-]*:') OR regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1) = '' THEN NULL
        WHEN starts_with({link}, '//') THEN regexp_extract({url}, '(?s)^(.*?)://', 1) || ':' || {link}
        WHEN starts_with({link}, '/') THEN {root} || {_without_dots(own)} || {rest}
        WHEN starts_with({link}, '?') THEN {root} || {path} || {link}
        WHEN starts_with({link}, '#') THEN regexp_extract({url}, '(?s)^([^#]*)', 1) || {link}
        ELSE {root} || {_without_dots(f"({folder} || {own})")} || {rest} END"""


_UNREAD = "|".join(["<!--.*?(?:-->|\\z)", *(
    f"<{name}\\b.*?(?:</{name}\\s*>|\\z)" for name in ("script", "style", "template", "noscript", "textarea", "title", "xmp", "iframe")
)])

URL_FILTER = f"""
WITH RECURSIVE read AS (
  SELECT url, regexp_replace(html, '(?is){_UNREAD}', ' ', 'g') AS live
  FROM pages WHERE url IS NOT NULL AND regexp_matches(html, '(?i)canonical|refresh')),
tags AS (
  SELECT url, {_tags("link")} AS link_tags, {_tags("meta")} AS meta_tags,
    list_filter(list_transform({_tags("base")}, lambda t: {_attribute("t", "href")}), lambda h: h IS NOT NULL)[1] AS base
  FROM read),
based AS (SELECT url, coalesce({_resolved("url", "base")}, url) AS base, link_tags, meta_tags FROM tags),
tag AS (SELECT url, base, unnest(link_tags) AS t, false AS meta FROM based UNION ALL SELECT url, base, unnest(meta_tags), true FROM based),
given AS (
  SELECT url, base, CASE
    WHEN NOT meta AND list_contains(regexp_split_to_array(lower({_attribute("t", "rel")}), '\\s+'), 'canonical') THEN {_attribute("t", "href")}
    WHEN meta AND lower({_attribute("t", "http-equiv")}) = 'refresh'
      THEN trim(regexp_extract({_attribute("t", "content")}, '(?is)\\burl\\s*=\\s*["'']?([^"'']+)', 1)) END AS link
  FROM tag),
named AS (SELECT url, {_resolved("base", "link")} AS target FROM given WHERE link IS NOT NULL),
links AS (
  SELECT url AS a, {_canonical('url')} AS b FROM pages WHERE url IS NOT NULL
  UNION SELECT url, target FROM named WHERE target IS NOT NULL
  UNION SELECT target, {_canonical('target')} FROM named WHERE target IS NOT NULL),
edges AS (SELECT a, b FROM links WHERE a <> b AND b IS NOT NULL UNION SELECT b, a FROM links WHERE a <> b AND b IS NOT NULL),
reach AS (SELECT a AS node, a AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
urls AS (SELECT node AS u FROM reach UNION SELECT url FROM pages WHERE url IS NOT NULL),
parts AS (
  SELECT u, translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM urls),
ruled AS (
  SELECT u, host, path, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts),
judged AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS own FROM ruled),
spread AS (
  SELECT r.node, bool_or(j.own = 'allow') AS allowed, bool_or(j.own = 'block') AS blocked
  FROM reach r JOIN judged j ON r.other = j.u GROUP BY r.node)
SELECT p.page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, j.rule,
  coalesce(j.own, CASE WHEN s.allowed THEN 'allow' WHEN s.blocked THEN 'block' END, 'allow') AS verdict
FROM pages p LEFT JOIN judged j ON p.url = j.u LEFT JOIN spread s ON p.url = s.node
"""

#: Equal class ids need every pair of texts with a shared window compared, which small tables allow.
NEAR_COPIES = """
WITH RECURSIVE texts AS (
  SELECT DISTINCT coalesce(text, '') AS text FROM documents),
numbered AS (SELECT row_number() OVER (ORDER BY text) AS t, text FROM texts),
word AS (
  SELECT t, unnest(w) AS word, generate_subscripts(w, 1) AS n, len(w) AS size
  FROM (SELECT t, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM numbered)),
joined AS (
  SELECT t, n, size, word || ' ' || string_agg(word, ' ') OVER (PARTITION BY t ORDER BY n ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING) AS five,
    word FROM word),
windows AS (
  SELECT t, coalesce(five, word) AS shingle, count(*) AS c FROM joined WHERE n <= greatest(size - 4, 1) GROUP BY ALL),
size AS (SELECT t, sum(c) AS total FROM windows GROUP BY t),
shared AS (
  SELECT x.t AS a, y.t AS b, sum(least(x.c, y.c)) AS s FROM windows x JOIN windows y ON x.shingle = y.shingle AND x.t <> y.t GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN size p ON p.t = a JOIN size q ON q.t = b WHERE s >= 0.8 * (p.total + q.total - s)),
reach AS (SELECT t AS node, t AS other FROM numbered UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
least AS (SELECT t, min(doc_id) AS d FROM documents JOIN numbered n ON n.text = coalesce(documents.text, '') GROUP BY t),
class AS (SELECT node, min(d) AS class_id FROM reach JOIN least ON other = t GROUP BY node)
SELECT doc_id, class_id FROM documents JOIN numbered n ON n.text = coalesce(documents.text, '') JOIN class ON node = t
"""

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

RANKED_SEARCH = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
word AS (SELECT r, unnest(terms) AS term FROM doc),
tf AS (SELECT r, term, count(*) AS tf FROM word GROUP BY ALL),
whole AS (SELECT count(DISTINCT r) AS n, count(*) AS l FROM word),
weight AS (SELECT term, cast(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term),
damped AS (SELECT r, doc_id, 100 - 25 + (25 * len(terms) * n) // l AS m FROM doc, whole WHERE len(terms) > 0),
wanted AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, r, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM wanted JOIN weight USING (term) JOIN tf USING (term) JOIN damped USING (r) GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, cast(place AS INT) AS rank, doc_id, score FROM placed WHERE place <= 20
"""


def _nearest(book: str) -> str:
    """Each part with the entry of ``book`` nearest to it, the lower of equally near ones, and its squared distance."""
    far = "list_sum(list_transform(list_zip(part.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""
  SELECT r, p, x, own.e AS e, own.d AS d FROM (
    SELECT r, part.p, any_value(part.x) AS x, min({{'d': cast({far} AS BIGINT), 'e': b.e}}) AS own FROM part JOIN {book} b ON part.p = b.p GROUP BY r, part.p)"""


def _moved(book: str, own: str) -> str:
    """The entries of ``book`` at the floor of the mean of the parts that ``own`` gives them."""
    return f"""
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY k) AS x FROM (
      SELECT p, e, k, cast(floor(sum(c) / count(*)) AS BIGINT) AS mean
      FROM (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS k FROM {own}) GROUP BY p, e, k) GROUP BY p, e) m
    ON b.p = m.p AND b.e = m.e"""


VECTOR_CODES = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) AS t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM part WHERE r <= 64),
own0 AS MATERIALIZED ({_nearest("book0")}),
book1 AS MATERIALIZED ({_moved("book0", "own0")}),
own1 AS MATERIALIZED ({_nearest("book1")}),
book2 AS MATERIALIZED ({_moved("book1", "own1")}),
own2 AS MATERIALIZED ({_nearest("book2")}),
code AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, cast(sum(d) AS BIGINT) AS error FROM own2 GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS sha FROM book2)
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha FROM digest) AS codebooks_sha256
FROM kept JOIN code USING (r)
"""

LLM_ORACLE_SQL = {
    "op4_url_filter": URL_FILTER,
    "op2_near_copies": NEAR_COPIES,
    "op11_ranked_search": RANKED_SEARCH,
    "op12_vector_codes": VECTOR_CODES,
}
