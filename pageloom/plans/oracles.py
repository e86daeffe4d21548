"""DuckDB SQL with the expected result of each registered query.

Written from the meaning of the operators, with other means than the Spark code
where possible: rendered pages are not parsed, the expected values come from
the order rows; containment is an interval join, depths are a recursive query,
chains are gaps and islands.
"""

from __future__ import annotations

from . import inputs as I

# character classes, as in pageloom.functions.text
W = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]"
NOT_WORD = r"[^\p{L}\p{N}_\t-\r\x1c-\x1f \x{85}\p{Z}]"
DROP = "('ddx', 'hID', 'sdx', 'SFIELD', 'XT', 'lang')"
URI = r"^(([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"


def clean(e: str) -> str:
    return f"trim(regexp_replace(coalesce({e}, ''), '{W}+', ' ', 'g'))"


def normal(e: str) -> str:
    return f"regexp_replace(lower({clean(e)}), '{NOT_WORD}', '', 'g')"


def part(e: str, group: int) -> str:
    return f"regexp_extract({e}, '{URI}', {group})"


def raw_path(e: str) -> str:
    return part(e, 5)


def path(e: str) -> str:
    return f"regexp_replace({raw_path(e)}, ';[^/]*$', '')"


def params(e: str) -> str:
    return f"regexp_extract({raw_path(e)}, ';([^/]*)$', 1)"


def pairs(query: str) -> str:
    """List of {n, v} in URL order."""
    return (
        f"list_transform(list_filter(string_split({query}, '&'), lambda s: strpos(s, '=') > 0 AND "
        f"length(s) > strpos(s, '=')), lambda s: {{'n': url_decode(replace(left(s, strpos(s, '=') - 1), '+', ' ')), "
        f"'v': url_decode(replace(substr(s, strpos(s, '=') + 1), '+', ' '))}})"
    )


def normalized(e: str) -> str:
    q = (
        f"array_to_string(list_transform(list_sort(list_filter({pairs(part(e, 7))}, lambda p: p.n NOT IN {DROP})), "
        "lambda p: p.n || '=' || p.v), '&')"
    )
    p = params(e)
    return (
        f"CASE WHEN {part(e, 4)} = '' AND NOT starts_with({path(e)}, '/') THEN 'https:' ELSE 'https://' END || "
        f"regexp_replace(lower({part(e, 4)}), '^www\\.', '') || rtrim({path(e)}, '/') || "
        f"CASE WHEN {p} <> '' THEN ';' || {p} ELSE '' END || "
        f"CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END"
    )


def key_of(n: str) -> str:
    """Content key of a canonical URL ``n``."""
    def value(name: str) -> str:
        return f"list_filter({pairs(part(n, 7))}, lambda p: p.n = '{name}')[-1].v"

    stem = f"{part(n, 4)} || {path(n)}"
    options = [f"{stem} || '?{k}=' || {value(k)}" for k in ("bidx", "article_no", "idx")]
    return f"coalesce({', '.join(options)}, {normalized(n)})"


def excluded(n: str) -> str:
    return (
        f"(starts_with({n}, 'https://spam-farm.example.org/') OR starts_with({path(n)}, '/the') OR "
        f"coalesce(starts_with(list_filter({pairs(part(n, 7))}, lambda p: p.n = 'page')[1].v, '2'), false))"
    )


WEB_URLS = f"SELECT url FROM pages UNION ALL SELECT {I.ORDER_URL} AS url FROM orders"
HREFS = f"SELECT o_orderkey, {I.ORDER_BASE} AS base, {I.ORDER_HREF} AS href FROM orders"
DEPTH = I.PAGE_DEPTH
ARTICLES = (
    f"SELECT cast(o_orderkey AS varchar) AS article_no, '{I.BOARD_URL}?mode=view&article_no=' || o_orderkey AS url, "
    "cast(year(o_orderdate) AS integer) AS notice_year, o_orderpriority AS category FROM orders"
)
MARK = "(SELECT cast(floor(avg(o_orderkey)) AS bigint) FROM orders)"


def entities(e: str) -> str:
    for name, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        e = f"replace({e}, '{name}', '{char}')"
    return e


STRIPPED = "regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g')"
TOKENS = f"""
tokens0 AS (
  SELECT page_id, list_zip(t, range(len(t))) AS z FROM (
    SELECT page_id, regexp_extract_all({STRIPPED}, '(?s)<[^>]*>|[^<]+') AS t FROM pages)),
tokens1 AS (SELECT page_id, u[1] AS token, cast(u[2] AS integer) AS pos FROM (SELECT page_id, unnest(z) AS u FROM tokens0)),
tokens AS (
  SELECT page_id, pos,
    CASE WHEN token LIKE '</%' THEN 'close' WHEN token LIKE '<%' THEN 'open' ELSE 'text' END AS kind,
    CASE WHEN token LIKE '<%' THEN lower(regexp_extract(token, '^</?([A-Za-z0-9]+)', 1)) END AS tag,
    CASE WHEN token LIKE '<%' THEN token END AS raw,
    CASE WHEN token NOT LIKE '<%' THEN {entities('token')} END AS text
  FROM tokens1 WHERE token NOT LIKE '<!%')"""
# an opening tag pairs with the closing tag that brings the count back
SPANS = """
tags AS (
  SELECT page_id, tag, pos, kind,
    sum(CASE kind WHEN 'open' THEN 1 ELSE -1 END) OVER (PARTITION BY page_id, tag ORDER BY pos) AS s
  FROM tokens WHERE kind <> 'text' AND tag NOT IN ('br', 'meta', 'img', 'hr', 'input', 'link')),
spans AS (
  SELECT o.page_id, o.tag, o.pos AS start, (SELECT min(c.pos) FROM tags c WHERE c.page_id = o.page_id AND c.tag = o.tag
    AND c.pos > o.pos AND c.kind = 'close' AND c.s = o.s - 1) AS "end", cast(o.s AS integer) AS level
  FROM tags o WHERE o.kind = 'open')"""
ANCHORS = f"""
anchors AS (
  SELECT page_id, url, {DEPTH} AS depth, unnest(range(len(h))) AS pos, unnest(h) AS href FROM (
    SELECT page_id, url, list_transform(regexp_extract_all({STRIPPED}, '<a href="([^"]*)"', 1),
      lambda x: {entities('x')}) AS h FROM pages)),
links AS (
  SELECT page_id, depth, cast(pos AS integer) AS pos,
    CASE WHEN starts_with({part('url', 4)}, 'www.') THEN {part('url', 2)} || '://' || {part('url', 4)} || href
    ELSE {part('url', 2)} || '://www.' || {part('url', 4)} || href END AS target FROM anchors)"""

# --- text of a page: blocks, two views, stitched ---------------------------------
BLOCK_TAGS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|li|"
    "main|nav|ol|p|pre|section|table|td|th|tr|ul"
)
_marked = f"regexp_replace({STRIPPED}, '(?is)<head.*?</head>', '', 'g')"
_marked = f"regexp_replace({_marked}, '(?i)</?({BLOCK_TAGS})(\\s[^>]*)?/?>', chr(1), 'g')"
_marked = f"regexp_replace({_marked}, '<a [^>]*>', chr(2), 'g')"
_marked = f"regexp_replace(replace({_marked}, '</a>', chr(3)), '<[^>]*>', '', 'g')"
_linked = "array_to_string(regexp_extract_all(raw, chr(2) || '([^' || chr(2) || chr(3) || ']*)', 1), ' ')"


def _n_words(e: str) -> str:
    return f"CASE WHEN {e} = '' THEN 0 ELSE len(string_split({e}, ' ')) END"


BLOCKS = f"""
cut AS (SELECT page_id, lower({part('url', 4)}) AS host, string_split({_marked}, chr(1)) AS parts FROM pages),
cut1 AS (SELECT page_id, host, unnest(parts) AS raw, unnest(range(len(parts))) AS n FROM cut),
cut2 AS (
  SELECT page_id, host, n, {clean(entities("replace(replace(raw, chr(2), ''), chr(3), '')"))} AS text,
    {clean(entities(_linked))} AS linked FROM cut1),
blocks AS (
  SELECT page_id, host, cast(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS integer) AS block_no, text,
    cast({_n_words('text')} AS integer) AS n_words, cast({_n_words('linked')} AS integer) AS n_link_words
  FROM cut2 WHERE text <> '')"""


def stitched(source: str) -> str:
    """CTEs from ``source``(id, a, b) to stitched(id, hit, lead, merged)."""
    return f"""
st0 AS (SELECT id, CASE WHEN {clean('a')} = '' THEN [] ELSE string_split({clean('a')}, ' ') END AS aw, {clean('b')} AS b FROM {source}),
st1 AS (SELECT id, aw, b, unnest(range(1, len(aw) - 3)) AS i FROM st0 WHERE len(aw) >= 5),
st2 AS (SELECT id, min(i) AS hit FROM st1 WHERE contains(b, array_to_string(aw[i:i + 4], ' ')) GROUP BY id),
st3 AS (SELECT id, aw, hit, trim(left(b, strpos(b, array_to_string(aw[hit:hit + 4], ' ')) - 1)) AS lead FROM st0 LEFT JOIN st2 USING (id)),
stitched AS (
  SELECT id, hit, CASE WHEN hit IS NOT NULL THEN lead END AS lead,
    CASE WHEN hit IS NULL THEN array_to_string(aw, ' ')
    ELSE array_to_string(list_concat(list_concat(aw[:hit - 1], [lead]), aw[hit:]), ' ') END AS merged FROM st3)"""


EXTRACTS = f"""
extracts AS (SELECT doc_id AS id, {I.EXTRACT_A} AS a, text AS b FROM documents)"""
PAGE_TEXT = f"""{BLOCKS},
views AS (
  SELECT p.page_id AS id,
    coalesce(string_agg(text, ' ' ORDER BY block_no) FILTER (n_words >= 10 AND n_link_words <= n_words * 0.33), '') AS a,
    coalesce(string_agg(text, ' ' ORDER BY block_no) FILTER (n_link_words <= n_words * 0.5), '') AS b
  FROM pages p LEFT JOIN blocks USING (page_id) GROUP BY 1),
{stitched('views')}"""

ADMIT = f"""
candidates AS (
  SELECT url, {DEPTH} AS depth FROM pages UNION ALL SELECT target, depth + 1 FROM links),
canon AS (SELECT {normalized('url')} AS url, depth FROM candidates),
kept AS (SELECT url, min(depth) AS depth FROM canon WHERE depth <= 2 AND NOT {excluded('url')} GROUP BY url),
keyed AS (SELECT url, depth, {key_of('url')} AS content_key FROM kept),
ranked AS (SELECT *, row_number() OVER (PARTITION BY content_key ORDER BY depth, url) AS rn FROM keyed),
history AS (SELECT {normalized('url')} AS url FROM pages WHERE url LIKE 'http://%' OR url LIKE '%.html'),
admitted AS (SELECT url, cast(depth AS integer) AS depth, content_key FROM ranked WHERE rn = 1 AND url NOT IN (SELECT url FROM history))"""

SITE_PASS = f"""
{PAGE_TEXT},
hashed AS (SELECT id AS page_id, sha256({normal('merged')}) AS fp FROM stitched WHERE {normal('merged')} <> ''),
survivors AS (SELECT min(page_id) AS page_id, fp FROM hashed GROUP BY fp),
{ANCHORS},
own AS (SELECT url, {normalized('url')} AS n FROM pages),
own_keys AS (SELECT {key_of('n')} AS k FROM own),
found AS (SELECT {normalized('target')} AS url, min(depth + 1) AS depth FROM links SEMI JOIN survivors USING (page_id)
  WHERE depth + 1 <= 3 GROUP BY 1),
found_keys AS (SELECT url, depth, {key_of('url')} AS k FROM found WHERE NOT {excluded('url')}),
new_links AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY depth, url) AS rn FROM found_keys)
  WHERE rn = 1 AND k NOT IN (SELECT k FROM own_keys) AND url NOT IN (SELECT n FROM own))"""


def stated(state: str, item: str, detail: str, distinct: bool = False) -> str:
    return f"SELECT {'DISTINCT ' if distinct else ''}'{state}' AS state, {item} AS item, {detail} AS detail FROM own"


def state_rows(distinct: bool) -> str:
    own = f"WITH own AS (SELECT page_id, url, html, {DEPTH} AS depth, {normalized('url')} AS norm FROM pages) "
    return own + " UNION ALL ".join(
        [
            stated("frontier", "url", "cast(depth AS varchar)"),
            stated("pending_pages", "url", "md5(html)"),
            stated("visited", "norm", "''", True),
            stated("parsed", "url", "''", distinct),
            stated("seen", "sha256(html)", "''", True),
            stated("identities", key_of("norm"), "''", True),
        ]
    )


# --- rendered pages: expected values from the rows they were made of -----------------
ITEMS = """
items AS (
  SELECT l_orderkey AS page_id, l_partkey, l_suppkey, cast(l_quantity AS bigint) AS qty,
    cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, cast(l_quantity AS bigint)) AS integer) AS i,
    cast(count(*) OVER (PARTITION BY l_orderkey) AS integer) AS n
  FROM lineitem),
keys AS (SELECT DISTINCT l_orderkey AS page_id FROM lineitem),
nesting AS (SELECT page_id FROM items GROUP BY page_id HAVING count(*) > 7)"""
CELLS = f"""{ITEMS},
cells AS (
  SELECT page_id, 0 AS table_no, 0 AS row, 0 AS col, 2 AS colspan, NULL::integer AS rowspan, 'Order ' || page_id AS text FROM keys
  UNION ALL SELECT page_id, 0, 0, 2, NULL, NULL, 'Quantity' FROM keys
  UNION ALL SELECT page_id, 0, i, 0, NULL, NULL, '' FROM items
  UNION ALL SELECT page_id, 0, i, 1, NULL, NULL, 'Part & ' || l_partkey || ' part ' || l_partkey FROM items
  UNION ALL SELECT page_id, 0, i, 2, NULL, NULL, qty::varchar FROM items
  UNION ALL SELECT page_id, 1, 0, 0, NULL, CASE WHEN n > 1 THEN n END, 'all' FROM items WHERE i = 1
  UNION ALL SELECT page_id, 1, i - 1, 1, NULL, NULL, l_suppkey::varchar FROM items
  UNION ALL SELECT page_id, 2, 0, 0, NULL, NULL, 'outer inner ' || page_id FROM nesting
  UNION ALL SELECT page_id, 2, 0, 1, NULL, NULL, 'end' FROM nesting
  UNION ALL SELECT page_id, 2, 1, 0, NULL, NULL, 'inner ' || page_id FROM nesting
  UNION ALL SELECT page_id, 3, 0, 0, NULL, NULL, 'inner ' || page_id FROM nesting),
numbered AS (
  SELECT *, cast(row_number() OVER (PARTITION BY page_id, table_no ORDER BY row, col) - 1 AS integer) AS cell_no FROM cells)"""
SHOP = "https://www.shop.example.com"
NOTICE_DATE = "strftime(o_orderdate, '%Y.%-m.%-d')"
NOTICE_TITLE = "'Order ' || o_orderkey || ' &more'"

ORACLES: dict[str, str] = {
    # S
    "page_source": "SELECT page_id, url, 0 AS depth, md5(html) AS html_md5 FROM pages",
    "jsonl_source": "SELECT 'https://docs.example.com/d/' || doc_id AS url, text AS merged_text, 0 AS n_images FROM documents",
    "jsonl_append": "SELECT 'https://docs.example.com/d/' || doc_id AS url, text AS value FROM documents",
    "size_bounded_write": "SELECT 'https://docs.example.com/d/' || doc_id AS url, text AS merged_text FROM documents",
    "bounded_file_sizes": "SELECT count(*)::BIGINT AS n_records, 0::BIGINT AS n_too_large FROM documents",
    "year_partitioned_notices": ARTICLES,
    "crawl_state_tables": state_rows(distinct=True),
    "crawl_state_snapshot": state_rows(distinct=False),
    "page_stream_source": "SELECT page_id, url, md5(html) AS html_md5 FROM pages",
    # U
    "url_parts": f"""SELECT url, lower({part('url', 2)}) AS scheme, {part('url', 4)} AS netloc, {path('url')} AS path,
      {params('url')} AS params, {part('url', 7)} AS query, {part('url', 9)} AS fragment FROM ({WEB_URLS})""",
    "normalize_url": f"SELECT url, {normalized('url')} AS normalized FROM ({WEB_URLS})",
    "url_query_params": f"""SELECT url, cast(unnest(range(len(ps))) AS integer) AS pos, unnest(ps).n AS name, unnest(ps).v AS value
      FROM (SELECT url, {pairs(part('url', 7))} AS ps FROM ({WEB_URLS}))""",
    "content_key": f"SELECT url, {key_of('n')} AS content_key FROM (SELECT url, {normalized('url')} AS n FROM ({WEB_URLS}))",
    "absolute_urls": f"""SELECT url FROM ({WEB_URLS} UNION ALL SELECT href FROM ({HREFS})) WHERE regexp_matches(url, '^([A-Za-z]+:)?//[^/?#]')""",
    "in_domain": f"""SELECT url FROM ({WEB_URLS}) WHERE {part('lower(url)', 4)} = 'example.com' OR {part('lower(url)', 4)} LIKE '%.example.com'""",
    "http_only": f"""SELECT url FROM ({WEB_URLS} UNION ALL SELECT CASE o_orderstatus WHEN 'F' THEN 'ftp://h/' WHEN 'O' THEN 'mailto:' ELSE 'https:' END
      || o_orderkey FROM orders) WHERE lower(url) LIKE 'http:%' OR lower(url) LIKE 'https:%'""",
    "exclude_by_rules": f"SELECT url FROM (SELECT {normalized('url')} AS url FROM ({WEB_URLS})) WHERE NOT {excluded('url')}",
    "exclude_by_many_rules": f"""WITH u AS (SELECT {normalized('url')} AS url FROM ({WEB_URLS})),
      n AS (SELECT DISTINCT url, list_filter({pairs(part('url', 7))}, lambda p: p.n = 'article_no')[1].v AS article FROM u),
      heads AS (SELECT url, left(article, unnest(range(1, length(article) + 1))) AS head FROM n),
      r AS (SELECT {normalized('url')} AS value FROM pages WHERE page_id % 5 = 0)
      SELECT url FROM u WHERE url NOT IN (SELECT url FROM heads JOIN orders ON head = cast(o_orderkey AS varchar) WHERE o_orderkey % 7 = 3)
        AND NOT EXISTS (SELECT 1 FROM r WHERE starts_with(u.url, r.value))""",
    "resolve_links": f"""SELECT o_orderkey, base, href, CASE o_orderpriority
        WHEN '1-URGENT' THEN '{SHOP}/s/a/' || o_orderkey || '?x=1#f' WHEN '2-HIGH' THEN '{SHOP}/b//' || o_orderkey
        WHEN '3-MEDIUM' THEN '{SHOP}/s/' || o_orderstatus || '/v.jsp?p=' || o_orderkey
        WHEN '4-NOT SPECIFIED' THEN 'https://other.example.org/' || o_orderkey || '/..'
        ELSE '{SHOP}/s/' || o_orderkey || '/' END AS resolved
      FROM (SELECT o_orderkey, o_orderpriority, o_orderstatus, {I.ORDER_BASE} AS base, {I.ORDER_HREF} AS href FROM orders)""",
    "link_base": f"""SELECT url, CASE WHEN {part('url', 4)} LIKE 'www.%' THEN url
      ELSE lower({part('url', 2)}) || '://www.' || {part('url', 4)} || {path('url')} END AS base FROM ({WEB_URLS})""",
    # X
    "html_tokens": f"WITH {TOKENS} SELECT * FROM tokens",
    "element_spans": f"WITH {TOKENS}, {SPANS} SELECT page_id, tag, start, \"end\", level FROM spans",
    "contained_elements": f"""WITH {TOKENS}, {SPANS},
      outers AS (SELECT * FROM spans WHERE tag IN ('nav', 'ul', 'li', 'article') AND "end" IS NOT NULL),
      pairs AS (SELECT t.page_id, t.pos, t.tag, o.start FROM tokens t JOIN outers o ON o.page_id = t.page_id AND o.start < t.pos AND t.pos < o."end"
        WHERE t.kind = 'open' AND t.tag IN ('a', 'li', 'p', 'h1'))
      SELECT page_id, pos, tag, start AS outer_start, start = max(start) OVER (PARTITION BY page_id, pos) AS nearest FROM pairs""",
    "page_links": f"""WITH {ANCHORS} SELECT page_id, pos, target FROM (SELECT page_id, target,
        cast(pos AS integer) AS pos FROM links) WHERE {part('target', 4)} LIKE '%.example.com'""",
    "page_files": f"""SELECT o_orderkey AS page_id, 0 AS pos, '{SHOP}/s/' || o_orderstatus || '/doc/' || o_orderkey || '.PDF' AS target FROM orders
      UNION ALL SELECT o_orderkey, 1, '{SHOP}/Download?id=' || o_orderkey || '&s=' || o_orderstatus FROM orders""",
    "page_images": f"""SELECT o_orderkey AS page_id, '{SHOP}/i/' || o_orderkey || '.jpg' AS target FROM orders
      UNION ALL SELECT o_orderkey, '{SHOP}/s/' || o_orderstatus || '/i/' || o_orderkey || '.PNG' FROM orders
      UNION ALL SELECT o_orderkey, '{SHOP}/s/o/' || o_orderkey || '.gif' FROM orders""",
    "table_cells": f"WITH {CELLS} SELECT page_id, table_no, cell_no, row, col, colspan, rowspan, text FROM numbered",
    "table_cell_links": f"""WITH {ITEMS} SELECT page_id, 0 AS table_no, 2 + (i - 1) * 3 + 1 AS cell_no, i AS row, 1 AS col, 0 AS link_no,
      '{SHOP}/o/' || page_id || '/part/' || l_partkey AS href, 'part ' || l_partkey AS link_text FROM items""",
    "table_cell_images": f"""WITH {ITEMS} SELECT page_id, 0 AS table_no, 2 + (i - 1) * 3 AS cell_no, i AS row, 0 AS col, 0 AS image_no,
      '{SHOP}/f/' || l_partkey || '.PNG' AS src FROM items""",
    "page_text_blocks": f"""WITH {BLOCKS},
      light AS (SELECT *, {normal('text')} AS norm FROM blocks WHERE n_link_words <= n_words * 0.5),
      template AS (SELECT host, norm FROM light GROUP BY 1, 2 HAVING count(DISTINCT page_id) >= 3)
      SELECT page_id, host, block_no, text, n_words, n_link_words FROM light l
      WHERE NOT EXISTS (SELECT 1 FROM template t WHERE t.host = l.host AND t.norm = l.norm)""",
    "page_records": f"""WITH {ITEMS}
      SELECT -1 - o_orderkey AS page_id, '{SHOP}/s/' || o_orderstatus || '/v.jsp?id=' || o_orderkey AS url, '' AS merged_text,
        (SELECT array_to_string(list_sort(['{SHOP}/i/' || o_orderkey || '.jpg', '{SHOP}/s/' || o_orderstatus || '/i/' || o_orderkey || '.PNG',
          '{SHOP}/s/o/' || o_orderkey || '.gif']), '|')) AS images,
        '{SHOP}/s/' || o_orderstatus || '/doc/' || o_orderkey || '.PDF|{SHOP}/Download?id=' || o_orderkey || '&s=' || o_orderstatus AS files,
        0 AS n_tables, 0 AS n_cells FROM orders
      UNION ALL SELECT page_id, '{SHOP}/o/' || page_id || '/view.jsp?lang=en', '',
        array_to_string(list_sort(list_distinct(list('{SHOP}/f/' || l_partkey || '.PNG'))), '|'), '',
        CASE WHEN count(*) > 7 THEN 4 ELSE 2 END,
        cast(3 + 4 * count(*) + CASE WHEN count(*) > 7 THEN 4 ELSE 0 END AS integer) FROM items GROUP BY page_id""",
    # T
    "clean_text": f"SELECT doc_id, {clean('text')} AS clean FROM documents",
    "normalize_text": f"SELECT doc_id, {normal('text')} AS normal FROM documents",
    "text_fingerprint": f"SELECT doc_id, sha256({normal('text')}) AS fp FROM documents",
    "word_shingles": f"""WITH w AS (SELECT doc_id, string_split({clean('text')}, ' ') AS w FROM documents WHERE {clean('text')} <> ''),
      s AS (SELECT doc_id, list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' ')) AS s FROM w)
      SELECT doc_id, cast(coalesce(len(s), 0) AS bigint) AS n_shingles, md5(coalesce(array_to_string(s, '|'), '')) AS shingles_md5
      FROM documents LEFT JOIN s USING (doc_id)""",
    "stitch_extracts": f"WITH {EXTRACTS}, {stitched('extracts')} SELECT id AS doc_id, merged AS merged_text FROM stitched",
    "lead_in_text": f"WITH {EXTRACTS}, {stitched('extracts')} SELECT id AS doc_id, lead AS lead_in FROM stitched",
    # D
    "nonempty_records": f"SELECT doc_id FROM documents WHERE {clean('text')} <> '' AND {normal('text')} <> ''",
    "dedup_by_text": f"SELECT min(doc_id) AS doc_id, fp FROM (SELECT doc_id, sha256({normal('text')}) AS fp FROM documents) GROUP BY fp",
    "dedup_against_history": f"""WITH h AS (SELECT doc_id, source, sha256({normal('text')}) AS fp FROM documents)
      SELECT min(doc_id) AS doc_id, fp FROM h WHERE source NOT IN ('src1', 'src2', 'src3')
        AND fp NOT IN (SELECT fp FROM h WHERE source IN ('src1', 'src2', 'src3')) GROUP BY fp""",
    "admit_urls": f"WITH {ANCHORS}, {ADMIT} SELECT url, depth, content_key FROM admitted",
    "link_log": f"WITH {ANCHORS}, {ADMIT} SELECT url, depth FROM admitted",
    "merge_extra_links": f"""WITH waiting AS (SELECT {normalized('url')} AS url, {DEPTH} AS depth FROM pages WHERE url LIKE '%#top'),
      history AS (SELECT {normalized('url')} AS url FROM pages WHERE url LIKE 'http://%' OR url LIKE '%.html'),
      extra AS (SELECT DISTINCT {normalized('url')} AS url FROM ({WEB_URLS}))
      SELECT url, depth FROM waiting UNION ALL SELECT url, 0 FROM extra
      WHERE url NOT IN (SELECT url FROM history) AND url NOT IN (SELECT url FROM waiting)""",
    "link_depths": """WITH RECURSIVE pairs AS (SELECT DISTINCT 'o/' || l_orderkey AS a, 'p/' || l_partkey AS b FROM lineitem),
      edges AS (SELECT a AS src, b AS dst FROM pairs UNION ALL SELECT b, a FROM pairs),
      walk AS (SELECT min(src) AS url, 0 AS depth FROM edges
        UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.url WHERE w.depth < 16)
      SELECT url, min(depth) AS depth FROM walk GROUP BY url""",
    "depth_filter": f"SELECT page_id, url, {DEPTH} AS depth FROM pages WHERE {DEPTH} <= 2",
    "next_batch": f"SELECT url, {DEPTH} AS depth, page_id AS seq FROM pages ORDER BY depth, seq LIMIT 100",
    "site_pass": f"""WITH {SITE_PASS}
      SELECT 'record' AS kind, p.url, {DEPTH} AS depth, s.fp AS key FROM survivors s JOIN pages p USING (page_id)
      UNION ALL SELECT 'link', url, depth, k FROM new_links""",
    # N
    "notice_fields": f"""SELECT o_orderkey AS page_id, {NOTICE_TITLE} AS title, {NOTICE_DATE} AS date_text, o_orderpriority AS category,
      cast(o_orderdate AS date) AS notice_date, cast(year(o_orderdate) AS integer) AS notice_year FROM orders""",
    "notice_records": f"""SELECT o_orderkey AS page_id, '{I.BOARD_URL}?mode=view&article_no=' || o_orderkey AS url,
      'category: [' || o_orderpriority || '] title: ''' || {NOTICE_TITLE} || ''' date: ' || {NOTICE_DATE} || ' ' || chr(10) ||
        ' - First ' || o_orderkey || ' - By' || o_custkey || ' - end' AS merged_text,
      'https://www.board.example.com/i/' || o_orderkey || '.png|http://cdn.example.com/' || o_orderkey || '.gif|https://www.board.example.com/sc/tail/'
        || o_orderkey || '.jpg' AS images,
      'https://www.board.example.com/sc/files/' || o_orderkey || '.hwp' AS files, 1 AS n_tables, 'customer|' || o_custkey AS cells,
      o_orderpriority AS category, {NOTICE_TITLE} AS title, cast(o_orderdate AS date) AS notice_date,
      cast(year(o_orderdate) AS integer) AS notice_year, o_orderkey AS article_no FROM orders""",
    "article_no": f"""SELECT url, list_filter({pairs(part('url', 7))}, lambda p: p.n = 'article_no')[1].v AS article_no FROM ({WEB_URLS})""",
    "feed_high_water": f"SELECT max(o_orderkey) AS last_article_no, '{I.BOARD_URL}?mode=view&article_no=' || max(o_orderkey) AS last_page_url FROM orders",
    "new_notices": f"SELECT article_no, url FROM ({ARTICLES}) WHERE category <> '5-LOW' AND cast(article_no AS bigint) > {MARK}",
    "next_notice_link": f"""SELECT o_orderkey AS page_id, '{I.BOARD_URL}?mode=view&article_no=' || o_orderkey AS url,
      CASE WHEN NOT {I.ENDS_CHAIN} THEN '{I.BOARD_URL}?mode=view&article_no=' || (o_orderkey + 1) END AS next_url FROM orders""",
    "notice_chain": f"""WITH marked AS (SELECT o_orderkey AS k, {I.ENDS_CHAIN} AS ends FROM orders),
      breaks AS (SELECT k, CASE WHEN coalesce(lag(ends) OVER w, true) OR lag(k) OVER w <> k - 1 THEN k END AS b FROM marked WINDOW w AS (ORDER BY k)),
      chains AS (SELECT k, max(b) OVER (ORDER BY k) AS s FROM breaks)
      SELECT '{I.BOARD_URL}?mode=view&article_no=' || s AS start, '{I.BOARD_URL}?mode=view&article_no=' || k AS url, k - s AS pos FROM chains""",
    # R
    "stream_dedup_text": f"SELECT DISTINCT sha256({normal('text')}) AS fp FROM documents",
    "stream_new_notices": f"""SELECT cast(o_orderkey AS varchar) AS article_no, 'notice' AS kind FROM orders WHERE o_orderkey > {MARK}
      UNION ALL SELECT cast(max(o_orderkey) AS varchar), 'mark' FROM orders""",
    "notice_feed": f"""WITH notices AS (SELECT '{I.BOARD_URL}?mode=view&article_no=' || o_orderkey AS url, cast(year(o_orderdate) AS integer) AS notice_year,
        'category: [' || o_orderpriority || '] title: ''' || {NOTICE_TITLE} || ''' date: ' || {NOTICE_DATE} || ' ' || chr(10) ||
          ' - First ' || o_orderkey || ' - By' || o_custkey || ' - end' AS merged_text, o_orderkey AS article_no FROM orders)
      SELECT *, 'record' AS kind FROM notices UNION ALL SELECT url, notice_year, merged_text, NULL, 'line' FROM notices
      UNION ALL SELECT '{I.BOARD_URL}?mode=view&article_no=' || max(article_no), NULL, NULL, max(article_no), 'mark' FROM notices""",
    "stream_resume": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    # G
    "admit_responses": """SELECT event_id, 'https://h/' || user_id AS url, CASE event_type WHEN 'error' THEN 'retry' WHEN 'click' THEN 'retry'
      WHEN 'signup' THEN 'fail' WHEN 'purchase' THEN 'skip_type' ELSE 'admitted' END AS outcome FROM events""",
    "fetch_outcomes": """WITH n AS (SELECT 'https://h/' || user_id AS url, event_type, cast(value AS decimal(12, 2)) AS e,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
      s AS (SELECT *, sum(e) OVER (PARTITION BY url ORDER BY n) AS spent FROM n),
      stop AS (SELECT url, min(n) AS last FROM s WHERE event_type NOT IN ('error', 'click') OR n = 10 OR spent >= 200 GROUP BY url),
      ends AS (SELECT s.url, max(s.n) AS last FROM s LEFT JOIN stop USING (url) WHERE s.n <= coalesce(stop.last, s.n) GROUP BY s.url)
      SELECT s.url, s.n AS attempts, cast(s.spent AS decimal(22, 2)) AS total_seconds,
        CASE event_type WHEN 'purchase' THEN 'skip_type' WHEN 'view' THEN 'ok' ELSE 'fail' END AS outcome
      FROM s JOIN ends ON ends.url = s.url AND ends.last = s.n""",
    "pass_progress": """SELECT strftime(ts, '%Y-%m-%d') AS pass, count(*) FILTER (event_type = 'click') AS pending,
      count(*) FILTER (event_type = 'view') AS visited, count(*) FILTER (event_type = 'purchase') AS parsed,
      count(*) FILTER (event_type = 'error') AS seen, count(*) FILTER (event_type = 'signup') AS "new" FROM events GROUP BY 1""",
    "activity_sessions": """WITH logs AS (SELECT user_id, epoch_us(ts) AS t FROM events UNION ALL SELECT -1, epoch_us(ts) FROM events),
      gaps AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) >= 120000000 OR lag(t) OVER (PARTITION BY user_id ORDER BY t) IS NULL
        THEN 1 ELSE 0 END AS g FROM logs),
      numbered AS (SELECT *, sum(g) OVER (PARTITION BY user_id ORDER BY t) AS session_no FROM gaps)
      SELECT user_id, cast(session_no AS bigint) AS session_no, min(t) AS started_us, max(t) AS ended_us, count(*) AS n_rows FROM numbered GROUP BY 1, 2""",
}
# Same pages in arrival order: the batches give what one pass gives.
ORACLES["stream_site_pass"] = f"SELECT kind, url, key FROM ({ORACLES['site_pass']})"


def _site_walk(levels: int = 12) -> str:
    """One set of tables per level; with ten links per customer, twelve levels are enough for 10^11 of them."""
    steps = []
    for i in range(levels):
        before = f"SELECT url FROM v{i - 1} UNION ALL " if i else ""
        texts = f"SELECT t FROM s{i - 1}" if i else "SELECT NULL WHERE false"
        steps += [
            f"v{i} AS MATERIALIZED ({before}SELECT url FROM f{i})",
            f"w{i} AS MATERIALIZED (SELECT min(page_id) AS page_id FROM f{i} JOIN page USING (url) WHERE t IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM ({texts}) seen(t) WHERE seen.t = page.t) GROUP BY t)",
            f"r{i} AS MATERIALIZED (SELECT page.*, {i} AS depth FROM page JOIN w{i} USING (page_id))",
            f"s{i} AS MATERIALIZED ({texts.replace('SELECT NULL WHERE false', '')}{' UNION ALL ' if i else ''}SELECT t FROM r{i})",
            f"f{i + 1} AS MATERIALIZED (SELECT DISTINCT dst AS url FROM link JOIN r{i} ON src = r{i}.url WHERE dst NOT IN (SELECT url FROM v{i}))",
        ]
    # stitching puts a blank behind the (here empty) lead-in of a text
    records = " UNION ALL ".join(f"SELECT 'record' AS kind, url, depth, ' ' || t AS merged_text FROM r{i}" for i in range(levels))
    links = " UNION ALL ".join(f"SELECT 'link', replace(url, '://www.', '://'), {i}, NULL FROM f{i} WHERE url NOT IN (SELECT url FROM page)" for i in range(levels))
    url = lambda kind, key: f"'{I.SHOP}/{kind}/' || ({key})"
    return f"""WITH page AS MATERIALIZED (
        SELECT c_custkey * 2 AS page_id, {url('c', 'c_custkey')} AS url, {I.CUSTOMER_TEXT} AS t FROM customer
        UNION ALL SELECT o_orderkey * 2 + 1, {url('o', 'o_orderkey')}, {I.ORDER_TEXT} FROM orders),
      link AS MATERIALIZED (
        SELECT {url('c', 'c_custkey')} AS src, {url('c', 'c_custkey * 10 + n')} AS dst FROM customer, range(10) d(n)
        UNION ALL SELECT {url('c', 'o_custkey')}, {url('o', 'o_orderkey')} FROM orders
        UNION ALL SELECT {url('o', 'o_orderkey')}, {url('c', 'o_custkey')} FROM orders
        UNION ALL SELECT {url('o', 'o_orderkey')}, {url('p', 'o_orderkey % 1000')} FROM orders),
      f0 AS MATERIALIZED (SELECT {url('c', 'n')} AS url FROM range(1, 10) d(n)),
      {", ".join(steps)}
      {records} UNION ALL {links}"""


ORACLES["site_walk"] = _site_walk()
