"""DuckDB oracle SQL, one statement per job of ``plans.jobs``.

Only the driver tables are registered in DuckDB, so derived views are
written as CTEs inside each statement.
"""

from __future__ import annotations

from . import oracle_pages as P

SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    SQL[name] = text.strip()


# --------------------------------------------------------------------------- pages

from ..sources.tables import FEED_BUCKET, MIXED, MIXED_BUCKET, SNIPPETS  # noqa: E402
from .sqlfn import q  # noqa: E402


def _snippet(text: str) -> str:
    return f"replace({q(text)}, '{{url}}', url)" if "{url}" in text else q(text)


# ``pages`` with the snippets of the fixture
PW = ("pw AS (SELECT page_id, url, coalesce(html, '') || CASE page_id % " + str(len(SNIPPETS)) + " "
      + " ".join(f"WHEN {i} THEN {_snippet(t)}" for i, t in enumerate(SNIPPETS)) + " END AS html FROM pages)")

sql("tokens", f"""
WITH {P.tokens_ctes()}
SELECT page_id, CAST(pos AS INTEGER) AS pos, kind, name, closing, tok FROM tk WHERE tok <> ''
""")

sql("visible_depth", f"""
WITH {PW}, {P.state_ctes("pw")}
SELECT page_id, count(*) AS n_tokens, count(CASE WHEN kind = 'text' THEN 1 END) AS n_text,
  count(CASE WHEN kind = 'text' AND active AND skip = 0 THEN 1 END) AS n_visible_text,
  CAST(max(skip) AS INTEGER) AS max_skip_depth, CAST(max(pre) AS INTEGER) AS max_pre_depth
FROM st WHERE tok <> '' GROUP BY page_id
""")

sql("page_title", f"""
WITH {P.extract_ctes(False, 50_000)}
SELECT page_id, title FROM ex
""")

sql("page_text", f"""
WITH {P.extract_ctes(False, 50_000)}
SELECT page_id, content, CAST(length AS INTEGER) AS length, truncated FROM ex
""")

sql("page_markdown", f"""
WITH {PW}, {P.extract_ctes(True, 50_000, "pw")}
SELECT page_id, content, CAST(length AS INTEGER) AS length, truncated FROM ex
""")

sql("page_truncated", f"""
WITH {P.extract_ctes(False, 1_000)}
SELECT page_id, content, CAST(length AS INTEGER) AS length, truncated FROM ex
""")

sql("raw_links", f"""
WITH {P.raw_links_ctes()}
SELECT page_id, CAST(link_pos AS INTEGER) AS link_pos, text, href FROM raw_links
""")

sql("tag_attributes", f"""
WITH {PW}, {P.tokens_ctes("pw")},
att AS (SELECT page_id, pos, name, unnest(l) AS a, unnest(range(len(l))) AS i FROM
  (SELECT *, regexp_extract_all(tok, {q(P.ATTR_RE)}) AS l FROM tk WHERE kind = 'tag' AND NOT closing)),
av AS (SELECT page_id, pos, name, i, lower(regexp_extract(a, '^[^=[:space:]]+')) AS attribute,
  regexp_extract(a, '(?s)=[^"'']*"(.*)"$', 1) || regexp_extract(a, '(?s)=[^"'']*''(.*)''$', 1) || regexp_extract(a, '=[[:space:]]*([^"''[:space:]]+)$', 1) AS value FROM att)
SELECT page_id, CAST(pos AS INTEGER) AS pos, name, attribute, value FROM av
QUALIFY row_number() OVER (PARTITION BY page_id, pos, attribute ORDER BY i DESC) = 1
""")

sql("page_images", f"""
WITH {PW}, {P.state_ctes("pw")}
SELECT page_id, CAST(pos AS INTEGER) AS pos, {P.js_trim(f"coalesce({P.attr('tok', 'alt')}, '')")} AS alt,
  coalesce({P.attr('tok', 'src')}, '') AS src
FROM st WHERE active AND kind = 'tag' AND NOT closing AND name = 'img'
""")

sql("page_outline", f"""
WITH {PW}, {P.state_ctes("pw")},
hd AS (
  SELECT page_id, pos, tok, kind, active AND kind = 'text' AND skip = 0 AS txt,
    CASE WHEN active AND kind = 'tag' AND NOT closing AND skip = 0 AND name IN ('h1', 'h2', 'h3', 'h4', 'h5', 'h6')
      THEN CAST(substr(name, 2) AS INTEGER) END AS lvl,
    last_value(CASE WHEN active AND kind = 'tag' AND NOT closing AND skip = 0
        AND name IN ('h1', 'h2', 'h3', 'h4', 'h5', 'h6') THEN pos
      WHEN active AND kind = 'tag' AND {P.in_list('name', (*P.BLOCK_TAGS, *P.HEADINGS, 'li', 'hr'))} THEN -1 END IGNORE NULLS)
      OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS h
  FROM st),
hg AS (SELECT page_id, h, max(lvl) AS level, coalesce(string_agg(tok, '' ORDER BY pos) FILTER (WHERE txt), '') AS raw
       FROM hd WHERE h >= 0 GROUP BY page_id, h)
SELECT page_id, CAST(h AS INTEGER) AS pos, level, {P.collapse_ws(P.decode_html_entities('raw'))} AS text
FROM hg WHERE text <> ''
""")


# --------------------------------------------------------------------------- URLs and links

from . import sqlurl as U  # noqa: E402
from ..functions.constants import TRUNCATED_PAGE_NOTE  # noqa: E402

GATED = U.gate_ctes("pages", "url", "pgg") + """,
gp AS (SELECT page_id, url, final_url FROM pgg WHERE final_url IS NOT NULL)"""

RESOLVED = PW + ", " + P.raw_links_ctes("pw") + ",\n" + GATED + """,
rj AS (SELECT r.*, g.final_url FROM raw_links r JOIN pgg g USING (page_id)),
""" + U.resolve_ctes("rj", "href", "final_url", "rs0") + """,
rs AS (SELECT * REPLACE (CASE WHEN final_url IS NOT NULL THEN resolved END AS resolved,
  CASE WHEN final_url IS NULL THEN 'page rejected' ELSE drop_reason END AS drop_reason) FROM rs0)"""

INVENTORY = RESOLVED + """,
inv0 AS (SELECT page_id, resolved, min(link_pos) AS link_pos, arg_min(text, link_pos) AS text
         FROM rs WHERE resolved IS NOT NULL GROUP BY page_id, resolved),
inv1 AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY link_pos) AS rnk, text, resolved FROM inv0),
inv AS (SELECT page_id, CAST(rnk AS INTEGER) AS rank, text, resolved AS href FROM inv1 WHERE rnk <= 50)"""

sql("url_gate", f"""
WITH {RESOLVED},
cand AS (SELECT page_id, CAST(NULL AS INTEGER) AS link_pos, url AS input FROM pages
         UNION ALL SELECT page_id, CAST(link_pos AS INTEGER), coalesce(resolved, href) FROM rs),
{U.gate_ctes("cand", "input", "cg")}
SELECT page_id, link_pos, input, reason IS NULL AS accepted, final_url, reason FROM cg
""")

sql("link_resolve", f"""
WITH {RESOLVED}
SELECT page_id, CAST(link_pos AS INTEGER) AS link_pos, href, resolved, drop_reason FROM rs
""")

sql("link_drop_stats", f"""
WITH {RESOLVED}
SELECT {U.host_of('final_url')} AS host, coalesce(drop_reason, 'resolved') AS outcome, count(*) AS n
FROM rs GROUP BY ALL
""")

sql("page_links", f"""
WITH {RESOLVED}
SELECT page_id, CAST(link_pos AS INTEGER) AS link_pos, text, resolved AS href FROM rs WHERE resolved IS NOT NULL
""")

sql("link_inventory", f"""
WITH {INVENTORY}
SELECT page_id, rank, text, href FROM inv
""")

sql("link_count", f"""
WITH {INVENTORY}
SELECT p.page_id, coalesce(c.n, 0) AS n_links
FROM pages p LEFT JOIN (SELECT page_id, count(*) AS n FROM inv GROUP BY page_id) c USING (page_id)
""")

sql("host_edges", f"""
WITH {RESOLVED}
SELECT {U.host_of('final_url')} AS src_host, {U.host_of('resolved')} AS dst_host,
  count(*) AS n_links, count(DISTINCT page_id) AS n_pages
FROM rs WHERE resolved IS NOT NULL GROUP BY ALL
""")

sql("link_to_page", f"""
WITH {RESOLVED},
pairs AS (SELECT page_id, resolved, count(*) AS n_links FROM rs WHERE resolved IS NOT NULL GROUP BY ALL)
SELECT pairs.page_id AS src_page_id, gp.page_id AS dst_page_id, n_links
FROM pairs JOIN gp ON gp.final_url = pairs.resolved
""")

sql("frontier", f"""
WITH {RESOLVED},
targets AS (SELECT DISTINCT resolved AS href, page_id FROM rs WHERE resolved IS NOT NULL)
SELECT href, count(*) AS n_pages FROM targets
WHERE NOT EXISTS (SELECT 1 FROM gp WHERE gp.final_url = targets.href) GROUP BY href
""")

PAGE_EXTRACT = PW + ", " + P.extract_ctes(True, 50_000, "pw") + ",\n" + GATED + """,
exj AS (SELECT ex.*, pgg.url, pgg.final_url, pgg.reason FROM ex JOIN pgg USING (page_id)),
lk0 AS (SELECT page_id, final_url, unnest(links) AS l, unnest(range(len(links))) AS lpos FROM exj),
lk1 AS (SELECT page_id, final_url, lpos, l.text AS l_text, l.href AS l_href FROM lk0 WHERE final_url IS NOT NULL),
""" + U.resolve_ctes("lk1", "l_href", "final_url", "lk2") + """,
lk AS (SELECT page_id, list(struct_pack(lpos := lpos, text := l_text, href := resolved)) AS lk
       FROM lk2 WHERE resolved IS NOT NULL GROUP BY page_id),
pe AS (
  SELECT exj.page_id, url, final_url, CASE WHEN final_url IS NOT NULL THEN 200 END AS status, title, content, CAST(length AS INTEGER) AS length, truncated,
    CAST(coalesce(len(lk.lk), 0) AS INTEGER) AS link_count,
    coalesce(array_to_string(list_transform(list_sort(lk.lk), lambda x: x.text || chr(9) || x.href), chr(10)), '')
      AS links_text, reason AS reject_reason
  FROM exj LEFT JOIN lk USING (page_id))"""

sql("page_extract", f"""
WITH {PAGE_EXTRACT}
SELECT * FROM pe
""")

sql("fetch_report", f"""
WITH {PAGE_EXTRACT}
SELECT page_id, CASE WHEN final_url IS NULL THEN 'not fetched (' || reject_reason || ')' || coalesce(': ' || url, '') ELSE 'HTTP ' || CAST(status AS VARCHAR)
  || CASE WHEN url <> final_url THEN ' (redirected from ' || url || ')' ELSE '' END || ' — '
  || CASE WHEN title <> '' THEN 'title: ' || title ELSE '(no title)' END || chr(10) || content
  || CASE WHEN truncated THEN {q(TRUNCATED_PAGE_NOTE)} ELSE '' END END AS report
FROM pe
""")

sql("links_report", f"""
WITH {INVENTORY},
per AS (SELECT page_id, count(*) AS n,
  list_sort(list(struct_pack(rank := rank, line := '  ' || CAST(rank AS VARCHAR) || '. ' ||
    CASE WHEN text = '' THEN href ELSE text || ' — ' || href END))) AS ls FROM inv GROUP BY page_id)
SELECT pgg.page_id, CASE WHEN final_url IS NULL THEN 'not fetched (' || reason || ')' || coalesce(': ' || url, '')
  WHEN n IS NULL THEN 'no links found on ' || final_url
  ELSE CAST(n AS VARCHAR) || ' link(s) on ' || final_url || ':' || chr(10)
    || array_to_string(list_transform(ls, lambda x: x.line), chr(10)) END AS report
FROM pgg LEFT JOIN per USING (page_id)
""")


# --------------------------------------------------------------------------- feeds

from ..operators import feeds as FD  # noqa: E402
from ..functions.constants import TRUNCATED_FEED_NOTE, UNTITLED  # noqa: E402
from .sqlfn import clean_feed_text, cap_with_ellipsis, in_list  # noqa: E402


def _esc(x):
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


_AT = "(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(doc_id AS INTEGER)))"
# the six forms of a date, and the moment each of them names
_TS = (f"CASE doc_id % 6 WHEN 1 THEN strftime({_AT}, '%a, %d %b %Y %H:%M:%S GMT') WHEN 2 THEN strftime({_AT}, '%d %b %y %H:%M +0000') "
       f"WHEN 3 THEN strftime({_AT}, '%d %B %Y') WHEN 4 THEN strftime({_AT}, '%Y-%m-%d') "
       f"WHEN 5 THEN strftime({_AT} + INTERVAL 2 HOURS, '%Y-%m-%dT%H:%M:%S+02:00') ELSE strftime({_AT}, '%Y-%m-%dT%H:%M:%SZ') END")
_MOMENT = f"strftime(CASE WHEN doc_id % 6 IN (3, 4) THEN date_trunc('day', {_AT}) ELSE {_AT} END, '%Y-%m-%d %H:%M:%S')"
_GRP = f"CASE WHEN {in_list('source', MIXED)} THEN 'mixed' ELSE source END"
_BUCKET = f"doc_id // CASE WHEN {in_list('source', MIXED)} THEN {MIXED_BUCKET} ELSE {FEED_BUCKET} END"
FEEDS = f"""
fd0 AS (
  SELECT {_GRP} AS grp, lang, {_BUCKET} AS bucket, min(doc_id) AS first_doc, string_agg(CASE WHEN lang = 'en' THEN
    '<item><title>' || {_esc('text')} || '</title><link>/doc/' || CAST(doc_id AS VARCHAR)
    || '</link><dc:date>' || {_TS} || '</dc:date><dc:creator>' || source || '</dc:creator><description>'
    || {_esc('text')} || '</description><content:encoded><![CDATA[<p>'
    || replace(text, ']]>', ' ') || '</p>]]></content:encoded></item>'
  ELSE
    '<entry><title>' || {_esc('text')} || '</title><link rel="self" href="/self/'
    || CAST(doc_id AS VARCHAR) || '"/><link rel="alternate" href="/doc/' || CAST(doc_id AS VARCHAR)
    || '"/><updated>' || {_TS} || '</updated><author><name>' || source
    || '</name></author><summary type="html">&lt;p&gt;' || {_esc('text')}
    || '&lt;/p&gt;</summary></entry>'
  END, '' ORDER BY doc_id) AS body
  FROM documents GROUP BY 1, 2, 3
),
fd1 AS (
  SELECT grp || '/' || lang || '/' || CAST(bucket AS VARCHAR) AS feed_id, lang, first_doc,
    'https://' || grp || '.example.com/' || lang || '/feed-' || CAST(bucket AS VARCHAR) || '.xml' AS url,
    CASE WHEN lang = 'en' THEN '<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>'
      || grp || ' ' || lang || '</title>' || body || '</channel></rss>'
    ELSE '<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>'
      || grp || ' ' || lang || '</title>' || body || '</feed>' END AS xml
  FROM fd0
),
{U.gate_ctes("fd1", "url", "fd2")},
feeds AS (SELECT feed_id, url, xml, final_url, false AS truncated, first_doc, lang FROM fd2)"""


def _parsed(src: str, out: str) -> str:
    return f"""{out}__0 AS (
  SELECT *, CASE WHEN regexp_matches(xml, {q(FD.RSS_ROOT)}) THEN 'rss'
                 WHEN regexp_matches(xml, {q(FD.ATOM_ROOT)}) THEN 'atom' END AS kind,
    CASE WHEN regexp_matches(xml, {q(FD.CHANNEL_RE)}) THEN regexp_extract(xml, {q(FD.CHANNEL_RE)}, 1) ELSE xml END AS _channel
  FROM {src}),
{out}__1 AS (
  SELECT *, CASE WHEN kind = 'rss' THEN regexp_extract(_channel, {q(FD.tag_re('title'))}, 1)
                 WHEN kind = 'atom' THEN regexp_extract(xml, {q(FD.tag_re('title'))}, 1) END AS _t FROM {out}__0),
{out} AS (
  SELECT * EXCLUDE (_channel, _t), CASE WHEN kind IS NOT NULL THEN {clean_feed_text('_t')} END AS feed_title,
    CASE WHEN kind IS NULL THEN {q(FD.NOT_A_FEED)} END AS error
  FROM {out}__1)"""


def _entries(parsed: str, out: str, max_items=None) -> str:
    blocks = (f"CASE WHEN kind = 'rss' THEN regexp_extract_all(xml, {q(FD.ITEM_RE)}, 1) "
              f"WHEN kind = 'atom' THEN regexp_extract_all(xml, {q(FD.ENTRY_RE)}, 1) END")
    if max_items is not None:
        blocks = f"list_slice({blocks}, 1, {max_items})"
    raw = {
        "r_title": FD.tag_re("title"), "r_link": FD.tag_re("link"), "r_guid": FD.tag_re("guid"),
        "r_pub": FD.tag_re("pubDate"), "r_dcdate": FD.tag_re("dc:date"),
        "r_apub": "(?i)<(?:published|updated)\\b[^>]*>([\\s\\S]*?)</(?:published|updated)>",
        "r_creator": FD.tag_re("dc:creator"), "r_author": FD.tag_re("author"),
        "r_aname": "(?i)<author\\b[^>]*>[\\s\\S]*?<name\\b[^>]*>([\\s\\S]*?)</name>",
        "r_desc": FD.tag_re("description"), "r_summary": FD.tag_re("summary"),
        "r_encoded": FD.tag_re("content:encoded"), "r_content": FD.tag_re("content"),
    }
    raw_sel = ",\n    ".join(f"regexp_extract(b, {q(p)}, 1) AS {k}" for k, p in raw.items())
    clean_sel = ",\n    ".join(f"{clean_feed_text(k)} AS c{k[1:]}" for k in raw)
    links = (f"list_filter(list_transform(regexp_extract_all(b, {q(FD.LINK_TAG_RE)}), lambda t: struct_pack("
             f"has := regexp_matches(t, {q(FD.HREF_RE)}), "
             f"href := regexp_extract(t, {q(FD.HREF_RE)}, 1) || regexp_extract(t, {q(FD.HREF_RE)}, 2), "
             f"rel := lower(regexp_extract(t, {q(FD.REL_RE)}, 1) || regexp_extract(t, {q(FD.REL_RE)}, 2)))), "
             f"lambda s: s.has)")
    return f"""{out}__0 AS (
  SELECT feed_id, kind, unnest(bl) AS b, unnest(range(len(bl))) AS pos
  FROM (SELECT feed_id, kind, {blocks} AS bl FROM {parsed} WHERE kind IS NOT NULL)),
{out}__1 AS (SELECT *, {raw_sel},
    {links} AS _links FROM {out}__0),
{out}__2 AS (SELECT *, {clean_sel},
    coalesce(struct_extract(list_filter(_links, lambda s: strpos(s.rel, 'alternate') > 0)[1], 'href'),
             struct_extract(list_filter(_links, lambda s: s.rel = '')[1], 'href'),
             struct_extract(_links[1], 'href'), '') AS _alink
  FROM {out}__1),
{out} AS (
  SELECT feed_id, CAST(pos AS INTEGER) AS pos, kind,
    CASE WHEN c_title = '' THEN {q(UNTITLED)} ELSE c_title END AS title,
    CASE WHEN kind = 'rss' THEN (CASE WHEN c_link = '' AND regexp_matches(c_guid, '(?i)^https?://') THEN c_guid ELSE c_link END)
         ELSE _alink END AS url,
    CASE WHEN kind = 'rss' THEN coalesce(nullif(c_pub, ''), c_dcdate) ELSE c_apub END AS published,
    CASE WHEN kind = 'rss' THEN coalesce(nullif(c_creator, ''), c_author) ELSE c_aname END AS author,
    CASE WHEN kind = 'rss' THEN c_desc ELSE c_summary END AS summary,
    CASE WHEN kind = 'rss' THEN c_encoded ELSE c_content END AS content
  FROM {out}__2)"""


def _items(parsed: str, out: str, max_items: int, include_content: bool) -> str:
    full = "(CASE WHEN content <> '' THEN content ELSE summary END)"
    content = (f"CASE WHEN {full} <> '' THEN {cap_with_ellipsis(full, 2000)} END" if include_content
               else "CAST(NULL AS VARCHAR)")
    return _entries(parsed, out + "_e", max_items) + f""",
{out}_j AS (SELECT e.*, p.final_url FROM {out}_e e JOIN {parsed} p USING (feed_id)),
{U.resolve_ctes(out + "_j", "url", "final_url", out + "_r", out="_res", reason="_why")},
{out} AS (
  SELECT feed_id, pos, title, coalesce(_res, '') AS url, nullif(published, '') AS published,
    nullif(author, '') AS author, CASE WHEN summary <> '' THEN {cap_with_ellipsis('summary', 500)} END AS summary,
    {content} AS content
  FROM {out}_r)"""


sql("feed_kind", f"""
WITH {FEEDS},
src AS (SELECT feed_id, xml FROM feeds UNION ALL SELECT 'page-' || CAST(page_id AS VARCHAR), html FROM pages),
{_parsed("src", "pf")}
SELECT feed_id, kind, feed_title, error FROM pf
""")

sql("rss_items", f"""
WITH {FEEDS}, {_parsed("feeds", "pf")}, {_entries("pf", "en")}
SELECT feed_id, pos, title, url, published, author, summary, content FROM en WHERE kind = 'rss'
""")

sql("atom_entries", f"""
WITH {FEEDS}, {_parsed("feeds", "pf")}, {_entries("pf", "en")}
SELECT feed_id, pos, title, url, published, author, summary, content FROM en WHERE kind = 'atom'
""")

sql("feed_entries", f"""
WITH {FEEDS}, {_parsed("feeds", "pf")}, {_items("pf", "it", 10, False)}
SELECT * FROM it
""")

sql("feed_entries_full", f"""
WITH {FEEDS}, {_parsed("feeds", "pf")}, {_items("pf", "it", 50, True)}
SELECT * FROM it
""")

sql("feed_entry_count", f"""
WITH {FEEDS}, {_parsed("feeds", "pf")}, {_items("pf", "it", 10, False)}
SELECT pf.feed_id, CAST(coalesce(c.n, 0) AS INTEGER) AS entry_count
FROM pf LEFT JOIN (SELECT feed_id, count(*) AS n FROM it GROUP BY feed_id) c USING (feed_id)
WHERE pf.kind IS NOT NULL
""")

sql("feed_report", f"""
WITH {FEEDS}, {_parsed("feeds", "pf")}, {_items("pf", "it", 10, False)},
blk AS (
  SELECT feed_id, pos, concat_ws(chr(10),
    CAST(pos + 1 AS VARCHAR) || '. ' || title || CASE WHEN url = '' THEN '' ELSE ' — ' || url END,
    CASE WHEN published IS NOT NULL THEN '   published: ' || published END,
    CASE WHEN author IS NOT NULL THEN '   author: ' || author END,
    CASE WHEN summary IS NOT NULL THEN '   ' || summary END,
    CASE WHEN content IS NOT NULL THEN '   ' || content END) AS block FROM it),
per AS (SELECT feed_id, list_sort(list(struct_pack(pos := pos, block := block))) AS bs FROM blk GROUP BY feed_id),
j AS (SELECT pf.*, per.bs, CASE WHEN per.bs IS NULL THEN 0 ELSE len(per.bs) END AS n
      FROM pf LEFT JOIN per USING (feed_id) WHERE pf.kind IS NOT NULL)
SELECT feed_id, concat_ws(chr(10),
  'feed: ' || feed_title || chr(10) || CAST(n AS VARCHAR) || CASE WHEN n = 1 THEN ' entry' ELSE ' entries' END
    || ' from ' || final_url,
  CASE WHEN bs IS NOT NULL THEN array_to_string(list_transform(bs, lambda x: x.block), chr(10)) END,
  CASE WHEN truncated THEN {q(TRUNCATED_FEED_NOTE)} END) AS report
FROM j
""")


# --------------------------------------------------------------------------- responses

from ..operators import responses as RS  # noqa: E402
from ..functions.constants import FEED_TYPES, PAGE_TYPES, REDIRECT_STATUSES  # noqa: E402
from .sqlfn import in_list, js_trim  # noqa: E402

RLOG = """
rlog AS (
  SELECT p.page_id, p.url, p.html,
    CAST(CASE WHEN p.page_id % 50 = 49 THEN 302 WHEN p.page_id % 10 = 0 THEN 302 WHEN p.page_id % 20 = 1 THEN 301
         WHEN p.page_id % 25 = 7 THEN 404 WHEN p.page_id % 25 = 8 THEN 302 ELSE 200 END AS INTEGER) AS status,
    CASE WHEN p.page_id % 50 = 49 THEN p.url
         WHEN p.page_id % 10 = 0 OR p.page_id % 20 = 1 THEN coalesce(n.url, 'https://gone.example.com/') END AS location,
    CASE WHEN p.page_id % 15 = 4 THEN 'application/json' WHEN p.page_id % 15 = 5 THEN NULL WHEN p.page_id % 15 = 6 THEN 'Text/Plain'
         WHEN length(p.html) = strlen(p.html) AND p.page_id % 15 = 7 THEN 'text/html; charset=ISO-8859-1'
         WHEN length(p.html) = strlen(p.html) AND p.page_id % 15 = 9 THEN 'text/html;charset="windows-1251"'
         WHEN length(p.html) = strlen(p.html) AND p.page_id % 15 = 11 THEN 'application/xhtml+xml; charset=big5'
         ELSE 'text/html; charset=utf-8' END AS content_type,
    CAST((p.page_id * 37) % 12000 AS INTEGER) AS elapsed_ms, CASE WHEN p.page_id % 40 = 13 THEN 'reset' END AS body_error,
    encode(p.html) AS body
  FROM pages p LEFT JOIN pages n ON n.page_id = p.page_id + 1
)"""


def _media(ct):
    return f"(CASE WHEN {ct} IS NULL THEN 'unknown' ELSE lower({js_trim(f'split_part({ct}, chr(59), 1)')}) END)"


sql("response_scan", f"""
WITH {RLOG}
SELECT page_id, url, status, location, content_type, elapsed_ms, CAST(octet_length(body) AS INTEGER) AS n_bytes,
  md5(decode(body)) AS body_md5
FROM rlog
""")

sql("status_gate", f"""
WITH {RLOG}
SELECT page_id, status,
  CASE WHEN status IN {tuple(REDIRECT_STATUSES)} THEN 'redirect' WHEN status BETWEEN 200 AND 299 THEN 'ok'
       ELSE 'rejected' END AS class,
  CASE WHEN NOT (status IN {tuple(REDIRECT_STATUSES)}) AND NOT (status BETWEEN 200 AND 299)
       THEN 'HTTP ' || CAST(status AS VARCHAR) END AS reason
FROM rlog
""")

sql("content_type_gate", f"""
WITH {RLOG}
SELECT page_id, {_media('content_type')} AS media_type, {in_list(_media('content_type'), PAGE_TYPES)} AS page_ok,
  {in_list(_media('content_type'), FEED_TYPES)} AS feed_ok
FROM rlog
""")

sql("size_cap", f"""
WITH {RLOG}
SELECT page_id, CAST(octet_length(body) AS INTEGER) AS n_bytes,
  CAST(least(octet_length(body), 10000) AS INTEGER) AS kept_bytes, octet_length(body) > 10000 AS truncated
FROM rlog
""")


def _byte_prefix_ctes(src: str, out: str, col: str, nbytes: int) -> str:
    """``out`` = ``src`` + ``_head``: longest character prefix of ``col`` within ``nbytes`` UTF-8 bytes
    (binary search, one CTE per step so no expression is duplicated)."""
    ctes, prev_cte, prev = [], src, "0"
    step, i = 1 << (nbytes.bit_length() - 1), 0
    while step >= 1:
        name = f"{out}_s{i}"
        keep = "" if i == 0 else f" EXCLUDE (_m{i - 1})"
        ctes.append(f"{name} AS (SELECT *{keep}, CASE WHEN strlen(substr({col}, 1, {prev} + {step})) <= {nbytes} "
                    f"THEN {prev} + {step} ELSE {prev} END AS _m{i} FROM {prev_cte})")
        prev_cte, prev, step, i = name, f"_m{i}", step // 2, i + 1
    ctes.append(f"{out} AS (SELECT * EXCLUDE ({prev}), substr({col}, 1, {prev}) AS _head FROM {prev_cte})")
    return ",\n".join(ctes)


def _charset(ct: str) -> str:
    g = lambda x, p: f"nullif(regexp_extract({x}, {q(p)}, 1), '')"
    return (f"coalesce({g(f'coalesce({ct}, {q(chr(39) * 0)})', RS.HEADER_CHARSET_RE)}, {g('_head', RS.XML_CHARSET_RE)}, "
            f"{g('_head', RS.META_CHARSET_RE)}, {g('_head', RS.META_CONTENT_RE)}, 'utf-8')")


sql("charset_detect", f"""
WITH {RLOG}, {_byte_prefix_ctes("rlog", "rh", "html", 2048)}
SELECT page_id, {_charset('content_type')} AS charset FROM rh
""")

sql("body_decode", f"""
WITH {RLOG}, {_byte_prefix_ctes("rlog", "rh", "html", 2048)},
cs AS (SELECT *, {_charset('content_type')} AS charset FROM rh)
SELECT page_id, charset,
  CASE WHEN regexp_replace(lower(charset), '[_-]', '', 'g') = 'utf8' THEN 'utf-8'
       WHEN {in_list('lower(charset)', RS.LATIN1_LABELS)} THEN 'windows-1252'
       WHEN lower(charset) = 'windows-1251' THEN 'windows-1251' WHEN lower(charset) IN ('utf-16le', 'utf-16') THEN 'utf-16le' WHEN lower(charset) = 'utf-16be' THEN 'utf-16be'
       ELSE 'utf-8 (charset_unsupported)' END AS decoder,
  decode(body) AS text
FROM cs
""")

sql("header_map", f"""
WITH {RLOG},
hb AS (SELECT page_id, CASE WHEN page_id % 50 = 3 THEN 'HTTP/x 200 X' ELSE 'HTTP/1.1 ' || CAST(status AS VARCHAR) || ' X' END
  || chr(13) || chr(10) || 'Content-Type: ' || coalesce(content_type, '') || chr(13) || chr(10) || 'X-A: 1'
  || chr(13) || chr(10) || 'x-a: 2' AS head FROM rlog),
lines AS (SELECT page_id, unnest(ls) AS line, unnest(range(len(ls))) AS ln
          FROM (SELECT page_id, string_split(head, chr(13) || chr(10)) AS ls FROM hb)),
fl AS (SELECT page_id, regexp_matches(line, {q(RS.STATUS_LINE_RE)}) AS ok,
         regexp_extract(line, {q(RS.STATUS_LINE_RE)}, 1) AS st, regexp_extract(line, {q(RS.STATUS_LINE_RE)}, 2) AS status_text
       FROM lines WHERE ln = 0),
kv AS (SELECT page_id, ln, lower({js_trim("substr(line, 1, strpos(line, ':') - 1)")}) AS key,
         {js_trim("substr(line, strpos(line, ':') + 1)")} AS value FROM lines WHERE ln > 0 AND strpos(line, ':') > 1),
mg AS (SELECT page_id, key, array_to_string(list_transform(list_sort(list(struct_pack(ln := ln, value := value))),
         lambda x: x.value), ', ') AS value FROM kv GROUP BY page_id, key)
SELECT fl.page_id, ok, CAST(st AS INTEGER) AS status, status_text, key, value FROM fl LEFT JOIN mg USING (page_id) WHERE ok
UNION ALL
SELECT page_id, ok, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM fl WHERE NOT ok
""")


def _redirect_ctes(n: int = 3, timeout: int = 10_000, allowed=PAGE_TYPES, log: str = "rlog", starts: str = "pages") -> str:
    """CTE ``chain``: every start walked hop by hop (recursive, to be used with WITH RECURSIVE)."""
    redir = f"status IN {tuple(REDIRECT_STATUSES)}"
    return ",\n".join([
        U.gate_ctes(f"(SELECT page_id, url FROM {starts})", "url", "g0", out="cur", reason="why"),
        U.gate_ctes(log, "url", "lgg", out="cur", reason="_lw"),
        "lg AS (SELECT split_part(cur, '#', 1) AS key, page_id AS capture_id, url AS capture_url, status, location, content_type, elapsed_ms, body_error FROM lgg "
        "WHERE cur IS NOT NULL QUALIFY row_number() OVER (PARTITION BY split_part(cur, '#', 1) ORDER BY page_id, url) = 1)",
        U.resolve_ctes("lg", "location", "key", "lr", out="to_url", reason="to_why", junk_filter=False),
        f"""walk AS (
  SELECT page_id, url, cur, 0 AS hops FROM g0 WHERE cur IS NOT NULL
  UNION ALL
  SELECT w.page_id, w.url, lr.to_url, w.hops + 1 FROM walk w JOIN lr ON lr.key = split_part(w.cur, '#', 1)
  WHERE w.hops < {n} AND {redir} AND elapsed_ms <= {timeout} AND location <> '' AND to_url IS NOT NULL AND NOT regexp_matches(to_url, '^[a-z]+://[^/?#]*@'))""",
        "tip AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY hops DESC) = 1)",
        f"""chain0 AS (
  SELECT t.page_id, t.url, t.cur AS final_url, t.hops, lr.status,
    CASE WHEN lr.status IS NULL THEN 'fetch failed' WHEN elapsed_ms > {timeout} THEN 'timed out'
         WHEN {redir} AND (location IS NULL OR location = '') THEN 'redirect without Location' WHEN {redir} AND hops = {n} THEN 'too many redirects'
         WHEN {redir} AND to_why = 'unsupported_scheme' THEN 'unsupported protocol' WHEN {redir} AND to_why IS NOT NULL THEN 'invalid URL'
         WHEN {redir} THEN 'embedded credentials' WHEN NOT (lr.status BETWEEN 200 AND 299) THEN 'HTTP status'
         WHEN NOT {in_list(_media('lr.content_type'), allowed)} THEN 'unsupported content type' WHEN body_error IS NOT NULL THEN 'body read failed'
         ELSE 'ok' END AS outcome, capture_id, capture_url, content_type
  FROM tip t LEFT JOIN lr ON lr.key = split_part(t.cur, '#', 1))""",
        """chain AS (
  SELECT page_id, url, final_url, hops, CASE WHEN outcome NOT IN ('fetch failed', 'timed out') THEN status END AS status, outcome,
    CASE WHEN outcome = 'ok' THEN capture_id END AS capture_id, CASE WHEN outcome = 'ok' THEN capture_url END AS capture_url, content_type FROM chain0
  UNION ALL SELECT page_id, url, NULL, 0, NULL, why, NULL, NULL, NULL FROM g0 WHERE cur IS NULL)"""])


sql("redirect_resolve", f"""
WITH RECURSIVE {RLOG}, {_redirect_ctes()}
SELECT page_id, url, final_url, hops, status, outcome FROM chain
""")

FETCHED_LINKS = f"""
wf0 AS (SELECT c.page_id, c.final_url, unnest(ex.links) AS l, unnest(range(len(ex.links))) AS lpos
        FROM chain c JOIN ex ON ex.page_id = c.capture_id),
wf1 AS (SELECT page_id, final_url, lpos, l.text AS l_text, l.href AS l_href FROM wf0),
{U.resolve_ctes("wf1", "l_href", "final_url", "wf2")}"""

sql("web_fetch", f"""
WITH RECURSIVE {RLOG}, {_redirect_ctes()},
{P.extract_ctes(True, 50_000)},
{FETCHED_LINKS},
wl AS (SELECT page_id, list(struct_pack(lpos := lpos, text := l_text, href := resolved)) AS lk
       FROM wf2 WHERE resolved IS NOT NULL GROUP BY page_id)
SELECT c.page_id, c.url, c.final_url, c.hops, c.status, c.outcome,
  CASE WHEN c.outcome = 'ok' THEN CASE WHEN contains(c.content_type, '8859') THEN 'windows-1252' WHEN contains(c.content_type, '1251') THEN 'windows-1251'
    WHEN contains(c.content_type, 'big5') THEN 'utf-8 (charset_unsupported)' ELSE 'utf-8' END END AS decoder,
  ex.title, ex.content, CAST(ex.length AS INTEGER) AS length, ex.truncated,
  CASE WHEN c.outcome = 'ok' THEN CAST(coalesce(len(wl.lk), 0) AS INTEGER) END AS link_count,
  CASE WHEN c.outcome = 'ok' THEN coalesce(array_to_string(list_transform(list_sort(wl.lk), lambda x: x.text || chr(9) || x.href),
    chr(10)), '') END AS links_text
FROM chain c LEFT JOIN ex ON ex.page_id = c.capture_id LEFT JOIN wl ON wl.page_id = c.page_id
""")

sql("web_links", f"""
WITH RECURSIVE {RLOG}, {_redirect_ctes()},
{P.extract_ctes(False, 50_000)},
{FETCHED_LINKS},
one AS (SELECT page_id, resolved, min(lpos) AS lpos, arg_min(l_text, lpos) AS text FROM wf2 WHERE resolved IS NOT NULL GROUP BY page_id, resolved
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY min(lpos)) <= 50),
wl AS (SELECT page_id, count(*) AS n, string_agg(text || chr(9) || resolved, chr(10) ORDER BY lpos) AS t FROM one GROUP BY page_id)
SELECT c.page_id, url, final_url, hops, status, outcome, CASE WHEN outcome = 'ok' THEN CAST(coalesce(n, 0) AS INTEGER) END AS link_count,
  CASE WHEN outcome = 'ok' THEN coalesce(t, '') END AS links_text
FROM chain c LEFT JOIN wl USING (page_id)
""")

# captured feeds beside the captured pages; bodies cut at 10,000 bytes (the last character may go with the cut)
FEED_READS = FEEDS + f""",
{RLOG},
fk AS (SELECT -1 - first_doc AS page_id, first_doc % 8 AS k, lang, url, xml FROM feeds),
flog AS (
  SELECT page_id, CASE WHEN k = 0 THEN url || '?v=2' ELSE url END AS url, 200 AS status, CAST(NULL AS VARCHAR) AS location,
    CASE k WHEN 1 THEN CASE WHEN lang = 'en' THEN 'application/rss+xml' ELSE 'application/atom+xml; charset=UTF-8' END WHEN 2 THEN 'text/xml'
      WHEN 3 THEN 'text/html; charset=utf-8' WHEN 4 THEN 'application/json' WHEN 5 THEN 'text/html' ELSE ' Application/XML ' END AS content_type,
    20 AS elapsed_ms, CASE WHEN k = 6 THEN 'reset' END AS body_error, CASE WHEN k = 5 THEN '<html><title>moved away</title></html>' ELSE xml END AS html FROM fk
  UNION ALL SELECT page_id, url, 301, '?v=2', 'text/html', 10, NULL, '' FROM fk WHERE k = 0
  UNION ALL SELECT page_id, url, status, location, content_type, elapsed_ms, body_error, html FROM rlog),
starts AS (SELECT page_id, url FROM fk UNION ALL SELECT page_id, url FROM pages),
{_redirect_ctes(allowed=FEED_TYPES, log="flog", starts="starts")},
cap AS (SELECT DISTINCT capture_id, capture_url, split_part(final_url, '#', 1) AS base FROM chain WHERE outcome = 'ok'),
cb AS (SELECT capture_url AS feed_id, base AS final_url, html AS whole, strlen(html) > 10000 AS truncated FROM cap JOIN flog ON page_id = capture_id AND url = capture_url),
{_byte_prefix_ctes("cb", "cc", "whole", 10_000)},
fcap AS (SELECT feed_id, final_url, truncated, _head AS xml FROM cc),
{_parsed("fcap", "pf")}"""

sql("web_feed", f"""
WITH RECURSIVE {FEED_READS}, {_items("pf", "it", 10, False)},
n AS (SELECT feed_id, count(*) AS n FROM it GROUP BY feed_id)
SELECT c.page_id, c.url, c.final_url, hops, status, CASE WHEN outcome = 'ok' AND kind IS NULL THEN 'not a feed' ELSE outcome END AS outcome,
  feed_title, CASE WHEN kind IS NOT NULL THEN truncated END AS truncated, CASE WHEN kind IS NOT NULL THEN CAST(coalesce(n, 0) AS INTEGER) END AS entry_count
FROM chain c LEFT JOIN pf ON pf.feed_id = c.capture_url LEFT JOIN n ON n.feed_id = c.capture_url
""")

sql("web_feed_entries", f"""
WITH RECURSIVE {FEED_READS}, {_items("pf", "it", 50, True)}
SELECT c.page_id, c.final_url, it.pos, it.title, it.url, it.published, it.author, it.summary, it.content
FROM chain c JOIN it ON it.feed_id = c.capture_url
""")

sql("fetch_outcome", f"""
WITH RECURSIVE {RLOG}, {_redirect_ctes()},
{U.gate_ctes("chain", "url", "cg", out="_u", reason="_w")}
SELECT coalesce({U.host_of('_u')}, '') AS host, outcome, count(*) AS n FROM cg GROUP BY ALL
""")


# --------------------------------------------------------------------------- hosts

from ..operators import hosts as H  # noqa: E402


def _ipv4_int(ip: str) -> str:
    octets = f"string_split({ip}, '.')"
    return (f"(CASE WHEN regexp_matches({ip}, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$') AND len(list_filter({octets}, "
            f"lambda o: CAST(o AS INTEGER) > 255)) = 0 THEN list_reduce(list_transform({octets}, lambda o: CAST(o AS BIGINT)), "
            f"lambda acc, o: acc * 256 + o) END)")


# the rules read one by one: a theta join of every host with every rule
RULE_LIST = f"""
rl AS (SELECT lower(trim(r)) AS r FROM (SELECT unnest(string_split({q(H.DEFAULT_NO_PROXY)}, ',')) AS r)),
nr AS (SELECT regexp_replace(CASE WHEN regexp_matches(r, ':[0-9]+$') THEN regexp_replace(r, ':[0-9]+$', '') ELSE r END, '^[*][.]', '.') AS n
       FROM rl WHERE NOT contains(r, '/') AND r <> ''),
cr AS (SELECT CAST(split_part(r, '/', 2) AS INTEGER) AS bits, {_ipv4_int("split_part(r, '/', 1)")} AS net
       FROM rl WHERE contains(r, '/'))"""


def _in_any_net(ip: str) -> str:
    return f"EXISTS (SELECT 1 FROM cr WHERE ({_ipv4_int(ip)} >> (32 - cr.bits)) = (cr.net >> (32 - cr.bits)))"


PAGE_HOSTS = RULE_LIST + "," + GATED + f""",
ph AS (SELECT page_id, {U.host_of('final_url')} AS host, regexp_extract(final_url, '^([a-z]+):', 1) AS scheme FROM gp),
pr AS (SELECT *, EXISTS (SELECT 1 FROM nr WHERE host = n OR (starts_with(n, '.') AND ends_with(host, n))
                         OR (NOT starts_with(n, '.') AND ends_with(host, '.' || n))) AS name_match,
       {_in_any_net('host')} AS cidr_match FROM ph)"""

sql("host_rule_match", f"""
WITH {PAGE_HOSTS}
SELECT page_id, host, name_match AS bypass FROM pr
""")

sql("cidr_match", f"""
WITH {RULE_LIST},
hi AS (SELECT event_id, CASE WHEN event_id % 100 = 0 THEN '300.1.1.1'
  ELSE '10.0.' || CAST(user_id % 8 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) END AS ip FROM events)
SELECT event_id, ip, {_in_any_net('ip')} AS cidr_match FROM hi
""")

sql("route_assign", f"""
WITH {PAGE_HOSTS}
SELECT CASE WHEN name_match OR cidr_match THEN 'direct'
            WHEN scheme = 'https' THEN {q('direct' if not H.DEFAULT_HTTPS_PROXY else 'proxy ' + H.DEFAULT_HTTPS_PROXY)}
            ELSE {q('proxy ' + H.DEFAULT_HTTP_PROXY)} END AS route, count(*) AS n
FROM pr GROUP BY ALL
""")


# the rule tables: every host (address) with every rule
RULE_ROWS = """
hp AS (SELECT page_id, regexp_extract(url, '://([^/:?#]*)', 1) AS h FROM pages WHERE page_id % 3 = 0),
hr AS (SELECT CASE page_id % 7 WHEN 0 THEN h || ':8080' WHEN 1 THEN '*' || substr(h, strpos(h, '.')) WHEN 2 THEN ' ' || substr(h, strpos(h, '.'))
    WHEN 3 THEN upper(h) WHEN 4 THEN 'sub.' || h ELSE '' END AS rule FROM hp),
he AS (SELECT '10.0.' || CAST(user_id % 8 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '/' ||
    CASE WHEN event_id % 11 < 4 THEN '28' WHEN event_id % 11 < 7 THEN '31' WHEN event_id % 11 = 7 THEN '32' WHEN event_id % 11 = 8 THEN ''
    WHEN event_id % 11 = 9 THEN '33' ELSE '30' END AS rule FROM events WHERE event_id % 5 = 0),
hw AS (SELECT * FROM (VALUES ('10.9.0.0/16'), ('192.0.0.0/9'), ('10.0.6.0/24')) v(rule)),
rr AS (SELECT lower(trim(rule)) AS r FROM (SELECT rule FROM hr WHERE rule NOT IN ('.example.com', '*.example.com') UNION ALL
  SELECT rule FROM he UNION ALL SELECT rule FROM hw) WHERE trim(rule) <> '')"""

sql("host_rule_table", f"""
WITH {RULE_ROWS},
nm AS (SELECT DISTINCT regexp_replace(regexp_replace(r, ':[0-9]+$', ''), '^[*]', '') AS n FROM rr WHERE NOT contains(r, '/')),
nk AS (SELECT DISTINCT n, NOT starts_with(n, '.') AS whole FROM nm),
{GATED},
ph AS (SELECT page_id, {U.host_of('final_url')} AS host FROM gp),
hh AS (SELECT DISTINCT host FROM ph),
hits AS (SELECT host, count(DISTINCT key) AS n FROM (
    SELECT host, 'exact ' || n AS key FROM hh JOIN nk ON whole AND host = n
    UNION ALL SELECT host, 'suffix ' || CASE WHEN whole THEN '.' || n ELSE n END FROM hh JOIN nk ON ends_with(host, CASE WHEN whole THEN '.' || n ELSE n END))
  GROUP BY host)
SELECT page_id, host, hits.n IS NOT NULL AS bypass, coalesce(hits.n, 0) AS name_rules FROM ph LEFT JOIN hits USING (host)
""")

sql("cidr_rule_table", f"""
WITH {RULE_ROWS},
nt AS (SELECT DISTINCT bits, net >> (32 - bits) AS top FROM (SELECT TRY_CAST(split_part(r, '/', 2) AS INTEGER) AS bits, {_ipv4_int("split_part(r, '/', 1)")} AS net
  FROM rr WHERE contains(r, '/')) WHERE bits BETWEEN 0 AND 32),
hi AS (SELECT event_id, CASE WHEN event_id % 100 = 0 THEN '300.1.1.1'
  ELSE '10.0.' || CAST(user_id % 8 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) END AS ip FROM events),
ii AS (SELECT ip, max(bits) AS bits FROM (SELECT DISTINCT ip, {_ipv4_int('ip')} AS v FROM hi) JOIN nt ON v >> (32 - bits) = top GROUP BY ip)
SELECT event_id, ip, ii.bits IS NOT NULL AS cidr_match, ii.bits AS cidr_bits FROM hi LEFT JOIN ii USING (ip)
""")


# --------------------------------------------------------------------------- sinks and streams

sql("write_pages", f"""
WITH {PAGE_EXTRACT}
SELECT page_id, url, final_url, status, title, content, length, truncated, link_count, links_text,
  {U.host_of('final_url')} AS host FROM pe
""")

sql("write_links", f"""
WITH {RESOLVED}
SELECT page_id, CAST(link_pos AS INTEGER) AS link_pos, text, resolved AS href, {U.host_of('resolved')} AS host FROM rs WHERE resolved IS NOT NULL
""")

sql("write_entries", f"""
WITH {FEEDS}, {_parsed("feeds", "pf")}, {_items("pf", "it", 10, False)}
SELECT *, {U.host_of('url')} AS host FROM it
""")

SQL["stream_pages"] = SQL["page_markdown"]
SQL["stream_feed_entries"] = SQL["feed_entries"]


# every form of date is read back to the moment that it was made from
sql("published_ts", f"""
WITH d AS (SELECT {_GRP} || '/' || lang || '/' || CAST({_BUCKET} AS VARCHAR) AS feed_id, doc_id, {_TS} AS published, {_MOMENT} AS published_utc FROM documents)
SELECT feed_id, CAST(row_number() OVER (PARTITION BY feed_id ORDER BY doc_id) - 1 AS INTEGER) AS pos, published, published_utc FROM d
""")
