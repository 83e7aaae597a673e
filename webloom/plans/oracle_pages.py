"""DuckDB oracle SQL for the page plan (tokens -> state -> pieces -> text).

Mirrors ``operators.html`` step by step so the driver can check value
equality; every step is plain SQL (regex table functions, windows, lists).
"""

from __future__ import annotations

from ..functions.constants import (ATTR_NAME_RE, ATTR_RE, ATTR_VALUE_RE, BLOCK_TAGS,
                                   BRK, FENCE, HEADING_LEVELS, SKIP_TAGS, STRIP,
                                   TAG_NAME_RE, TOKEN_RE, WS)
from .sqlfn import (collapse_ws, decode_html_entities, in_list, js_trim,
                    normalize_ws, q, rr)

BIG = 1 << 62
HEADINGS = tuple(HEADING_LEVELS)
BLOCKS_NO_PRE = tuple(t for t in BLOCK_TAGS if t != "pre")

INC = "OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
EXC = "OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
AFTER = "OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"


def attr(tok: str, name: str) -> str:
    vals = (f"list_transform(list_filter(regexp_extract_all({tok}, {q(ATTR_RE)}), "
            f"lambda a: lower(regexp_extract(a, {q(ATTR_NAME_RE)}, 1)) = {q(name)}), "
            f"lambda a: regexp_extract(a, {q(ATTR_VALUE_RE)}, 1) || regexp_extract(a, {q(ATTR_VALUE_RE)}, 2)"
            f" || regexp_extract(a, {q(ATTR_VALUE_RE)}, 3))")
    return f"({vals})[-1]"


def tokens_ctes(src: str = "pages") -> str:
    """CTEs ``tk0``, ``tk``: the token relation."""
    return f"""
tk0 AS (
  SELECT page_id, unnest(tl) AS tok, unnest(range(len(tl))) AS pos
  FROM (SELECT page_id, list_append(regexp_extract_all(translate(coalesce(html, ''), '\uFDD0\uFDD1\uFDD2', '\uFFFD\uFFFD\uFFFD'), {q(TOKEN_RE)}), '') AS tl FROM {src})
),
tk AS (
  SELECT * FROM (
    SELECT page_id, pos, tok,
      CASE WHEN starts_with(tok, '<!--') THEN 'comment' WHEN starts_with(tok, '<') THEN 'tag' ELSE 'text' END AS kind,
      CASE WHEN starts_with(tok, '<') THEN lower(regexp_extract(tok, {q(TAG_NAME_RE)}, 1)) END AS name,
      starts_with(tok, '</') AS closing
    FROM tk0)
  WHERE kind = 'text' OR (kind = 'tag' AND name <> '')
)"""


def state_ctes(src: str = "pages") -> str:
    """CTEs ``tk`` (tokens) ... ``st`` (full state); ``src`` has (page_id, html)."""
    o = "(active AND kind = 'tag' AND NOT closing)"
    c = "(active AND kind = 'tag' AND closing)"
    t_open = "(kind = 'tag' AND NOT closing AND name = 'title')"
    t_close = "(kind = 'tag' AND closing AND name = 'title')"
    pre0 = "(pre = 0)"
    a_open = f"({o} AND name = 'a')"
    closes = (f"((({o} OR {c}) AND (name = 'a' OR {in_list('name', ('li', 'pre', *HEADINGS, *BLOCK_TAGS))}))"
              f" OR ({o} AND name = 'img'))")
    txt = "(kind = 'text' AND active AND skip = 0)"
    forced = (f"({pre0} AND (({o} AND {in_list('name', ('li', *HEADINGS, *BLOCKS_NO_PRE))})"
              f" OR ({c} AND {in_list('name', ('li', 'pre', *HEADINGS, *BLOCKS_NO_PRE))})))")
    soft = f"({o} AND name IN ('br', 'hr') AND {pre0})"
    emits = f"({txt} AND {pre0} AND clean <> '')"
    return tokens_ctes(src) + f""",
s1 AS (
  SELECT *,
    coalesce(last_value(CASE WHEN {t_open} THEN true WHEN {t_close} THEN false END IGNORE NULLS) {EXC}, false) AS in_title,
    sum(CASE WHEN {t_open} THEN 1 ELSE 0 END) {INC} AS title_seg
  FROM tk
),
s2 AS (SELECT *, NOT in_title AND NOT {t_open} AS active FROM s1),
s3 AS (
  SELECT *,
    sum(CASE WHEN {o} AND {in_list('name', SKIP_TAGS)} THEN 1 WHEN {c} AND {in_list('name', SKIP_TAGS)} THEN -1 ELSE 0 END) {INC} AS s_skip,
    sum(CASE WHEN {o} AND name IN ('pre', 'code') THEN 1 WHEN {c} AND name IN ('pre', 'code') THEN -1 ELSE 0 END) {INC} AS s_pre
  FROM s2
),
s4 AS (
  SELECT *, s_skip - least(0, min(s_skip) {INC}) AS skip, s_pre - least(0, min(s_pre) {INC}) AS pre FROM s3
),
s5 AS (SELECT *, CASE WHEN {txt} THEN {decode_html_entities('tok')} END AS dec FROM s4),
s6 AS (SELECT *, CASE WHEN {txt} AND {pre0} THEN {normalize_ws('dec')} END AS clean FROM s5),
s7 AS (
  SELECT *, {a_open} AS a_open, coalesce({emits}, false) AS emits,
    CASE WHEN {a_open} THEN 'anchor' WHEN {forced} THEN 'break' WHEN {closes} THEN 'close' WHEN {soft} THEN 'soft' WHEN {emits} THEN 'text' END AS ev,
    ev IN ('anchor', 'break', 'close') AS edge
  FROM s6
),
s8 AS (
  SELECT *, last_value(ev IGNORE NULLS) {EXC} AS prev, last_value(CASE WHEN edge THEN ev END IGNORE NULLS) {EXC} AS prev_edge,
    coalesce(last_value(CASE WHEN edge THEN false WHEN ev = 'soft' THEN true END IGNORE NULLS) {EXC}, false) AS softened,
    sum(CASE WHEN a_open THEN 1 ELSE 0 END) {INC} AS anchor_seq
  FROM s7
),
s9 AS (
  SELECT *, coalesce(prev_edge = 'anchor', false) AS in_a, coalesce(last_value(CASE WHEN edge THEN
    CASE WHEN prev IN ('break', 'soft') THEN true WHEN prev = 'text' AND coalesce(prev_edge, '') <> 'anchor' THEN false END END IGNORE NULLS) {INC}, false) AS at_edge
  FROM s8
),
s10 AS (
  SELECT *, CASE WHEN edge THEN at_edge WHEN in_a THEN at_edge OR (softened AND coalesce(prev = 'soft', false))
      ELSE coalesce(CASE prev WHEN 'soft' THEN true WHEN 'break' THEN true WHEN 'text' THEN false END, at_edge) END AS lwb,
    emits AND NOT (in_a AND (at_edge OR NOT softened)) AS direct, emits AND in_a AND (at_edge OR NOT softened) AS label,
    coalesce(ev IN ('break', 'soft'), false) AS brk_call
  FROM s9
),
s11 AS (
  SELECT *, brk_call AND NOT lwb AS brk, coalesce(edge OR (ev = 'soft' AND NOT lwb), false) AS closer,
    coalesce(last_value(CASE WHEN a_open THEN true WHEN label THEN false END IGNORE NULLS) {EXC}, false) AS label_first,
    coalesce(last_value(CASE WHEN {o} AND name = 'li' THEN true WHEN (brk_call AND NOT lwb) OR direct THEN false END
      IGNORE NULLS) {EXC}, false) AS marker
  FROM s10
),
st AS (
  SELECT *, coalesce(min(CASE WHEN closer THEN pos END) {AFTER}, {BIG}) AS flush FROM s11
)"""


def _piece(k1: str, k2: int, k3: str, s: str) -> str:
    return f"struct_pack(k1 := ({k1})::BIGINT, k2 := {k2}, k3 := ({k3})::BIGINT, s := {s})"


def finish_content(raw: str) -> str:
    r = rr(raw, "[ \\t]*" + STRIP, "")
    r = rr(r, "(" + FENCE + "|```)([ \\t]*" + BRK + "|\\n)[ \\t" + BRK + FENCE + "]*", "\\1\\2")
    r = rr(r, FENCE, "\n```")
    r = rr(r, "[ \\t]*" + BRK + "(?:[ \\t]*" + BRK + ")*", BRK)
    r = rr(r, "\\n" + BRK, "\n")
    r = rr(r, BRK, "\n")
    r = normalize_ws(r)
    r = rr(r, "\\]\\(([^)]*)\\)" + WS + "+", "](\\1) ")
    r = rr(r, " {2,}", " ")
    r = rr(r, " *\\n *", "\n")
    r = rr(r, "\\n{3,}", "\n\n")
    return js_trim(r)


def extract_ctes(md: bool, max_chars: int, src: str = "pages") -> str:
    """CTEs ending in ``ex(page_id, title, content, length, truncated, links)``."""
    o = "(active AND kind = 'tag' AND NOT closing)"
    c = "(active AND kind = 'tag' AND closing)"
    mdl = "true" if md else "false"
    brk = f"(CASE WHEN brk THEN {q(BRK)} ELSE '' END)"
    linked = f"({mdl} AND href <> '')"
    alt = js_trim(f"coalesce({attr('tok', 'alt')}, '')")
    src_ = f"coalesce({attr('tok', 'src')}, '')"
    img = (f"(CASE WHEN {mdl} AND {src_} <> '' THEN '![' || {alt} || '](' || {src_} || ') ' "
           f"WHEN {alt} <> '' THEN {alt} || ' ' ELSE '' END)")
    heading = "''"
    if md:
        heading = "(CASE " + " ".join(f"WHEN name = {q(h)} THEN {q('#' * n + ' ')}" for h, n in HEADING_LEVELS.items()) + " END)"
    raw_txt = "(kind = 'text' AND active AND skip = 0 AND pre > 0)"
    own = f"""(CASE
      WHEN {raw_txt} THEN dec
      WHEN direct THEN CASE WHEN marker AND {mdl} THEN '- ' || clean ELSE clean || ' ' END
      WHEN {o} AND name = 'img' THEN {img}
      WHEN {o} AND name = 'hr' THEN {brk} || {q('---' + chr(10) if md else chr(10))}
      WHEN {o} AND {in_list('name', HEADINGS)} THEN {brk} || {heading}
      WHEN {o} AND name = 'pre' THEN {q('```' + chr(10) if md else '')}
      WHEN {c} AND name = 'pre' THEN {q(STRIP)} || {q(FENCE if md else '')} || {brk}
      WHEN brk_call THEN {brk}
    END)"""
    title_txt = "(kind = 'text' AND in_title)"
    title_done = "(kind = 'tag' AND closing AND name = 'title' AND in_title)"
    return state_ctes(src) + f""",
pc0 AS (SELECT *, CASE WHEN a_open THEN coalesce({attr('tok', 'href')}, '') END AS href FROM st),
pc AS (
  SELECT *,
    CASE WHEN a_open THEN {_piece('flush', 0, 'pos', f"CASE WHEN {linked} THEN '[' ELSE '' END")}
         WHEN label THEN {_piece('flush', 1, 'pos', f"CASE WHEN label_first THEN '' ELSE ' ' END || {collapse_ws('clean')}")}
    END AS piece_a,
    CASE WHEN a_open THEN {_piece('flush', 2, 'pos', f"CASE WHEN {linked} THEN '](' || href || ')' ELSE '' END")}
         WHEN {own} IS NOT NULL AND {own} <> '' THEN {_piece('pos', 5, '0', own)}
    END AS piece_b
  FROM pc0
),
seg AS (
  SELECT page_id, anchor_seq,
    list_concat(list(piece_a) FILTER (WHERE piece_a IS NOT NULL), list(piece_b) FILTER (WHERE piece_b IS NOT NULL)) AS pieces,
    max(CASE WHEN {title_done} THEN title_seg END) AS tseg,
    list(struct_pack(title_seg := title_seg, pos := pos, tok := tok)) FILTER (WHERE {title_txt}) AS tparts,
    max(CASE WHEN a_open THEN pos END) AS link_pos,
    max(href) AS href,
    list(struct_pack(pos := pos, t := {collapse_ws('clean')})) FILTER (WHERE label) AS lparts
  FROM pc GROUP BY page_id, anchor_seq
),
seg2 AS (
  SELECT page_id, pieces, tseg, coalesce(tparts, []) AS tparts,
    CASE WHEN href <> '' THEN struct_pack(link_pos := link_pos,
      text := array_to_string(list_transform(list_sort(coalesce(lparts, [])), lambda x: x.t), ' '), href := href) END AS link
  FROM seg
),
agg AS (
  SELECT page_id, flatten(list(pieces)) AS pieces, max(tseg) AS tseg, flatten(list(tparts)) AS tparts,
    list_sort(coalesce(list(link) FILTER (WHERE link IS NOT NULL), [])) AS links
  FROM seg2 GROUP BY page_id
),
ag2 AS (
  SELECT page_id, tseg, links,
    array_to_string(list_transform(list_sort(pieces), lambda p: p.s), '') AS raw,
    array_to_string(list_transform(list_filter(list_sort(tparts), lambda x: x.title_seg = tseg), lambda x: x.tok), '') AS title_raw
  FROM agg
),
ag3 AS (
  SELECT page_id, links, CASE WHEN tseg IS NOT NULL THEN {collapse_ws(decode_html_entities('title_raw'))} ELSE '' END AS title,
    {finish_content('raw')} AS fulltxt
  FROM ag2
),
ex AS (
  SELECT page_id, title, substr(fulltxt, 1, {max_chars}) AS content, least(length(fulltxt), {max_chars}) AS length,
    length(fulltxt) > {max_chars} AS truncated,
    list_transform(links, lambda x: struct_pack(text := x.text, href := x.href)) AS links
  FROM ag3
)"""


def raw_links_ctes(src: str = "pages") -> str:
    return state_ctes(src) + f""",
rl AS (
  SELECT page_id, anchor_seq, max(CASE WHEN a_open THEN pos END) AS link_pos,
    max(CASE WHEN a_open THEN coalesce({attr('tok', 'href')}, '') END) AS href,
    array_to_string(list_transform(list_sort(coalesce(list(struct_pack(pos := pos, t := {collapse_ws('clean')}))
      FILTER (WHERE label), [])), lambda x: x.t), ' ') AS text
  FROM st WHERE a_open OR label GROUP BY page_id, anchor_seq
),
raw_links AS (SELECT page_id, link_pos, text, href FROM rl WHERE href <> '')"""
