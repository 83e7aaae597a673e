"""DuckDB twin of ``functions.urls`` (select-list fragments with lateral aliases)."""

from __future__ import annotations

from ..functions.urls import (ABS_RE, BASE_RE, DOT_SEG_RE, FORBIDDEN_HOST_RE, FRAG_ENC,
                              HOST_RE, PATH_ENC, PORT_RE, QUERY_ENC, SCHEME_RE)
from .sqlfn import js_trim, q


def pct_encode(x: str, run_re: str) -> str:
    return (f"(CASE WHEN regexp_matches({x}, {q(run_re)}) THEN array_to_string(list_transform(list_zip("
            f"string_split_regex({x}, {q(run_re)}), list_append(list_transform(regexp_extract_all({x}, {q(run_re)}),"
            f" lambda r: url_encode(r)), '')), lambda z: z[1] || z[2]), '') ELSE {x} END)")


def remove_dot_segments(p: str) -> str:
    segs = (f"list_transform(string_split(substr({p}, 2), '/'), lambda s: CASE WHEN regexp_matches(s, "
            f"'^(?:[.]|%2[eE]){{1,2}}$') THEN regexp_replace(s, '%2[eE]', '.', 'g') ELSE s END)")
    stack = (f"list_reduce({segs}, lambda acc, s: CASE WHEN s = '..' THEN (CASE WHEN len(acc) = 0 THEN acc "
             f"ELSE acc[1:len(acc) - 1] END) WHEN s = '.' THEN acc ELSE list_append(acc, s) END, []::VARCHAR[])")
    out = (f"('/' || array_to_string({stack}, '/') || CASE WHEN ({segs})[-1] IN ('.', '..') AND len({stack}) > 0 "
           f"THEN '/' ELSE '' END)")
    return f"(CASE WHEN regexp_matches({p}, {q(DOT_SEG_RE)}) THEN {out} ELSE {p} END)"


def parsed_url(src: str, p: str) -> str:
    """Select-list fragment adding ``{p}_scheme, _user, _pass, _host, _ok, _url``."""
    rx = q(ABS_RE)
    return f"""
    lower(regexp_extract({src}, {rx}, 1)) AS {p}_scheme,
    regexp_extract({src}, {rx}, 2) AS {p}__auth,
    regexp_extract({src}, {rx}, 3) AS {p}__path,
    regexp_extract({src}, {rx}, 4) AS {p}__query,
    regexp_extract({src}, {rx}, 5) AS {p}__frag,
    CASE WHEN strpos({p}__auth, '@') > 0 THEN regexp_extract({p}__auth, '^([\\s\\S]*)@', 1) ELSE '' END AS {p}__userinfo,
    regexp_extract({p}__auth, '([^@]*)$', 1) AS {p}__hostport,
    regexp_extract({p}__userinfo, '^([^:]*)', 1) AS {p}_user,
    regexp_extract({p}__userinfo, '^[^:]*:([\\s\\S]*)$', 1) AS {p}_pass,
    regexp_extract({p}__hostport, {q(HOST_RE)}, 1) AS {p}__host0,
    lower(CASE WHEN contains({p}__host0, '%') AND NOT starts_with({p}__host0, '[') AND NOT regexp_matches({p}__host0, '%([^0-9a-fA-F]|.[^0-9a-fA-F]|.?$)')
      THEN url_decode({p}__host0) ELSE {p}__host0 END) AS {p}_host,
    regexp_extract({p}__hostport, {q(PORT_RE)}, 1) AS {p}__port,
    ({p}_scheme <> '' AND ({p}__port = '' OR (regexp_matches({p}__port, '^[0-9]{{1,5}}$')
      AND TRY_CAST({p}__port AS INTEGER) <= 65535))
      AND {p}_host <> '' AND (regexp_matches({p}_host, '^\\[[^\\]]*\\]$')
      OR NOT regexp_matches({p}_host, {q(FORBIDDEN_HOST_RE)}))) AS {p}_ok,
    CASE WHEN {p}__port = '' THEN '' ELSE CAST(TRY_CAST({p}__port AS INTEGER) AS VARCHAR) END AS {p}__portn0,
    CASE WHEN ({p}_scheme = 'http' AND {p}__portn0 = '80') OR ({p}_scheme = 'https' AND {p}__portn0 = '443')
      THEN '' ELSE {p}__portn0 END AS {p}__portn,
    CASE WHEN {p}__path = '' THEN '/' ELSE translate({p}__path, '\\', '/') END AS {p}__path0,
    {pct_encode(remove_dot_segments(f'{p}__path0'), PATH_ENC)} AS {p}__pathn,
    CASE WHEN {p}_ok THEN {p}_scheme || '://' ||
      CASE WHEN {p}_pass <> '' THEN {p}_user || ':' || {p}_pass || '@' WHEN {p}_user <> '' THEN {p}_user || '@' ELSE '' END
      || {p}_host || CASE WHEN {p}__portn <> '' THEN ':' || {p}__portn ELSE '' END || {p}__pathn
      || {pct_encode(f'{p}__query', QUERY_ENC)} || {pct_encode(f'{p}__frag', FRAG_ENC)} END AS {p}_url"""


def clean_input(x: str) -> str:
    return f"regexp_replace({js_trim(x)}, '[\\t\\n\\r]', '', 'g')"


def gate_ctes(src_cte: str, col: str, out_cte: str, out: str = "final_url", reason: str = "reason") -> str:
    """CTE ``out_cte`` = ``src_cte`` plus ``{out}`` and ``{reason}``."""
    given = clean_input(f"coalesce({col}, '')")
    return f"""{out_cte}__0 AS (SELECT *, {given} AS _g_in FROM {src_cte}),
{out_cte}__1 AS (SELECT *, {parsed_url('_g_in', '_g')} FROM {out_cte}__0),
{out_cte} AS (
  SELECT * EXCLUDE (_g_in, _g_scheme, _g__auth, _g__path, _g__query, _g__frag, _g__userinfo, _g__hostport,
      _g_user, _g_pass, _g__host0, _g_host, _g__port, _g_ok, _g__portn0, _g__portn, _g__path0, _g__pathn, _g_url),
    CASE WHEN NOT regexp_matches(_g_in, {q(SCHEME_RE)}) THEN 'invalid URL'
         WHEN _g_scheme NOT IN ('http', 'https') THEN 'unsupported protocol'
         WHEN NOT _g_ok THEN 'invalid URL'
         WHEN _g_user <> '' OR _g_pass <> '' THEN 'embedded credentials' END AS {reason},
    CASE WHEN {reason} IS NULL THEN _g_url END AS {out}
  FROM {out_cte}__1)"""


def resolve_ctes(src_cte: str, href: str, base: str, out_cte: str,
                 out: str = "resolved", reason: str = "drop_reason", junk_filter: bool = True) -> str:
    """CTE ``out_cte`` = ``src_cte`` plus ``{out}`` and ``{reason}``."""
    h = js_trim(href)
    junk = (f"""CASE WHEN {h} = '' THEN 'empty' WHEN starts_with({h}, '#') THEN 'fragment'
         WHEN starts_with({h}, 'javascript:') THEN 'javascript' WHEN starts_with({h}, 'mailto:') THEN 'mailto'
         WHEN starts_with({h}, 'tel:') THEN 'tel' WHEN starts_with({h}, 'data:') THEN 'data' END"""
            if junk_filter else "CAST(NULL AS VARCHAR)")
    return f"""{out_cte}__0 AS (
  SELECT *,
    {junk} AS _r_junk,
    regexp_extract({base}, {q(BASE_RE)}, 1) AS _r_bs, {clean_input(href)} AS _r_h0,
    CASE WHEN regexp_matches(_r_h0, {q(SCHEME_RE)}) AND lower(split_part(_r_h0, ':', 1)) = _r_bs
      THEN substr(_r_h0, length(_r_bs) + 2) ELSE _r_h0 END AS _r_h,
    regexp_extract({base}, {q(BASE_RE)}, 2) AS _r_ba,
    CASE WHEN regexp_extract({base}, {q(BASE_RE)}, 3) = '' THEN '/' ELSE regexp_extract({base}, {q(BASE_RE)}, 3) END AS _r_bp,
    regexp_extract(_r_bp, '^([\\s\\S]*/)', 1) AS _r_bdir,
    CASE WHEN _r_junk IS NULL THEN
      CASE WHEN _r_h = '' THEN split_part({base}, '#', 1)
           WHEN regexp_matches(_r_h, {q(SCHEME_RE)}) THEN _r_h
           WHEN starts_with(_r_h, '#') THEN split_part({base}, '#', 1) || _r_h
           WHEN regexp_matches(_r_h, '^[/\\\\][/\\\\]') THEN _r_bs || ':' || _r_h
           WHEN regexp_matches(_r_h, '^[/\\\\]') THEN _r_bs || '://' || _r_ba || _r_h
           WHEN starts_with(_r_h, '?') THEN _r_bs || '://' || _r_ba || _r_bp || _r_h
           ELSE _r_bs || '://' || _r_ba || _r_bdir || _r_h END END AS _r_abs
  FROM {src_cte}),
{out_cte}__1 AS (SELECT *, {parsed_url('_r_abs', '_r')} FROM {out_cte}__0),
{out_cte} AS (
  SELECT * EXCLUDE (_r_junk, _r_h0, _r_h, _r_bs, _r_ba, _r_bp, _r_bdir, _r_abs, _r_scheme, _r__auth, _r__path, _r__query,
      _r__frag, _r__userinfo, _r__hostport, _r_user, _r_pass, _r__host0, _r_host, _r__port, _r_ok, _r__portn0, _r__portn,
      _r__path0, _r__pathn, _r_url),
    CASE WHEN _r_junk IS NOT NULL THEN _r_junk WHEN _r_scheme NOT IN ('http', 'https') THEN 'unsupported_scheme'
         WHEN NOT _r_ok THEN 'invalid' END AS {reason},
    CASE WHEN {reason} IS NULL THEN _r_url END AS {out}
  FROM {out_cte}__1)"""


def host_of(url: str) -> str:
    return f"regexp_extract({url}, '^[a-z][a-z0-9+.-]*://(?:[^@/?#]*@)?(\\[[^\\]]*\\]|[^:/?#]*)', 1)"
