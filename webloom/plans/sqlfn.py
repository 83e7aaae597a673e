"""DuckDB SQL text for the oracle: the same expressions as ``webloom.functions``.

Each helper takes SQL expression text (normally a plain column name) and
returns SQL expression text.  Patterns come from ``functions.constants`` so
both engines run the same regexes.
"""

from __future__ import annotations

from ..functions.constants import (ELLIPSIS, FEED_ENTITIES, FEED_ENTITY_RE,
                                   HTML_ENTITIES, HTML_ENTITY_RE, WS)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rr(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def js_trim(x: str) -> str:
    return rr(x, "\\A" + WS + "+|" + WS + "+\\z", "")


def collapse_ws(x: str) -> str:
    return js_trim(rr(x, WS + "+", " "))


def normalize_ws(x: str) -> str:
    c = rr(x, "[ \\t\\f\\x0B]+", " ")
    c = rr(c, " *\\n *", "\n")
    c = rr(c, "\\n{3,}", "\n\n")
    return js_trim(c)


def _map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in table.items()) + "}"


def _code_point(digits: str, radix: int, max_len: int) -> str:
    s = rr(digits, "^0+", "")
    val = f"('0x' || {s})::BIGINT" if radix == 16 else f"({s})::BIGINT"
    return (f"(CASE WHEN length({s}) = 0 THEN 0::BIGINT "
            f"WHEN length({s}) <= {max_len} THEN {val} END)")


def _decode_one(b: str, table: str, hex_re: str) -> str:
    lit = f"('&' || {b} || ';')"
    code = (f"(CASE WHEN regexp_matches({b}, {q(hex_re)}) THEN {_code_point(f'substr({b}, 3)', 16, 6)} "
            f"ELSE {_code_point(f'substr({b}, 2)', 10, 7)} END)")
    num = (f"(CASE WHEN {code} IS NOT NULL AND {code} <= 1114111 AND NOT ({code} BETWEEN 55296 AND 57343) AND NOT ({code} BETWEEN 64976 AND 64978) "
           f"THEN chr(({code})::INTEGER) ELSE {lit} END)")
    return f"(CASE WHEN starts_with({b}, '#') THEN {num} ELSE coalesce({table}[{b}], {lit}) END)"


def _replace_chain(x: str, table: dict[str, str]) -> str:
    for name in sorted(table, key=lambda n: n == "amp"):
        x = f"replace({x}, {q('&' + name + ';')}, {q(table[name])})"
    return x


def _chain_safe(x: str, table: dict[str, str]) -> str:
    conds = [f"strpos({x}, '&#') = 0"] + [f"strpos({x}, {q('&' + n + ';')}) = 0" for n, v in table.items() if v == ""]
    return "(" + " AND ".join(conds) + ")"


def _decode(x: str, pattern: str, table: dict[str, str], hex_re: str, chain: bool = False) -> str:
    one = _decode_one("b", _map(table), hex_re)
    fast = f"WHEN {_chain_safe(x, table)} THEN {_replace_chain(x, table)} " if chain else ""
    return (f"(CASE WHEN strpos({x}, '&') = 0 THEN {x} {fast}"
            f"WHEN strpos({x}, '&') > 0 THEN array_to_string(list_transform("
            f"list_zip(string_split_regex({x}, {q(pattern)}), "
            f"list_append(list_transform(regexp_extract_all({x}, {q(pattern)}, 1), lambda b: {one}), '')), "
            f"lambda z: z[1] || z[2]), '') ELSE {x} END)")


def decode_html_entities(x: str) -> str:
    return _decode(x, HTML_ENTITY_RE, HTML_ENTITIES, "^#[xX]", chain=True)


def decode_feed_entities(x: str) -> str:
    return _decode(x, FEED_ENTITY_RE, FEED_ENTITIES, "^#x")


def strip_tags(x: str) -> str:
    c = rr(x, "(?i)<br" + WS + "*/?>", "\n")
    c = rr(c, "(?i)</(?:p|div|li|h[1-6]|tr|blockquote|pre|section|article)>", "\n")
    return rr(c, "<[^>]*>", "")


def clean_feed_text(x: str) -> str:
    c = rr(x, "<!\\[CDATA\\[([\\s\\S]*?)\\]\\]>", "\\1")
    return collapse_ws(strip_tags(decode_feed_entities(c)))


def cap_with_ellipsis(x: str, n: int) -> str:
    return f"(CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n}) || {q(ELLIPSIS)} ELSE {x} END)"


def in_list(x: str, values) -> str:
    return f"{x} IN (" + ", ".join(q(v) for v in values) + ")"
