"""Column expressions for text: whitespace, entities, tags, caps.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside the JVM (whole-stage codegen where Spark supports it; the
entity decoder uses higher-order functions and is gated by a fast path).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (ELLIPSIS, FEED_ENTITIES, FEED_ENTITY_RE, HTML_ENTITIES,
                        HTML_ENTITY_RE, WS, WS_CLASS)

# The whitespace set for the JVM alone: as characters to trim, and as a class that dismisses ASCII letters at once
# instead of asking each of its ranges.
_WS_CHARS = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
_MAY_BE_WS = "[\\x00-\\x20\\x{A0}\\x{1680}-\\x{FEFF}]"
_WS = f"[{_MAY_BE_WS}&&[{WS_CLASS}]]"
_WS_BUT_SPACE = f"[{_MAY_BE_WS}&&[{WS_CLASS.replace(' ', '')}]]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bind(x, then) -> Column:
    """``then`` of the value of ``x``, which is computed once however often ``then`` names it."""
    return F.get(F.transform(F.array(_c(x)), then), F.lit(0))


def js_trim(x) -> Column:
    """String.prototype.trim(): strip the JavaScript whitespace set at both ends."""
    return F.trim(_c(x), F.lit(_WS_CHARS))


def collapse_ws(x) -> Column:
    """``s.replace(/\\s+/g, ' ').trim()``"""
    # single spaces stay as they are, so that a text of plain words is not put together anew word by word
    return F.trim(F.regexp_replace(_c(x), f" {_WS}+|{_WS_BUT_SPACE}{_WS}*", " "))


def normalize_ws(x) -> Column:
    """Collapse horizontal runs, strip spaces round newlines, at most one blank line, trim."""
    c = F.regexp_replace(_c(x), "[ \\t\\f\\x0B]+", " ")
    c = F.regexp_replace(c, " *\\n *", "\n")
    c = F.regexp_replace(c, "\\n{3,}", "\n\n")
    return js_trim(c)


def _entity_map(table: dict[str, str]) -> Column:
    kv = []
    for k, v in table.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def _code_point(digits: Column, radix: int, max_len: int) -> Column:
    """Numeric reference digits -> code point (BIGINT) or NULL when too long."""
    stripped = F.regexp_replace(digits, "^0+", "")
    value = (F.conv(stripped, radix, 10) if radix == 16 else stripped).cast("bigint")
    return (F.when(F.length(stripped) == 0, F.lit(0).cast("bigint"))
            .when(F.length(stripped) <= max_len, value))


def _chr(code: Column) -> Column:
    """Code point -> one-character string (UTF-32 decode, no wrap-around)."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _decode_one(body: Column, table: Column, hex_re: str) -> Column:
    literal = F.concat(F.lit("&"), body, F.lit(";"))
    is_hex = body.rlike(hex_re)
    code = (F.when(is_hex, _code_point(F.substr(body, F.lit(3)), 16, 6))
            .otherwise(_code_point(F.substr(body, F.lit(2)), 10, 7)))
    ok = code.isNotNull() & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF) & ~code.between(0xFDD0, 0xFDD2)
    numeric = F.when(ok, _chr(code)).otherwise(literal)
    return (F.when(body.startswith("#"), numeric)
            .otherwise(F.coalesce(F.try_element_at(table, body), literal)))


def _replace_chain(col: Column, table: dict[str, str]) -> Column:
    """Named entities by literal replaces, ``&amp;`` last: equal to one regex pass when the text has no
    numeric reference and no entity that maps to '' (no output can start or complete another entity)."""
    for name in sorted(table, key=lambda n: n == "amp"):
        col = F.replace(col, F.lit(f"&{name};"), F.lit(table[name]))
    return col


def _chain_safe(col: Column, table: dict[str, str]) -> Column:
    safe = ~col.contains("&#")
    for name, value in table.items():
        if value == "":
            safe = safe & ~col.contains(f"&{name};")
    return safe


def _decode(x, pattern: str, table: dict[str, str], hex_re: str, chain: bool = False) -> Column:
    col = _c(x)
    tmap = _entity_map(table)
    parts = F.split(col, pattern, -1)
    bodies = F.regexp_extract_all(col, F.lit(pattern), 1)
    decoded = F.array_append(F.transform(bodies, lambda b: _decode_one(b, tmap, hex_re)), F.lit(""))
    joined = F.array_join(F.zip_with(parts, decoded, lambda p, d: F.concat(p, d)), "")
    # single pass over the original text: decoded output is never re-scanned
    if not chain:
        return F.when(F.instr(col, "&") > 0, joined).otherwise(col)
    return (F.when(F.instr(col, "&") == 0, col)
            .when(_chain_safe(col, table), _replace_chain(col, table))
            .otherwise(joined))


def decode_html_entities(x) -> Column:
    """Page-text entities: 58 names (2-8 chars), ``&#NN;``, ``&#xHH;`` / ``&#XHH;``."""
    # page text is the hot path (every text token): named-only texts take the replace chain
    return _decode(x, HTML_ENTITY_RE, HTML_ENTITIES, "^#[xX]", chain=True)


def decode_feed_entities(x) -> Column:
    """Feed-text entities: larger table, any name length, hex only with lower-case x."""
    return _decode(x, FEED_ENTITY_RE, FEED_ENTITIES, "^#x")


def strip_tags(x) -> Column:
    """``<br>`` and block closers -> newline, every other tag removed."""
    c = F.regexp_replace(_c(x), "(?i)<br" + WS + "*/?>", "\n")
    c = F.regexp_replace(c, "(?i)</(?:p|div|li|h[1-6]|tr|blockquote|pre|section|article)>", "\n")
    return F.when(F.instr(_c(x), "<") > 0, F.regexp_replace(c, "<[^>]*>", "")).otherwise(_c(x))


def unwrap_cdata(x) -> Column:
    c, opening = _c(x), "<![CDATA["
    # up to the first closing mark, run by run: a lazy pattern would try it at every character
    unwrapped = F.regexp_replace(c, "<!\\[CDATA\\[((?:[^\\]]+|\\](?!\\]>))*+)\\]\\]>", "$1")
    return F.when(F.instr(c, opening) > 0, unwrapped).otherwise(c)


def clean_feed_text(x) -> Column:
    """CDATA unwrap -> entity decode -> strip tags -> collapse whitespace -> trim."""
    return collapse_ws(bind(bind(bind(x, unwrap_cdata), decode_feed_entities), strip_tags))


def cap_with_ellipsis(x, n: int) -> Column:
    """First ``n`` characters plus an ellipsis when longer than ``n``."""
    c = _c(x)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(ELLIPSIS))).otherwise(c)
