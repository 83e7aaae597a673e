"""Fixed values that must equal the reference for equal results.

Tag sets, entity tables and patterns are stated here once, in natural order,
and used by the Spark plans and by the DuckDB oracle SQL alike.  Patterns are
written so that Java regex (Spark) and RE2 (DuckDB) read them the same way:
no look-around, no back-references, whitespace classes spelled out.
"""

# ---------------------------------------------------------------------------
# HTML element sets.
# ---------------------------------------------------------------------------
SKIP_TAGS = (
    "script", "style", "noscript", "template", "svg", "math", "head", "title",
    "select", "textarea", "iframe", "object", "canvas", "audio", "video",
)

BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "caption", "dd", "details",
    "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "header", "hgroup", "main", "nav", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
)

HEADING_LEVELS = {"h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6}

# ---------------------------------------------------------------------------
# Named entities of page text (case-sensitive names).
# ---------------------------------------------------------------------------
HTML_ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "mdash": "—", "ndash": "–", "hellip": "…", "middot": "·",
    "copy": "©", "reg": "®", "trade": "™", "deg": "°",
    "laquo": "«", "raquo": "»", "bull": "•", "sect": "§", "para": "¶",
    "ldquo": "“", "rdquo": "”", "lsquo": "‘", "rsquo": "’",
    "times": "×", "divide": "÷", "plusmn": "±", "shy": "",
    "euro": "€", "pound": "£", "cent": "¢", "curren": "¤", "yen": "¥",
    "agrave": "à", "aacute": "á", "acirc": "â", "auml": "ä", "aring": "å", "aelig": "æ",
    "egrave": "è", "eacute": "é", "ecirc": "ê", "euml": "ë",
    "igrave": "ì", "iacute": "í", "icirc": "î", "iuml": "ï",
    "ograve": "ò", "oacute": "ó", "ocirc": "ô", "ouml": "ö", "oslash": "ø",
    "ugrave": "ù", "uacute": "ú", "ucirc": "û", "uuml": "ü",
    "ccedil": "ç", "ntilde": "ñ", "szlig": "ß",
}

# ---------------------------------------------------------------------------
# Named entities of feed text (a different, larger table).
# ---------------------------------------------------------------------------
FEED_ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'",
    "nbsp": " ", "ensp": " ", "emsp": " ", "thinsp": " ",
    "shy": "­", "zwnj": "‌", "zwj": "‍",
    "mdash": "—", "ndash": "–", "hellip": "…",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "laquo": "«", "raquo": "»",
    "copy": "©", "reg": "®", "trade": "™", "deg": "°",
    "plusmn": "±", "times": "×", "divide": "÷", "middot": "·",
    "bull": "•", "sect": "§", "para": "¶",
    "euro": "€", "pound": "£", "yen": "¥", "cent": "¢", "curren": "¤",
    "micro": "µ", "frac12": "½", "frac14": "¼", "frac34": "¾",
    "aacute": "á", "agrave": "à", "acirc": "â", "atilde": "ã", "auml": "ä",
    "aring": "å", "aelig": "æ", "ccedil": "ç",
    "eacute": "é", "egrave": "è", "ecirc": "ê", "euml": "ë",
    "iacute": "í", "igrave": "ì", "icirc": "î", "iuml": "ï",
    "ntilde": "ñ",
    "oacute": "ó", "ograve": "ò", "ocirc": "ô", "otilde": "õ", "ouml": "ö", "oslash": "ø",
    "uacute": "ú", "ugrave": "ù", "ucirc": "û", "uuml": "ü",
    "yacute": "ý", "szlig": "ß",
}

# ---------------------------------------------------------------------------
# Patterns.
# ---------------------------------------------------------------------------
# JavaScript's \s / String.trim() set, spelled out (Java and RE2 disagree on \s).
WS_CLASS = ("\\t\\n\\x0B\\f\\r \\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}"
            "\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}")
WS = "[" + WS_CLASS + "]"

# comment | tag | text run, in document order
TOKEN_RE = r"<!--[\s\S]*?-->|<[^>]*>|[^<]+"
TAG_NAME_RE = r"^</?([a-zA-Z][a-zA-Z0-9-]*)"
# one attribute: name, then optional "double" | 'single' | bare value
ATTR_RE = ("[a-zA-Z_:][-a-zA-Z0-9_:.]*(?:" + WS + "*=" + WS
           + "*(?:\"[^\"]*\"|'[^']*'|[^" + WS_CLASS + "\"'=<>`]+))?")
ATTR_NAME_RE = r"^([a-zA-Z_:][-a-zA-Z0-9_:.]*)"
ATTR_VALUE_RE = ("^[a-zA-Z_:][-a-zA-Z0-9_:.]*" + WS + "*=" + WS
                 + "*(?:\"([^\"]*)\"|'([^']*)'|([^" + WS_CLASS + "\"'=<>`]+))")

HTML_ENTITY_RE = "&(#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9]{1,7});"
FEED_ENTITY_RE = "&(#x[0-9a-fA-F]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9]*);"

# Markers placed in the output stream of the page plan and resolved by regex
# after the ordered concatenation (noncharacters: never part of real text).
BRK = "﷐"      # ensure a line break
STRIP = "﷑"    # strip trailing spaces/tabs
FENCE = "﷒"    # close a code fence unless the fence was just opened

# URL prefixes that are never links.
JUNK_HREF_PREFIXES = ("#", "javascript:", "mailto:", "tel:", "data:")

# Accepted content types.
PAGE_TYPES = ("text/html", "application/xhtml+xml", "text/plain")
FEED_TYPES = ("text/html", "application/xhtml+xml", "text/plain",
              "application/rss+xml", "application/atom+xml", "application/xml", "text/xml")
REDIRECT_STATUSES = (301, 302, 303, 307, 308)

# Rendered report strings.
TRUNCATED_PAGE_NOTE = "\n[content truncated — use a smaller page or raise maxChars]"
TRUNCATED_FEED_NOTE = "[feed truncated — response body exceeded the size cap]"
ELLIPSIS = "…"
UNTITLED = "(untitled)"
