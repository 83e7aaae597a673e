"""URL gate, normalisation and href resolution as DataFrame column steps.

Spark has no URL resolver, so URLs are split with one regex, each part is
normalised (scheme/host case, default port, dot segments, percent-encoding
of spaces, quotes, angle brackets, backticks and non-ASCII), and the parts
are joined again.  Rules follow the WHATWG parser for http/https where that
is cheap; punycode and IPv4 number forms are not done.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import js_trim

# URL patterns.
SCHEME_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
# scheme : (slashes ignored for http/https) authority path ?query #fragment
ABS_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*):[/\\]*([^/\\?#]*)([^?#]*)(\?[^#]*)?(#[\s\S]*)?$"
HOST_RE = r"^(\[[^\]]*\]|[^:\[]*)"
PORT_RE = r"^(?:\[[^\]]*\]|[^:\[]*):([\s\S]*)$"
FORBIDDEN_HOST_RE = r"[ #%/:<>?@\[\\\]^|]"
DOT_SEG_RE = r"(^|/)(\.|%2[eE]){1,2}(/|$)"
# runs of characters percent-encoded per component: all outside printable ASCII, and in paths "<>`{}, in
# queries "<>', in fragments "<>`. One flat class each (the kept characters, negated): a group of
# alternatives would recurse for every character of a long run
PATH_ENC = "[^\\x21\\x23-\\x3B\\x3D\\x3F-\\x5F\\x61-\\x7A\\x7C\\x7E]+"
QUERY_ENC = "[^\\x21\\x23-\\x26\\x28-\\x3B\\x3D\\x3F-\\x7E]+"
FRAG_ENC = "[^\\x21\\x23-\\x3B\\x3D\\x3F-\\x5F\\x61-\\x7E]+"
BASE_RE = r"^([a-z][a-z0-9+.-]*)://([^/?#]*)([^?#]*)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct_encode(x, run_re: str) -> Column:
    """UTF-8 percent-encode every run matching ``run_re`` (space -> %20)."""
    col = _c(x)
    parts = F.split(col, run_re, -1)
    runs = F.transform(F.regexp_extract_all(col, F.lit(run_re), 0),
                       lambda r: F.replace(F.url_encode(r), F.lit("+"), F.lit("%20")))
    joined = F.array_join(F.zip_with(parts, F.array_append(runs, F.lit("")), lambda p, r: F.concat(p, r)), "")
    return F.when(col.rlike(run_re), joined).otherwise(col)


def remove_dot_segments(path) -> Column:
    """RFC 3986 dot-segment removal for an absolute path (fast path when no dots)."""
    p = _c(path)
    segs = F.split(F.substr(p, F.lit(2)), "/", -1)
    segs = F.transform(segs, lambda s: F.when(s.rlike("^(?:[.]|%2[eE]){1,2}$"), F.regexp_replace(s, "%2[eE]", ".")).otherwise(s))
    stack = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc).otherwise(F.array_append(acc, s)))
    last = F.element_at(segs, -1)
    out = F.concat(F.lit("/"), F.array_join(stack, "/"),
                   F.when(last.isin(".", "..") & (F.size(stack) > 0), F.lit("/")).otherwise(F.lit("")))
    return F.when(p.rlike(DOT_SEG_RE), out).otherwise(p)


def decoded_host(host: Column) -> Column:
    """Percent-decoded host. One with a bad escape stays as it is, so its ``%`` is found by the test of characters."""
    plain = F.try_url_decode(F.replace(host, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(host, F.lit("%")) & ~host.startswith("["), F.coalesce(plain, host)).otherwise(host)


def with_parsed_url(df: DataFrame, src: str, p: str) -> DataFrame:
    """Add ``{p}_scheme, {p}_user, {p}_pass, {p}_host, {p}_ok, {p}_url`` for absolute URL text in ``src``.

    Four projections (``withColumns``), one per dependency level, so the plan stays small.
    """
    u = F.col(src)
    df = df.withColumns({
        f"{p}_scheme": F.lower(F.regexp_extract(u, ABS_RE, 1)),
        f"{p}__auth": F.regexp_extract(u, ABS_RE, 2),
        f"{p}__path": F.regexp_extract(u, ABS_RE, 3),
        f"{p}__query": F.regexp_extract(u, ABS_RE, 4),
        f"{p}__frag": F.regexp_extract(u, ABS_RE, 5),
    })
    a = F.col(f"{p}__auth")
    userinfo = F.when(F.instr(a, "@") > 0, F.regexp_extract(a, "^([\\s\\S]*)@", 1)).otherwise(F.lit(""))
    hostport = F.regexp_extract(a, "([^@]*)$", 1)
    df = df.withColumns({
        f"{p}_user": F.regexp_extract(userinfo, "^([^:]*)", 1),
        f"{p}_pass": F.regexp_extract(userinfo, "^[^:]*:([\\s\\S]*)$", 1),
        f"{p}_host": F.lower(decoded_host(F.regexp_extract(hostport, HOST_RE, 1))),
        f"{p}__port": F.regexp_extract(hostport, PORT_RE, 1),
    })
    host, port, scheme = F.col(f"{p}_host"), F.col(f"{p}__port"), F.col(f"{p}_scheme")
    port_ok = (port == "") | (port.rlike("^[0-9]{1,5}$") & (port.try_cast("int") <= 65535))
    host_ok = (host != "") & (host.rlike(r"^\[[^\]]*\]$") | ~host.rlike(FORBIDDEN_HOST_RE))
    port_n = F.when(port == "", F.lit("")).otherwise(port.try_cast("int").cast("string"))
    port_n = F.when(((scheme == "http") & (port_n == "80")) | ((scheme == "https") & (port_n == "443")),
                    F.lit("")).otherwise(port_n)
    path = F.col(f"{p}__path")
    path_n = F.when(path == "", F.lit("/")).otherwise(F.translate(path, "\\", "/"))
    df = df.withColumns({
        f"{p}_ok": (scheme != "") & port_ok & host_ok,
        f"{p}__portn": port_n,
        f"{p}__pathn": pct_encode(remove_dot_segments(path_n), PATH_ENC),
    })
    user, pw = F.col(f"{p}_user"), F.col(f"{p}_pass")
    cred = (F.when(pw != "", F.concat(user, F.lit(":"), pw, F.lit("@")))
            .when(user != "", F.concat(user, F.lit("@"))).otherwise(F.lit("")))
    url = F.concat(scheme, F.lit("://"), cred, host,
                   F.when(F.col(f"{p}__portn") != "", F.concat(F.lit(":"), F.col(f"{p}__portn"))).otherwise(F.lit("")),
                   F.col(f"{p}__pathn"),
                   pct_encode(F.col(f"{p}__query"), QUERY_ENC),
                   pct_encode(F.col(f"{p}__frag"), FRAG_ENC))
    df = df.withColumn(f"{p}_url", F.when(F.col(f"{p}_ok"), url))
    return df.drop(f"{p}__auth", f"{p}__path", f"{p}__query", f"{p}__frag", f"{p}__port", f"{p}__portn",
                   f"{p}__pathn")


def clean_input(x) -> Column:
    """Trim, then drop ASCII tab / LF / CR anywhere (as URL parsers do)."""
    return F.regexp_replace(js_trim(x), "[\\t\\n\\r]", "")


def settled(df: DataFrame, kept: list[str], new: dict[str, Column]) -> DataFrame:
    """``kept`` and the ``new`` columns, computed once: filters on these are not pushed below a generator, where
    they would evaluate a whole URL (or decoded body) a second time."""
    return df.select(*kept, F.inline(F.array(F.struct(*(c.alias(n) for n, c in new.items())))))


def gate(df: DataFrame, src: str, out: str = "final_url", reason: str = "reason") -> DataFrame:
    """Accept http/https URLs without credentials; reasons in the reference's order."""
    kept = df.columns
    df = df.withColumn("_g_in", clean_input(F.coalesce(F.col(src), F.lit(""))))  # a null is no URL either
    df = with_parsed_url(df, "_g_in", "_g")
    has_scheme = F.col("_g_in").rlike(SCHEME_RE)
    why = (F.when(~has_scheme, F.lit("invalid URL"))
           .when(~F.col("_g_scheme").isin("http", "https"), F.lit("unsupported protocol"))
           .when(~F.col("_g_ok"), F.lit("invalid URL"))
           .when((F.col("_g_user") != "") | (F.col("_g_pass") != ""), F.lit("embedded credentials")))
    return settled(df, kept, {out: F.when(why.isNull(), F.col("_g_url")), reason: why})


def resolve(df: DataFrame, href: str, base: str, out: str = "resolved", reason: str = "drop_reason",
            junk_filter: bool = True) -> DataFrame:
    """Absolute http(s) URL of ``href`` against the normalised ``base``; NULL + reason when dropped.

    ``junk_filter=False`` resolves like a redirect ``Location`` (no prefix filter).
    """
    h = js_trim(href)
    junk = (F.when(h == "", F.lit("empty"))
            .when(h.startswith("#"), F.lit("fragment"))
            .when(h.startswith("javascript:"), F.lit("javascript"))
            .when(h.startswith("mailto:"), F.lit("mailto"))
            .when(h.startswith("tel:"), F.lit("tel"))
            .when(h.startswith("data:"), F.lit("data")))
    if not junk_filter:
        junk = F.lit(None).cast("string")
    kept = df.columns
    df = df.withColumns({"_r_junk": junk, "_r_h": clean_input(href)})
    b = F.col(base)
    bs, ba, bp = (F.regexp_extract(b, BASE_RE, i) for i in (1, 2, 3))
    bp = F.when(bp == "", F.lit("/")).otherwise(bp)
    bdir = F.regexp_extract(bp, "^([\\s\\S]*/)", 1)
    hh = F.col("_r_h")
    # a scheme equal to the base's says nothing: the rest is relative, with one slash, two or none
    hh = F.when(hh.rlike(SCHEME_RE) & (F.lower(F.substring_index(hh, ":", 1)) == bs), F.substr(hh, F.length(bs) + 2)).otherwise(hh)
    absu = (F.when(hh == "", F.substring_index(b, "#", 1))
            .when(hh.rlike(SCHEME_RE), hh)
            .when(hh.startswith("#"), F.concat(F.substring_index(b, "#", 1), hh))
            .when(hh.rlike(r"^[/\\][/\\]"), F.concat(bs, F.lit(":"), hh))
            .when(hh.rlike(r"^[/\\]"), F.concat(bs, F.lit("://"), ba, hh))
            .when(hh.startswith("?"), F.concat(bs, F.lit("://"), ba, bp, hh))
            .otherwise(F.concat(bs, F.lit("://"), ba, bdir, hh)))
    df = df.withColumn("_r_abs", F.when(F.col("_r_junk").isNull(), absu))
    df = with_parsed_url(df, "_r_abs", "_r")
    why = (F.when(F.col("_r_junk").isNotNull(), F.col("_r_junk"))
           .when(~F.col("_r_scheme").isin("http", "https"), F.lit("unsupported_scheme"))
           .when(~F.col("_r_ok"), F.lit("invalid")))
    return settled(df, kept, {out: F.when(why.isNull(), F.col("_r_url")), reason: why})


def host_of(url) -> Column:
    """Lower-case host of a normalised URL ('' when none)."""
    return F.regexp_extract(_c(url), r"^[a-z][a-z0-9+.-]*://(?:[^@/?#]*@)?(\[[^\]]*\]|[^:/?#]*)", 1)
