"""Captured HTTP responses: gates, byte cap, charset, decoding, header maps, redirects.

Redirect chains are followed by pointer doubling. Each captured URL is one node; its redirect target is resolved once,
whatever number of chains pass through it. Jump tables over the 3xx nodes alone (2, 4, 8 hops) are built by joining
the table of half as many hops with itself; each 3xx node then takes the largest jumps that the limit leaves room for.
Starts meet the result in two joins, whatever the limit is, and rows that are settled are never carried along. The
nodes are a reliable checkpoint in the cluster's checkpoint folder; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.constants import FEED_TYPES, PAGE_TYPES, REDIRECT_STATUSES, WS
from ..functions.text import js_trim
from ..options import MAX_BYTES, MAX_REDIRECTS, SNIFF_BYTES, TIMEOUT_MS, clamp
from ..session import checkpoint_dir

# Windows-1252 characters for bytes 0x80-0x9F (the latin1 label decodes as windows-1252).
CP1252_C1 = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰",
    0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•",
    0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
LATIN1_LABELS = ("iso-8859-1", "iso8859-1", "latin1", "l1", "windows-1252", "cp1252", "us-ascii", "ascii",
                 "iso_8859-1", "x-cp1252", "ansi_x3.4-1968")

CS = "([a-zA-Z0-9._-]+)"
HEADER_CHARSET_RE = "(?i)charset" + WS + "*=" + WS + "*[\"']?" + CS
XML_CHARSET_RE = "(?i)<\\?xml[^>]+encoding" + WS + "*=" + WS + "*[\"']" + CS
META_CHARSET_RE = "(?i)<meta[^>]+charset" + WS + "*=" + WS + "*[\"']?" + CS
META_CONTENT_RE = ("(?i)<meta[^>]+content" + WS + "*=" + WS + "*[\"'][^\"']*charset" + WS + "*=" + WS + "*" + CS)
# JavaScript '.' = any char but \n \r U+2028 U+2029 (Java and RE2 each differ), spelled out
STATUS_LINE_RE = ("^HTTP/[0-9](?:\\.[0-9])?" + WS + "+([0-9]{3})(?:" + WS
                  + "+([^\\n\\r\\x{2028}\\x{2029}]*))?$")


def media_type(ct) -> Column:
    """Header before ';', trimmed, lower-cased; missing header -> 'unknown'."""
    c = F.col(ct) if isinstance(ct, str) else ct
    return F.when(c.isNull(), F.lit("unknown")).otherwise(F.lower(js_trim(F.substring_index(c, ";", 1))))


def status_class(status) -> Column:
    s = F.col(status) if isinstance(status, str) else status
    return (F.when(s.isin(*REDIRECT_STATUSES), F.lit("redirect"))
            .when(s.between(200, 299), F.lit("ok")).otherwise(F.lit("rejected")))


def size_cap(log: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Keep the first maxBytes bytes of ``body``; flag truncation."""
    n = clamp(max_bytes, MAX_BYTES)
    return log.select("*", F.substring("body", 1, n).alias("kept"),
                      (F.octet_length("body") > n).alias("truncated"))


def detect_charset(ct, body) -> Column:
    """Content-Type charset, else XML declaration / meta in the first 2,048 bytes (latin1), else utf-8."""
    c = F.coalesce(F.col(ct), F.lit(""))
    head = F.decode(F.substring(F.col(body), 1, SNIFF_BYTES), "ISO-8859-1")

    def grab(x, pattern):
        return F.nullif(F.regexp_extract(x, pattern, 1), F.lit(""))
    return F.coalesce(grab(c, HEADER_CHARSET_RE), grab(head, XML_CHARSET_RE), grab(head, META_CHARSET_RE),
                      grab(head, META_CONTENT_RE), F.lit("utf-8"))


# Labels of the single-byte encodings, each under the name its byte table is built from.
SINGLE_BYTE = {
    "cp1250": ("windows-1250", "cp1250", "x-cp1250"), "cp1251": ("windows-1251", "cp1251", "x-cp1251"),
    "cp1253": ("windows-1253", "cp1253", "x-cp1253"), "cp1254": ("windows-1254", "cp1254", "x-cp1254", "iso-8859-9", "iso8859-9", "latin5", "l5"),
    "cp1255": ("windows-1255", "cp1255", "x-cp1255"), "cp1256": ("windows-1256", "cp1256", "x-cp1256"),
    "cp1257": ("windows-1257", "cp1257", "x-cp1257"), "cp1258": ("windows-1258", "cp1258", "x-cp1258"),
    "iso8859-2": ("iso-8859-2", "iso8859-2", "latin2", "l2"), "iso8859-3": ("iso-8859-3", "iso8859-3", "latin3", "l3"),
    "iso8859-4": ("iso-8859-4", "iso8859-4", "latin4", "l4"), "iso8859-5": ("iso-8859-5", "iso8859-5", "cyrillic"),
    "iso8859-6": ("iso-8859-6", "iso8859-6", "arabic"), "iso8859-7": ("iso-8859-7", "iso8859-7", "greek"),
    "iso8859-8": ("iso-8859-8", "iso8859-8", "hebrew", "iso-8859-8-i"), "iso8859-10": ("iso-8859-10", "iso8859-10", "latin6", "l6"),
    "iso8859-13": ("iso-8859-13", "iso8859-13"), "iso8859-14": ("iso-8859-14", "iso8859-14"),
    "iso8859-15": ("iso-8859-15", "iso8859-15", "latin9", "l9"), "iso8859-16": ("iso-8859-16",),
    "koi8-r": ("koi8-r", "koi8", "koi8_r"), "koi8-u": ("koi8-u", "koi8-ru"), "mac-roman": ("macintosh", "mac", "x-mac-roman"),
    "mac-cyrillic": ("x-mac-cyrillic", "x-mac-ukrainian"), "cp866": ("ibm866", "cp866", "866"), "cp874": ("windows-874", "dos-874", "tis-620", "iso-8859-11"),
}
UTF16LE_LABELS = ("utf-16le", "utf-16", "unicode", "ucs-2", "iso-10646-ucs-2", "csunicode", "unicodefeff")
UTF16BE_LABELS = ("utf-16be", "unicodefffe")


def _high_half(codec: str) -> str:
    """Characters of bytes 0x80-0xFF; bytes without one: the C1 control below 0xA0, U+FFFD above."""
    return "".join(bytes([k]).decode(codec, "ignore") or (chr(k) if k < 0xA0 else "\uFFFD") for k in range(0x80, 0x100))


def _utf16_text(body: Column, little: bool) -> Column:
    """UTF-16 without failing: an odd last byte and every lone surrogate become U+FFFD."""
    unit, bad = (lambda u: F.concat(F.substring(u, 3, 2), F.substring(u, 1, 2))) if little else (lambda u: u), "FFFD"
    digits = F.hex(body)
    units = F.transform(F.regexp_extract_all(digits, F.lit("[0-9A-F]{4}"), 0), unit)
    def is_high(u):
        return u.between("D800", "DBFF")
    def is_low(u):
        return u.between("DC00", "DFFF")
    whole = F.transform(units, lambda u, i: F.when(
        (is_high(u) & ~F.coalesce(is_low(F.get(units, i + 1)), F.lit(False)))
        | (is_low(u) & ~F.coalesce(is_high(F.get(units, i - 1)), F.lit(False))), F.lit(bad)).otherwise(u))
    odd = F.when(F.length(digits) % 4 != 0, F.lit(bad)).otherwise(F.lit(""))
    return F.decode(F.unhex(F.concat(F.array_join(whole, ""), odd)), "UTF-16BE")


def decode_body(body, charset) -> tuple[Column, Column]:
    """(text, decoder). utf-8 and utf-16 with U+FFFD for bad input, their byte order mark dropped; single-byte
    encodings by their tables; any other label falls back to utf-8 like the reference's unknown-label path."""
    label = F.lower(F.col(charset))
    key = F.regexp_replace(label, "[_-]", "")
    b = F.col(body)
    latin = F.decode(b, "ISO-8859-1")
    upper = "".join(chr(k) for k in range(0x80, 0x100))
    decoder = F.when(key.isin("utf8", "unicode11utf8", "xunicode20utf8"), F.lit("utf-8")).when(label.isin(*LATIN1_LABELS), F.lit("windows-1252"))
    decoder = decoder.when(label.isin(*UTF16LE_LABELS), F.lit("utf-16le")).when(label.isin(*UTF16BE_LABELS), F.lit("utf-16be"))
    for labels in SINGLE_BYTE.values():
        decoder = decoder.when(label.isin(*labels), F.lit(labels[0]))
    decoder = decoder.otherwise(F.lit("utf-8 (charset_unsupported)"))
    text = (F.when(decoder == "windows-1252", F.translate(latin, "".join(chr(k) for k in CP1252_C1), "".join(CP1252_C1.values())))
            .when(decoder == "utf-16le", _utf16_text(b, True)).when(decoder == "utf-16be", _utf16_text(b, False)))
    for codec, labels in SINGLE_BYTE.items():
        text = text.when(decoder == labels[0], F.translate(latin, upper, _high_half(codec)))
    text = text.otherwise(F.make_valid_utf8(b.cast("string")))
    marked = decoder.startswith("utf-") & text.startswith("\uFEFF")
    return F.when(marked, F.substr(text, F.lit(2))).otherwise(text), decoder


def header_map(heads: DataFrame) -> DataFrame:
    """``(page_id, head)`` -> ``(page_id, ok, status, status_text, key, value)``; duplicate keys joined ', '.

    A head is split once; its status line goes along with each header, so one shuffle (the join of equal keys) is all.
    A head without headers, or with a bad status line, is one row without a key.
    """
    heads = heads.select("page_id", F.split("head", "\r\n", -1).alias("lines"))
    first = F.col("lines")[0]
    colon = F.instr("l", ":")
    h = heads.select("page_id", first.rlike(STATUS_LINE_RE).alias("ok"), F.regexp_extract(first, STATUS_LINE_RE, 1).alias("st"),
                     F.regexp_extract(first, STATUS_LINE_RE, 2).alias("status_text"),
                     F.filter(F.transform("lines", lambda l, i: F.struct(i.alias("ln"), l.alias("l"))), lambda x: (x["ln"] > 0) & (F.instr(x["l"], ":") > 1)).alias("kv"))
    none = F.array(F.lit(None).cast("struct<ln:int,l:string>"))
    h = h.select("page_id", "ok", F.when(F.col("ok"), F.col("st").cast("int")).alias("status"), F.when(F.col("ok"), F.col("status_text")).alias("status_text"),
                 F.explode(F.when(F.col("ok") & (F.size("kv") > 0), F.col("kv")).otherwise(none)).alias("x")).select("*", "x.ln", "x.l")
    h = h.select("page_id", "ok", "status", "status_text", "ln", F.lower(js_trim(F.substring("l", F.lit(1), colon - 1))).alias("key"),
                 js_trim(F.substr(F.col("l"), colon + 1)).alias("value"))
    merged = h.groupBy("page_id", "ok", "status", "status_text", "key").agg(F.array_sort(F.collect_list(F.struct("ln", "value"))).alias("v"))
    return merged.select("page_id", "ok", "status", "status_text", "key", F.when(F.col("key").isNotNull(), F.array_join(F.transform("v", lambda x: x["value"]), ", ")).alias("value"))


def profiles(spark: SparkSession) -> DataFrame:
    """R3 as a table: ``(profile, media)``, the media types that page and feed reads accept."""
    return spark.createDataFrame([("page", t) for t in PAGE_TYPES] + [("feed", t) for t in FEED_TYPES], "profile string, media string")


def capture_nodes(log: DataFrame, timeout_ms: int | None = None) -> DataFrame:
    """One row for each captured URL without its fragment (of several captures the one with the smallest page_id, then
    URL): ``(key, capture_id, capture_url, status, media, outcome, nxt)``.

    ``outcome``: why a fetch ends here; NULL at a redirect that can be followed (``nxt``) and at a 2xx response whose
    media type is still to be asked for. A column ``body_error`` of the log, where there is one, says that the body
    could not be read.
    """
    checkpoint_dir(log.sparkSession)
    error = F.col("body_error").cast("string") if "body_error" in log.columns else F.lit(None).cast("string")
    kept = ["status", "location", "content_type", "elapsed_ms", "body_error"]
    rows = log.select("page_id", "url", "status", "location", "content_type", "elapsed_ms", error.alias("body_error"))
    keyed = urls.gate(rows, "url", out="key", reason="_lw").filter(F.col("key").isNotNull())
    nodes = keyed.groupBy(F.substring_index("key", "#", 1).alias("key")).agg(F.min(F.struct("page_id", "url", *kept)).alias("c")) \
        .select("key", F.col("c.page_id").alias("capture_id"), F.col("c.url").alias("capture_url"), *[f"c.{k}" for k in kept])
    late = F.coalesce(F.col("elapsed_ms") > clamp(timeout_ms, TIMEOUT_MS), F.lit(False))
    redirect = F.col("status").isin(*REDIRECT_STATUSES)
    named = F.coalesce(F.col("location"), F.lit("")) != ""
    nodes = nodes.withColumn("target", F.when(redirect & ~late & named, F.col("location")))
    nodes = urls.resolve(nodes, "target", "key", out="nxt", reason="nwhy", junk_filter=False)
    why = (F.when(F.col("nwhy") == "unsupported_scheme", F.lit("unsupported protocol"))
           .when(F.col("nwhy").isNotNull(), F.lit("invalid URL"))
           .when(F.col("nxt").rlike("^[a-z]+://[^/?#]*@"), F.lit("embedded credentials")))
    outcome = (F.when(F.col("status").isNull(), F.lit("fetch failed"))
               .when(late, F.lit("timed out"))
               .when(redirect & ~named, F.lit("redirect without Location"))
               .when(redirect, why)
               .when(~F.col("status").between(200, 299), F.lit("HTTP status")))
    nodes = nodes.select("key", "capture_id", "capture_url", "status", media_type("content_type").alias("media"), "body_error",
                         F.col("target").isNotNull().alias("redirects"), outcome.alias("outcome"), "nxt")
    return nodes.withColumn("nxt", F.when(F.col("outcome").isNull(), F.col("nxt"))).checkpoint()


def jump_ends(nodes: DataFrame, limit: int) -> DataFrame:
    """``(start, to, at, hops)`` for each redirecting node: where up to ``limit`` hops lead (URL and node key)."""
    at = F.substring_index("to", "#", 1)
    jump = nodes.filter(F.col("nxt").isNotNull()).select("key", F.col("nxt").alias("to")).withColumn("at", at)
    ends = jump.select(F.col("key").alias("start"), F.lit(None).cast("string").alias("to"), F.col("key").alias("at"), F.lit(0).alias("hops"))
    jumps = [jump] if limit else []
    for _ in range(1, limit.bit_length()):
        last = jumps[-1]
        after = last.select(F.col("key").alias("at"), F.col("to").alias("to2"))
        doubled = last.join(after, "at").select("key", F.col("to2").alias("to")).withColumn("at", at)
        # a table of hops is read for the next one and for the walk; without a cut its plan would double each time
        jumps.append(doubled.checkpoint() if limit.bit_length() > 2 else doubled)
    for power in reversed(range(len(jumps))):
        step = jumps[power].select(F.col("key").alias("from"), F.col("to").alias("to2"), F.col("at").alias("at2"))
        asked = F.when(F.col("hops") + (1 << power) <= limit, F.col("at"))
        gone = F.col("to2").isNotNull()
        ends = ends.withColumn("from", asked).join(step, "from", "left").select(
            "start", F.coalesce("to2", "to").alias("to"), F.coalesce("at2", "at").alias("at"),
            (F.col("hops") + F.when(gone, 1 << power).otherwise(0)).alias("hops"))
    return ends


def resolve_redirects(log: DataFrame, starts: DataFrame, max_redirects: int | None = None,
                      timeout_ms: int | None = None, profile: str = "page") -> DataFrame:
    """Follow every start URL through the log.

    -> ``(page_id, url, final_url, hops, status, outcome, capture_id, capture_url)``: outcome 'ok' or the reference's
    error class; the last two tell the capture that answered an ok chain. Starts may be read by profiles of their own
    (column ``profile``: 'page' or 'feed').
    """
    limit = clamp(max_redirects, MAX_REDIRECTS)
    nodes = capture_nodes(log, timeout_ms)
    own = F.col("profile") if "profile" in starts.columns else F.lit(profile).alias("profile")
    g = urls.gate(starts.select("page_id", "url", own), "url", out="cur", reason="why")
    no_id, no_text = F.lit(None).cast(dict(log.dtypes)["page_id"]), F.lit(None).cast("string")
    never = g.filter(F.col("cur").isNull()).select("page_id", "url", no_text.alias("final_url"), F.lit(0).alias("hops"), F.lit(None).cast("int").alias("status"),
                                                   F.col("why").alias("outcome"), no_id.alias("capture_id"), no_text.alias("capture_url"))
    active = g.filter(F.col("cur").isNotNull()).withColumn("start", F.substring_index("cur", "#", 1))
    reached = active.join(jump_ends(nodes, limit), "start", "left").select(
        "page_id", "url", "profile", F.coalesce("to", "cur").alias("final_url"), F.coalesce("at", "start").alias("key"), F.coalesce("hops", F.lit(0)).alias("hops"))
    accepted = profiles(log.sparkSession).withColumn("accepted", F.lit(True))
    j = reached.join(nodes, "key", "left").join(accepted, ["profile", "media"], "left")
    outcome = (F.when(F.col("status").isNull(), F.lit("fetch failed"))
               .when(F.col("redirects") & (F.col("hops") == limit), F.lit("too many redirects"))
               .when(F.col("outcome").isNotNull(), F.col("outcome"))
               .when(F.col("accepted").isNull(), F.lit("unsupported content type"))
               .when(F.col("body_error").isNotNull(), F.lit("body read failed"))
               .otherwise(F.lit("ok")))
    j = j.withColumn("outcome", outcome)
    ok = F.col("outcome") == "ok"
    done = j.select("page_id", "url", "final_url", "hops", F.when(~F.col("outcome").isin("fetch failed", "timed out"), F.col("status")).alias("status"),
                    "outcome", F.when(ok, F.col("capture_id")).alias("capture_id"), F.when(ok, F.col("capture_url")).alias("capture_url"))
    return never.unionByName(done)
