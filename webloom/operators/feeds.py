"""RSS / Atom documents -> feed rows and entry rows.

Row expressions and one generator only: ``regexp_extract_all`` pulls the
item blocks, ``posexplode`` turns them into rows and every field is a
``regexp_extract`` + clean-up.  No shuffle, and the same plan runs on a
stream.  ``maxItems`` slices the block array *before* fields are extracted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.constants import UNTITLED, WS
from ..functions.text import bind, cap_with_ellipsis, clean_feed_text
from ..options import CONTENT_CAP, FEED_MAX_ITEMS, SUMMARY_CAP, clamp

NOT_A_FEED = "not a recognized RSS or Atom feed (no <rss> or <feed> root element found)"
RSS_ROOT = "(?i)<rss[" + WS[1:-1] + ">]"
ATOM_ROOT = "(?i)<feed[" + WS[1:-1] + ">]"
ITEM_RE = "(?i)<item(?:" + WS + "[^>]*)?>([\\s\\S]*?)</item>"
ENTRY_RE = "(?i)<entry(?:" + WS + "[^>]*)?>([\\s\\S]*?)</entry>"
CHANNEL_RE = "(?i)(<channel[" + WS[1:-1] + ">][\\s\\S]*?)</channel>"
LINK_TAG_RE = "(?i)<link\\b[^>]*>"
HREF_RE = "(?i)href" + WS + "*=" + WS + "*(?:\"([^\"]*)\"|'([^']*)')"
REL_RE = "(?i)rel" + WS + "*=" + WS + "*(?:\"([^\"]*)\"|'([^']*)')"


def tag_re(tag: str) -> str:
    """First ``<tag ...>…</tag>`` (case-insensitive), group 1 = inner text."""
    return f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}>"


def run_re(tag: str) -> str:
    """The same match for the JVM: the text is taken run by run, as ``.*?`` tries its end at every character."""
    return f"(?is)<{tag}\\b[^>]*>((?:[^<]+|<(?!/{tag}>))*+)</{tag}>"


def field(block: Column, pattern: str) -> Column:
    return clean_feed_text(F.regexp_extract(block, pattern, 1))


def feed_kind(xml: Column) -> Column:
    return F.when(xml.rlike(RSS_ROOT), F.lit("rss")).when(xml.rlike(ATOM_ROOT), F.lit("atom"))


def parse_feeds(feeds: DataFrame) -> DataFrame:
    """``(feed_id, url, xml)`` -> adds ``kind`` (NULL = not a feed), ``feed_title``, ``error``."""
    x, kind = F.col("xml"), F.col("kind")
    # one cleaning expression for the title of either kind
    title = field(F.when(kind == "rss", channel_of(x)).when(kind == "atom", x), run_re("title"))
    # the kind is settled first: later filters on it do not search the document again
    return urls.settled(feeds, feeds.columns, {"kind": feed_kind(x)}).select(
        "*", title.alias("feed_title"), F.when(kind.isNull(), F.lit(NOT_A_FEED)).alias("error"))


def tag_blocks(xml: Column, tag: str) -> Column:
    """Inner texts of all ``<tag ...>...</tag>``: cut at the closing tags, then behind the first opening one of each cut.

    The same as matching opening, shortest text, closing one after the other, without a regex that tries its end at
    every character. Only where an opening tag itself holds a closing one does the pattern decide.
    """
    opening, closing = f"(?i)<{tag}(?:{WS}[^>]*)?>", f"(?i)</{tag}>"
    cut = bind(F.split(xml, closing, -1), lambda cuts: F.transform(F.slice(cuts, F.lit(1), F.size(cuts) - 1), lambda c: F.split(c, opening, 2)))
    plain = F.transform(F.filter(cut, lambda c: F.size(c) == 2), lambda c: c[1])
    return F.when(xml.rlike(f"(?i)<{tag}{WS}[^>]*</{tag}"), F.regexp_extract_all(xml, F.lit(f"{opening}([\\s\\S]*?)</{tag}>"), 1)).otherwise(plain)


def _blocks(max_items: int | None) -> Column:
    k = F.col("kind")
    blocks = F.when(k == "rss", tag_blocks(F.col("xml"), "item")).when(k == "atom", tag_blocks(F.col("xml"), "entry"))
    return blocks if max_items is None else F.slice(blocks, 1, max_items)


def channel_of(xml: Column) -> Column:
    """Text of the first closed ``<channel>``, the whole document where there is none."""
    behind = F.split(xml, "(?i)<channel[" + WS[1:-1] + ">]", 2)
    inner = F.split(F.get(behind, F.lit(1)), "(?i)</channel>", 2)
    return bind(inner, lambda i: F.when(F.size(i) == 2, i[0]).otherwise(xml))


def _atom_link(b: Column) -> Column:
    tags = F.regexp_extract_all(b, F.lit(LINK_TAG_RE), 0)
    links = F.filter(F.transform(tags, lambda t: F.struct(
        t.rlike(HREF_RE).alias("has"),
        F.concat(F.regexp_extract(t, HREF_RE, 1), F.regexp_extract(t, HREF_RE, 2)).alias("href"),
        F.lower(F.concat(F.regexp_extract(t, REL_RE, 1), F.regexp_extract(t, REL_RE, 2))).alias("rel"))),
        lambda s: s["has"])
    alternate = F.try_element_at(F.filter(links, lambda s: F.instr(s["rel"], "alternate") > 0), F.lit(1))
    no_rel = F.try_element_at(F.filter(links, lambda s: s["rel"] == ""), F.lit(1))
    first = F.try_element_at(links, F.lit(1))
    return F.coalesce(alternate["href"], no_rel["href"], first["href"], F.lit(""))


def entries(parsed: DataFrame, max_items: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per item/entry: ``(feed_id, pos, kind, title, url, published, author, summary, content)``.

    Fields are '' when absent, as in the reference parser; ``url`` is raw.
    ``keep`` passes feed columns through (streams use it instead of a join).
    """
    e = parsed.filter(F.col("kind").isNotNull()).select(
        "feed_id", "kind", *keep, F.posexplode(_blocks(max_items)).alias("pos", "b"))
    b, rss = F.col("b"), F.col("kind") == "rss"

    def tag(name: str) -> Column:
        return F.regexp_extract(b, run_re(name), 1)

    def either(of_rss: Column, of_atom: Column) -> Column:
        return F.when(rss, of_rss).otherwise(of_atom)
    none = F.lit("")
    moment = F.regexp_extract(b, run_re("(?:published|updated)"), 1)
    person = F.regexp_extract(b, "(?i)<author\\b[^>]*>[\\s\\S]*?<name\\b[^>]*>([\\s\\S]*?)</name>", 1)
    raw = {"title": tag("title"), "link": either(tag("link"), none), "guid": either(tag("guid"), none), "published": either(tag("pubDate"), moment),
           "date": either(tag("dc:date"), none), "author": either(tag("dc:creator"), person), "person": either(tag("author"), none),
           "summary": either(tag("description"), tag("summary"))}
    # the dialect's own raw texts, then one cleaning expression over all of them; content on its own, as few ask for it
    def cleaned(texts: list[Column]) -> Column:
        return F.transform(F.array(*texts), clean_feed_text)
    e = e.select("feed_id", "pos", "kind", *keep, F.when(~rss, _atom_link(b)).alias("alink"), cleaned(list(raw.values())).alias("c"),
                 cleaned([either(tag("content:encoded"), tag("content"))]).alias("full"))
    c = {k: F.col("c")[i] for i, k in enumerate(raw)}
    by_guid = F.when((c["link"] == "") & c["guid"].rlike("(?i)^https?://"), c["guid"]).otherwise(c["link"])
    e = e.select(
        "feed_id", "pos", "kind", *keep,
        c["title"].alias("_title"),
        F.when(rss, by_guid).otherwise(F.col("alink")).alias("url"),
        F.coalesce(F.nullif(c["published"], none), c["date"]).alias("published"),
        F.coalesce(F.nullif(c["author"], none), c["person"]).alias("author"),
        c["summary"].alias("summary"), F.col("full")[0].alias("content"),
    )
    return e.select("feed_id", F.col("pos").cast("int").alias("pos"), "kind", *keep,
                    F.when(F.col("_title") == "", F.lit(UNTITLED)).otherwise(F.col("_title")).alias("title"),
                    "url", "published", "author", "summary", "content")


def feed_items(parsed: DataFrame, max_items: int | None = None, include_content: bool = False,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """web_feed entries: first ``maxItems``, URL resolved against the feed URL ('' when dropped),
    summary capped at 500, content (or summary) at 2,000 when requested; absent fields NULL."""
    n = clamp(max_items, FEED_MAX_ITEMS)
    e = entries(parsed, n, keep=("final_url", *keep))
    e = urls.resolve(e, "url", "final_url", out="_res", reason="_why")
    full = F.when(F.col("content") != "", F.col("content")).otherwise(F.col("summary"))
    return e.select(
        "feed_id", "pos", "title",
        F.coalesce("_res", F.lit("")).alias("url"),
        F.nullif(F.col("published"), F.lit("")).alias("published"),
        F.nullif(F.col("author"), F.lit("")).alias("author"),
        F.when(F.col("summary") != "", cap_with_ellipsis("summary", SUMMARY_CAP)).alias("summary"),
        (F.when(full != "", cap_with_ellipsis(full, CONTENT_CAP)) if include_content
         else F.lit(None).cast("string")).alias("content"),
        *keep,
    )


def entry_counts(parsed: DataFrame, items: DataFrame) -> DataFrame:
    """A2: entries *returned* per feed (0 for empty feeds)."""
    c = items.groupBy("feed_id").agg(F.count("*").alias("n"))
    return (parsed.filter(F.col("kind").isNotNull()).select("feed_id").join(c, "feed_id", "left")
            .select("feed_id", F.coalesce("n", F.lit(0)).cast("int").alias("entry_count")))


# Zone names of RFC 822 dates and their offsets.
ZONES = {"UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
         "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}


# Months of RFC 822 dates, short or in full.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
RFC_RE = (r"^([0-9]{1,2}) (" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + r"|Sept) ([0-9]{4}|[0-9]{2})"
          r"(?: ([0-9]{1,2}:[0-9]{2})(:[0-9]{2})?(?: ([A-Za-z]{1,3}|[+-][0-9]{4}))?)?$")
ISO_RE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[Tt ]([0-9]{2}:[0-9]{2})(:[0-9]{2})?(?:[.][0-9]+)?([Zz]|[+-][0-9]{2}:?[0-9]{2})?)?$"


def published_utc(published) -> Column:
    """F14 (ours): entry date as 'yyyy-MM-dd HH:mm:ss' UTC, or NULL.

    RFC 822 (weekday dropped, month short or in full, two digits of a year from 50 on are 19xx, time and zone may be
    missing) and ISO 8601 (date alone, or with time, optional seconds and fraction). Without a zone it is UTC.
    """
    c = F.col(published) if isinstance(published, str) else published
    s = F.regexp_replace(F.trim(F.regexp_replace(c, "^[A-Za-z]{3,9},[ ]*", "")), " +", " ")

    def known(x, default):
        return F.when(x == "", F.lit(default)).otherwise(x)

    def mail(p):
        """Parts day, month, year, clock, seconds, zone -> one form."""
        year = F.when(F.length(p[2]) == 4, p[2]).otherwise(F.concat(F.when(p[2] >= "50", F.lit("19")).otherwise(F.lit("20")), p[2]))
        zone = F.when(p[5].rlike("^[+-]"), p[5]).otherwise(F.try_element_at(zones, F.upper(known(p[5], "Z"))))
        clock = F.concat(F.lpad(known(p[3], "00:00"), 5, "0"), known(p[4], ":00"))
        return F.concat_ws(" ", p[0], F.initcap(F.substring(p[1], 1, 3)), year, F.concat(clock, F.lit(" "), zone))

    def iso(p):
        """Parts date, clock, seconds, zone -> one form."""
        return F.concat(p[0], F.lit(" "), known(p[1], "00:00"), known(p[2], ":00"), F.lit(" "), F.replace(F.upper(known(p[3], "+0000")), F.lit(":"), F.lit("")))
    zones = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
    is_iso, is_mail = s.rlike(ISO_RE), s.rlike("(?i)" + RFC_RE)
    # one match gives all parts; the one-element arrays bind them, so that no pattern is run for each use
    parts = F.split(F.when(is_iso, F.regexp_replace(s, ISO_RE, "$1|$2|$3|$4")).when(is_mail, F.regexp_replace(s, "(?i)" + RFC_RE, "$1|$2|$3|$4|$5|$6")), "[|]", -1)
    form = F.get(F.transform(F.array(parts), lambda p: F.when(F.size(p) == 4, iso(p)).otherwise(mail(p))), F.lit(0))
    ts = F.when(is_iso, F.try_to_timestamp(F.regexp_replace(form, "Z$", "+0000"), F.lit("yyyy-MM-dd HH:mm:ss Z"))) \
        .when(is_mail, F.try_to_timestamp(form, F.lit("d MMM yyyy HH:mm:ss Z")))
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
