"""Table jobs: ``(spark, sf_dir) -> DataFrame``, one per operator of SURVEY §2.

Every job reads the driver tables (or views Spark derives from them) whole;
nothing is sampled or capped except where the cap *is* the operator (link
limit, feed maxItems).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import html
from ..options import ExtractOptions
from ..session import configure
from ..sources import tables

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}


def job(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        JOBS[name] = run
        return run
    return deco


# --------------------------------------------------------------------------- pages

@job("tokens")
def tokens_job(spark, sf_dir):
    """Token relation of every page (comments and name-less tags dropped)."""
    t = html.tokenize(tables.pages(spark, sf_dir), clustered=True)  # no window follows, so no shuffle
    return t.filter(F.col("tok") != "").select(
        "page_id", F.col("pos").cast("int").alias("pos"), "kind", "name", "closing", "tok")


@job("visible_depth")
def visible_depth_job(spark, sf_dir):
    """Per page token counts and the clamped skip / pre depths."""
    s = html.page_state(tables.web_pages(spark, sf_dir)).filter(F.col("tok") != "")
    text = F.col("kind") == "text"
    return s.groupBy("page_id").agg(
        F.count("*").alias("n_tokens"),
        F.count(F.when(text, 1)).alias("n_text"),
        F.count(F.when(text & F.col("active") & (F.col("skip") == 0), 1)).alias("n_visible_text"),
        F.max("skip").cast("int").alias("max_skip_depth"),
        F.max("pre").cast("int").alias("max_pre_depth"),
    )


@job("page_title")
def page_title_job(spark, sf_dir):
    """Last closed ``<title>``, decoded and whitespace-collapsed ('' if none)."""
    return html.titles(tables.pages(spark, sf_dir))


@job("page_text")
def page_text_job(spark, sf_dir):
    """P7 (+P17-P19): plain-text content."""
    ex = html.extract(tables.pages(spark, sf_dir), ExtractOptions.of("text"), with_links=False)
    return ex.select("page_id", "content", F.col("length").cast("int").alias("length"), "truncated")


@job("page_markdown")
def page_markdown_job(spark, sf_dir):
    """Markdown content (headings, lists, fences, links, images)."""
    ex = html.extract(tables.web_pages(spark, sf_dir), ExtractOptions.of("markdown"), with_links=False)
    return ex.select("page_id", "content", F.col("length").cast("int").alias("length"), "truncated")


@job("page_truncated")
def page_truncated_job(spark, sf_dir):
    """Content cut at the smallest allowed cap (1,000 chars) and flagged."""
    ex = html.extract(tables.pages(spark, sf_dir), ExtractOptions.of("text", 1_000), with_links=False)
    return ex.select("page_id", "content", F.col("length").cast("int").alias("length"), "truncated")


@job("raw_links")
def raw_links_job(spark, sf_dir):
    """Every anchor with an href, label as rendered, document order."""
    rl = html.raw_links(html.page_state(tables.pages(spark, sf_dir)))
    return rl.select("page_id", F.col("link_pos").cast("int").alias("link_pos"), "text", "href")


@job("page_images")
def page_images_job(spark, sf_dir):
    """Images with alt and src."""
    im = html.images(html.page_state(tables.web_pages(spark, sf_dir)))
    return im.select("page_id", F.col("pos").cast("int").alias("pos"), "alt", "src")


@job("tag_attributes")
def tag_attributes_job(spark, sf_dir):
    """Attributes of every opening tag, the last of equal names, values as written."""
    t = html.tokenize(tables.web_pages(spark, sf_dir), clustered=True).filter((F.col("kind") == "tag") & ~F.col("closing"))
    return t.select("page_id", F.col("pos").cast("int").alias("pos"), "name", F.explode(html.attributes("tok")).alias("attribute", "value"))


@job("page_outline")
def page_outline_job(spark, sf_dir):
    """Headings of the whole page, from its tokens."""
    ol = html.outline(html.page_state(tables.web_pages(spark, sf_dir)))
    return ol.select("page_id", F.col("pos").cast("int").alias("pos"), F.col("level").cast("int").alias("level"), "text")


# --------------------------------------------------------------------------- URLs and links

from ..functions import urls  # noqa: E402
from ..operators import links as L  # noqa: E402
from ..options import MAX_BYTES  # noqa: E402

SIZE_CAP_BYTES = MAX_BYTES[1]  # smallest allowed cap (10,000 bytes): it fires on the test pages


@job("url_gate")
def url_gate_job(spark, sf_dir):
    """Page URLs and raw hrefs as fetch candidates -> accepted (normalised) or reason."""
    return L.url_gate(spark, sf_dir)


@job("link_resolve")
def link_resolve_job(spark, sf_dir):
    """Every raw href resolved against its page's final URL, or the drop reason."""
    r = L.resolved_links(spark, sf_dir)
    return r.select("page_id", F.col("link_pos").cast("int").alias("link_pos"), "href", "resolved", "drop_reason")


@job("link_drop_stats")
def link_drop_stats_job(spark, sf_dir):
    """U4: link outcomes (resolved or drop reason) counted per page host."""
    return L.drop_stats(L.resolved_links(spark, sf_dir))


@job("page_links")
def page_links_job(spark, sf_dir):
    """L1: all resolved links per page, not deduplicated, document order."""
    return L.page_links(L.resolved_links(spark, sf_dir)).select(
        "page_id", F.col("link_pos").cast("int").alias("link_pos"), "text", "href")


@job("link_inventory")
def link_inventory_job(spark, sf_dir):
    """L2/A4: resolved, deduplicated by href (first label wins), first 50 per page."""
    return L.inventory(L.resolved_links(spark, sf_dir), limit=None)


@job("link_count")
def link_count_job(spark, sf_dir):
    """A1: links per page after dedupe + limit; pages without links count 0."""
    inv = L.inventory(L.resolved_links(spark, sf_dir), limit=None)
    return L.link_count(tables.pages(spark, sf_dir), inv)


@job("host_edges")
def host_edges_job(spark, sf_dir):
    """A5: host-to-host link counts (links and distinct source pages)."""
    return L.host_edges(L.resolved_links(spark, sf_dir))


@job("link_to_page")
def link_to_page_job(spark, sf_dir):
    """Resolved links that point at captured pages."""
    return L.link_to_page(L.resolved_links(spark, sf_dir), L.gated_pages(spark, sf_dir))


@job("frontier")
def frontier_job(spark, sf_dir):
    """Resolved link targets that are not captured pages, with how many pages point there."""
    return L.frontier(L.resolved_links(spark, sf_dir), L.gated_pages(spark, sf_dir))


@job("page_extract")
def page_extract_job(spark, sf_dir):
    """P20 (flagship of web_fetch): title, markdown content, length, truncated, resolved links."""
    return L.page_extract(spark, sf_dir, ExtractOptions.of("markdown"))


@job("web_fetch")
def web_fetch_job(spark, sf_dir):
    """Every page URL fetched from the captured log, from redirects to extracted page."""
    return L.web_fetch(tables.response_log(spark, sf_dir), tables.pages(spark, sf_dir))


@job("web_links")
def web_links_job(spark, sf_dir):
    """Link inventory of every page URL fetched from the captured log."""
    return L.web_links(tables.response_log(spark, sf_dir), tables.pages(spark, sf_dir))


def _feed_reads(spark, sf_dir):
    """The log of pages and feeds side by side, and all URLs to read as feeds."""
    log = tables.response_log(spark, sf_dir).unionByName(tables.feed_log(spark, sf_dir))
    starts = tables.feeds(spark, sf_dir).select((-1 - F.col("first_doc")).alias("page_id"), "url").unionByName(tables.pages(spark, sf_dir).select("page_id", "url"))
    return log, starts


@job("web_feed")
def web_feed_job(spark, sf_dir):
    """Every feed and page URL read as a feed from the captured log, one row each (byte cap 10,000)."""
    log, starts = _feed_reads(spark, sf_dir)
    return L.web_feed(log, starts, max_bytes=SIZE_CAP_BYTES).drop("entries")


@job("web_feed_entries")
def web_feed_entries_job(spark, sf_dir):
    """The entries of those reads, in order, with content."""
    log, starts = _feed_reads(spark, sf_dir)
    r = L.web_feed(log, starts, max_items=50, include_content=True, max_bytes=SIZE_CAP_BYTES)
    return r.select("page_id", "final_url", F.posexplode("entries").alias("pos", "e")).select("page_id", "final_url", "pos", "e.*")


# --------------------------------------------------------------------------- reports

from ..operators import reports as R  # noqa: E402


@job("fetch_report")
def fetch_report_job(spark, sf_dir):
    """Readable page listing per page."""
    return R.fetch_report(L.page_extract(spark, sf_dir, ExtractOptions.of("markdown")))


@job("links_report")
def links_report_job(spark, sf_dir):
    """Numbered link listing per page ('no links found' for pages without)."""
    pg = L.all_pages(spark, sf_dir)
    return R.links_report(pg, L.inventory(L.resolved_links(spark, sf_dir), limit=None))


# --------------------------------------------------------------------------- feeds

from ..operators import feeds as FD  # noqa: E402


@job("feed_kind")
def feed_kind_job(spark, sf_dir):
    """feed kind and title; pages read as feeds are rejected with the reference message."""
    f = tables.feeds(spark, sf_dir).select("feed_id", "xml")
    pg = tables.pages(spark, sf_dir).select(F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("feed_id"),
                                            F.col("html").alias("xml"))
    return FD.parse_feeds(f.unionByName(pg)).select("feed_id", "kind", "feed_title", "error")


@job("rss_items")
def rss_items_job(spark, sf_dir):
    """Every RSS item with cleaned fields."""
    e = FD.entries(FD.parse_feeds(tables.feeds(spark, sf_dir)))
    return e.filter(F.col("kind") == "rss").drop("kind")


@job("atom_entries")
def atom_entries_job(spark, sf_dir):
    """Every Atom entry with cleaned fields and the chosen link."""
    e = FD.entries(FD.parse_feeds(tables.feeds(spark, sf_dir)))
    return e.filter(F.col("kind") == "atom").drop("kind")


@job("feed_entries")
def feed_entries_job(spark, sf_dir):
    """web_feed entries, default 10 per feed, summaries only."""
    return FD.feed_items(FD.parse_feeds(tables.feeds(spark, sf_dir)))


@job("feed_entries_full")
def feed_entries_full_job(spark, sf_dir):
    """F10 with maxItems=50 and includeContent=true."""
    return FD.feed_items(FD.parse_feeds(tables.feeds(spark, sf_dir)), max_items=50, include_content=True)


@job("feed_entry_count")
def feed_entry_count_job(spark, sf_dir):
    """A2: entries returned per feed."""
    p = FD.parse_feeds(tables.feeds(spark, sf_dir))
    return FD.entry_counts(p, FD.feed_items(p))


@job("feed_report")
def feed_report_job(spark, sf_dir):
    """Rendered feed listing."""
    p = FD.parse_feeds(tables.feeds(spark, sf_dir)).filter(F.col("kind").isNotNull())
    return R.feed_report(p, FD.feed_items(p))


# --------------------------------------------------------------------------- responses

from ..operators import responses as RS  # noqa: E402


@job("response_scan")
def response_scan_job(spark, sf_dir):
    """Captured response log (body as its byte length)."""
    r = tables.response_log(spark, sf_dir)
    return r.select("page_id", "url", "status", "location", "content_type", "elapsed_ms",
                    F.octet_length("body").cast("int").alias("n_bytes"), F.md5("body").alias("body_md5"))


@job("status_gate")
def status_gate_job(spark, sf_dir):
    """R2: 2xx accepted, 301/302/303/307/308 redirect, anything else rejected as 'HTTP <status>'."""
    r = tables.response_log(spark, sf_dir)
    cls = RS.status_class("status")
    return r.select("page_id", "status", cls.alias("class"),
                    F.when(cls == "rejected", F.concat(F.lit("HTTP "), F.col("status").cast("string"))).alias("reason"))


@job("content_type_gate")
def content_type_gate_job(spark, sf_dir):
    """Media type and whether the page / feed profiles accept it."""
    from ..functions.constants import FEED_TYPES, PAGE_TYPES
    r = tables.response_log(spark, sf_dir)
    mt = RS.media_type("content_type")
    return r.select("page_id", mt.alias("media_type"), mt.isin(*PAGE_TYPES).alias("page_ok"),
                    mt.isin(*FEED_TYPES).alias("feed_ok"))


@job("size_cap")
def size_cap_job(spark, sf_dir):
    """Bodies cut at maxBytes (10,000 here), truncation flagged."""
    r = RS.size_cap(tables.response_log(spark, sf_dir), SIZE_CAP_BYTES)
    return r.select("page_id", F.octet_length("body").cast("int").alias("n_bytes"),
                    F.octet_length("kept").cast("int").alias("kept_bytes"), "truncated")


@job("charset_detect")
def charset_detect_job(spark, sf_dir):
    """Charset from header, XML declaration or meta tag (first 2,048 bytes), else utf-8."""
    r = tables.response_log(spark, sf_dir)
    return r.select("page_id", RS.detect_charset("content_type", "body").alias("charset"))


@job("body_decode")
def body_decode_job(spark, sf_dir):
    """Body bytes decoded by the detected charset."""
    r = tables.response_log(spark, sf_dir).withColumn("charset", RS.detect_charset("content_type", "body"))
    text, decoder = RS.decode_body("body", "charset")
    return r.select("page_id", "charset", decoder.alias("decoder"), text.alias("text"))


@job("header_map")
def header_map_job(spark, sf_dir):
    """Raw heads -> status + lower-cased header keys, duplicates joined ', '."""
    return RS.header_map(tables.header_block(spark, sf_dir))


@job("redirect_resolve")
def redirect_resolve_job(spark, sf_dir):
    """Every page URL followed through the log (max 3 redirects), final URL and outcome."""
    log = tables.response_log(spark, sf_dir)
    return RS.resolve_redirects(log, tables.pages(spark, sf_dir)).drop("capture_id", "capture_url")


@job("fetch_outcome")
def fetch_outcome_job(spark, sf_dir):
    """Outcome classes of every captured fetch, counted per host."""
    log = tables.response_log(spark, sf_dir)
    r = RS.resolve_redirects(log, tables.pages(spark, sf_dir))
    g = urls.gate(r, "url", out="_u", reason="_w")
    return (g.select(F.coalesce(urls.host_of("_u"), F.lit("")).alias("host"), "outcome")
            .groupBy("host", "outcome").agg(F.count("*").alias("n")))


# --------------------------------------------------------------------------- hosts

from ..operators import hosts as H  # noqa: E402


def _page_hosts(spark, sf_dir):
    g = L.gated_pages(spark, sf_dir)
    return g.select("page_id", urls.host_of("final_url").alias("host"),
                    F.regexp_extract("final_url", "^([a-z]+):", 1).alias("scheme"))


@job("host_rule_match")
def host_rule_match_job(spark, sf_dir):
    """Pages whose host matches the rule list (exact, suffix, wildcard, port-stripped)."""
    return H.match_names(_page_hosts(spark, sf_dir), "page_id", "host", H.DEFAULT_NO_PROXY).select(
        "page_id", "host", F.col("name_match").alias("bypass"))


@job("cidr_match")
def cidr_match_job(spark, sf_dir):
    """Addresses inside the IPv4 networks of the rule list."""
    ips = tables.host_ips(spark, sf_dir)
    return H.match_cidrs(ips, "event_id", "ip", H.DEFAULT_NO_PROXY).select("event_id", "ip", "cidr_match")


@job("host_rule_table")
def host_rule_table_job(spark, sf_dir):
    """J1 with a rule table: page hosts joined with the rules by exact and suffix keys."""
    rules = H.parsed_rules(tables.host_rules(spark, sf_dir))
    return H.match_name_table(_page_hosts(spark, sf_dir), "host", rules).select("page_id", "host", F.col("name_match").alias("bypass"), "name_rules")


@job("cidr_rule_table")
def cidr_rule_table_job(spark, sf_dir):
    """J2 with a rule table: addresses joined with the networks by (bits, masked address)."""
    rules = H.parsed_rules(tables.host_rules(spark, sf_dir))
    return H.match_cidr_table(tables.host_ips(spark, sf_dir), "ip", rules).select("event_id", "ip", "cidr_match", "cidr_bits")


@job("route_assign")
def route_assign_job(spark, sf_dir):
    """Route per page URL (bypass -> direct, else the scheme's proxy), counted."""
    ph = _page_hosts(spark, sf_dir)
    m = H.match_names(ph, "page_id", "host", H.DEFAULT_NO_PROXY)
    m = m.withColumn("ipn", H.ipv4_int(F.col("host")))
    m = H.match_cidrs(m, "page_id", "host", H.DEFAULT_NO_PROXY)
    r = H.route(F.col("scheme"), F.col("name_match") | F.col("cidr_match"), H.DEFAULT_HTTP_PROXY,
                H.DEFAULT_HTTPS_PROXY)
    return m.select(r.alias("route")).groupBy("route").agg(F.count("*").alias("n"))


# --------------------------------------------------------------------------- sinks and streams

from ..sources import sinks  # noqa: E402
from ..streaming import jobs as ST  # noqa: E402


def _written_twice(spark, df, name, fmt, url_col):
    """Written, written again as the same run, and read by the manifest."""
    path = ST._run_dir(spark, "s5") + "/" + name
    for _ in range(2):
        sinks.write_by_host(df, path, "1", url_col, fmt)
    return sinks.read_committed(spark, path, fmt)


@job("write_pages")
def write_pages_job(spark, sf_dir):
    """page_extract written as Parquet, clustered by host, read back."""
    return _written_twice(spark, L.page_extract(spark, sf_dir, ExtractOptions.of("markdown")).drop("reject_reason"), "pages", "parquet", "final_url")


@job("write_links")
def write_links_job(spark, sf_dir):
    """Resolved links written as JSON, clustered by their target's host, read back."""
    links = L.page_links(L.resolved_links(spark, sf_dir)).select("page_id", F.col("link_pos").cast("int").alias("link_pos"), "text", "href")
    return _written_twice(spark, links, "links", "json", "href")


@job("write_entries")
def write_entries_job(spark, sf_dir):
    """Feed entries written as JSON, clustered by their link's host, read back."""
    return _written_twice(spark, FD.feed_items(FD.parse_feeds(tables.feeds(spark, sf_dir))), "entries", "json", "url")


@job("stream_pages")
def stream_pages_job(spark, sf_dir):
    """ST1: pages arriving as files, extracted per micro-batch (equals page_markdown)."""
    return ST.stream_pages_job(spark, sf_dir)


@job("stream_feed_entries")
def stream_feed_entries_job(spark, sf_dir):
    """ST2: feeds polled twice; entries deduplicated by URL within the watermark (equals feed_entries)."""
    return ST.stream_feed_entries_job(spark, sf_dir)


@job("published_ts")
def published_ts_job(spark, sf_dir):
    """entry dates normalised to UTC (session time zone is UTC)."""
    e = FD.entries(FD.parse_feeds(tables.feeds(spark, sf_dir)))
    return e.select("feed_id", "pos", "published", FD.published_utc("published").alias("published_utc"))
