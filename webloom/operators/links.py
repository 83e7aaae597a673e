"""Link jobs: gate, resolve, page links, inventory (dedupe + limit), counts, graph.

All joins are equi-joins on ``page_id`` or on the normalised URL; Catalyst
and AQE choose broadcast / sort-merge and split skewed keys (a hub URL
linked from a third of all pages is a skewed join key, handled by the
AQE skew-join split, not by dropping rows).  Aggregations are partial +
final, so a hot host or URL collapses map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..options import LINK_LIMIT, ExtractOptions, clamp
from ..sources import tables
from . import feeds, html, responses


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, final_url, reason)``: pages that the gate rejects have no final URL but a reason."""
    return urls.gate(tables.pages(spark, sf_dir).select("page_id", "url"), "url").select("page_id", "url", "final_url", "reason")


def gated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, final_url)`` for pages whose URL passes the gate."""
    return all_pages(spark, sf_dir).filter(F.col("final_url").isNotNull()).drop("reason")


def url_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.pages(spark, sf_dir)
    cand = pages.select("page_id", F.lit(None).cast("int").alias("link_pos"), F.col("url").alias("input"))
    # links are gated as they would be fetched: resolved; an href that does not resolve is gated as it stands
    rl = resolved_links(spark, sf_dir).select(
        "page_id", F.col("link_pos").cast("int").alias("link_pos"), F.coalesce("resolved", "href").alias("input"))
    g = urls.gate(cand.unionByName(rl), "input")
    return g.select("page_id", "link_pos", "input", F.col("reason").isNull().alias("accepted"),
                    "final_url", "reason")


def resolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw links joined to their page's final URL and resolved: adds ``resolved``, ``drop_reason``.

    Links of a page that the gate rejects are kept, unresolved, with ``page rejected`` as the reason.
    """
    rl = html.raw_links(html.page_state(tables.web_pages(spark, sf_dir)))
    j = rl.join(all_pages(spark, sf_dir).select("page_id", "final_url"), "page_id")
    r = urls.resolve(j, "href", "final_url")
    rejected = F.col("final_url").isNull()
    return r.withColumns({"resolved": F.when(~rejected, F.col("resolved")),
                          "drop_reason": F.when(rejected, F.lit("page rejected")).otherwise(F.col("drop_reason"))})


def page_links(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("resolved").isNotNull()).select(
        "page_id", "link_pos", "text", F.col("resolved").alias("href"))


def inventory(resolved: DataFrame, limit: int | None = None) -> DataFrame:
    """Deduplicate by resolved href keeping the first label, then the first ``limit`` per page."""
    n = clamp(limit, LINK_LIMIT)
    ok = resolved.filter(F.col("resolved").isNotNull())
    first = ok.groupBy("page_id", "resolved").agg(
        F.min("link_pos").alias("link_pos"), F.min_by("text", "link_pos").alias("text"))
    w = Window.partitionBy("page_id").orderBy("link_pos")
    ranked = first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return ranked.select("page_id", F.col("rank").cast("int").alias("rank"), "text",
                         F.col("resolved").alias("href"))


def link_count(pages: DataFrame, inv: DataFrame) -> DataFrame:
    counts = inv.groupBy("page_id").agg(F.count("*").alias("n"))
    return (pages.select("page_id").join(counts, "page_id", "left")
            .select("page_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links")))


def drop_stats(resolved: DataFrame) -> DataFrame:
    return (resolved.select(urls.host_of("final_url").alias("host"),
                            F.coalesce("drop_reason", F.lit("resolved")).alias("outcome"))
            .groupBy("host", "outcome").agg(F.count("*").alias("n")))


def host_edges(resolved: DataFrame) -> DataFrame:
    ok = resolved.filter(F.col("resolved").isNotNull())
    e = ok.select(urls.host_of("final_url").alias("src_host"), urls.host_of("resolved").alias("dst_host"), "page_id")
    return e.groupBy("src_host", "dst_host").agg(
        F.count("*").alias("n_links"), F.countDistinct("page_id").alias("n_pages"))


def link_to_page(resolved: DataFrame, pages: DataFrame) -> DataFrame:
    # pre-aggregate per (source page, target) before the join on the URL
    pairs = (resolved.filter(F.col("resolved").isNotNull())
             .groupBy("page_id", "resolved").agg(F.count("*").alias("n_links")))
    dst = pages.select(F.col("page_id").alias("dst_page_id"), F.col("final_url").alias("resolved"))
    return (pairs.join(dst, "resolved")
            .select(F.col("page_id").alias("src_page_id"), "dst_page_id", "n_links"))


def frontier(resolved: DataFrame, pages: DataFrame) -> DataFrame:
    targets = (resolved.filter(F.col("resolved").isNotNull())
               .select(F.col("resolved").alias("href"), "page_id").distinct())
    captured = pages.select(F.col("final_url").alias("href"))
    return (targets.join(captured, "href", "left_anti")
            .groupBy("href").agg(F.count("*").alias("n_pages")))


def with_links(ex: DataFrame) -> DataFrame:
    """Extracted pages with ``final_url`` -> their ``links`` resolved, counted and rendered.

    ``ex`` is clustered by page_id, and so are the exploded links and their aggregate: no further shuffle. Only the
    first link of a page carries the page's own columns.
    """
    own = [c for c in ex.columns if c not in ("page_id", "links", "final_url")]
    e = ex.select("page_id", "final_url", F.struct(*own).alias("own"), F.posexplode_outer("links").alias("lpos", "l"))
    e = e.select("page_id", "final_url", F.when(F.coalesce("lpos", F.lit(0)) == 0, F.col("own")).alias("own"), "lpos",
                 F.col("l.href").alias("l_href"), F.col("l.text").alias("l_text"))
    e = urls.resolve(e, "l_href", "final_url")
    usable = F.col("resolved").isNotNull() & F.col("final_url").isNotNull()
    agg = e.groupBy("page_id").agg(
        F.first("final_url", True).alias("final_url"), F.first("own", True).alias("own"),
        F.collect_list(F.when(usable, F.struct("lpos", F.col("l_text").alias("text"), F.col("resolved").alias("href")))).alias("lk"))
    return agg.select("page_id", "final_url", "own.*", F.size("lk").cast("int").alias("link_count"), F.array_join(
        F.transform(F.array_sort("lk"), lambda x: F.concat(x["text"], F.lit("\t"), x["href"])), "\n").alias("links_text"))


def page_extract(spark: SparkSession, sf_dir: str, opts: ExtractOptions = ExtractOptions()) -> DataFrame:
    """P20: one window pass for title, content and links; links resolved against the final URL.

    A page that the gate rejects keeps its row, with the reason and without final URL, status and links.
    """
    ex = html.extract(tables.web_pages(spark, sf_dir), opts).join(all_pages(spark, sf_dir), "page_id")
    return with_links(ex).select(
        "page_id", "url", "final_url", F.when(F.col("final_url").isNotNull(), F.lit(200)).alias("status"), "title", "content",
        F.col("length").cast("int").alias("length"), "truncated", "link_count", "links_text", F.col("reason").alias("reject_reason"))


def captured_bodies(log: DataFrame, fetched: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``(page_id, html)`` of every capture that answers a start of ``fetched``, capped and decoded once.

    ``page_id`` is the capture: a struct of its id and URL, the base of its links, the decoder and whether the byte
    cap has cut. So all a page needs travels as its key, bodies are read once, and two URLs that share an id stay two.
    """
    base = F.substring_index("final_url", "#", 1)
    asked = fetched.filter(F.col("outcome") == "ok").select("capture_id", "capture_url", base.alias("base")).distinct()
    bodies = responses.size_cap(log.select("page_id", "url", "content_type", "body"), max_bytes).select(
        F.col("page_id").alias("capture_id"), F.col("url").alias("capture_url"), "content_type", "kept", F.col("truncated").alias("body_cut"))
    got = asked.join(bodies, ["capture_id", "capture_url"]).withColumn("charset", responses.detect_charset("content_type", "kept"))
    text, decoder = responses.decode_body("kept", "charset")
    got = urls.settled(got, ["capture_id", "capture_url", "base", "body_cut"], {"html": text, "decoder": decoder})
    return got.select(F.struct("capture_id", "capture_url", "base", "decoder", "body_cut").alias("page_id"), "html")


def to_starts(fetched: DataFrame, captures: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of each start's capture beside the start; a start without one keeps its row and outcome.

    Failed starts do not take part in the join, where they would all share the null key.
    """
    head = ["page_id", "url", "final_url", "hops", "status", "outcome"]
    ok = fetched.filter(F.col("outcome") == "ok").select(*head, "capture_id", "capture_url").join(
        captures.select("page_id.capture_id", "page_id.capture_url", *columns), ["capture_id", "capture_url"], "left")
    rest = fetched.filter(F.col("outcome") != "ok").select(*head)
    return ok.select(*head, *columns).unionByName(rest, allowMissingColumns=True)


def web_fetch(log: DataFrame, starts: DataFrame, opts: ExtractOptions = ExtractOptions(), max_bytes: int | None = None,
              max_redirects: int | None = None) -> DataFrame:
    """E1, the whole fetch of every start URL from the captured log: redirects, status and type gates, byte cap,
    charset, decoding, extraction, links against the final URL.

    ``truncated``: the byte cap or the content cap has cut. A start that ends otherwise than ok keeps its row, with
    the outcome and without page columns. Each capture is extracted once, however many starts lead to it; the byte
    cap bounds every page that reaches the window plan.
    """
    r = responses.resolve_redirects(log, starts, max_redirects)
    ex = html.extract(captured_bodies(log, r, max_bytes), opts)
    done = with_links(ex.withColumn("final_url", F.col("page_id.base"))).drop("final_url").select(
        "page_id", F.col("page_id.decoder").alias("decoder"), "title", "content", F.col("length").cast("int").alias("length"),
        (F.col("truncated") | F.col("page_id.body_cut")).alias("truncated"), "link_count", "links_text")
    return to_starts(r, done, ["decoder", "title", "content", "length", "truncated", "link_count", "links_text"])


def web_links(log: DataFrame, starts: DataFrame, limit: int | None = None, max_bytes: int | None = None, max_redirects: int | None = None) -> DataFrame:
    """The link inventory of every start URL from the captured log: ``link_count`` and ``links_text`` (label, tab,
    target a line) beside the start's outcome; resolved against the final URL, first label of each target, first
    ``limit`` in document order."""
    r = responses.resolve_redirects(log, starts, max_redirects)
    bodies = captured_bodies(log, r, max_bytes)
    rl = html.raw_links(html.page_state(bodies)).withColumn("base", F.col("page_id.base"))
    inv = inventory(urls.resolve(rl, "href", "base"), limit)
    lines = F.array_sort(F.collect_list(F.struct("rank", F.concat("text", F.lit("\t"), "href").alias("line"))))
    per = inv.groupBy("page_id").agg(F.count("*").cast("int").alias("link_count"),
                                     F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("links_text"))
    out = to_starts(r, per, ["link_count", "links_text"])
    ok = F.col("outcome") == "ok"
    return out.withColumns({"link_count": F.when(ok, F.coalesce("link_count", F.lit(0))), "links_text": F.when(ok, F.coalesce("links_text", F.lit("")))})


def web_feed(log: DataFrame, starts: DataFrame, max_items: int | None = None, include_content: bool = False, max_bytes: int | None = None,
             max_redirects: int | None = None) -> DataFrame:
    """Every start URL read as a feed from the captured log: redirects, status and feed type gates, byte cap,
    charset, feed parsing; ``feed_title``, ``entry_count``, ``truncated`` (the byte cap alone) and ``entries`` in order.
    A response that is no feed keeps its row with the outcome 'not a feed'."""
    r = responses.resolve_redirects(log, starts, max_redirects, profile="feed")
    bodies = captured_bodies(log, r, max_bytes)
    parsed = feeds.parse_feeds(bodies.select(F.col("page_id").alias("feed_id"), F.col("html").alias("xml"), F.col("page_id.base").alias("final_url")))
    items = feeds.feed_items(parsed, max_items, include_content)
    fields = ["title", "url", "published", "author", "summary", "content"]
    entry = F.array_sort(F.collect_list(F.struct("pos", *fields)))
    per = items.groupBy("feed_id").agg(F.transform(entry, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("entries"))
    heads = parsed.select(F.col("feed_id").alias("page_id"), "kind", "feed_title", F.col("feed_id.body_cut").alias("truncated"))
    done = heads.join(per.withColumnRenamed("feed_id", "page_id"), "page_id", "left")
    out = to_starts(r, done, ["kind", "feed_title", "truncated", "entries"])
    ok, feed = F.col("outcome") == "ok", F.col("kind").isNotNull()
    none = F.array().cast(dict(per.dtypes)["entries"])
    return out.withColumns({"entries": F.when(ok & feed, F.coalesce("entries", none)), "truncated": F.when(ok & feed, F.col("truncated")),
                            "outcome": F.when(ok & ~feed, F.lit("not a feed")).otherwise(F.col("outcome"))}) \
        .withColumn("entry_count", F.size("entries")).withColumn("entry_count", F.when(F.col("entry_count") >= 0, F.col("entry_count"))).drop("kind")
