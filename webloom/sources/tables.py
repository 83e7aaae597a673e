"""Input tables: the captured crawl and the views derived from it.

``pages`` is read as is; ``feeds``, ``response_log``, ``header_block``,
``host_rules`` and ``host_ips`` are derived from the driver tables by
Spark SQL that DuckDB reproduces row for row (see ``plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages(page_id BIGINT, url STRING, html STRING)``"""
    return read(spark, sf_dir, "pages")


# Fixed values of the fixture: what a page gets at its end, by page_id modulo their number (``{url}``: its own URL).
SNIPPETS = (
    '<p>one<br>two<br><br><a href="../up/x?a=1&amp;b=2">up <b>bold</b><br>down</a><br>tail</p>',
    "<pre>x = 1\n  y = 2</pre></pre><p>after</p>",
    '<img src="pic.png" alt=" a pic "><img alt=only ALT="last wins"><a href="/img"><img src=i.gif alt=in></a>',
    '<ol><li>soup<li><a href="//cdn.example.net/s">bread</a></ol><hr><h5>Deep &lt;head&gt;</h5>',
    '<a href="mailto:a@b.test">m</a><a href="javascript:void(0)">j</a><a href="#x">h</a><a href=" tel:1">t</a><a href="data:,x">d</a><a>none</a>',
    'see <a href="{url}">itself</a> and <a href="{url}">again</a>',
    '<a href="http:/one-slash">1</a><a href="https:two">2</a><a href="http://h%41.example.com/p">3</a><a href="http://u:p@example.com/">4</a><a href="http://e%zz.com/">5</a>',
    '<svg><title>Drawn</title><a href="/in-svg">no label</a></svg><script>var a = "<p>";</script><!-- <a href="/gone"> --><p>shown',
    "<pre>a<code>b</code></pre>c<code>d</code><blockquote>q</blockquote>",
    "<p>&#65;&#x42;&nbsp;&copy;&bogus;&#xD800;&amp;lt;</p>",
    '<a href="?only=query">q</a><a href="a/./b/../c">rel</a><a href="\\back">bs</a><a href="/sp ace/\u00e9?q=1 2#fr ag">enc</a>',
    "",
)


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with a snippet at the end of each, so that fences, images, soft breaks, all kinds of hrefs and links
    to captured pages occur."""
    from pyspark.sql import functions as F
    k, extra = F.col("page_id") % len(SNIPPETS), F.lit("")
    for i, text in enumerate(SNIPPETS):
        extra = F.when(k == i, F.replace(F.lit(text), F.lit("{url}"), F.col("url")) if "{url}" in text else F.lit(text)).otherwise(extra)
    return pages(spark, sf_dir).select("page_id", "url", F.concat(F.coalesce("html", F.lit("")), extra).alias("html"))


# Feeds are built from ``documents``: one feed per (group, lang, doc_id bucket); the first sources share the group
# 'mixed', whose feeds are longer than any limit of entries. lang 'en' -> RSS 2.0, other languages -> Atom.  The bucket
# bounds every feed, so no group grows with the data.  Descriptions and titles carry the whole document text (the 500 /
# 2,000 caps are web_feed's), dates come in six forms.
FEED_BUCKET, MIXED_BUCKET = 50, 400
MIXED = ("src0", "src1", "src2", "src3", "src4")


def _esc(c):
    from pyspark.sql import functions as F
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _rss_item(r):
    from pyspark.sql import functions as F
    return F.concat(
        F.lit("<item><title>"), r["esc"], F.lit("</title><link>/doc/"), r["doc_id"].cast("string"),
        F.lit("</link><dc:date>"), r["ts"], F.lit("</dc:date><dc:creator>"), r["source"],
        F.lit("</dc:creator><description>"), r["esc"],
        F.lit("</description><content:encoded><![CDATA[<p>"), F.replace(r["text"], F.lit("]]>"), F.lit(" ")),
        F.lit("</p>]]></content:encoded></item>"))


def _atom_entry(r):
    from pyspark.sql import functions as F
    did = r["doc_id"].cast("string")
    return F.concat(
        F.lit("<entry><title>"), r["esc"], F.lit("</title><link rel=\"self\" href=\"/self/"), did,
        F.lit("\"/><link rel=\"alternate\" href=\"/doc/"), did, F.lit("\"/><updated>"), r["ts"],
        F.lit("</updated><author><name>"), r["source"], F.lit("</name></author><summary type=\"html\">&lt;p&gt;"),
        r["esc"], F.lit("&lt;/p&gt;</summary></entry>"))


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feeds(feed_id, url, xml, final_url, truncated, first_doc)``"""
    from pyspark.sql import functions as F

    from ..functions import urls
    d = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,cast(doc_id as int),0,0)")
    k = F.col("doc_id") % 6
    ts = (F.when(k == 1, F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(k == 2, F.date_format(at, "dd MMM yy HH:mm '+0000'"))
          .when(k == 3, F.date_format(at, "dd MMMM yyyy")).when(k == 4, F.date_format(at, "yyyy-MM-dd"))
          .when(k == 5, F.date_format(at + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    # texts travel as they are and become entries behind the shuffle: an entry holds its text up to three times
    mixed = F.col("source").isin(*MIXED)
    g = d.select(F.when(mixed, F.lit("mixed")).otherwise(F.col("source")).alias("grp"), "lang",
                 F.floor(F.col("doc_id") / F.when(mixed, MIXED_BUCKET).otherwise(FEED_BUCKET)).cast("bigint").alias("bucket"), "doc_id",
                 F.struct("doc_id", ts.alias("ts"), "text", "source").alias("doc"))
    agg = g.groupBy("grp", "lang", "bucket").agg(F.collect_list("doc").alias("docs"), F.min("doc_id").alias("first_doc"))
    escaped = F.transform("docs", lambda r: F.struct(r["doc_id"].alias("doc_id"), r["ts"].alias("ts"), r["text"].alias("text"),
                                                     r["source"].alias("source"), _esc(r["text"]).alias("esc")))
    entry = F.transform(escaped, lambda r: F.struct(r["doc_id"].alias("doc_id"), F.when(F.col("lang") == "en", _rss_item(r)).otherwise(_atom_entry(r)).alias("x")))
    agg = agg.withColumn("body", F.array_join(F.transform(F.array_sort(entry), lambda r: r["x"]), ""))
    head = F.concat(F.col("grp"), F.lit(" "), F.col("lang"))
    xml = F.when(F.col("lang") == "en", F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>'), head,
        F.lit("</title>"), F.col("body"), F.lit("</channel></rss>"))).otherwise(F.concat(
            F.lit('<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>'), head,
            F.lit("</title>"), F.col("body"), F.lit("</feed>")))
    b = F.col("bucket").cast("string")
    f = agg.select(
        F.concat_ws("/", "grp", "lang", b).alias("feed_id"),
        F.concat(F.lit("https://"), F.col("grp"), F.lit(".example.com/"), F.col("lang"), F.lit("/feed-"), b,
                 F.lit(".xml")).alias("url"),
        xml.alias("xml"), "first_doc")
    return urls.gate(f, "url").select("feed_id", "url", "xml", "final_url", F.lit(False).alias("truncated"), "first_doc")


def feed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured responses of feed URLs, with the columns of ``response_log``; page_id is -1 - the feed's first doc_id.

    By first doc_id modulo 8: moved to another URL (two captures), the dialect's own type, ``text/xml``, a feed sent
    as HTML, JSON, an HTML page in its place, a body that could not be read, ``application/xml``.
    """
    from pyspark.sql import functions as F
    f = feeds(spark, sf_dir).select((-1 - F.col("first_doc")).alias("page_id"), "url", "xml", (F.col("first_doc") % 8).alias("k"), "feed_id")
    k, url = F.col("k"), F.col("url")
    own = F.when(F.split("feed_id", "/")[1] == "en", F.lit("application/rss+xml")).otherwise(F.lit("application/atom+xml; charset=UTF-8"))
    ctype = (F.when(k == 1, own).when(k == 2, F.lit("text/xml")).when(k == 3, F.lit("text/html; charset=utf-8")).when(k == 4, F.lit("application/json"))
             .when(k == 5, F.lit("text/html")).otherwise(F.lit(" Application/XML ")))
    body = F.when(k == 5, F.lit("<html><title>moved away</title></html>")).otherwise(F.col("xml"))
    plain = f.select("page_id", F.when(k == 0, F.concat(url, F.lit("?v=2"))).otherwise(url).alias("url"), F.lit(200).alias("status"),
                     F.lit(None).cast("string").alias("location"), ctype.alias("content_type"), F.lit(20).alias("elapsed_ms"),
                     F.when(k == 6, F.lit("reset")).alias("body_error"), F.encode(body, "UTF-8").alias("body"))
    moved = f.filter(k == 0).select("page_id", "url", F.lit(301).alias("status"), F.lit("?v=2").alias("location"), F.lit("text/html").alias("content_type"),
                                    F.lit(10).alias("elapsed_ms"), F.lit(None).cast("string").alias("body_error"), F.encode(F.lit(""), "UTF-8").alias("body"))
    return plain.unionByName(moved)


def response_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured responses derived from ``pages``: redirect chains of 0-3 hops, a self-loop, a missing
    Location, 404s, wrong / missing content types, plain text, labels of other charsets (on ASCII pages, where the
    text is the same), bodies that could not be read and slow responses.

    ``response_log(page_id, url, status, location, content_type, elapsed_ms, body_error, body BINARY)``
    """
    from pyspark.sql import functions as F
    p = pages(spark, sf_dir).alias("p")
    n = pages(spark, sf_dir).select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    j = p.join(n, "page_id", "left")
    pid = F.col("page_id")
    status = (F.when(pid % 50 == 49, 302).when(pid % 10 == 0, 302).when(pid % 20 == 1, 301)
              .when(pid % 25 == 7, 404).when(pid % 25 == 8, 302).otherwise(200))
    location = (F.when(pid % 50 == 49, F.col("url"))
                .when((pid % 10 == 0) | (pid % 20 == 1), F.coalesce("next_url", F.lit("https://gone.example.com/"))))
    ascii_only = F.length("html") == F.octet_length("html")
    ctype = (F.when(pid % 15 == 4, F.lit("application/json")).when(pid % 15 == 5, F.lit(None)).when(pid % 15 == 6, F.lit("Text/Plain"))
             .when(ascii_only & (pid % 15 == 7), F.lit("text/html; charset=ISO-8859-1")).when(ascii_only & (pid % 15 == 9), F.lit('text/html;charset="windows-1251"'))
             .when(ascii_only & (pid % 15 == 11), F.lit("application/xhtml+xml; charset=big5")).otherwise(F.lit("text/html; charset=utf-8")))
    return j.select("page_id", "url", status.cast("int").alias("status"), location.alias("location"),
                    ctype.cast("string").alias("content_type"),
                    ((pid * 37) % 12000).cast("int").alias("elapsed_ms"), F.when(pid % 40 == 13, F.lit("reset")).alias("body_error"),
                    F.encode("html", "UTF-8").alias("body"))


def header_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw response heads ``(page_id, head)``; every 50th (page_id % 50 = 3) has a malformed status line."""
    from pyspark.sql import functions as F
    r = response_log(spark, sf_dir)
    crlf = F.lit("\r\n")
    first = F.when(F.col("page_id") % 50 == 3, F.lit("HTTP/x 200 X")).otherwise(
        F.concat(F.lit("HTTP/1.1 "), F.col("status").cast("string"), F.lit(" X")))
    return r.select("page_id", F.concat(first, crlf, F.lit("Content-Type: "), F.coalesce("content_type", F.lit("")),
                                        crlf, F.lit("X-A: 1"), crlf, F.lit("x-a: 2")).alias("head"))


def host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``host_rules(rule)``: a rule table that grows with the data, from the hosts of ``pages`` and the users of ``events``.

    By page_id modulo 7: the host with a port, its parent with ``*.`` or a leading dot, the host in upper case, a host
    below it, nothing. By event_id modulo 11: networks of 8 to 32 bits, one without bits and one with too many.
    """
    from pyspark.sql import functions as F
    p = pages(spark, sf_dir).select("page_id", F.regexp_extract("url", "://([^/:?#]*)", 1).alias("h")).filter("page_id % 3 = 0")
    k, parent = F.col("page_id") % 7, F.regexp_extract("h", "^[^.]*(\\..*)$", 1)
    names = p.select(F.when(k == 0, F.concat("h", F.lit(":8080"))).when(k == 1, F.concat(F.lit("*"), parent)).when(k == 2, F.concat(F.lit(" "), parent))
                     .when(k == 3, F.upper("h")).when(k == 4, F.concat(F.lit("sub."), F.col("h"))).otherwise(F.lit("")).alias("rule")) \
        .filter("rule <> '.example.com' and rule <> '*.example.com'")
    e = read(spark, sf_dir, "events").filter("event_id % 5 = 0")
    m, user, low = F.col("event_id") % 11, (F.col("user_id") % 8).cast("string"), (F.col("event_id") % 256).cast("string")
    bits = F.when(m < 4, F.lit("28")).when(m < 7, F.lit("31")).when(m == 7, F.lit("32")).when(m == 8, F.lit("")).when(m == 9, F.lit("33")).otherwise(F.lit("30"))
    nets = e.select(F.concat(F.lit("10.0."), user, F.lit("."), low, F.lit("/"), bits).alias("rule"))
    wide = e.limit(0).select(F.lit("").alias("rule")).unionByName(spark.createDataFrame([("10.9.0.0/16",), ("192.0.0.0/9",), ("10.0.6.0/24",)], "rule string"))
    return names.unionByName(nets).unionByName(wide)


def host_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``host_ips(event_id, ip)`` from ``events``; every 100th address is invalid (300.1.1.1)."""
    from pyspark.sql import functions as F
    e = read(spark, sf_dir, "events")
    return e.select("event_id", F.when(F.col("event_id") % 100 == 0, F.lit("300.1.1.1")).otherwise(
        F.concat(F.lit("10.0."), (F.col("user_id") % 8).cast("string"), F.lit("."),
                 (F.col("event_id") % 256).cast("string"))).alias("ip"))
