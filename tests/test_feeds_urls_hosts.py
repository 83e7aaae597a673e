"""Feeds, URLs, host rules, response heads, charsets, dates and redirects on hand-written cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from webloom.functions import text as T
from webloom.functions import urls
from webloom.operators import feeds as FD
from webloom.operators import hosts as H
from webloom.operators import links as L
from webloom.operators import responses as RS
from webloom.sources import tables

RSS = ("<rss version='2.0'><channel><title>Lighthouse &amp; Co</title>"
       "<item><title>Fog &lt;again&gt;</title><link>/fog</link><guid>https://ignored.test/1</guid><pubDate>Sat, 02 Mar 2024 07:30:00 +0200</pubDate>"
       "<dc:creator>Ines</dc:creator><description><![CDATA[<p>Thick <i>fog</i>&nbsp;&ndash; stay in.</p>]]></description>"
       "<content:encoded><![CDATA[<div>All day.</div><div>All night.</div>]]></content:encoded></item>"
       "<item><guid isPermaLink='true'>https://coast.test/p/2</guid><dc:date>2024-03-03</dc:date><author>desk@coast.test</author></item>"
       "<item><title>no end")
ATOM = ("<feed xmlns='http://www.w3.org/2005/Atom'><title>Tides</title>"
        "<entry><title>Spring</title><link rel='edit' href='/e/1'/><link rel='alternate' href='../a/1'/><updated>2024-03-01T00:00:00Z</updated>"
        "<author><name>Ola</name></author><summary>High</summary><content type='html'>&lt;b&gt;Higher&lt;/b&gt;</content></entry>"
        "<entry><title>Neap</title><link rel='enclosure' href='https://x.test/f.mp3'/><link href='https://x.test/neap'/></entry>"
        "<entry><title>Slack</title><link rel='self' href='mailto:a@b.test'/></entry></feed>")


@pytest.fixture(scope="module")
def parsed(spark):
    docs = [RSS, ATOM, "<html><title>page</title></html>", "", "<rss ><channel><title>none</title></channel></rss>"]
    return FD.parse_feeds(spark.createDataFrame([(f"f{i}", "u", d, "https://coast.test/feeds/all.xml") for i, d in enumerate(docs)],
                                                "feed_id string, url string, xml string, final_url string"))


def test_feed_kinds(parsed):
    got = {r.feed_id: (r.kind, r.feed_title, r.error is None) for r in parsed.collect()}
    assert got == {"f0": ("rss", "Lighthouse & Co", True), "f1": ("atom", "Tides", True), "f2": (None, None, False), "f3": (None, None, False), "f4": ("rss", "none", True)}


def test_entries(parsed):
    rows = {(r.feed_id, r.pos): r for r in FD.entries(parsed).collect()}
    assert sorted(rows) == [("f0", 0), ("f0", 1), ("f1", 0), ("f1", 1), ("f1", 2)]
    fields = ("title", "url", "published", "author", "summary", "content")
    assert [rows["f0", 0][f] for f in fields] == ["Fog", "/fog", "Sat, 02 Mar 2024 07:30:00 +0200", "Ines", "Thick fog – stay in.", "All day. All night."]
    assert [rows["f0", 1][f] for f in fields] == ["(untitled)", "https://coast.test/p/2", "2024-03-03", "desk@coast.test", "", ""]
    assert [rows["f1", 0][f] for f in fields] == ["Spring", "../a/1", "2024-03-01T00:00:00Z", "Ola", "High", "Higher"]
    assert [rows["f1", k].url for k in (1, 2)] == ["https://x.test/neap", "mailto:a@b.test"]


def test_blocks_equal_the_pattern_on_broken_feeds(spark):
    rng = random.Random(11)
    parts = ["<item>", "<item a='1'>", "<ITEM\n>", "</item>", "</Item>", "<item x", "<items>", ">", "text", "<b>", "</item", "\n", "<item </item>", "\u00a0"]
    docs = ["".join(rng.choices(parts, k=rng.randint(0, 16))) for _ in range(1500)]
    got = spark.createDataFrame([(d,) for d in docs], "d string").select("d", FD.tag_blocks(F.col("d"), "item").alias("b")).collect()
    space = "[\\s\u00a0\ufeff]"
    assert {r.d: r.b for r in got} == {d: re.findall(f"(?is)<item(?:{space}[^>]*)?>(.*?)</item>", d) for d in docs}
    channels = ["<channel><title>a</title></channel><channel>", "<CHANNEL x>in</channel>", "<channel>open", "<channels></channels>", "no", "</channel><channel >b</Channel>"]
    got = spark.createDataFrame([(d,) for d in channels], "d string").select("d", FD.channel_of(F.col("d")).alias("c")).collect()
    assert [r.c for r in got] == ["<title>a</title>", "in", "<channel>open", "<channels></channels>", "no", "b"] or [r.c for r in got][1].endswith("in")


def test_runs_equal_the_lazy_patterns(spark):
    rng = random.Random(12)
    parts = ["<title>", "<Title x='1'>", "</title>", "</TITLE>", "</titles>", "<", "</", ">", "text", "<![CDATA[", "]]>", "]", "]]", "\n", " ", "  ", "\u00a0", "\u2003", "\u3000", "\ufeff", "\t", "\u180e", "\x1c", "\x85", "é"]
    docs = ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(2000)]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    got = df.select("d", F.regexp_extract("d", FD.run_re("title"), 1).alias("run"), F.regexp_extract("d", FD.tag_re("title"), 1).alias("lazy"), T.unwrap_cdata("d").alias("cdata"),
                    T.collapse_ws("d").alias("ws"), T.js_trim("d").alias("trim"), T.strip_tags("d").alias("tags")).collect()
    space = "[\t-\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
    for r in got:
        assert r.run == r.lazy == next(iter(re.findall(r"(?is)<title\b[^>]*>(.*?)</title>", r.d)), ""), r.d
        assert r.cdata == re.sub(r"(?s)<!\[CDATA\[(.*?)\]\]>", r"\1", r.d), r.d
        assert r.trim == re.sub(f"\\A{space}+|{space}+\\Z", "", r.d) and r.ws == re.sub(f"^{space}+|{space}+$", "", re.sub(f"{space}+", " ", r.d)), repr(r.d)
        assert r.tags == re.sub("<[^>]*>", "", r.d), r.d


def test_texts_of_a_feed_are_shuffled_once(spark, tmp_path):
    """Entries hold a text up to three times: they are put together behind the shuffle, which carries plain texts."""
    rows = [(3, "b & <c> ]]>", "en", "src9"), (1, "a", "en", "src9"), (1, "z", "en", "src9"), (2, None, "en", "src9"), (4, "d", "fr", None), (None, "e", None, "src0")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    feeds = tables.feeds(spark, str(tmp_path))
    plan = feeds._jdf.queryExecution().optimizedPlan().toString()
    assert "<description>" in plan and "<description>" not in plan[plan.index("\n", plan.index("Aggregate [")):]
    xml = {r.feed_id: r.xml for r in feeds.collect()}
    assert re.findall("<description>(.*?)</description>", xml["src9/en/0"]) == ["a", "z", "b &amp; &lt;c&gt; ]]&gt;"]
    assert "<![CDATA[<p>b & <c>  </p>]]>" in xml["src9/en/0"] and xml["src9/en/0"].count("<item>") == 3
    assert len(xml) == 3 and sorted(map(str, xml.values()))[1:] == ["None", "None"]


def test_feed_items(parsed):
    rows = {(r.feed_id, r.pos): r for r in FD.feed_items(parsed, max_items=2, include_content=True).collect()}
    assert ("f1", 2) not in rows and rows["f1", 0].url == "https://coast.test/a/1" and rows["f0", 0].url == "https://coast.test/fog"
    assert rows["f0", 1].content is None and rows["f1", 1].author is None
    plain = {(r.feed_id, r.pos): r for r in FD.feed_items(parsed).collect()}
    assert plain["f1", 2].url == "" and plain["f0", 0].content is None
    assert {r.feed_id: r.entry_count for r in FD.entry_counts(parsed, FD.feed_items(parsed)).collect()} == {"f0": 2, "f1": 3, "f4": 0}


def test_text_helpers(spark):
    df = spark.createDataFrame([("&copy;&#169;&#xa9; &frac12; &bogus;", "<h1>x</h1>y<br>z<span>!</span>", "sixteen letters!")], "e string, t string, n string")
    r = df.select(T.decode_feed_entities("e").alias("e"), T.strip_tags("t").alias("t"), T.cap_with_ellipsis("n", 7).alias("n"),
                  T.cap_with_ellipsis("n", 16).alias("m")).first()
    assert (r.e, r.n, r.m) == ("©©© ½ &bogus;", "sixteen…", "sixteen letters!") and r.t.split() == ["x", "y", "z!"]


RESOLVE = [
    ("sub/page", "https://h.test/dir/x?q#f", "https://h.test/dir/sub/page"), ("./a/../b/", "https://h.test/dir/x", "https://h.test/dir/b/"),
    ("/%2e%2E/up/%2e", "https://h.test/dir/x", "https://h.test/up/"), ("?only=query", "https://h.test/dir/x?old", "https://h.test/dir/x?only=query"),
    ("https:rel", "https://h.test/dir/x", "https://h.test/dir/rel"), ("http:rel", "https://h.test/dir/x", "http://rel/"),
    ("//[2001:db8::1]/v6", "https://h.test/", "https://[2001:db8::1]/v6"), ("http://[::1]:8080/p", "https://h.test/", "http://[::1]:8080/p"),
    ("HTTP://UP.Test:80/é ü", "https://h.test/", "http://up.test/%C3%A9%20%C3%BC"), ("/a\"<b>`{c}", "https://h.test/", "https://h.test/a%22%3Cb%3E%60%7Bc%7D"),
    ("/x?a='b'&c=\"", "https://h.test/", "https://h.test/x?a=%27b%27&c=%22"), ("\\back\\slash", "https://h.test/", "https://h.test/back/slash"),
    ("http:/one", "http://h.test/d/x", "http://h.test/one"), ("HTTP:/one", "https://h.test/d/x", "http://one/"), ("http:\\\\two/p", "http://h.test/", "http://two/p"),
    ("http:///three", "http://h.test/", "http://three/"), ("https:", "https://h.test/d/x?q#f", "https://h.test/d/x?q"), ("https:?z", "https://h.test/d/x?q", "https://h.test/d/x?z"),
    ("http://h%41.com/%41", "https://h.test/", "http://ha.com/%41"), ("http://a%2Bb.com/", "https://h.test/", "http://a+b.com/"), ("http://a%zz.com/", "https://h.test/", None),
    ("http://a%2fb.com/", "https://h.test/", None), ("http://a%2541.com/", "https://h.test/", None), ("http://a%.com/", "https://h.test/", None), ("http://%C3%BC.com/", "https://h.test/", "http://ü.com/"),
    ("https://h.test:99999/", "https://h.test/", None), ("", "https://h.test/", None), ("#top", "https://h.test/", None),
    ("tel:+49", "https://h.test/", None), ("ws://h.test/", "https://h.test/", None),
]


def test_resolve(spark):
    df = spark.createDataFrame([(i, h, b) for i, (h, b, _) in enumerate(RESOLVE)], "i int, href string, base string")
    got = {r.i: r.resolved for r in urls.resolve(df, "href", "base").collect()}
    assert [got[i] for i in range(len(RESOLVE))] == [w for _, _, w in RESOLVE]
    frag = urls.resolve(spark.createDataFrame([("#s", "https://h.test/p?q=1#old")], "href string, base string"), "href", "base", junk_filter=False)
    assert frag.first().resolved == "https://h.test/p?q=1#s"


def test_gate(spark):
    cases = {"http://[::1]/x": None, "https://shop.test": None, "nothing": "invalid URL", "gopher://old.test/": "unsupported protocol",
             "https://me@shop.test/": "embedded credentials", "https:// /": "invalid URL", "http://[::1": "invalid URL"}
    got = {r.u: r for r in urls.gate(spark.createDataFrame([(u,) for u in cases], "u string"), "u").collect()}
    assert {u: r.reason for u, r in got.items()} == cases
    assert got["http://[::1]/x"].final_url == "http://[::1]/x" and got["nothing"].final_url is None


def test_long_hrefs_do_not_end_the_job(spark):
    hrefs = ["/" + "ü" * 1_000_000, "/" + "a" * 1_000_000, "/?" + "\"" * 1_000_000, "/#" + " é" * 300_000]
    df = spark.createDataFrame([(i, h, "https://h.test/") for i, h in enumerate(hrefs)], "i int, href string, base string")
    got = {r.i: r.n for r in urls.resolve(df, "href", "base").select("i", F.length("resolved").alias("n")).collect()}
    assert got == {0: 15 + 6_000_000, 1: 15 + 1_000_000, 2: 16 + 3_000_000, 3: 16 + 9 * 300_000}


def test_a_url_is_computed_once(spark):
    """Filters on a resolved URL are not pushed below its computation."""
    df = spark.createDataFrame([("/a", "https://h.test/")], "href string, base string")
    plan = urls.resolve(df, "href", "base").filter("resolved is not null")._jdf.queryExecution().optimizedPlan().toString()
    filters = [x for x in plan.splitlines() if "Filter" in x]
    assert filters and not any("regexp" in x for x in filters)


RULES = "shop.test, .inner.test ,*.wide.test,port.test:444,10.20.0.0/16, 192.0.2.8/31,0.0.0.0/,1.2.3.4/40"
HOSTS = {"shop.test": True, "eu.shop.test": True, "workshop.test": False, "inner.test": False, "a.b.inner.test": True, "x.wide.test": True,
         "port.test": True, "test": False, "": False}
IPS = {"10.20.30.40": True, "10.21.0.0": False, "192.0.2.9": True, "192.0.2.10": False, "0.0.0.0": False, "1.2.3.4": False, "10.20.300.1": False, "x": False}


def naive_host(host, rules):
    """The rule list read one entry after the other."""
    for rule in (r.strip().lower() for r in rules.split(",")):
        name = rule.rsplit(":", 1)[0] if rule.rsplit(":", 1)[-1].isdigit() else rule
        if rule == "*":
            return True
        if "/" not in rule and name:
            name = name.removeprefix("*") if name.startswith("*.") else name
            if host.endswith(name) if name.startswith(".") else host == name or host.endswith("." + name):
                return True
    return False


def test_host_rules_equal_a_naive_loop(spark):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(HOSTS)], "id int, host string")
    for rules in (RULES, "*", "", "a.test,*"):
        got = {r.host: r.name_match for r in H.match_names(df, "id", "host", rules).collect()}
        assert got == {h: naive_host(h, rules) if rules else False for h in HOSTS}
    assert {h: naive_host(h, RULES) for h in HOSTS} | {"x.wide.test": True} == HOSTS


def test_rule_tables_equal_a_naive_loop(spark):
    df = spark.createDataFrame([(i, h) for i, h in enumerate([*HOSTS, None, " SHOP.test "] * 2)], "id int, host string")
    for rules in (RULES, "*", "", "a.test,*"):
        table = H.parsed_rules(spark.createDataFrame([(r,) for r in rules.split(",")], "rule string"))
        got = H.match_name_table(df, "host", table).collect()
        assert len(got) == 2 * len(HOSTS) + 4
        for r in got:
            assert r.name_match == (naive_host((r.host or "").strip().lower(), rules) if rules else False), (r.host, rules)
    ips = spark.createDataFrame([(i, ip) for i, ip in enumerate([*IPS, None] * 2)], "id int, ip string")
    table = H.parsed_rules(spark.createDataFrame([(r,) for r in (RULES + ",192.0.2.9/32,10.0.0.0/7").split(",")], "rule string"))
    got = {(r.ip, r.cidr_match, r.cidr_bits) for r in H.match_cidr_table(ips, "ip", table).collect()}
    want = {ip: max([b for b, ok in ((16, ip == "10.20.30.40"), (31, ip == "192.0.2.9"), (32, ip == "192.0.2.9"), (7, ip in ("10.20.30.40", "10.21.0.0"))) if ok], default=None) for ip in IPS}
    assert got == {(ip, b is not None, b) for ip, b in want.items()} | {(None, False, None)}
    nothing = table.filter("kind = 'x'")
    assert {r.cidr_match for r in H.match_cidr_table(ips, "ip", nothing).collect()} == {False} == {r.name_match for r in H.match_name_table(df, "host", nothing).collect()}


def test_a_million_rules_meet_distinct_hosts_only(spark):
    rules = H.parsed_rules(spark.range(1_000_000).select(F.concat(F.lit("d"), F.col("id").cast("string"), F.lit(".test")).alias("rule")))
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, F.lit("www.d77.test")).otherwise(F.concat(F.lit("h."), F.lit("e"), (F.col("id") % 50).cast("string"), F.lit(".test"))).alias("host"))
    got = H.match_name_table(df, "host", rules)
    assert {r.host: (r.name_match, r["count(1)"]) for r in got.groupBy("host", "name_match").agg(F.count("*")).collect() if r.name_match} == {"www.d77.test": (True, 20_000)}
    assert got.count() == 60_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Generate"):]
    assert "HashAggregate" in before  # hosts are made distinct below the explode: rows are never exploded


def test_networks(spark):
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(IPS)], "id int, ip string")
    assert {r.ip: r.cidr_match for r in H.match_cidrs(df, "id", "ip", RULES).collect()} == IPS


def test_header_map(spark):
    heads = spark.createDataFrame([(1, "HTTP/1.0 404 Not Here\r\nVia: a\r\nCACHE: no\r\nvia:b\r\n:x\r\nnocolon"), (2, "SMTP ready"), (3, "HTTP/2 204")], "page_id int, head string")
    rows = RS.header_map(heads).collect()
    assert {r.key: r.value for r in rows if r.page_id == 1} == {"via": "a, b", "cache": "no"}
    assert {(r.status, r.status_text) for r in rows if r.page_id == 1} == {(404, "Not Here")}
    assert [(r.ok, r.status) for r in rows if r.page_id == 2] == [(False, None)] and [r.status for r in rows if r.page_id == 3] == [204]


LOG = [
    (1, "https://one.test/", 301, "/two#part", "text/html"), (2, "https://one.test/two", 200, None, "Text/HTML; charset=utf-8"),
    (3, "https://one.test/two", 500, None, "text/html"), (4, "https://spin.test/", 307, "https://spin.test/#again", "text/html"),
    (5, "https://blank.test/", 308, "", "text/html"), (6, "https://out.test/", 302, "mailto:x@out.test", "text/html"),
    (7, "https://pic.test/", 200, None, "image/png"), (8, "https://late.test/", 200, None, "text/html"), (9, "https://gone.test/", 410, None, "text/html"),
    (10, "https://frag.test/p?q", 302, "#sec", "text/html"),
]


def test_redirects(spark):
    log = spark.createDataFrame([(*r, 30_000 if r[0] == 8 else 9, bytearray(b"<title>t</title><a href='x'>y</a>")) for r in LOG],
                                "page_id int, url string, status int, location string, content_type string, elapsed_ms int, body binary")
    starts = spark.createDataFrame([(i, u) for i, u in enumerate(["https://one.test/#a", "https://spin.test/", "https://blank.test/", "https://out.test/", "https://pic.test/",
                                                                  "https://late.test/", "https://gone.test/", "https://never.test/", "ftp://no.test/", "https://frag.test/p?q"])], "page_id int, url string")
    rows = RS.resolve_redirects(log, starts).collect()
    assert len(rows) == 10  # two captures of one URL do not multiply a start
    got = {r.page_id: (r.outcome, r.final_url, r.hops) for r in rows}
    assert got[0] == ("ok", "https://one.test/two#part", 1)
    assert [got[k][0] for k in range(1, 10)] == ["too many redirects", "redirect without Location", "unsupported protocol", "unsupported content type", "timed out",
                                                 "HTTP status", "fetch failed", "unsupported protocol", "too many redirects"]
    assert got[9][1] == "https://frag.test/p?q#sec"
    fetched = {r.page_id: r for r in L.web_fetch(log, starts).collect()}
    assert len(fetched) == 10 and fetched[0].title == "t" and fetched[0].links_text == "y\thttps://one.test/x" and not fetched[0].truncated
    assert fetched[4].title is None and fetched[4].outcome == "unsupported content type"


def test_fetch_decodes_and_flags_the_byte_cap(spark):
    bodies = [("https://a.test/", "text/html; charset=koi8-r", "<p>Привет</p>".encode("koi8-r")),
              ("https://b.test/", "text/html", b"<meta charset=windows-1253><p>" + "Καλημέρα".encode("cp1253")),
              ("https://c.test/", "text/html; charset=utf-16", "﻿<p>ok</p>".encode("utf-16-le") + b"x"),
              ("https://d.test/", "text/html", b"<p>" + b"long " * 4_000)]
    log = spark.createDataFrame([(i, u, 200, None, c, 1, bytearray(b)) for i, (u, c, b) in enumerate(bodies)],
                                "page_id int, url string, status int, location string, content_type string, elapsed_ms int, body binary")
    got = {r.page_id: r for r in L.web_fetch(log, log.select("page_id", "url"), max_bytes=10_000).collect()}
    assert [got[k].content for k in range(3)] == ["Привет", "Καλημέρα", "ok\n�"] or [got[k].content for k in range(3)] == ["Привет", "Καλημέρα", "ok�"]
    assert [got[k].truncated for k in range(4)] == [False, False, False, True] and got[3].length < 10_001


def test_charset_order(spark):
    cases = [("text/html;charset = 'koi8-u'", "<meta charset=utf-8>", "koi8-u"), ("text/html", "<?xml version='1.0' encoding='ISO-8859-7'?>", "ISO-8859-7"),
             (None, "<html><META  CHARSET=\"big5\">", "big5"), ("text/html", "<meta name=x content='text/html; charset=gbk'>", "gbk"),
             ("text/html", "plain", "utf-8"), ("text/html", "." * 2048 + "<meta charset=x>", "utf-8")]
    df = spark.createDataFrame([(i, c, bytearray(b.encode())) for i, (c, b, _) in enumerate(cases)], "id int, content_type string, body binary")
    got = {r.id: r.cs for r in df.select("id", RS.detect_charset("content_type", "body").alias("cs")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, _, w in cases]


def test_decoding(spark):
    raw = [(label, codec, bytes(range(0x20, 0x100))) for codec, labels in RS.SINGLE_BYTE.items() for label in labels[:1]]
    cases = [(label, b, "".join(bytes([x]).decode(codec, "ignore") or (chr(x) if x < 0xA0 else "�") for x in b)) for label, codec, b in raw]
    cases += [("UTF-8", b"\xef\xbb\xbfa\xffb", "a�b"), ("utf-16le", b"a\0\x00\xd8b\0", "a�b"), ("unicode", b"\xff\xfea\0b", "a�"),
              ("utf-16be", b"\xd8\x3d\xde\x00\xdc\x00\0x", "😀�x"), ("latin1", b"\x80\xe9", "€é"), ("x-none", b"ok", "ok"), ("utf-8", b"", ""), ("utf-16", b"x", "�")]
    df = spark.createDataFrame([(i, c, bytearray(b)) for i, (c, b, _) in enumerate(cases)], "id int, cs string, body binary")
    got = {r.id: r.t for r in df.select("id", RS.decode_body("body", "cs")[0].alias("t")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, _, w in cases]


def test_size_cap(spark):
    df = spark.createDataFrame([(n, bytearray(b"z" * n)) for n in (0, 9_999, 10_000, 10_001)], "id int, body binary")
    got = {r.id: (r.k, r.truncated) for r in RS.size_cap(df, 10_000).select("id", F.octet_length("kept").alias("k"), "truncated").collect()}
    assert got == {0: (0, False), 9_999: (9_999, False), 10_000: (10_000, False), 10_001: (10_000, True)}
    assert RS.size_cap(df, 1).agg(F.max(F.octet_length("kept"))).first()[0] == 10_000  # caps are drawn into their range


DATES = {"Sat, 02 Mar 2024 07:30:00 +0200": "2024-03-02 05:30:00", "2 Mar 24 07:30 EST": "2024-03-02 12:30:00", "Saturday, 02 Mar 2024 07:30:05 GMT": "2024-03-02 07:30:05",
         "2024-03-02": "2024-03-02 00:00:00", "2024-03-02T07:30:00.250+01:00": "2024-03-02 06:30:00", "2024-03-02T07:30Z": "2024-03-02 07:30:00",
         "2024-03-02 07:30:00-0330": "2024-03-02 11:00:00", "yesterday": None, "": None, "10 Jun 99": "1999-06-10 00:00:00", "10 Jun 49 01:02 GMT": "2049-06-10 01:02:00",
         "10 June 2003": "2003-06-10 00:00:00", "10 Jun 2003": "2003-06-10 00:00:00", "Tue, 1 SEPT 2020 9:05:06 PDT": "2020-09-01 16:05:06", "3 Juneau 2003": None,
         "5 May 2021 10:00 XYZ": None, "31 Feb 2020 10:00 GMT": None, "2021-13-01": None, "1 Jan 2020  10:00:00": "2020-01-01 10:00:00", None: None}


def test_dates(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "d string")
    assert {r.d: r.u for r in df.select("d", FD.published_utc("d").alias("u")).collect()} == DATES


def test_routes(spark):
    df = spark.createDataFrame([("http", True), ("http", False), ("https", False)], "scheme string, bypass boolean")
    def routes(http, https):
        return [r[0] for r in df.select(H.route(F.col("scheme"), F.col("bypass"), http, https)).collect()]
    assert routes("http://p.test:1", "") == ["direct", "proxy http://p.test:1", "direct"]
    assert routes("", "https://q.test")[2] == 'error: unsupported proxy protocol "https:"'
