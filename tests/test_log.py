"""The captured log: redirect chains against a plain walk, feeds and links read from responses, captures that share an id."""

import random

import pytest

from webloom.operators import html
from webloom.operators import links as L
from webloom.operators import responses as RS

from .plain_page import ATTR, NAME, VALUE

LOG = "page_id bigint, url string, status int, location string, content_type string, elapsed_ms int, body_error string, body binary"


def row(i, url, status=200, location=None, ctype="text/html", late=1, error=None, body=""):
    return (i, url, status, location, ctype, late, error, bytearray(body.encode()))


def walk(log, url, limit):
    """(outcome, final URL, hops) hop by hop."""
    for hop in range(limit + 1):
        status, location, late, error, ctype = log.get(url, (None,) * 5)
        if status is None:
            return "fetch failed", url, hop
        if late > 10_000:
            return "timed out", url, hop
        if status == 301:
            if not location:
                return "redirect without Location", url, hop
            if hop == limit:
                return "too many redirects", url, hop
            if location.startswith("ftp:"):
                return "unsupported protocol", url, hop
            url = "https://h.test" + location
            continue
        if status != 200:
            return "HTTP status", url, hop
        return ("unsupported content type" if ctype != "text/html" else "body read failed" if error else "ok"), url, hop
    raise AssertionError


@pytest.mark.parametrize("limit", [0, 1, 2, 3, 5, 10])
def test_pointer_doubling_equals_a_plain_walk(spark, limit):
    rng = random.Random(limit)
    n, log = 120, {}
    for k in range(n):
        kind = rng.random()
        to = f"/{rng.choice([k + 1, k + 1, k + 1, rng.randrange(n), k, n + 5])}"
        log[f"https://h.test/{k}"] = (301, to, 1, None, "text/html") if kind < 0.75 else (301, rng.choice([None, "", "ftp://x/"]), 1, None, "text/html") if kind < 0.8 \
            else (rng.choice([200, 200, 404]), None, rng.choice([1, 20_000]), rng.choice([None, "reset"]), rng.choice(["text/html", "image/png"]))
    df = spark.createDataFrame([row(k, u, s, loc, c, late, e) for k, (u, (s, loc, late, e, c)) in enumerate(log.items())], LOG)
    starts = spark.createDataFrame([(k, f"https://h.test/{k}") for k in range(n + 3)], "page_id bigint, url string")
    got = {r.page_id: (r.outcome, r.final_url, r.hops) for r in RS.resolve_redirects(df, starts, limit).collect()}
    assert got == {k: walk(log, f"https://h.test/{k}", limit) for k in range(n + 3)}


def test_settled_rows_are_not_carried(spark):
    """The limit changes the number of joins of 3xx captures, not of starts: two joins, at any limit."""
    df = spark.createDataFrame([row(1, "https://a.test/")], LOG)
    starts = spark.createDataFrame([(1, "https://a.test/")], "page_id bigint, url string")

    def joins(limit):
        plan = RS.resolve_redirects(df, starts, limit)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join ")
    assert joins(3) - joins(1) == 2 and joins(0) >= 2


def test_captures_that_share_an_id_stay_apart(spark):
    log = spark.createDataFrame([row(1, "https://a.test/", body="one <a href=x>x</a>"), row(1, "https://b.test/", body="two"), row(2, "https://c.test/", 302, "https://b.test/#f")], LOG)
    starts = spark.createDataFrame([(1, "https://a.test/"), (1, "https://b.test/"), (5, "https://c.test/"), (None, "https://b.test/"), (7, None)], "page_id bigint, url string")
    got = {(r.page_id, r.url): (r.outcome, r.content, r.final_url) for r in L.web_fetch(log, starts).collect()}
    assert got == {(1, "https://a.test/"): ("ok", "one [x](x)", "https://a.test/"), (1, "https://b.test/"): ("ok", "two", "https://b.test/"),
                   (5, "https://c.test/"): ("ok", "two", "https://b.test/#f"), (None, "https://b.test/"): ("ok", "two", "https://b.test/"), (7, None): ("invalid URL", None, None)}


def test_links_from_the_log(spark):
    page = "<a href=/x>one</a><a href='/x'>two</a><a href=y>three</a><a href=mailto:a@b.c>m</a><a href=/z>four</a>"
    log = spark.createDataFrame([row(1, "https://a.test/d/", body=page), row(2, "https://b.test/", 301, "https://a.test/d/"), row(3, "https://n.test/", body="none")], LOG)
    starts = log.select("page_id", "url")
    got = {r.page_id: (r.link_count, r.links_text) for r in L.web_links(log, starts, limit=2).collect()}
    two = (2, "one\thttps://a.test/x\nthree\thttps://a.test/d/y")
    assert got == {1: two, 2: two, 3: (0, "")}


FEED = "<rss><channel><title>T</title><item><title>a</title><link>/1</link></item><item><title>é</title><description>s</description></item></channel></rss>"


def test_feeds_from_the_log(spark):
    log = spark.createDataFrame([
        row(1, "https://a.test/f", ctype="Application/RSS+xml; charset=utf-8", body=FEED), row(2, "https://b.test/", 307, "https://a.test/f#x"),
        row(3, "https://c.test/", body="<html>"), row(4, "https://d.test/", ctype="application/json", body=FEED), row(5, "https://e.test/", ctype="text/xml", error="cut", body=FEED),
        row(6, "https://f.test/", ctype="application/xml", body="<rss><channel><title>L</title>" + "<item><title>i</title></item>" * 500),
        row(7, "https://g.test/", ctype="text/xml", body="<feed><title>none</title></feed>")], LOG)
    rows = {r.page_id: r for r in L.web_feed(log, log.select("page_id", "url"), max_items=50, max_bytes=10_000).collect()}
    assert {k: r.outcome for k, r in rows.items()} == {1: "ok", 2: "ok", 3: "not a feed", 4: "unsupported content type", 5: "body read failed", 6: "ok", 7: "ok"}
    assert [(e.title, e.url, e.summary) for e in rows[2].entries] == [("a", "https://a.test/1", None), ("é", "", "s")] and rows[2].final_url == "https://a.test/f#x"
    assert (rows[1].entry_count, rows[1].truncated, rows[1].feed_title) == (2, False, "T")
    assert (rows[6].entry_count, rows[6].truncated) == (50, True)  # the byte cap alone sets the flag
    assert (rows[7].entry_count, rows[7].entries, rows[3].entries, rows[3].truncated) == (0, [], None, None)
    pages = {r.page_id: r.outcome for r in L.web_fetch(log, log.select("page_id", "url")).collect()}
    assert (pages[1], pages[3], pages[6]) == ("unsupported content type", "ok", "unsupported content type")


TAGS = ["<a href='x' HREF=\"y > z\" href=last>", "<img src = 'a b' alt>", "<p class=\"a\" data-x:y='1' CLASS='' =\"odd\" 9x>", "<br/>", "<td\nwidth=5\theight = '6'>", "<i " + "a" * 50 + "=1 " * 3 + ">",
        "<b " + " ".join(f"k{i % 700}={i}" for i in range(3000)) + ">", "<x>"]


def test_attributes_are_a_map_of_last_values(spark):
    def plain(tag):
        found = {}
        for a in ATTR.findall(tag):
            value = VALUE.match(a)
            found[NAME.match(a)[1].lower()] = "".join(g or "" for g in value.groups()) if value else ""
        return found
    got = spark.createDataFrame([(t,) for t in TAGS], "tok string").select("tok", html.attributes("tok").alias("m")).collect()
    assert {r.tok: r.m for r in got} == {t: plain(t) for t in TAGS}
