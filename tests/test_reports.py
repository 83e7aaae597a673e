"""Report renderers against the reference's renderer cases."""

from webloom.operators import reports as R


def test_fetch_report(spark):
    ex = spark.createDataFrame([(1, "https://x.test/", "https://x.test/", 200, "Example", "body text", False, None),
                                (2, "ftp://x.test/", None, None, "Example", "body text", False, "unsupported protocol"),
                                (3, None, None, None, "", "", False, "invalid URL")],
                               "page_id int, url string, final_url string, status int, title string, content string, "
                               "truncated boolean, reject_reason string")
    assert [r.report for r in R.fetch_report(ex).orderBy("page_id").collect()] == [
        "HTTP 200 — title: Example\nbody text", "not fetched (unsupported protocol): ftp://x.test/", "not fetched (invalid URL)"]


def test_links_report(spark):
    pages = spark.createDataFrame([(1, "u", "https://x.test/", None), (2, "u", "https://y.test/", None), (3, "me@x", None, "invalid URL")],
                                  "page_id int, url string, final_url string, reason string")
    inv = spark.createDataFrame([(1, 1, "Home", "https://x.test/home")], "page_id int, rank int, text string, href string")
    got = {r.page_id: r.report for r in R.links_report(pages, inv).collect()}
    assert got[1] == "1 link(s) on https://x.test/:\n  1. Home — https://x.test/home"
    assert got[2] == "no links found on https://y.test/" and got[3] == "not fetched (invalid URL): me@x"


def test_feed_report(spark):
    feeds = spark.createDataFrame([("f", "Example Feed", "https://x.test/feed.xml", False)],
                                  "feed_id string, feed_title string, final_url string, truncated boolean")
    items = spark.createDataFrame([("f", 0, "Post", "https://x.test/post", "Mon, 01 Jan 2024 10:00:00 GMT", None,
                                    "Short summary", None)],
                                  "feed_id string, pos int, title string, url string, published string, author string, "
                                  "summary string, content string")
    assert R.feed_report(feeds, items).collect()[0].report == (
        "feed: Example Feed\n1 entry from https://x.test/feed.xml\n1. Post — https://x.test/post\n"
        "   published: Mon, 01 Jan 2024 10:00:00 GMT\n   Short summary")
