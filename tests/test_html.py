"""Page plan on hand-written pages: exact title, content, links and outline."""

import pytest

from webloom.operators import html
from webloom.options import ExtractOptions

MD, TEXT = ExtractOptions.of("markdown", 10_000, clamp_chars=False), ExtractOptions.of("text", 10_000, clamp_chars=False)

# (page, title, markdown, text)
PAGES = [
    ("<title>Harbour log</title><p>Tide at noon.</p><p>Wind from <em>north</em>-west.</p>", "Harbour log",
     "Tide at noon.\nWind from north -west.", "Tide at noon.\nWind from north -west."),
    ("<style>p{color:red}</style><p>stays</p><script>if (1 > 2) leave()</script><noscript>gone</noscript><!-- <p>gone</p> --><p>too</p>", "",
     "stays\ntoo", "stays\ntoo"),
    ("<h1>Menu</h1><ol><li>soup</li><li>bread</li></ol><h3>Drinks</h3>tea", "",
     "# Menu\n- soup\n- bread\n### Drinks\ntea", "Menu\nsoup\nbread\nDrinks\ntea"),
    ("<p>above</p><hr><p>be<br>low</p>", "", "above\n---\nbe\nlow", "above\n\nbe\nlow"),
    ('<p>See <a href="https://maps.test/p?q=1">the map</a> or <img src="m.png" alt="a map"></p>', "",
     "See [the map](https://maps.test/p?q=1)or ![a map](m.png)", None),
    ("<pre>x = 1\n  y = 2</pre><p>done</p>", "", "```\nx = 1\ny = 2\n```\ndone", None),
    ("<ul><li>ham<i>let</i></li></ul>", "", "- hamlet", "ham let"),
    ("<title>first</title><title>fish &amp; chips &#xFDD0;</title>", "fish & chips &#xFDD0;", "", ""),
    ("<title>open<p>never seen</p>", "", "", ""),
    ("a &#xFDD0; b ﷑ c", "", "a &#xFDD0; b � c", "a &#xFDD0; b � c"),
    ("&lt;b&gt; &unknown; &euro;5 &#8364;6 &#x20AC;7 &#0; &#x110000;", "", None, None),
    ("", "", "", ""),
    (None, "", "", ""),
]


@pytest.fixture(scope="module")
def extracted(spark):
    df = spark.createDataFrame([(i, "u", p[0]) for i, p in enumerate(PAGES)], "page_id bigint, url string, html string")
    return [{r.page_id: r for r in html.extract(df, o).collect()} for o in (MD, TEXT)]


@pytest.mark.parametrize("i", range(len(PAGES)))
def test_pages(extracted, i):
    _, title, markdown, plain = PAGES[i]
    md, text = (x[i] for x in extracted)
    assert md.title == title
    if markdown is not None:
        assert md.content == markdown and (plain is None or text.content == plain)
        assert md.length == len(markdown) and not md.truncated


def test_entities(extracted):
    got = extracted[1][10].content
    assert got.startswith("<b> &unknown; €5 €6 €7") and got.endswith("&#x110000;")


def test_links_in_order(pages_df):
    page = ('<nav><a href="/in">in</a><a name="x">no href</a></nav><svg><a href="/drawn">hidden</a></svg>'
            "<a href='/q?a=1&b=2'>two <b>words</b></a><a href=bare><img src=i.gif alt=pic></a><a href='/last'></a>")
    p = html.extract(pages_df(page), MD).first()
    assert [(x.text, x.href) for x in p.links] == [("in", "/in"), ("", "/drawn"), ("two words", "/q?a=1&b=2"), ("", "bare"), ("", "/last")]


def test_content_cap(pages_df):
    p = html.extract(pages_df("<p>" + "lorem " * 300 + "</p>"), ExtractOptions.of("text", 40, clamp_chars=False)).first()
    assert (p.content, p.length, p.truncated) == (("lorem " * 300)[:40], 40, True)


def test_outline_reads_headings_of_the_whole_page(pages_df):
    page = ("<h2>Start &amp; end</h2><pre># no heading</pre><p># hashtag</p><script><h1>gone</h1></script><p>" + "filler " * 12_000
            + "</p><h4>Far <a href='/x'>down</a></h4><h3></h3><h1>open<p>next</p>")
    rows = html.outline(html.page_state(pages_df(page, "<h6>other</h6>"))).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.level, r.text) for r in rows] == [(0, 2, "Start & end"), (0, 4, "Far down"), (0, 1, "open"), (1, 6, "other")]


def test_long_pages_do_not_end_the_job(pages_df):
    many = html.extract(pages_df("<p>" + "é" * 100_000 + "</p>", "<" * 20_000, "&" * 20_000, "<a href='" + "ü" * 20_000 + "'>x</a>"), MD)
    assert sorted(r.page_id for r in many.collect()) == [0, 1, 2, 3]


def test_tokens_are_sorted_once(pages_df):
    """All state of a page comes from one order of its tokens: a second sort would hold every row of a task twice."""
    for links in (True, False):
        plan = html.extract(pages_df("<a href='/x'>x<p>y</a><img alt=z>"), with_links=links)._jdf.queryExecution().executedPlan().toString()
        assert "DESC" not in plan and plan.count("Sort [") == 1
