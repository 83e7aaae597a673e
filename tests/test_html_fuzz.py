"""Thousands of random pages: the window plan against the plain reader."""

import random

import pytest

from webloom.operators import html
from webloom.options import ExtractOptions

from .plain_page import read

PARTS = ["<a href='/x'>", "<a href=/y>", "<a>", "</a>", "<br>", "<br>", "<hr>", "<p>", "</p>", "<li>", "</li>", "<h2>", "</h2>", "<pre>", "</pre>", "<code>", "</code>",
         "<img src=i alt=pic>", "<img alt=only>", "<div>", "</div>", "<b>", "</b>", "one", "two ", " three", " ", "\n", "a  b", "```", "```\n", "<svg>", "</svg>", "<title>", "</title>",
         "<td>", "<script>", "</script>", "<!-- <p> -->", "<x", "text"]


def pages(seed, number, at_most):
    rng = random.Random(seed)
    weights = [rng.random() ** 2 for _ in PARTS]
    out = []
    for k in range(number):
        if k % 50 == 0:
            weights = [rng.random() ** 2 for _ in PARTS]
        out.append("".join(rng.choices(PARTS, weights, k=rng.randint(1, at_most))))
    return out


@pytest.mark.parametrize("fmt", ["markdown", "text"])
def test_random_pages_equal_the_plain_reader(pages_df, fmt):
    docs = pages(7, 3600, 14) + pages(8, 400, 90)
    got = {r.page_id: (r.content, [(x.text, x.href) for x in r.links]) for r in html.extract(pages_df(*docs), ExtractOptions.of(fmt)).collect()}
    wrong = [(d, got[k], read(d, fmt == "markdown")) for k, d in enumerate(docs) if got[k] != read(d, fmt == "markdown")]
    assert not wrong, (len(wrong), min(wrong, key=lambda w: len(w[0])))


CASES = [("<pre>x</pre></pre><p>y</p>", "```\nx\n```\ny"), ("<p>a</p><pre>x</pre></pre>", "a\n```\nx\n```\n```"), ("<pre></pre>", "```"),
         ("<a href=/x>one<br>two</a>", "[one](/x) two"), ("<p><a href=/x><br>one<br>two</a>", "[one two](/x)"), ("t<a href=/x>one<br>two<a href=/y>z<br>w", "t [one](/x) two [z](/y) w")]


@pytest.mark.parametrize("page, want", CASES)
def test_fences_and_soft_breaks(pages_df, page, want):
    assert read(page)[0] == want == html.extract(pages_df(page), ExtractOptions.of("markdown")).first().content
