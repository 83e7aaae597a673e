"""Invariants: tokens rebuild the page; batch equals stream (ST1)."""

import re
import tempfile

from pyspark.sql import functions as F

from webloom.functions.constants import TAG_NAME_RE, TOKEN_RE
from webloom.operators import html
from webloom.options import ExtractOptions
from webloom.streaming import jobs as ST

PAGES = [
    '<!doctype html><title>T &amp; U</title><p>a < b<!-- c --> d</p><a href="/x">x</a>',
    "<ul><li>one</li><li>two<br>three</li></ul><pre>  code\n  here</pre><hr><h3>end</h3>",
    "plain text only, no tags at all",
    "",
]


def test_tokens_rebuild_page(pages_df):
    toks = html.tokenize(pages_df(*PAGES)).filter(F.col("tok") != "")
    got = {r.page_id: r.s for r in toks.groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tok"))), lambda x: x["tok"]), "")
        .alias("s")).collect()}
    for i, h in enumerate(PAGES):
        # brute force: every match of the token pattern, minus comments and name-less tags
        kept = [m for m in re.findall(TOKEN_RE, h)
                if not m.startswith("<!--") and (not m.startswith("<") or re.match(TAG_NAME_RE, m))]
        assert got.get(i, "") == "".join(kept), i


def test_batch_equals_stream(spark, pages_df):
    run = tempfile.mkdtemp(prefix="webloom-st1-test-")
    pages = pages_df(*PAGES)
    for k in range(2):
        pages.filter(F.col("page_id") % 2 == k).write.parquet(f"{run}/in/part={k}")
    spark.createDataFrame([], ST.EXTRACT_SCHEMA).write.parquet(f"{run}/out")
    opts = ExtractOptions.of("markdown")
    ST.stream_pages(spark, f"{run}/in/*", f"{run}/out", f"{run}/ckpt", opts)
    streamed = {r.page_id: (r.title, r.content) for r in spark.read.schema(ST.EXTRACT_SCHEMA).parquet(f"{run}/out").collect()}
    batch = {r.page_id: (r.title, r.content) for r in html.extract(pages, opts).collect()}
    assert streamed == batch and len(batch) == len(PAGES)


def test_clustered_flag_same_result(pages_df):
    pages = pages_df(*PAGES)
    opts = ExtractOptions.of("markdown")
    a = {r.page_id: (r.title, r.content) for r in html.extract(pages, opts).collect()}
    b = {r.page_id: (r.title, r.content)
         for r in html.extract(pages, opts, state=html.page_state(pages, clustered=True)).collect()}
    assert a == b
