"""Structured Streaming variants of the page and feed jobs.

ST1: pages arriving as files -> ``foreachBatch`` runs the batch page plan
(row windows are not allowed on streams, the batch plan is).  ST2: feed
documents polled repeatedly -> stateless entry extraction directly on the
stream, then ``dropDuplicatesWithinWatermark(['url'])`` so a re-poll adds
only new entries; the state lives in the checkpointed state store.

Run folders live under the session's shared checkpoint folder
(``spark.checkpoint.dir``); a scratch folder is used only when it is unset.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import feeds as FD
from ..operators import html
from ..options import ExtractOptions
from ..session import checkpoint_dir, configure
from ..sources import tables

EXTRACT_SCHEMA = "page_id bigint, title string, content string, length int, truncated boolean"
ENTRY_SCHEMA = ("feed_id string, pos int, title string, url string, published string, author string, "
                "summary string, content string")


def _run_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/webloom-{name}-{uuid.uuid4().hex[:12]}"


def stream_pages(spark: SparkSession, source_dir: str, out_dir: str, ckpt: str,
                 opts: ExtractOptions = ExtractOptions()) -> None:
    """Extract every page file that lands in ``source_dir``; results appended to ``out_dir``."""
    configure(spark)
    src = spark.readStream.schema("page_id bigint, url string, html string").parquet(source_dir)

    def batch(df: DataFrame, epoch: int) -> None:
        ex = html.extract(df, opts, with_links=False).drop("links")
        ex.select("page_id", "title", "content", F.col("length").cast("int").alias("length"), "truncated") \
          .write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")  # a replayed batch writes the same place again

    q = (src.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_pages_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 over the captured pages: arrive in four files (page_id % 4), extracted per micro-batch."""
    run = _run_dir(spark, "st1")
    pages = tables.web_pages(spark, sf_dir)
    for k in range(4):  # four arrivals, each its own file set
        pages.filter(F.col("page_id") % 4 == k).write.parquet(f"{run}/in/part={k}")
    stream_pages(spark, f"{run}/in/*", f"{run}/out", f"{run}/ckpt", ExtractOptions.of("markdown"))
    return spark.read.schema(EXTRACT_SCHEMA).parquet(f"{run}/out/epoch=*").select(
        "page_id", "content", "length", "truncated")


def stream_feed_entries(spark: SparkSession, source_dir: str, out_dir: str, ckpt: str,
                        watermark: str = "1 day") -> None:
    """Entries of polled feeds, each entry URL emitted once per watermark horizon."""
    configure(spark)
    src = (spark.readStream
           .schema("feed_id string, url string, xml string, final_url string, truncated boolean, "
                   "fetched_at timestamp").parquet(source_dir))
    items = FD.feed_items(FD.parse_feeds(src), keep=("fetched_at",))
    # an entry is "seen" when its own feed has shown it: by its URL, or where it has none by all its fields
    whole = F.sha2(F.to_json(F.struct("title", "published", "author", "summary", "content")), 256)
    items = items.withColumn("seen_key", F.coalesce(F.nullif(F.col("url"), F.lit("")), whole))
    fresh = items.withWatermark("fetched_at", watermark).dropDuplicatesWithinWatermark(["feed_id", "seen_key"])
    q = (fresh.drop("fetched_at", "seen_key").writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def stream_feed_entries_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: the feeds are polled twice (an hour apart); the second poll must add nothing."""
    run = _run_dir(spark, "st2")
    feeds = tables.feeds(spark, sf_dir)
    for i, ts in enumerate(("2024-06-01 00:00:00", "2024-06-01 01:00:00")):
        if i:  # built once: the second poll brings what the first one has written
            feeds = spark.read.parquet(f"{run}/in/poll=0")
        feeds.withColumn("fetched_at", F.lit(ts).cast("timestamp")).write.parquet(f"{run}/in/poll={i}")
    stream_feed_entries(spark, f"{run}/in/*", f"{run}/out", f"{run}/ckpt")
    return spark.read.schema(ENTRY_SCHEMA).parquet(f"{run}/out")
