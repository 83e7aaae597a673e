"""Readable reports (S6-S8): string assembly with concat / ordered collect_list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import TRUNCATED_FEED_NOTE, TRUNCATED_PAGE_NOTE


def fetch_report(ex: DataFrame) -> DataFrame:
    """``HTTP <status>[ (redirected from <url>)] — title: <t>|(no title)\\n<content>[note]``"""
    header = F.when(F.col("title") != "", F.concat(F.lit("title: "), F.col("title"))).otherwise(F.lit("(no title)"))
    redirect = F.when(F.col("url") != F.col("final_url"),
                      F.concat(F.lit(" (redirected from "), F.col("url"), F.lit(")"))).otherwise(F.lit(""))
    note = F.when(F.col("truncated"), F.lit(TRUNCATED_PAGE_NOTE)).otherwise(F.lit(""))
    report = F.concat(F.lit("HTTP "), F.col("status").cast("string"), redirect, F.lit(" — "), header, F.lit("\n"), F.col("content"), note)
    return ex.select("page_id", F.coalesce(report, _not_fetched(F.col("reject_reason"), F.col("url"))).alias("report"))


def _not_fetched(reason, url):
    """What stands for a page whose URL the gate rejects."""
    return F.concat(F.lit("not fetched ("), reason, F.lit(")"), F.coalesce(F.concat(F.lit(": "), url), F.lit("")))


def links_report(pages: DataFrame, inv: DataFrame) -> DataFrame:
    """Numbered lines ``  n. label — href`` (href alone without label); left join keeps pages without links."""
    line = F.concat(F.lit("  "), F.col("rank").cast("string"), F.lit(". "),
                    F.when(F.col("text") == "", F.col("href"))
                    .otherwise(F.concat(F.col("text"), F.lit(" — "), F.col("href"))))
    per = inv.groupBy("page_id").agg(F.count("*").alias("n"),
                                     F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("ls"))
    j = pages.select("page_id", "url", "final_url", "reason").join(per, "page_id", "left")
    body = F.array_join(F.transform("ls", lambda x: x["line"]), "\n")
    return j.select("page_id", F.when(F.col("final_url").isNull(), _not_fetched(F.col("reason"), F.col("url")))
                    .when(F.col("n").isNull(), F.concat(F.lit("no links found on "), F.col("final_url")))
                    .otherwise(F.concat(F.col("n").cast("string"), F.lit(" link(s) on "), F.col("final_url"),
                                        F.lit(":\n"), body)).alias("report"))


def feed_report(feeds: DataFrame, entries: DataFrame) -> DataFrame:
    """``feed: <title>\\n<n> entr(y|ies) from <url>`` + numbered entries + optional note."""
    ent = entries.select(
        "feed_id", "pos",
        F.concat_ws("\n",
                    F.concat((F.col("pos") + 1).cast("string"), F.lit(". "), F.col("title"),
                             F.when(F.col("url") == "", F.lit("")).otherwise(F.concat(F.lit(" — "), F.col("url")))),
                    F.when(F.col("published").isNotNull(), F.concat(F.lit("   published: "), F.col("published"))),
                    F.when(F.col("author").isNotNull(), F.concat(F.lit("   author: "), F.col("author"))),
                    F.when(F.col("summary").isNotNull(), F.concat(F.lit("   "), F.col("summary"))),
                    F.when(F.col("content").isNotNull(), F.concat(F.lit("   "), F.col("content")))).alias("block"))
    per = ent.groupBy("feed_id").agg(F.array_sort(F.collect_list(F.struct("pos", "block"))).alias("bs"))
    j = feeds.join(per, "feed_id", "left")
    n = F.when(F.col("bs").isNull(), F.lit(0)).otherwise(F.size("bs"))
    head = F.concat(F.lit("feed: "), F.col("feed_title"), F.lit("\n"), n.cast("string"),
                    F.when(n == 1, F.lit(" entry")).otherwise(F.lit(" entries")), F.lit(" from "), F.col("final_url"))
    blocks = F.when(F.col("bs").isNull(), F.lit(None)).otherwise(
        F.array_join(F.transform("bs", lambda x: x["block"]), "\n"))
    note = F.when(F.col("truncated"), F.lit(TRUNCATED_FEED_NOTE))
    return j.select("feed_id", F.concat_ws("\n", head, blocks, note).alias("report"))
