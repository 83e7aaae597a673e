"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.storage import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``edges`` (a, b: long): comp is the smallest node of its component.

    A round takes the smallest label among neighbours (partial aggregates, so a hub costs no more than its edges)
    and then the label of the label. Labels are written to the shared folder after each round; it ends when no
    label changes. Long chains halve in every round by the jump.
    """
    both = saved(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("m"))
        low = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        new = saved(low.join(jump, "comp", "left").select("node", "old", F.least("comp", F.coalesce("next", "comp")).alias("comp")))
        changed = not new.filter("old <> comp").isEmpty()
        labels = new.select("node", "comp")
        if not changed:
            return labels
