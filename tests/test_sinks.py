"""Sinks: bounded files, reruns, and runs that were never finished."""

from pyspark.sql import functions as F

from webloom.sources import sinks


def test_reruns_leave_no_duplicates_and_files_are_bounded(spark, tmp_path):
    rows = spark.range(3000).select("id", F.concat(F.lit("https://"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 70).cast("string")), F.lit(".test/")).alias("final_url"),
                                    F.when(F.col("id") % 2 == 0, F.lit("x\n\"y")).alias("text")).repartition(12)
    for fmt in ("parquet", "json"):
        path = str(tmp_path / fmt)
        for run in ("a", "a", "b"):
            sinks.write_by_host(rows, path, run, fmt=fmt, parts=5, salts=3)
        rows.withColumn("part", F.lit(0)).write.partitionBy("part").format(fmt).save(f"{path}/run-c")  # never listed: a writer that was lost
        got = sinks.read_committed(spark, path, fmt)
        assert got.columns == ["id", "final_url", "text", "host"] and got.count() == 6000
        assert got.drop("host").distinct().exceptAll(rows).count() == 0
        files = list((tmp_path / fmt / "run-a").rglob("part-*." + ("json" if fmt == "json" else "snappy.parquet")))
        assert 5 <= len(files) <= 15
        folders = {r.host: r.n for r in spark.read.format(fmt).load(f"{path}/run-a").groupBy("host").agg(F.countDistinct("part").alias("n")).collect()}
        assert set(folders.values()) == {1}  # the rows of a host lie in one part
