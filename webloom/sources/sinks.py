"""Sinks (S5): pages, links and entries as Parquet or JSON, clustered by host, in a bounded number of files.

A write goes to a folder of its own run and is listed in a manifest once it is whole; readers see listed runs only. A
run that is repeated (after a lost driver, say) writes the same folder again, so nothing is there twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls

#: Parts that hosts are dealt to, and files of a part at most: a host that holds a third of all rows is in one part
#: but in SALTS files, each written by a task of its own.
PARTS, SALTS = 16, 4


def write_by_host(df: DataFrame, path: str, run_id: str, url_col: str = "final_url", fmt: str = "parquet", parts: int = PARTS,
                  salts: int = SALTS) -> None:
    """Write ``df`` with a ``host`` column from ``url_col``, rows of a host in one part: at most parts * salts files."""
    rows = df.withColumn("host", urls.host_of(url_col))
    part = F.pmod(F.xxhash64("host"), F.lit(parts)).cast("int")
    salt = F.pmod(F.xxhash64(*[c for c, kind in rows.dtypes if not kind.startswith("map")]), F.lit(salts))
    rows = rows.withColumns({"part": part, "_salt": salt}).repartition(parts * salts, "part", "_salt").drop("_salt")
    out = f"run-{run_id}"
    rows.write.mode("overwrite").partitionBy("part").format(fmt).save(f"{path}/{out}")
    schema = T._parse_datatype_string("run string, schema string")
    done = df.sparkSession.createDataFrame([(out, rows.drop("part").schema.json())], schema)
    done.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/{out}")


def read_committed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Rows of all runs that the manifest lists (one line a run)."""
    runs = sorted((r.run, r.schema) for r in spark.read.parquet(f"{path}/commits/*").collect())
    own = T.StructType.fromJson(json.loads(runs[-1][1]))
    out = None
    for run, _ in runs:
        one = spark.read.schema(T.StructType([*own.fields, T.StructField("part", T.IntegerType())])).format(fmt).load(f"{path}/{run}").drop("part")
        out = one if out is None else out.unionByName(one)
    return out
