"""Shared storage of a run: folders and tables under the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from webloom.session import checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder of its own only where that is unset (tests)."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or checkpoint_dir(spark)


def new_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder name for one run of one operator."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder: lineage ends there and later reads don't compute it again."""
    checkpoint_dir(df.sparkSession)  # sets the folder where the session has none
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of this application (once), wherever it is installed on the driver."""
    sc = spark.sparkContext
    if getattr(sc, "_webloom_shipped", False):
        return
    here = pathlib.Path(__file__).resolve().parents[1]
    target = pathlib.Path(tempfile.mkdtemp(prefix="webloom-src-")) / "webloom_src.zip"  # read by the driver's own file server
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    sc.addPyFile(str(target))
    sc._webloom_shipped = True


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` by workers that have the package."""
    ship(df.sparkSession)

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()  # workers are reused; their peaks should not add up

    return df.mapInArrow(released, schema)
