"""Tables between the jobs of one operator, in the folder that all executors share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of one Arrow batch, instead of Spark's default.
BATCH_ROWS = 2000
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where that is unset, a local session uses one beside the warehouse's tables; on a cluster it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_operators"


def store(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """df written to the shared folder as Parquet and read again: a lost executor costs no more than a reread."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a small table that an iteration rewrites."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Gives executors this package once a context, as Spark's own file distribution does for any user's module."""
    context = spark.sparkContext
    if hasattr(context, "_rowloom_archive") or not os.path.isdir(_PACKAGE):
        return
    staging = tempfile.TemporaryDirectory(prefix="rowloom-")  # Spark serves the file from here; it goes with the driver
    name = os.path.basename(_PACKAGE)
    context.addPyFile(shutil.make_archive(f"{staging.name}/{name}", "zip", os.path.dirname(_PACKAGE), name))
    context._rowloom_archive = staging


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """df.mapInArrow, for functions of this package.

    Batches of texts are kept short where the session has Spark's own default for their rows, and what Arrow's pool
    holds for reuse is given back when a task ends, because workers live on.
    """
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH_CONF) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(lean, schema)
