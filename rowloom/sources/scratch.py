"""Where intermediate tables go."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a local session uses a folder beside the warehouse's tables; a cluster has no folder that all
    its machines share, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/rowloom-{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The same table, written to the scratch folder and read back: what follows does not compute it again."""
    path = scratch_path(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
