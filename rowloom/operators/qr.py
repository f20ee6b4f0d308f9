"""R factors of tall matrices, merged up a tree."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom import kernels

# Partial R factors merged by one task on the lower levels of the tree.
QR_FAN_IN = 64


def r_factor(rows: DataFrame, n: int, factor: np.ndarray | None = None) -> np.ndarray:
    """The n x n upper triangular R of A = QR; rows of zeros where A has fewer rows. A' is never multiplied by A.

    A is dense or sparse rows of length n; with ``factor`` (n x b) the result is that of A times it, b x b.
    """
    values = [c for c in rows.columns if c in ("v", "idx", "val")]
    level = rows.select(*values).mapInArrow(kernels.qr_partials(n, factor), kernels.PARTIAL_SCHEMA)
    n = n if factor is None else factor.shape[1]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lower = (tasks > QR_FAN_IN) + (tasks > QR_FAN_IN * QR_FAN_IN)
    for merged in [f"c div {QR_FAN_IN}"] * lower + ["0L"]:
        level = level.withColumn("c", F.expr(merged)).groupBy("c").applyInArrow(kernels.merge_r(n), kernels.PARTIAL_SCHEMA)
    out = np.zeros((n, n))
    for part in level.select("part").collect():
        found = np.frombuffer(part["part"], dtype=np.float64).reshape(-1, n)
        out[: len(found)] = found
    return out
