"""libsvm files as matrices: the label is the row index."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.vectors import index as valid_index
from rowloom.operators.catalog import require_unique
from rowloom.operators.forms import coo_to_rows
from rowloom.operators.sparse import sparse_rows, sparse_to_cells, sparse_to_rows

ON_DUPLICATE = ("error", "keep", "sum", "first")


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    """(i, idx, val) of every line ``label index:value ...``, indices from 1 in ascending order; a # opens a comment."""
    text = F.trim(F.regexp_replace(F.split("value", "#", 2)[0], r"\s+", " "))
    words = spark.read.text(path).select("*", "_metadata", text.alias("line")).where("line <> ''").select(
        "_metadata", F.split("line", " ").alias("w")
    )
    pairs = F.slice("w", 2, F.size("w") - 1)
    return words.select(
        valid_index(F.col("w")[0].cast("double")).alias("i"),
        F.transform(pairs, lambda t: F.split(t, ":")[0].cast("bigint") - 1).alias("idx"),
        F.transform(pairs, lambda t: F.split(t, ":")[1].cast("double")).alias("val"),
        "_metadata",
    )


def read_libsvm_sparse(
    spark: SparkSession, path: str, num_features: int | None = None, on_duplicate: str = "error"
) -> DataFrame:
    """Sparse rows of a libsvm file: the label, cut to an integer, is the row index; nothing is made dense.

    Lines with the same label: 'error' fails, 'keep' leaves several rows with one index, 'sum' adds them up, 'first'
    takes the one that comes first in the files. Indices that are negative, repeat or do not ascend fail, and so do
    those beyond ``num_features``. The text is read once, its labels once more to find repeated ones.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}, not {on_duplicate!r}")
    before = F.concat(F.array(F.lit(-1).cast("bigint")), F.slice("idx", 1, F.greatest(F.size("idx") - 1, F.lit(0))))
    disordered = F.exists(F.zip_with("idx", before, lambda j, p: j <= p), lambda bad: bad) & (F.size("idx") > 0)
    refused = F.raise_error(F.lit("column indices are negative, repeat or do not ascend")).cast("array<bigint>")
    idx = F.when(disordered, refused).otherwise(F.col("idx"))
    if num_features is not None:
        last = F.try_element_at("idx", F.lit(-1))
        outside = F.raise_error(F.concat(F.lit("column index "), last, F.lit(f" outside a matrix of width {num_features}")))
        idx = F.when(last >= num_features, outside.cast("array<bigint>")).otherwise(idx)
    lines = _parsed(spark, path).withColumn("idx", idx)
    if on_duplicate == "first":
        place = F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        )
        row = F.min_by(F.struct("idx", "val"), "place").alias("row")
        return lines.withColumn("place", place).groupBy("i").agg(row).select("i", "row.idx", "row.val")
    rows = lines.select("i", "idx", "val")
    if on_duplicate == "sum":
        return sparse_rows(sparse_to_cells(rows))
    return require_unique(rows) if on_duplicate == "error" else rows


def read_libsvm_matrix(
    spark: SparkSession, path: str, num_features: int | None = None, on_duplicate: str = "error"
) -> DataFrame:
    """Row form of a libsvm file, as ``read_libsvm_sparse`` reads it; features become dense.

    Giving ``num_features`` saves a pass over the file.
    """
    sparse = read_libsvm_sparse(spark, path, num_features, on_duplicate)
    if on_duplicate == "sum":
        return coo_to_rows(sparse_to_cells(sparse), num_features, unique=True)
    if num_features is None:
        indices = _parsed(spark, path).select(F.max(F.try_element_at("idx", F.lit(-1))) + 1)
        num_features = indices.first()[0] or 0
    return sparse_to_rows(sparse, num_features)
