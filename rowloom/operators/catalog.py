"""What a matrix is: its form, dimensions, density, name and index uniqueness."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.grids import LAYOUTS, Grid

ROWS, CELLS, BLOCKS, SPARSE = "rows", "cells", "blocks", "sparse"


def form_of(matrix: DataFrame) -> str:
    """Which of the four forms a DataFrame is in, judged by its column names."""
    names = set(matrix.columns)
    if {"bi", "bj", "i0", "j0", "nr", "nc", "data"} <= names:
        return BLOCKS
    if {"i", "j", "x"} <= names:
        return CELLS
    if {"i", "idx", "val"} <= names:
        return SPARSE
    if {"i", "v"} <= names:
        return ROWS
    raise TypeError(f"not a matrix: columns {matrix.columns}; expected (i, v), (i, idx, val), (i, j, x) or blocks")


def row_width(rows: DataFrame) -> int:
    """Number of columns, taken from one row; kernels check every other row against it."""
    first = rows.select(F.size("v").alias("n")).first()
    return 0 if first is None else first["n"]


def of_width(rows: DataFrame, n: int) -> DataFrame:
    """The same rows, failing on one that does not have ``n`` elements."""
    ragged = F.raise_error(F.concat(F.lit("row "), "i", F.lit(f" does not have {n} elements")))
    return rows.select("i", F.when(F.size("v") == n, F.col("v")).otherwise(ragged.cast("array<double>")).alias("v"))


def dims(matrix: DataFrame, width: int | None = None) -> tuple[int, int]:
    """(rows, columns): highest index plus one. Reads index columns only, plus one vector for rows."""
    form = form_of(matrix)
    if form == ROWS:
        m = matrix.agg(F.max("i")).first()[0]
        return (0 if m is None else m + 1), (row_width(matrix) if width is None else width)
    if form == CELLS:
        m, n = matrix.agg(F.max("i") + 1, F.max("j") + 1).first()
    elif form == SPARSE:
        m, n = matrix.agg(F.max("i") + 1, F.max(F.try_element_at("idx", F.lit(-1))) + 1).first()
    else:
        m, n = matrix.agg(F.max(F.col("i0") + F.col("nr")), F.max(F.col("j0") + F.col("nc"))).first()
    return m or 0, (n or 0) if width is None else width


def nonzeros(vector) -> Column:
    """How many elements of a vector differ from zero."""
    return F.size(F.filter(vector, lambda x: x != 0.0)).cast("bigint")


def _measures(matrix: DataFrame) -> DataFrame:
    """One pass over the matrix, one output record; partial aggregation keeps the shuffle to one row per task."""
    form = form_of(matrix)
    if form == ROWS:
        found = matrix.select("i", F.size("v").alias("n"), nonzeros("v").alias("nnz")).agg(
            F.max("i") + 1, F.max("n"), F.min("n"), F.count("*"), F.sum("nnz")
        )
    elif form == SPARSE:
        last = F.max(F.try_element_at("idx", F.lit(-1))) + 1
        found = matrix.agg(F.max("i") + 1, last, last, F.count("*"), F.sum(nonzeros("val")))
    elif form == CELLS:
        found = matrix.agg(
            F.max("i") + 1, F.max("j") + 1, F.max("j") + 1, F.lit(None), F.count_if(F.col("x") != 0.0)
        )
    else:
        right = F.col("j0") + F.col("nc")
        found = matrix.agg(
            F.max(F.col("i0") + F.col("nr")), F.max(right), F.max(right), F.lit(None), F.sum(nonzeros("data"))
        )
    found = found.toDF("m", "n", "least", "stored", "nnz")
    ragged = F.raise_error(F.concat(F.lit("rows of "), "least", F.lit(" to "), "n", F.lit(" elements in one matrix")))
    zero = F.lit(0).cast("bigint")
    return found.select(
        F.coalesce("m", zero).alias("num_rows"),
        F.when(F.col("least") < F.col("n"), ragged.cast("bigint"))
        .otherwise(F.coalesce(F.col("n").cast("bigint"), zero))
        .alias("num_cols"),
        F.col("stored").cast("bigint").alias("stored_rows"),
        F.coalesce("nnz", zero).alias("nnz"),
    )


def matrix_density(matrix: DataFrame) -> DataFrame:
    """Dimensions, nonzero count and the share of entries that are not zero."""
    size = F.col("num_rows") * F.col("num_cols")
    return _measures(matrix).select(
        "num_rows", "num_cols", "nnz", F.when(size > 0, F.col("nnz") / size).otherwise(0.0).alias("density")
    )


def matrix_info(matrix: DataFrame, name: str = "", layout: str = "VC_STAR", grid: Grid | None = None) -> DataFrame:
    """One-row handle of a matrix: name, dimensions, sparsity, layout, process grid and partition count."""
    grid = grid or Grid(1, 1)
    size = F.col("num_rows") * F.col("num_cols")
    return _measures(matrix).select(
        F.lit(name).alias("name"),
        "num_rows",
        "num_cols",
        "stored_rows",
        "nnz",
        F.when(size > 0, F.col("nnz") / size).otherwise(0.0).alias("density"),
        F.lit(layout).alias("layout"),
        F.lit(LAYOUTS[layout].code).alias("layout_code"),
        F.lit(LAYOUTS[layout].label).alias("layout_label"),
        F.lit(grid.rows).alias("grid_rows"),
        F.lit(grid.cols).alias("grid_cols"),
        F.lit(grid.size).alias("num_partitions"),
    )


def describe_matrix(info: DataFrame) -> DataFrame:
    """Human-readable text of each handle."""
    text = F.format_string(
        "%s: %d x %d, %d nonzero, layout %s, grid %d x %d",
        *[F.col(c) for c in ("name", "num_rows", "num_cols", "nnz", "layout_label", "grid_rows", "grid_cols")],
    )
    return info.select("name", text.alias("description"))


def register_matrix(matrix: DataFrame, name: str) -> DataFrame:
    """Make a matrix available to SQL and ``spark.table`` under a name."""
    form_of(matrix)
    matrix.createOrReplaceTempView(name)
    return matrix.sparkSession.table(name)


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """Row indices that occur more than once, with their number of copies."""
    return rows.groupBy("i").agg(F.count("*").alias("copies")).where("copies > 1")


def require_unique(matrix: DataFrame, *keys: str) -> DataFrame:
    """The same matrix, failing before its first record is processed when a key repeats.

    The check is a scalar subquery over the key columns alone, pre-aggregated per task, so neither a wide
    vector nor a heavily repeated key is ever gathered.
    """
    keys = keys or ("i",)
    copies = matrix.groupBy(*keys).agg(F.count("*").alias("copies")).agg(F.max("copies").alias("most"))
    message = F.concat(F.lit(f"repeated {', '.join(keys)}: up to "), "most", F.lit(" copies of one key"))
    verdict = copies.select(
        F.when(F.coalesce("most", F.lit(0)) <= 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )
    return matrix.where(verdict.scalar())
