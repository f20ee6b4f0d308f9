"""Sparse rows: (i, idx, val), one record per row with its stored elements in ascending column order."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom import kernels
from rowloom.functions.vectors import fill_gaps, index as valid_index, zeros
from rowloom.limits import BROADCAST_BYTES, MAX_ROW_WIDTH, check_row_width
from rowloom.operators import products
from rowloom.operators.catalog import BLOCKS, CELLS, ROWS, SPARSE, dims, form_of, require_unique
from rowloom.operators.forms import blocks_to_cells, coo_to_rows


def _records(table: DataFrame, cells) -> DataFrame:
    """Sparse rows from a column of sorted (j, x) structs."""
    named = table.select("i", cells.alias("c"))
    return named.select("i", F.col("c.j").alias("idx"), F.col("c.x").alias("val"))


def sparse_rows(matrix: DataFrame, unique: bool = False) -> DataFrame:
    """Sparse rows of a matrix in any form; elements that are zero are not stored.

    Dense rows are narrow. Cells and tiles are gathered by row after repeated cells are added up (``unique=True``
    promises that none repeats); a row of more than MAX_ROW_WIDTH stored elements fails before any is gathered.
    """
    form = form_of(matrix)
    if form == SPARSE:
        return matrix
    if form == ROWS:
        numbered = F.transform("v", lambda x, k: F.struct(k.cast("bigint").alias("j"), x.alias("x")))
        return _records(matrix, F.filter(numbered, lambda c: c["x"].isNull() | (c["x"] != 0.0)))
    cells = blocks_to_cells(matrix) if form == BLOCKS else matrix
    cells = cells.select(valid_index("i").alias("i"), valid_index("j").alias("j"), "x")
    if not unique and form == CELLS:
        cells = cells.groupBy("i", "j").agg(F.sum("x").alias("x"))
    cells = cells.where("x IS NULL OR x <> 0")
    longest = cells.groupBy("i").agg(F.count("*").alias("n")).agg(F.max("n").alias("n"))
    message = F.concat(F.lit("a row of "), "n", F.lit(f" stored elements exceeds {MAX_ROW_WIDTH}; keep the matrix in cells"))
    fits = F.when(F.coalesce("n", F.lit(0)) <= MAX_ROW_WIDTH, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    gathered = F.sort_array(F.collect_list(F.struct("j", "x")))
    return _records(cells.where(longest.select(fits).scalar()).groupBy("i").agg(gathered.alias("c")), F.col("c"))


def sparse_to_cells(rows: DataFrame) -> DataFrame:
    """One record per stored element. Narrow."""
    return rows.select("i", F.explode(F.arrays_zip("idx", "val")).alias("c")).select(
        "i", F.col("c.idx").alias("j"), F.col("c.val").alias("x")
    )


def sparse_to_rows(rows: DataFrame, num_cols: int | None = None) -> DataFrame:
    """Dense rows. Narrow; reads the last index of every row first unless ``num_cols`` is given."""
    n = check_row_width(dims(rows)[1] if num_cols is None else num_cols)
    cells = F.transform(
        F.arrays_zip("idx", "val"), lambda c: F.struct(c["idx"].alias("j"), c["val"].alias("x"))
    )
    return rows.select("i", cells.alias("c")).select("i", fill_gaps("c", n).alias("v"))


def gramian_sparse(matrix: DataFrame) -> DataFrame:
    """Cells of A'A from sparse rows, or from a matrix in another form: no cell is made that no row contributes to.

    Every task multiplies the stored elements of its rows pair by pair, a bounded number of pairs at a time, and adds
    up equal cells before the shuffle; so memory follows the non-zeros and the width has no bound. Rows of one index
    are rows of their own, as in the dense product.
    """
    rows = sparse_rows(matrix)
    partial = rows.select("idx", "val").mapInArrow(kernels.sparse_gram, "i bigint, j bigint, x double")
    upper = partial.groupBy("i", "j").agg(F.sum("x").alias("x"))
    own, turned = F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))
    both = F.when(F.col("i") == F.col("j"), F.array(own)).otherwise(F.array(own, turned))
    return upper.select(F.explode(both).alias("p"), "x").select("p.i", "p.j", "x")


def project_rows_sparse(matrix: DataFrame, b, num_cols: int | None = None) -> DataFrame:
    """A.B in row form for sparse A and dense B (numpy array or row form), one result row per row of A.

    While B is within the broadcast bound it travels to every task, which reads B's rows at the stored indices only,
    and A does not move. Beyond it, A's cells are joined with B's on the inner index. A row of A without stored
    elements is a zero row; an index outside B fails.
    """
    rows = sparse_rows(matrix)
    if isinstance(b, DataFrame):
        k, n = dims(b)
        k = max(k, num_cols or 0)
        if k * n * 8 > BROADCAST_BYTES:
            return _joined_projection(rows, b, k, n)
        b = products.collect_dense(b, k, n, "the right factor")
    b = np.asarray(b, dtype=np.float64)
    if b.nbytes > BROADCAST_BYTES:
        return _joined_projection(rows, products.local_rows(rows.sparkSession, b), *b.shape)
    return rows.select("i", "idx", "val").mapInArrow(kernels.sparse_project(b), kernels.ROW_SCHEMA)


def _joined_projection(rows: DataFrame, b: DataFrame, k: int, n: int) -> DataFrame:
    from rowloom.operators.forms import rows_to_coo

    keyed = products.keyed(rows, "idx", "val")
    cells = sparse_to_cells(keyed.select(F.col("key").alias("i"), "idx", "val"))
    outside = F.raise_error(F.concat(F.lit("column index "), "j", F.lit(f" outside a right factor of {k} rows")))
    cells = cells.withColumn("j", F.when(F.col("j") < k, F.col("j")).otherwise(outside.cast("bigint")))
    found = coo_to_rows(products.matmul(cells, rows_to_coo(require_unique(b))), n, unique=True)
    found = found.select(F.col("i").alias("key"), "v")
    length = F.least(F.lit(n), F.col("i") + n)
    return keyed.select("key", "i").join(found, "key", "left").select("i", F.coalesce("v", zeros(length)).alias("v"))

