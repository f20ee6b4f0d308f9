"""Row-wise norms and products, and whole-matrix sums."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.vectors import dot, norm, paired_or_zero, sqdist
from rowloom.operators.catalog import BLOCKS, CELLS, SPARSE, form_of, require_unique


def row_norms(rows: DataFrame) -> DataFrame:
    """Euclidean norm of every row. Narrow."""
    return rows.select("i", norm("v").alias("norm"))


def frobenius_sq(matrix: DataFrame) -> DataFrame:
    """Sum of squares of all entries, as one record; each task sends one partial sum.

    Exploding inside the generated code is several times faster than folding each vector; an empty vector's
    NULL adds nothing.
    """
    form = form_of(matrix)
    if form != CELLS:
        matrix = matrix.select(F.explode_outer({BLOCKS: "data", SPARSE: "val"}.get(form, "v")).alias("x"))
    return matrix.agg(F.coalesce(F.sum(F.col("x") * F.col("x")), F.lit(0.0)).alias("frobenius_sq"))


def _paired(a: DataFrame, b: DataFrame) -> DataFrame:
    """Equally numbered rows of A and B, which must be unique; a row that one of them lacks reads as zeros."""
    left, right = (require_unique(m).select("i", F.col("v").alias(name)) for m, name in ((a, "va"), (b, "vb")))
    both = left.join(right, "i", "full")
    va, vb = paired_or_zero("va", "vb")
    return both.select("i", va.alias("va"), vb.alias("vb"))


def row_sqdist(a: DataFrame, b: DataFrame) -> DataFrame:
    """Squared distance between equally numbered rows of two matrices; one equi-join on the index. An absent row is zero."""
    return _paired(a, b).select("i", sqdist("va", "vb").alias("sqdist"))


def row_dots(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner product of equally numbered rows of two matrices."""
    return _paired(a, b).select("i", dot("va", "vb").alias("dot"))
