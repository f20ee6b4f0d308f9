"""Difference of two matrices."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators.catalog import BLOCKS, CELLS, form_of, require_unique
from rowloom.operators.forms import blocks_to_cells

# Columns that say where a tile lies.
PLACE = ["bi", "bj", "i0", "j0", "nr", "nc"]


def _tiling(blocks: DataFrame):
    """(tile rows, tile columns) of a regular tiling, or None; reads no data."""
    size = blocks.agg(F.max("nr").alias("r"), F.max("nc").alias("c"), F.max("i0").alias("i"), F.max("j0").alias("j")).first()
    if size["r"] is None:
        return None
    off = (F.col("i0") != F.col("bi") * size["r"]) | (F.col("j0") != F.col("bj") * size["c"])
    return None if not blocks.where(off).isEmpty() else (size["r"], size["c"])


def _unequal_tiles(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tiles of both matrices whose digests differ or that the other lacks: only digests are joined."""
    seal = [F.xxhash64("data").alias("d"), F.xxhash64(F.reverse("data")).alias("e")]
    left, right = a.select(*PLACE, *seal), b.select(*PLACE, *seal)
    both = left.withColumn("n", F.lit(1)).unionByName(right.withColumn("n", F.lit(-1)))
    apart = both.groupBy(*PLACE, "d", "e").agg(F.sum("n").alias("n")).where("n <> 0")
    keys = apart.select("bi", "bj").distinct()
    return tuple(m.join(keys, ["bi", "bj"], "left_semi") for m in (a, b))


def matrix_diff(a: DataFrame, b: DataFrame, tol: float = 0.0) -> DataFrame:
    """Cells that differ by more than ``tol``: (i, j, xa, xb). An absent row, cell or element counts as 0.0.

    Rows, whose indices must be distinct, are joined whole and compared element by element in place, so only
    differing cells are ever exploded. Tiles of one regular tiling are compared by digests first, and only those that
    differ are opened; tiles cut differently are compared cell by cell. Repeated cells add up before the comparison. Two NaNs are equal; a NaN
    and a number differ.
    """
    differs = lambda x, y: ~x.eqNullSafe(y) & ~(F.abs(x - y) <= tol)
    if form_of(a) != form_of(b):
        raise TypeError(f"matrices in different forms: {form_of(a)} and {form_of(b)}")
    if form_of(a) == BLOCKS:
        if (cut := _tiling(a)) is not None and cut == _tiling(b):
            a, b = _unequal_tiles(a, b)
        a, b = blocks_to_cells(a), blocks_to_cells(b)
    if form_of(a) == CELLS:
        left = a.groupBy("i", "j").agg(F.sum("x").alias("xa"))
        right = b.groupBy("i", "j").agg(F.sum("x").alias("xb"))
        both = left.join(right, ["i", "j"], "full").fillna(0.0, ["xa", "xb"])
        return both.where(differs(F.col("xa"), F.col("xb")))
    left = require_unique(a).select("i", F.col("v").alias("va"))
    right = require_unique(b).select("i", F.col("v").alias("vb"))
    none = F.array().cast("array<double>")
    pair = F.zip_with(
        F.coalesce("va", none),
        F.coalesce("vb", none),
        lambda x, y: F.struct(F.coalesce(x, F.lit(0.0)).alias("xa"), F.coalesce(y, F.lit(0.0)).alias("xb")),
    )
    numbered = F.transform(pair, lambda p, j: F.struct(j.cast("bigint").alias("j"), p["xa"].alias("xa"), p["xb"].alias("xb")))
    found = F.filter(numbered, lambda p: differs(p["xa"], p["xb"]))
    return left.join(right, "i", "full").select("i", F.inline(found))
