"""Golub-Kahan bidiagonalisation in blocks, with thick restart. Long vectors are tables; the driver holds small factors.

A is never squared, so small singular values keep their accuracy, and neither its rows nor its columns are bounded by
one node's memory. A matrix with one short side is reduced to its R factor first, as in Chan's R-bidiagonalisation
(ACM TOMS 8, 1982): no long vector is stored or shuffled then.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom import kernels
from rowloom.functions.vectors import zeros
from rowloom.limits import BROADCAST_BYTES, DENSE_STEP_BYTES, PIECE_BYTES, SHORT_SIDE
from rowloom.operators.catalog import CELLS, ROWS, SPARSE, dims, form_of
from rowloom.operators.forms import rows_to_coo, to_rows
from rowloom.operators.products import keyed, local_rows, project_rows, summed
from rowloom.operators.qr import r_factor
from rowloom.operators.selection import row_spine
from rowloom.operators.sparse import sparse_to_cells
from rowloom.sources.random import random_rows
from rowloom.sources.scratch import stored

# Widest block of vectors that one pass multiplies, and blocks of a basis before it restarts.
MOST_WIDE = 32
BLOCKS = 8

# How many times longer the other side must be for a short one to be worth an R factor.
ASPECT = 8


class _Matrix:
    """A in a form that both products read in place; ``i`` numbers records, so repeated indices are rows of their own."""

    def __init__(self, matrix: DataFrame, n: int):
        form = form_of(matrix)
        if form not in (ROWS, SPARSE, CELLS):
            matrix, form = to_rows(matrix), ROWS
        self.n, self.keys, self.dense, self.held = n, None, None, None
        if form == CELLS:
            self.cells, self.m = matrix, dims(matrix, width=n)[0]
        else:
            values = ["v"] if form == ROWS else ["idx", "val"]
            self.held = held = keyed(matrix, *values)
            self.keys, self.m = held.select("key", "i"), held.count()
            records = held.select(F.col("key").alias("i"), *values)
            self.cells = rows_to_coo(records) if form == ROWS else sparse_to_cells(records)
            self.dense = records if form == ROWS else None

    def times(self, block: DataFrame, width: int) -> DataFrame:
        """A.V for a block V of ``width`` columns; rows that come out as zero may be absent."""
        if self.dense is not None and self.n * width * 8 <= BROADCAST_BYTES:
            return project_rows(self.dense, block, self.n)
        return self._joined(block, "j", "i", self.n, width)

    def turned_times(self, block: DataFrame, width: int) -> DataFrame:
        """A'.U for a block U of ``width`` columns."""
        if self.dense is not None and self.n * width * 8 <= DENSE_STEP_BYTES:
            u = block.select("i", F.col("v").alias("u"))
            pairs = self.dense.join(F.broadcast(u) if self.m * width * 8 <= BROADCAST_BYTES else u, "i").select("v", "u")
            partials = pairs.mapInArrow(kernels.cross_partials(self.n, width, PIECE_BYTES), kernels.PARTIAL_SCHEMA)
            return summed(partials, width)
        return self._joined(block, "i", "j", self.m, width)

    def _joined(self, block: DataFrame, inner: str, outer: str, length: int, width: int) -> DataFrame:
        """Cells joined with a block's rows on one index and added up, with map-side combine, by the other.

        A block within the broadcast bound goes to the cells; a longer one is shuffled with them, and an index that
        holds very many cells is cut by the engine's handling of skewed joins.
        """
        side = block.select(F.col("i").alias(inner), "v")
        joined = self.cells.join(F.broadcast(side) if length * width * 8 <= BROADCAST_BYTES else side, inner)
        sums = joined.groupBy(outer).agg(*[F.sum(F.col("x") * F.col("v")[c]).alias(f"s{c}") for c in range(width)])
        return sums.select(F.col(outer).alias("i"), F.array(*[f"s{c}" for c in range(width)]).alias("v"))

    def indexed(self, u: DataFrame, count: int) -> DataFrame:
        """Left vectors under A's own row indices; records that ``u`` lacks are zero."""
        if self.keys is None:
            return u
        length = F.least(F.lit(count), F.col("key") + count)
        rows = self.keys.join(u.select(F.col("i").alias("key"), "v"), "key", "left")
        return rows.select("i", F.coalesce("v", zeros(length)).alias("v"))

    def few_rows(self) -> list | None:
        """Indices of the rows that hold cells, where they are few against the columns and A is not dense."""
        if self.dense is not None or self.n < ASPECT:
            return None
        found = _indices(self.cells, "i")
        return found if 0 < len(found) <= min(SHORT_SIDE, self.n // ASPECT) else None

    def columns_of(self, names: list) -> DataFrame:
        """A' as stored sparse rows, whose indices are places in ``names``."""
        table = pa.table({"i": pa.array(names, pa.int64()), "place": pa.array(range(len(names)), pa.int64())})
        placed = self.cells.join(F.broadcast(self.cells.sparkSession.createDataFrame(table)), "i")
        return stored(_gathered(placed.select(F.col("j").alias("i"), F.col("place").alias("j"), "x")), "columns")

    def random_start(self, width: int, seed: int) -> DataFrame:
        """A'.G for a random block G: a start inside the row space."""
        rows = self.cells.select("i").distinct() if self.dense is None else self.dense.select("i")
        noise = random_rows(rows, width, seed).select("i", F.transform("v", lambda x: x - 0.5).alias("v"))
        return self.turned_times(noise, width)


def _indices(cells: DataFrame, side: str) -> list:
    """The row or column indices that hold cells, SHORT_SIDE and one at most; one with nulls alone fails."""
    counted = cells.where(F.col(side).isNotNull()).groupBy(side).agg(F.count("x").alias("known"))
    found = counted.limit(SHORT_SIDE + 1).collect()
    if not all(r["known"] for r in found):
        raise ValueError("matrix has a NULL element")
    return [r[side] for r in found]


def _gathered(cells: DataFrame) -> DataFrame:
    """Sparse rows of cells whose column indices are few; repeated cells add up, map-side first.

    As where cells are joined with vectors, those without an index meet nothing and sums pass over nulls; a row of
    nulls alone fails.
    """
    cells = cells.where("i IS NOT NULL AND j IS NOT NULL")
    summed_cells = cells.groupBy("i", "j").agg(F.sum("x").alias("x"))
    lines = summed_cells.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "x"))).alias("c"))
    known = F.filter("c", lambda c: c["x"].isNotNull())
    null = F.raise_error(F.lit("matrix has a NULL element")).cast(lines.schema["c"].dataType)
    lines = lines.select("i", F.when(F.size(known) > 0, known).otherwise(null).alias("c"))
    return lines.select("i", F.col("c.j").alias("idx"), F.col("c.x").alias("val"))


def _reduced(a: _Matrix, k: int, names: list | None):
    """(U, sigma, V) from the R factor of A, or of A' where ``names`` lists A's few rows.

    With R = P S Q', the short side's vectors are Q's columns. The long side's are A Q / S, made orthonormal by a
    second R factor, as small singular values leave rounding of the largest in them.
    """
    if names is not None:
        records, width = a.columns_of(names), len(names)
    elif a.held is not None:
        records, width = a.held, a.n
    else:
        _indices(a.cells, "j")
        records, width = stored(_gathered(a.cells), "rows"), a.n
    _, sigma, turn = np.linalg.svd(r_factor(records, width))
    found = min(k, int((sigma > width * np.finfo(float).eps * sigma[0]).sum()))
    if not found:
        raise ValueError("a matrix without non-zero elements has no singular vectors")
    sigma, short = sigma[:found], turn[:found].T
    first = short / sigma
    again = r_factor(records, width, first)
    last = np.linalg.inv(again * np.sign(np.diag(again))[:, None])
    values = [c for c in records.columns if c in ("v", "idx", "val")]
    long = lambda kept, signs: kept.select("i", *values).mapInArrow(
        kernels.project_twice(first, last * signs), kernels.ROW_SCHEMA
    )
    spark = records.sparkSession
    if names is None:
        signs = column_signs(short)
        return long(records, signs), sigma, local_rows(spark, short * signs)
    inside = records.where(F.col("i") < a.n)
    signs = _signs(long(inside, 1.0), found)
    length = F.least(F.lit(found), F.col("i") + found)
    # The hint keeps the long index from being broadcast, which its few compressed bytes would suggest.
    present = records.select("i").hint("merge")
    missing = row_spine(spark, a.n).join(present, "i", "left_anti").select("i", zeros(length).alias("v"))
    u = pa.Table.from_batches([kernels.row_batch(names, short * signs)])
    return a.indexed(spark.createDataFrame(u, kernels.ROW_SCHEMA), found), sigma, long(inside, signs).unionByName(missing)


def _extended(basis: DataFrame | None, held: int, block: DataFrame, width: int):
    """(basis with the block's new directions appended, C, R) where block = basis C + new R, by QR done twice.

    R has as many rows as there are new directions: those that rounding alone makes are dropped.
    """
    added = block.select("i", F.col("v").alias("w"))
    if basis is None:
        both = added.select("i", F.col("w").alias("v"))
    else:
        joined = basis.join(added, "i", "full")
        none = zeros(F.least(F.lit(held), F.col("i") + held)), zeros(F.least(F.lit(width), F.col("i") + width))
        both = joined.select("i", F.concat(F.coalesce("v", none[0]), F.coalesce("w", none[1])).alias("v"))
    both, total = stored(both, "vectors"), held + width
    r = r_factor(both, total)
    first = np.linalg.solve(r[:held, :held], r[:held, held:])
    _, size, turn = np.linalg.svd(r[held:, held:])
    kept = int((size > total * np.finfo(float).eps * max(np.linalg.norm(r[:, held:]), 1e-300)).sum())
    if not kept:
        return basis, first, np.zeros((0, width))
    scaled = turn[:kept].T / size[:kept]
    once = np.block([[np.eye(held), -first @ scaled], [np.zeros((width, held)), scaled]])
    near = project_rows(both, once)
    r = r_factor(near, held + kept)
    again = np.linalg.solve(r[:held, :held], r[:held, held:])
    last = np.linalg.inv(r[held:, held:])
    twice = np.block([[np.eye(held), -again @ last], [np.zeros((kept, held)), last]])
    shape = size[:kept, None] * turn[:kept]
    # One product after the other: their product applied to the block would bring the rounding back.
    return stored(project_rows(near, twice), "basis"), first + again @ shape, r[held:, held:] @ shape


def _columns(basis: DataFrame, start: int, count: int) -> DataFrame:
    return basis.select("i", F.slice("v", start + 1, count).alias("v"))


def bidiagonal_triplets(matrix: DataFrame, n: int, k: int, tol: float, max_passes: int, seed: int):
    """(U, sigma, V) of the k largest singular values: U and V as rows (i, v), sigma as an array.

    Each step multiplies a block by A and by A' and makes both results orthogonal to all earlier blocks, so that
    A V = U B with a small B whose singular values are A's. The run ends when the residuals of the wanted triplets are
    at most ``tol`` of their singular values (or rounding of the largest), or when the blocks span all A reaches; a
    basis of BLOCKS blocks is replaced by its best approximations and the last block. More than ``max_passes`` passes
    fail. U has a row for every record of A, V for every column. Cells are read many times: the caller stores them.

    Where one side has at most SHORT_SIDE indices and the other ASPECT times as many, A is reduced to its R factor,
    which the driver's LAPACK bidiagonalises: exact, so that no passes are counted. Dense rows are so reduced only
    where the columns are few; few dense rows have no more than MAX_ROW_WIDTH columns.
    """
    a = _Matrix(matrix, n)
    if n <= SHORT_SIDE and a.m >= ASPECT * n:
        return _reduced(a, k, None)
    if names := a.few_rows():
        return _reduced(a, k, names)
    width = min(n, MOST_WIDE, k + 2)
    v, _, grown = _extended(None, 0, a.random_start(width, seed), width)
    u, small = None, np.zeros((0, 0))
    new, passes, seeds = len(grown), 1, 0
    if not new:
        raise ValueError("a matrix without non-zero elements has no singular vectors")
    while True:
        held_u, held_v = small.shape
        u, c, r = _extended(u, held_u, a.times(_columns(v, held_v, new), new), new)
        small = np.block([[small, c], [np.zeros((len(r), held_v)), r]])
        passes, wide, fresh = passes + 1, held_v + new, len(r)
        step = np.zeros((0, fresh))
        if fresh:
            v, _, step = _extended(v, wide, a.turned_times(_columns(u, held_u, fresh), fresh), fresh)
            passes += 1
        left, sigma, right = np.linalg.svd(small, full_matrices=False)
        residual = np.linalg.norm(step @ left[held_u:, :k], axis=0)
        floor = 10 * wide * np.finfo(float).eps * sigma[0]
        new = len(step)
        if not new and (len(sigma) < k or width < k):
            seeds += 1
            v, _, step = _extended(v, wide, a.random_start(width, seed + seeds), width)
            passes, new = passes + 1, len(step)
            if not new:
                break
        elif not new or (len(sigma) >= k and (residual <= np.maximum(tol * sigma[:k], floor)).all()):
            break
        if passes > max_passes:
            raise RuntimeError(f"no convergence to {tol} within {max_passes} passes (last residual {residual.max():.3e})")
        if wide + new > BLOCKS * width + k:
            keep = min(len(sigma), k + width)
            u = stored(project_rows(u, left[:, :keep]), "basis")
            turned = np.block([[right[:keep].T, np.zeros((wide, new))], [np.zeros((new, keep)), np.eye(new)]])
            v, small = stored(project_rows(v, turned), "basis"), np.diag(sigma[:keep])
    found = min(k, len(sigma))
    turned = np.zeros((wide + new, found))
    turned[:wide] = right[:found].T
    signs = _signs(project_rows(v, turned), found)
    u = a.indexed(project_rows(u, left[:, :found] * signs), found)
    # Columns that no cell of A names have no record in the basis.
    length = F.least(F.lit(found), F.col("i") + found)
    v = row_spine(matrix.sparkSession, n).join(project_rows(v, turned * signs), "i", "left")
    return u, sigma[:found], v.select("i", F.coalesce("v", zeros(length)).alias("v"))


def _signs(vectors: DataFrame, count: int) -> np.ndarray:
    """Signs that make the largest component of each column (the first of those equal up to rounding) positive."""
    tops = vectors.select("v").mapInArrow(kernels.column_tops(count), "j bigint, x double")
    least = np.zeros(count)
    for r in tops.groupBy("j").agg(F.max("x").alias("x")).collect():
        least[r["j"]] = r["x"] * (1 - 1e-9)
    firsts = vectors.select("i", "v").mapInArrow(kernels.first_tops(least), "j bigint, i bigint, x double")
    signs = np.ones(count)
    for r in firsts.groupBy("j").agg(F.min_by("x", "i").alias("x")).collect():
        signs[r["j"]] = -1.0 if r["x"] < 0 else 1.0
    return signs


def column_signs(basis: np.ndarray) -> np.ndarray:
    """The same for an array."""
    size = np.abs(basis)
    top = (size >= size.max(axis=0) * (1 - 1e-9)).argmax(axis=0)
    signs = np.sign(basis[top, np.arange(basis.shape[1])])
    return np.where(signs == 0, 1.0, signs)
