"""Rank-k truncated SVD of a row-form matrix, reconstruction and its error.

Only n x n, n x k and n x b arrays ever reach the driver (n columns, b a small block width), each checked
against a size bound. Everything with one record per row stays distributed.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom import kernels
from rowloom.limits import BROADCAST_BYTES, DRIVER_BYTES, GRAM_MAX_COLS, PIECE_BYTES, QR_MAX_COLS, check_driver_bytes
from rowloom.operators.bidiagonal import bidiagonal_triplets, column_signs
from rowloom.operators.catalog import CELLS, ROWS, dims, form_of, row_width
from rowloom.operators.forms import to_rows, transpose
from rowloom.operators.products import collect_dense, gramian, keyed, local_rows, project_rows, summed, vectors
from rowloom.operators.qr import r_factor
from rowloom.operators.reductions import frobenius_sq, row_sqdist
from rowloom.sources.scratch import stored

# Blocks of basis vectors kept before a Krylov run restarts from its best approximations: at most, and the
# fewest that still converge usefully.
KRYLOV_BLOCKS = 24
KRYLOV_BLOCKS_LEAST = 3


class SVD(NamedTuple):
    """A = U diag(S) V': U (i, v) distributed, S (k, sigma) descending from k = 0, V (i, v) with n rows."""

    U: DataFrame
    S: DataFrame
    V: DataFrame


def _from_gram(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All singular values and right vectors from the Gram matrix, decomposed on the driver (n x n)."""
    gram = collect_dense(gramian(rows, n), n, n, "the Gram matrix")
    values, basis = np.linalg.eigh(gram)
    return np.sqrt(np.clip(values[::-1], 0.0, None)), basis[:, ::-1]


def _refined(rows: DataFrame, sigma: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values that rounding hides in A'A, from a second pass over A in the basis that the first one found.

    A W with W = V / sigma has columns of similar size, small ones raised to the noise floor, so its own Gram matrix
    hides nothing. From that R'R = (A W)'(A W), and A = (A W) W^-1 has the singular values of R W^-1 (n x n).
    """
    n = len(sigma)
    scale = np.maximum(sigma, sigma[0] * _floor(n))
    partials = vectors(rows).mapInArrow(kernels.whitened_partials(basis / scale, PIECE_BYTES), kernels.PARTIAL_SCHEMA)
    gram = collect_dense(summed(partials, n), n, n, "the Gram matrix")
    values, turned = np.linalg.eigh(gram)
    root = np.sqrt(np.clip(values, 0.0, None))[:, None] * turned.T
    _, found, vt = np.linalg.svd(root * scale @ basis.T)
    return found, vt.T


def _floor(n: int) -> float:
    """Singular values below this part of the largest are lost in A'A."""
    return float(np.sqrt(n * np.finfo(np.float64).eps))


def _from_qr(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values without squaring the condition number: R factors merged up a tree of three levels."""
    if n > QR_MAX_COLS:
        raise ValueError(f"tall-skinny QR of {n} columns exceeds {QR_MAX_COLS}; use method='bidiagonal'")
    if rows.isEmpty():
        raise ValueError("an empty matrix has no singular values")
    _, sigma, vt = np.linalg.svd(r_factor(rows, n), full_matrices=False)
    return sigma, vt.T


def _orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns spanning ``block`` outside ``basis``; dependent directions are dropped."""
    floor = np.linalg.norm(block) * 1e-12
    outside, sizes, _ = np.linalg.svd(block - basis @ (basis.T @ block), full_matrices=False)
    outside = outside[:, sizes > floor]
    return np.linalg.qr(outside - basis @ (basis.T @ outside))[0]


def _from_krylov(
    rows: DataFrame, n: int, k: int, tol: float, max_passes: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Leading singular values of a wide matrix by block Krylov iteration on A'A (Musco & Musco, NeurIPS 2015).

    Every step is one pass over A that returns n x b numbers. The run ends when the residual of all k
    approximations falls below ``tol`` relative to the k-th squared singular value; it fails loudly if that
    takes more than ``max_passes`` passes.
    """
    width = min(n, k + 5)
    pair = 2 * n * width * 8
    check_driver_bytes(KRYLOV_BLOCKS_LEAST * pair, "the Krylov basis")
    blocks = min(KRYLOV_BLOCKS, DRIVER_BYTES // pair)
    rng = np.random.default_rng(seed)
    block = np.linalg.qr(rng.standard_normal((n, width)))[0]
    basis, image = np.zeros((n, 0)), np.zeros((n, 0))
    for _ in range(max_passes):
        partials = vectors(rows).mapInArrow(
            kernels.normal_partials(block, PIECE_BYTES), kernels.PARTIAL_SCHEMA
        )
        found = collect_dense(summed(partials, block.shape[1]), n, block.shape[1], "a Krylov block")
        basis, image = np.hstack([basis, block]), np.hstack([image, found])
        small = basis.T @ image
        values, mix = np.linalg.eigh((small + small.T) / 2)
        values, mix = values[::-1], mix[:, ::-1]
        keep = min(width, len(values))
        ritz, ritz_image = basis @ mix[:, :keep], image @ mix[:, :keep]
        residual = ritz_image - ritz * values[:keep]
        worst = np.linalg.norm(residual[:, :k], axis=0).max()
        if basis.shape[1] == n or worst <= tol * max(values[min(k, keep) - 1], 0.0):
            return np.sqrt(np.clip(values[:k], 0.0, None)), ritz[:, :k]
        if basis.shape[1] + width > blocks * width:
            basis, image, found = ritz, ritz_image, residual
        block = _orthonormal(found, basis)[:, : n - basis.shape[1]]
        if block.shape[1] == 0:
            return np.sqrt(np.clip(values[:k], 0.0, None)), ritz[:, :k]
    raise RuntimeError(f"no convergence to {tol} within {max_passes} passes (last residual {worst:.3e})")


def _signed(basis: np.ndarray) -> np.ndarray:
    """Flip each column so that its largest component (the first of those equal up to rounding) is positive."""
    return basis * column_signs(basis) if basis.size else basis


def truncated_svd(
    rows: DataFrame,
    k: int,
    method: str = "auto",
    num_cols: int | None = None,
    rcond: float = 1e-9,
    tol: float = 1e-8,
    max_passes: int = 200,
    seed: int = 1000,
) -> SVD:
    """The k largest singular values and their vectors.

    ``method``: 'gram' (one pass, up to 4,096 columns), 'bidiagonal' (any height and width, two passes a step, small
    values stay accurate; one reduction to an R factor first where one side is short), 'tsqr' (one pass, up to 2,048 columns, small values stay accurate), 'krylov' (several
    passes, n x b arrays on the driver), 'auto' (gram when it fits, else bidiagonal). Values at or below ``rcond``
    times the largest are dropped, so fewer than k may return. 'gram' works
    on A'A, whose rounding hides values below about 1e-8 of the largest; where the k-th value comes near that, a
    second pass in the basis found recovers it. 'krylov' cannot: its ``rcond`` is at least sqrt(n * machine epsilon).
    In every column of V the component of largest magnitude is
    positive, and U follows. A matrix in cells or blocks is assembled into rows on every pass; store rows to
    avoid that.
    """
    if method == "bidiagonal":
        rows = _held_cells(rows)
    n = dims(rows, row_width(rows) if form_of(rows) == ROWS else None)[1] if num_cols is None else num_cols
    if not 1 <= k <= n:
        raise ValueError(f"k must lie in 1..{n}, not {k}")
    if method == "auto":
        method = "gram" if n <= GRAM_MAX_COLS else "bidiagonal"
        rows = rows if method == "gram" else _held_cells(rows)
    if method == "bidiagonal":
        u, sigma, v = bidiagonal_triplets(rows, n, k, tol, max_passes, seed)
        kept = int((sigma > rcond * sigma[0]).sum())
        cut = F.slice("v", 1, kept).alias("v")
        return SVD(u.select("i", cut), _values(rows.sparkSession, sigma[:kept]), v.select("i", cut))
    rows = to_rows(rows)
    if method == "gram":
        sigma, v = _from_gram(rows, n)
        if rcond < _floor(n) and sigma[0] > 0 and sigma[k - 1] <= 10 * _floor(n) * sigma[0]:
            sigma, v = _refined(rows, sigma, v)
    elif method == "tsqr":
        sigma, v = _from_qr(rows, n)
    elif method == "krylov":
        sigma, v = _from_krylov(rows, n, k, tol, max_passes, seed)
    else:
        raise ValueError(f"unknown method {method!r}; known: auto, gram, krylov, tsqr")
    if method == "krylov":
        rcond = max(rcond, _floor(n))
    sigma = sigma[:k]
    sigma = sigma[sigma > rcond * sigma[0]]
    v = np.ascontiguousarray(_signed(v[:, : len(sigma)]))
    spark = rows.sparkSession
    return SVD(project_rows(rows, v / sigma), _values(spark, sigma), local_rows(spark, v))


def _held_cells(matrix: DataFrame) -> DataFrame:
    """A matrix in cells as a stored table, for methods that read it many times; other forms as they are."""
    return stored(matrix.select("i", "j", "x"), "cells") if form_of(matrix) == CELLS else matrix


def _values(spark: SparkSession, sigma: np.ndarray) -> DataFrame:
    table = pa.table({"k": pa.array(range(len(sigma)), pa.int32()), "sigma": pa.array(sigma, pa.float64())})
    return spark.createDataFrame(table, "k int, sigma double")


def _factor(rows: DataFrame, v):
    """V as an array with as many rows as A has columns, or as the table it is when too large to broadcast."""
    if not isinstance(v, DataFrame):
        v = np.asarray(v, dtype=np.float64)
        return v if v.nbytes <= BROADCAST_BYTES else local_rows(rows.sparkSession, v)
    n, k = row_width(rows), row_width(v)
    return v if n * k * 8 > BROADCAST_BYTES else collect_dense(v, n, k, "the right singular vectors")


def reconstruct(rows: DataFrame, v) -> DataFrame:
    """A V V', computed as (A V) V' row by row. Narrow unless V is too large to broadcast."""
    rows = to_rows(rows)
    v = _factor(rows, v)
    if isinstance(v, DataFrame):
        return project_rows(project_rows(rows, v), transpose(v))
    return rows.select("i", "v").mapInArrow(kernels.reproject(v), kernels.ROW_SCHEMA)


def relative_error(rows: DataFrame, v) -> DataFrame:
    """Squared error of projecting every row on span(V), the squared norm of A, and their quotient.

    One narrow pass in which each task sends one pair of sums, unless V is too large to broadcast.
    """
    rows = to_rows(rows)
    v = _factor(rows, v)
    if isinstance(v, DataFrame):
        records = keyed(rows, "v").select(F.col("key").alias("i"), "v")
        apart = row_sqdist(records, reconstruct(records, v)).agg(F.sum("sqdist"))
        sums = frobenius_sq(rows).select(apart.scalar().alias("err"), F.col("frobenius_sq").alias("norm"))
    else:
        sums = rows.select("v").mapInArrow(kernels.residual_sums(v), "err double, norm double")
    total = sums.agg(
        F.coalesce(F.sum("err"), F.lit(0.0)).alias("squared_error"),
        F.coalesce(F.sum("norm"), F.lit(0.0)).alias("frobenius_sq"),
    )
    return total.withColumn("relative_error", F.try_divide("squared_error", "frobenius_sq"))


def reconstruction_error(rows: DataFrame, v) -> DataFrame:
    """Sum over all rows of the squared distance between a row and its projection on span(V)."""
    return relative_error(rows, v).select("squared_error")
