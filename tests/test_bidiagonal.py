"""Golub-Kahan bidiagonalisation against numpy: every form, small values, rank, ties, restarts, both product paths."""

import numpy as np
import pytest
from test_forms import dense_of, rows_of
from test_products import cells_of

import rowloom as R
from rowloom.operators import bidiagonal


def values(svd):
    return [r["sigma"] for r in svd.S.orderBy("k").collect()]


def check(svd, a, k, rtol=1e-8, atol=1e-7):
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(values(svd), s[:k], rtol=rtol)
    v, w = dense_of(svd.V, a.shape[1], k), dense_of(svd.U, a.shape[0], k)
    assert np.allclose(v.T @ v, np.eye(k), atol=1e-10) and np.allclose(w.T @ w, np.eye(k), atol=1e-10)
    assert np.allclose(a @ v, w * s[:k], atol=atol * s[0]) and np.allclose(a.T @ w, v * s[:k], atol=atol * s[0])
    assert (np.abs(v).argmax(axis=0) == (np.abs(v) * (v > 0)).argmax(axis=0)).all()


def test_rows_and_restart(spark, monkeypatch):
    monkeypatch.setattr(bidiagonal, "BLOCKS", 3)
    a = np.random.default_rng(1).random((60, 40)) * np.logspace(0, -3, 40)
    check(R.truncated_svd(rows_of(spark, a), 3, "bidiagonal"), a, 3)


def test_cells_and_sparse_rows_by_joins(spark, monkeypatch):
    monkeypatch.setattr(bidiagonal, "BROADCAST_BYTES", 8)
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 12)) * (rng.random((30, 12)) < 0.5)
    a[:, 4] = 0.0
    a[29, 11] = 1.0
    for matrix in (cells_of(spark, a), R.sparse_rows(rows_of(spark, a))):
        svd = R.truncated_svd(matrix, 2, "bidiagonal", num_cols=12)
        assert np.allclose(values(svd), np.linalg.svd(a, compute_uv=False)[:2])
        v = dense_of(svd.V, 12, 2)
        assert np.allclose(v.T @ v, np.eye(2)) and np.allclose(v[4], 0)


def test_small_values_keep_their_accuracy(spark):
    """Down to 1e-11 of the largest, where A'A has nothing left."""
    rng = np.random.default_rng(3)
    exact = 10.0 ** -np.arange(12)
    u, v = np.linalg.qr(rng.standard_normal((50, 12)))[0], np.linalg.qr(rng.standard_normal((12, 12)))[0]
    svd = R.truncated_svd(rows_of(spark, (u * exact) @ v.T), 12, "bidiagonal", rcond=1e-12)
    assert np.allclose(values(svd)[:10], exact[:10], rtol=1e-4) and np.allclose(values(svd), exact, rtol=1e-2)
    assert len(values(R.truncated_svd(rows_of(spark, (u * exact) @ v.T), 12, "bidiagonal", rcond=3e-9))) == 9


def test_rank_and_ties(spark):
    """An identity, a rank-one matrix with repeated indices, and fewer rows than values asked for."""
    assert np.allclose(values(R.truncated_svd(rows_of(spark, np.eye(9)), 4, "bidiagonal")), 1)
    ones = rows_of(spark, np.ones((6, 5)), [3, 3, 3, 0, 1, 2])
    svd = R.truncated_svd(ones, 3, "bidiagonal")
    assert np.allclose(values(svd), [np.sqrt(30)])
    assert sorted(r["i"] for r in svd.U.collect()) == [0, 1, 2, 3, 3, 3]
    short = np.random.default_rng(4).standard_normal((2, 8))
    assert np.allclose(values(R.truncated_svd(rows_of(spark, short), 5, "bidiagonal")), np.linalg.svd(short, compute_uv=False))
    with pytest.raises(ValueError, match="without non-zero"):
        R.truncated_svd(rows_of(spark, np.zeros((3, 2))), 1, "bidiagonal")


def test_more_values_than_a_block_is_wide(spark, monkeypatch):
    monkeypatch.setattr(bidiagonal, "MOST_WIDE", 3)
    a = np.kron(np.eye(2), np.diag([5.0, 5.0, 5.0, 5.0, 2.0]))
    assert np.allclose(values(R.truncated_svd(rows_of(spark, a), 8, "bidiagonal")), [5.0] * 8)


def test_passes_are_bounded(spark):
    a = np.random.default_rng(5).random((40, 30))
    with pytest.raises(RuntimeError, match="no convergence"):
        R.truncated_svd(rows_of(spark, a), 2, "bidiagonal", tol=1e-12, max_passes=3)


def test_wide_matrices_take_it_by_themselves(spark, monkeypatch):
    from rowloom.operators import factorize

    monkeypatch.setattr(factorize, "GRAM_MAX_COLS", 3)
    a = np.random.default_rng(6).standard_normal((12, 6)) * np.array([100, 50, 1, 1e-3, 1e-8, 1e-9])
    svd = R.truncated_svd(rows_of(spark, a), 6)
    assert np.allclose(values(svd), [x for x in np.linalg.svd(a, compute_uv=False) if x > 1e-9 * values(svd)[0]], rtol=1e-4)
