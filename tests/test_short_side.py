"""Bidiagonalisation of matrices with one short side: no long vector is stored, broadcast or shuffled."""

import numpy as np
import pytest
from test_bidiagonal import check, values
from test_forms import dense_of, rows_of
from test_products import cells_of

import rowloom as R
from rowloom.operators import bidiagonal
from rowloom.sources import scratch


@pytest.fixture
def purposes(monkeypatch):
    """What each table is for that goes to the scratch folder."""
    found, path = [], scratch.scratch_path
    monkeypatch.setattr(scratch, "scratch_path", lambda spark, purpose: found.append(purpose) or path(spark, purpose))
    return found


def test_tall_rows_store_no_vectors(spark, purposes):
    a = np.random.default_rng(11).random((90, 6)) * np.logspace(0, -4, 6)
    check(R.truncated_svd(rows_of(spark, a), 6, "bidiagonal"), a, 6)
    assert purposes == ["keyed"]


def test_tall_rows_of_one_index_stay_apart(spark):
    a = np.random.default_rng(12).standard_normal((40, 3))
    svd = R.truncated_svd(rows_of(spark, a, [7] * 40), 2, "bidiagonal")
    assert np.allclose(values(svd), np.linalg.svd(a, compute_uv=False)[:2])
    u = svd.U.collect()
    assert {r["i"] for r in u} == {7} and len(u) == 40
    assert np.allclose(sum(np.outer(r["v"], r["v"]) for r in u), np.eye(2))


def sparse_case(seed):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((50, 5)) * (rng.random((50, 5)) < 0.6)


def test_tall_cells_and_sparse_rows(spark):
    a = sparse_case(13)
    a[49, 4] = 1.0
    halves = cells_of(spark, a / 2)
    for matrix in (halves.unionAll(halves), R.sparse_rows(rows_of(spark, a))):
        check(R.truncated_svd(matrix, 3, "bidiagonal"), a, 3)


def test_wide_cells_store_no_vectors(spark, purposes):
    """Row indices with gaps, repeated cells, and a column without any cell."""
    a = sparse_case(14).T
    a[4, 49], a[:, 17] = 1.0, 0.0
    spread = cells_of(spark, a / 2).selectExpr("i * 10 AS i", "j", "x").where("x <> 0")
    svd = R.truncated_svd(spread.unionAll(spread), 3, "bidiagonal")
    check(svd._replace(U=svd.U.selectExpr("i div 10 AS i", "v")), a, 3)
    assert svd.V.count() == 50 and np.allclose(dense_of(svd.V, 50, 3)[17], 0)
    assert purposes == ["cells", "columns"]


def test_wide_sparse_rows(spark):
    """A row that comes twice is two rows, and one without elements is a row of zeros."""
    a = sparse_case(15).T
    a[4, 49] = 1.0
    a[2] = 0.0
    svd = R.truncated_svd(R.sparse_rows(rows_of(spark, a, [0, 1, 2, 3, 3])), 4, "bidiagonal")
    assert np.allclose(values(svd), np.linalg.svd(a, compute_uv=False)[:4])
    u = svd.U.collect()
    assert sorted(r["i"] for r in u) == [0, 1, 2, 3, 3]
    assert np.allclose(sum(np.outer(r["v"], r["v"]) for r in u), np.eye(4))
    assert next(r["v"] for r in u if r["i"] == 2) == [0.0] * 4


def test_both_ways_agree(spark, monkeypatch):
    a = sparse_case(16).T * np.logspace(0, -3, 5)[:, None]
    a[4, 49] = 1e-3
    short = R.truncated_svd(cells_of(spark, a), 5, "bidiagonal")
    monkeypatch.setattr(bidiagonal, "SHORT_SIDE", 0)
    long = R.truncated_svd(cells_of(spark, a), 5, "bidiagonal")
    assert np.allclose(values(short), values(long), rtol=1e-9)
    assert np.allclose(dense_of(short.U, 5, 5), dense_of(long.U, 5, 5), atol=1e-8)
    assert np.allclose(dense_of(short.V, 50, 5), dense_of(long.V, 50, 5), atol=1e-8)


def test_left_vectors_of_few_rows(spark, purposes):
    """Rows that are orthogonal, one element a column: each left vector is one row's."""
    a = np.zeros((3, 48))
    a[np.arange(48) % 3, np.arange(48)] = np.array([1.0, 3.0, 2.0])[np.arange(48) % 3]
    svd = R.truncated_svd(cells_of(spark, a), 2, "bidiagonal")
    assert np.allclose(dense_of(svd.U, 3, 2), [[0, 0], [1, 0], [0, 1]])
    assert np.allclose(values(svd), [12, 8]) and purposes == ["cells", "columns"]


def test_small_values_of_a_wide_matrix(spark, purposes):
    """Down to 1e-11 of the largest, with vectors that are orthonormal all the same."""
    rng = np.random.default_rng(17)
    exact = 10.0 ** -np.arange(12)
    u, v = np.linalg.qr(rng.standard_normal((120, 12)))[0], np.linalg.qr(rng.standard_normal((12, 12)))[0]
    svd = R.truncated_svd(cells_of(spark, ((u * exact) @ v.T).T), 12, "bidiagonal", rcond=1e-12)
    assert np.allclose(values(svd)[:10], exact[:10], rtol=1e-4) and np.allclose(values(svd), exact, rtol=1e-2)
    w = dense_of(svd.V, 120, 12)
    assert np.allclose(w.T @ w, np.eye(12), atol=1e-10)
    assert purposes == ["cells", "columns"]


def test_rank_and_zero_matrices(spark):
    assert np.allclose(values(R.truncated_svd(rows_of(spark, np.ones((40, 4))), 3, "bidiagonal")), [np.sqrt(160)])
    with pytest.raises(ValueError, match="without non-zero"):
        R.truncated_svd(rows_of(spark, np.zeros((40, 2))), 1, "bidiagonal")


def test_nulls(spark):
    """Cells without an index and single nulls are passed over, as on the other path; a line of nulls alone fails."""
    a = np.random.default_rng(18).standard_normal((3, 40))
    exact = np.linalg.svd(a, compute_uv=False)
    extra = [(None, 3, 1.0), (2, None, 1.0), (0, 2, None)]
    for turned in (False, True):
        held = [(j, i, x) if turned else (i, j, x) for i, j, x in extra + [(1, 50, None)]]
        cells = cells_of(spark, a.T if turned else a)
        odd = cells.unionAll(spark.createDataFrame(held[:3], cells.schema))
        svd = R.truncated_svd(odd, 3, "bidiagonal")
        assert np.allclose(values(svd), exact)
        assert svd.U.count() == (40 if turned else 3) and svd.V.count() == (3 if turned else 40)
        for bad in (held[3], (900, 2, None) if not turned else (2, 2, None)):
            lone = cells.where("NOT (i = 2 OR j = 2)") if turned and bad == (2, 2, None) else cells
            with pytest.raises(Exception, match="NULL element"):
                values(R.truncated_svd(lone.unionAll(spark.createDataFrame([bad], cells.schema)), 3, "bidiagonal", num_cols=3 if turned else 9000))
