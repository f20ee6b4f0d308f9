"""Sparse rows against numpy: conversions, libsvm, Gram matrix, projection, sums."""

import numpy as np
import pytest
from test_forms import dense_of, rows_of
from test_products import cells_of, dense_cells

import rowloom as R
from rowloom import kernels, limits
from rowloom.operators import sparse


def sparse_of(spark, a, index=None):
    index = range(len(a)) if index is None else index
    data = [(int(i), np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for i, r in zip(index, np.asarray(a, float))]
    return spark.createDataFrame(data, "i bigint, idx array<bigint>, val array<double>")


def thin(shape, seed, share=0.3):
    rng = np.random.default_rng(seed)
    return rng.standard_normal(shape) * (rng.random(shape) < share)


@pytest.mark.parametrize("shape", [(1, 1), (7, 1), (1, 9), (30, 12)])
def test_round_trips(spark, shape):
    a = thin(shape, shape[0])
    for matrix in (rows_of(spark, a), cells_of(spark, a), R.to_blocks(rows_of(spark, a), 4, 5), sparse_of(spark, a)):
        found = R.sparse_rows(matrix)
        assert np.array_equal(dense_cells(R.sparse_to_cells(found), *shape), a)
        held = np.zeros(shape)
        for r in R.sparse_to_rows(found, shape[1]).collect():
            held[r["i"]] = r["v"]
        assert np.array_equal(held, a)
    assert np.array_equal(dense_of(R.to_rows(R.sparse_rows(rows_of(spark, np.ones(shape)))), *shape), np.ones(shape))


def test_repeated_cells_add_up_and_zeros_are_not_stored(spark):
    cells = spark.createDataFrame([(0, 1, 2.0), (0, 1, -2.0), (0, 3, 1.0), (0, 3, 1.5), (2, 0, 0.0)], "i bigint, j bigint, x double")
    assert [tuple(r) for r in R.sparse_rows(cells).collect()] == [(0, [3], [2.5])]


def test_long_rows_are_refused_before_they_are_gathered(spark, monkeypatch):
    monkeypatch.setattr(sparse, "MAX_ROW_WIDTH", 2)
    with pytest.raises(Exception, match="a row of 3 stored elements"):
        R.sparse_rows(cells_of(spark, np.ones((2, 3)))).collect()
    assert limits.MAX_ROW_WIDTH > 2


@pytest.mark.parametrize("pairs", [1, 5, 1 << 20])
def test_gramian(spark, monkeypatch, pairs):
    """A full row, empty rows, repeated indices; a few products at a time or all."""
    monkeypatch.setattr(kernels, "PAIRS", pairs)
    a = thin((25, 10), 3)
    a[4], a[5] = 1.0, 0.0
    found = R.gramian_sparse(sparse_of(spark, a, [7] * 25).repartition(3))
    assert np.allclose(dense_cells(found, 10, 10), a.T @ a)
    assert found.count() == np.count_nonzero((a != 0).T.astype(int) @ (a != 0))


def test_gramian_of_a_very_wide_matrix(spark):
    """Two columns 10**12 apart: memory follows the stored elements."""
    far = 10**12
    rows = spark.createDataFrame([(0, [3, far], [2.0, 5.0]), (1, [far], [1.0])], "i bigint, idx array<bigint>, val array<double>")
    found = {(r["i"], r["j"]): r["x"] for r in R.gramian_sparse(rows).collect()}
    assert found == {(3, 3): 4.0, (3, far): 10.0, (far, 3): 10.0, (far, far): 26.0}


@pytest.mark.parametrize("bound", [8, 1 << 20])
def test_project(spark, monkeypatch, bound):
    monkeypatch.setattr(sparse, "BROADCAST_BYTES", bound)
    a, b = thin((20, 8), 5), np.random.default_rng(6).standard_normal((8, 3))
    a[3] = 0.0
    index = [*range(18), 17, 17]
    for right in (b, rows_of(spark, b)):
        found = R.project_rows_sparse(sparse_of(spark, a, index), right)
        assert sorted((r["i"], np.round(r["v"], 9).tolist()) for r in found.collect()) == sorted(
            (i, np.round(v + 0.0, 9).tolist()) for i, v in zip(index, a @ b)
        )
    outside = sparse_of(spark, np.ones((2, 9)))
    with pytest.raises(Exception, match="outside a right factor"):
        R.project_rows_sparse(outside, b).collect()


def test_sums_and_handles(spark):
    a = thin((9, 6), 8)
    a[8, 5] = 1.0
    rows = R.sparse_rows(rows_of(spark, a))
    assert np.isclose(R.frobenius_sq(rows).first()[0], np.square(a).sum())
    info = R.matrix_info(rows).first()
    assert (info["num_rows"], info["num_cols"], info["nnz"]) == (9, 6, np.count_nonzero(a))


@pytest.mark.parametrize("idx, val", [([1, 1], [1.0, 2.0]), ([2, 1], [1.0, 2.0]), ([-1], [1.0]), ([1], [1.0, 2.0]), ([1], [None])])
def test_malformed_rows_are_refused(spark, idx, val):
    rows = spark.createDataFrame([(0, idx, val)], "i bigint, idx array<bigint>, val array<double>")
    with pytest.raises(Exception, match="do not ascend|differ in number|NULL element"):
        R.gramian_sparse(rows).collect()


def test_libsvm(spark, tmp_path):
    path = tmp_path / "data.libsvm"
    path.write_text("2.9 1:1.5 3:2.5 # note\n\n0\t2:4\n# only a note\n5\n16777217 1:1  9:-2e3\n")
    found = {r["i"]: (r["idx"], r["val"]) for r in R.read_libsvm_sparse(spark, str(path)).collect()}
    assert found == {2: ([0, 2], [1.5, 2.5]), 0: ([1], [4.0]), 5: ([], []), 16777217: ([0, 8], [1.0, -2000.0])}
    with pytest.raises(Exception, match="outside a matrix of width 8"):
        R.read_libsvm_sparse(spark, str(path), 8).collect()
    path.write_text("2.9 1:1.5 3:2.5\n0 2:4\n# note\n16777217 1:1 9:-2e3\n")
    theirs = {r["label"]: r["features"].toArray().tolist() for r in spark.read.format("libsvm").load(str(path)).collect()}
    ours = {float(r["i"]): r["v"] for r in R.read_libsvm_matrix(spark, str(path)).collect()}
    assert ours == {float(int(k)): v for k, v in theirs.items()}


@pytest.mark.parametrize("line", ["1 3:1 2:1", "1 2:1 2:1", "1 0:1", "1 x:1", "1 2", "a 1:1", "-1 1:1"])
def test_libsvm_refuses_malformed_lines(spark, tmp_path, line):
    path = tmp_path / "bad.libsvm"
    path.write_text(line + "\n")
    with pytest.raises(Exception):
        R.read_libsvm_sparse(spark, str(path)).collect()
