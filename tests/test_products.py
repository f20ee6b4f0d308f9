"""Reductions, products and decompositions against numpy and MLlib."""

import numpy as np
import pytest
from test_forms import dense_of, rows_of

import rowloom as R
from rowloom import kernels, limits
from rowloom.operators import factorize, products


def cells_of(spark, a):
    i, j = np.nonzero(a)
    data = [(int(p), int(q), float(a[p, q])) for p, q in zip(i, j)]
    return spark.createDataFrame(data, "i bigint, j bigint, x double")


def dense_cells(cells, m, n):
    out = np.zeros((m, n))
    for r in cells.collect():
        out[r["i"], r["j"]] += r["x"]
    return out


@pytest.mark.parametrize("shape", [(1, 1), (3, 2), (40, 8), (50, 9), (30, 40), (1, 12)])
def test_gramian(spark, shape):
    a = np.random.default_rng(3).standard_normal(shape)
    found = dense_of(R.gramian(rows_of(spark, a).repartition(5)), shape[1], shape[1])
    assert np.allclose(found, a.T @ a, atol=1e-12)


@pytest.mark.parametrize("width", [3, 12])
def test_gramian_refuses_ragged_and_null(spark, width):
    good = [1.0] * width
    for bad in (good[:-1], good + [1.0], [None] + good[1:]):
        rows = spark.createDataFrame([(0, good), (1, bad)], "i bigint, v array<double>")
        with pytest.raises(Exception, match="length other than|NULL element"):
            R.gramian(rows, width).collect()


def test_pieces_of_a_wide_accumulator_add_up(spark, monkeypatch):
    """Many small pieces per task and several tasks per piece."""
    monkeypatch.setattr(products, "PIECE_BYTES", 700)
    a = np.random.default_rng(4).standard_normal((60, 33))
    found = dense_of(R.gramian(rows_of(spark, a).repartition(6)), 33, 33)
    assert np.allclose(found, a.T @ a, atol=1e-12)


def test_norms_distances_dots(spark):
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((2, 9, 6))
    ra, rb = rows_of(spark, a), rows_of(spark, b)
    norms = {r["i"]: r["norm"] for r in R.row_norms(ra).collect()}
    dist = {r["i"]: r["sqdist"] for r in R.row_sqdist(ra, rb).collect()}
    dots = {r["i"]: r["dot"] for r in R.row_dots(ra, rb).collect()}
    for i in range(9):
        assert np.isclose(norms[i], np.linalg.norm(a[i]))
        assert np.isclose(dist[i], np.square(a[i] - b[i]).sum())
        assert np.isclose(dots[i], a[i] @ b[i])
    for matrix in (ra, R.rows_to_coo(ra), R.to_blocks(ra, 4, 4)):
        assert np.isclose(R.frobenius_sq(matrix).first()[0], np.square(a).sum())
    assert R.frobenius_sq(ra.where("i < 0")).first()[0] == 0.0


def test_products_agree_in_every_form(spark, monkeypatch):
    rng = np.random.default_rng(6)
    a, b = rng.standard_normal((30, 11)), rng.standard_normal((11, 7))
    ra, rb = rows_of(spark, a), rows_of(spark, b)
    assert np.allclose(dense_of(R.matmul(ra, rb), 30, 7), a @ b)
    assert np.allclose(dense_of(R.project_rows(ra, b), 30, 7), a @ b)
    assert np.allclose(dense_cells(R.matmul(R.rows_to_coo(ra), R.rows_to_coo(rb)), 30, 7), a @ b)
    blocks = R.matmul(R.to_blocks(ra, 8, 4), R.to_blocks(rb, 4, 3))
    assert np.allclose(dense_of(R.blocks_to_rows(blocks), 30, 7), a @ b)
    monkeypatch.setattr(products, "BROADCAST_BYTES", 100)
    monkeypatch.setattr(products, "TILE", 4)
    assert np.allclose(dense_of(R.project_rows(ra, rb), 30, 7), a @ b)
    assert np.allclose(dense_of(R.project_rows(ra, b), 30, 7), a @ b)


def test_tiled_product_keeps_the_rows_of_the_left_factor(spark, monkeypatch):
    """Rows absent from A stay absent; rows of A that meet only absent rows of B are zero."""
    monkeypatch.setattr(products, "BROADCAST_BYTES", 8)
    monkeypatch.setattr(products, "TILE", 2)
    a = rows_of(spark, [[1, 0, 0, 0], [0, 0, 0, 0], [0, 2, 0, 0]], [0, 3, 6])
    b = rows_of(spark, [[5, 6], [7, 8]], [2, 3])
    assert {r["i"]: r["v"] for r in R.project_rows(a, b).collect()} == {0: [0, 0], 3: [0, 0], 6: [0, 0]}
    b = rows_of(spark, [[5, 6], [7, 8]], [0, 1])
    assert {r["i"]: r["v"] for r in R.project_rows(a, b).collect()} == {0: [5, 6], 3: [0, 0], 6: [14, 16]}


def test_repeated_rows_on_both_sides_of_the_broadcast_bound(spark, monkeypatch):
    """Every record of A has a record in the product and a part in the error, also where tiles are used."""
    a, b = np.random.default_rng(21).standard_normal((2, 6, 6))
    rows = rows_of(spark, a, [4, 4, 0, 9, 9, 9])
    v = np.linalg.qr(b[:, :2])[0]
    found = lambda: sorted((r["i"], np.round(r["v"], 9).tolist()) for r in R.project_rows(rows, b).collect())
    narrow, error = found(), R.relative_error(rows, v).first()
    monkeypatch.setattr(products, "BROADCAST_BYTES", 8)
    monkeypatch.setattr(factorize, "BROADCAST_BYTES", 8)
    monkeypatch.setattr(products, "TILE", 4)
    assert found() == narrow and len(narrow) == 6
    assert np.allclose(tuple(R.relative_error(rows, v).first()), tuple(error))
    assert R.project_rows(rows.limit(0), b, 6).count() == 0


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_many_inner_tiles_of_one_result_tile(spark, monkeypatch, held):
    """Sums in two levels, with and without tiles held in the task."""
    monkeypatch.setattr(products, "PARTIALS_PER_SUM", 2)
    monkeypatch.setattr(products, "TILE_SUM_BYTES", held)
    a, b = np.random.default_rng(22).standard_normal((2, 300, 300))
    left, right = R.to_blocks(rows_of(spark, a[:5]), 5, 2), R.to_blocks(rows_of(spark, b[:, :4]), 2, 4)
    found = R.blocks_to_rows(R.matmul(left.repartition(7), right))
    assert np.allclose(dense_of(found, 5, 4), a[:5] @ b[:, :4])


@pytest.mark.parametrize("shape, panel", [((40, 9), 4), ((3, 7), 7), ((5, 1), 3), ((30, 16), 5)])
def test_gramian_by_panels(spark, monkeypatch, shape, panel):
    """Panels of any width, one pair a pass, and the row form beyond the bound on columns."""
    a = np.random.default_rng(23).standard_normal(shape)
    rows = rows_of(spark, a).repartition(3)
    for held in (1, 1 << 30):
        monkeypatch.setattr(products, "TILE_SUM_BYTES", held)
        found = R.blocks_to_rows(R.gramian_panels(rows, panel=panel), shape[1])
        assert np.allclose(dense_of(found, shape[1], shape[1]), a.T @ a)
    monkeypatch.setattr(products, "GRAM_MAX_COLS", 0)
    monkeypatch.setattr(products, "SQL_GRAM_COLS", 0)
    assert np.allclose(dense_of(R.gramian(rows), shape[1], shape[1]), a.T @ a)


def test_factors_beyond_the_broadcast_bound(spark, monkeypatch):
    """Left vectors, reconstruction and error by tiles agree with the narrow path."""
    a = np.random.default_rng(14).standard_normal((40, 9))
    rows = rows_of(spark, a)
    v = R.truncated_svd(rows, 3).V
    narrow = R.relative_error(rows, v).first()
    monkeypatch.setattr(products, "BROADCAST_BYTES", 64)
    monkeypatch.setattr(factorize, "BROADCAST_BYTES", 64)
    monkeypatch.setattr(products, "TILE", 4)
    svd = R.truncated_svd(rows, 3)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    v = dense_of(svd.V, 9, 3)
    assert np.allclose(dense_of(svd.U, 40, 3), a @ v / s[:3])
    assert np.allclose(dense_of(R.reconstruct(rows, svd.V), 40, 9), a @ v @ v.T)
    tiled = R.relative_error(rows, v).first()
    assert np.allclose(tuple(tiled), tuple(narrow))


def test_inner_dimension_mismatch_and_missing_trailing_rows(spark):
    a = np.arange(12.0).reshape(3, 4)
    with pytest.raises(ValueError, match="inner dimensions"):
        R.matmul(rows_of(spark, a), rows_of(spark, np.ones((5, 2))))
    found = dense_of(R.matmul(rows_of(spark, a), rows_of(spark, np.ones((2, 2)))), 3, 2)
    assert np.array_equal(found, a[:, :2] @ np.ones((2, 2)))
    with pytest.raises(TypeError):
        R.matmul(rows_of(spark, a), cells_of(spark, a))


@pytest.mark.parametrize("parts", ["1", "8", "64"])
def test_hot_inner_index_gives_the_same_product(spark, parts):
    """A third of all cells sit in one column of A, which meets a full row of B."""
    rng = np.random.default_rng(8)
    a = np.zeros((300, 40))
    a[:, 7] = rng.integers(1, 5, 300)
    for _ in range(600):
        a[rng.integers(300), rng.integers(40)] = rng.integers(1, 5)
    b = rng.integers(0, 4, (40, 6)).astype(float)
    b[3] = 0
    b[21:25] = 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = dense_cells(R.matmul(cells_of(spark, a), cells_of(spark, b)), 300, 6)
        assert np.array_equal(found, a @ b)
        blocks = R.matmul(R.to_blocks(rows_of(spark, a), 16, 8), R.to_blocks(rows_of(spark, b), 8, 8))
        assert np.array_equal(dense_of(R.blocks_to_rows(blocks), 300, 6), a @ b)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def check_svd(a, svd, k, tol=1e-8):
    m, n = a.shape
    sigma = np.array([r["sigma"] for r in svd.S.orderBy("k").collect()])
    exact = np.linalg.svd(a, compute_uv=False)
    kept = len(sigma)
    assert np.allclose(sigma, exact[:kept], rtol=tol)
    assert kept == min(k, int((exact > 1e-9 * exact[0]).sum()))
    u, v = dense_of(svd.U, m, kept), dense_of(svd.V, n, kept)
    assert np.allclose(v.T @ v, np.eye(kept), atol=1e-8)
    assert np.allclose(u.T @ u, np.eye(kept), atol=1e-5)
    best = np.linalg.svd(a, full_matrices=False)
    approx = (best[0][:, :kept] * exact[:kept]) @ best[2][:kept]
    assert np.allclose((u * sigma) @ v.T, approx, atol=1e-5 * exact[0])
    top = np.abs(v).argmax(axis=0)
    assert (v[top, range(kept)] > 0).all()
    return u, sigma, v


def test_hot_indices_are_found_on_both_sides(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "10")
        left = spark.range(100).selectExpr("IF(id < 40, 7L, id) AS k")
        right = spark.range(100).selectExpr("IF(id < 25, 3L, id) AS k")
        # 40 + 25 + 15 * 1 + 60 * 3 = 260 records and products: index 7 costs 1.5 tasks, index 3 just under one
        assert [tuple(r) for r in products._hot_indices(left, right).collect()] == [(7, 2, 1)]
        one_each = spark.createDataFrame([(7,), (8,)], "k bigint")
        many = spark.range(100).selectExpr("7 + id % 2 AS k")
        assert {tuple(r) for r in products._hot_indices(many, one_each).collect()} == {(7, 5, 1), (8, 5, 1)}
        assert {tuple(r) for r in products._hot_indices(many, many).collect()} == {(7, 2, 3), (8, 2, 3)}
        assert products._hot_indices(left.where("k < 0"), right.where("k < 0")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("method", ["gram", "tsqr", "krylov"])
@pytest.mark.parametrize("shape,k", [((60, 12), 5), ((60, 12), 12), ((5, 9), 3), ((40, 1), 1), ((200, 30), 4)])
def test_svd_against_numpy(spark, method, shape, k):
    a = np.random.default_rng(shape[0]).standard_normal(shape) * np.linspace(1, 3, shape[1])
    rows = rows_of(spark, a).repartition(5)
    tol = 1e-8 if method != "krylov" else 1e-5
    svd = R.truncated_svd(rows, k, method, tol=1e-6)
    _, sigma, v = check_svd(a, svd, k, tol)
    error = R.relative_error(rows, svd.V).first()
    rest = np.square(np.linalg.svd(a, compute_uv=False)[k:]).sum()
    assert np.isclose(error["squared_error"], rest, rtol=1e-5, atol=1e-9)
    assert np.isclose(error["frobenius_sq"], np.square(a).sum())
    assert np.isclose(R.reconstruction_error(rows, svd.V).first()[0], rest, rtol=1e-5, atol=1e-9)
    assert np.allclose(dense_of(R.reconstruct(rows, svd.V), *shape), a @ v @ v.T)


def test_svd_of_rank_deficient_repeated_and_zero_matrices(spark):
    rng = np.random.default_rng(9)
    a = rng.standard_normal((30, 6))
    a[:, 5] = a[:, 0]
    for method in ("gram", "tsqr", "krylov"):
        svd = R.truncated_svd(rows_of(spark, a), 6, method, tol=1e-8)
        assert svd.S.count() == 5, method
    equal = np.vstack([np.eye(4), np.eye(4)])
    svd = R.truncated_svd(rows_of(spark, equal), 3)
    assert np.allclose([r["sigma"] for r in svd.S.collect()], np.sqrt(2))
    assert np.isclose(R.relative_error(rows_of(spark, equal), svd.V).first()["squared_error"], 2.0)
    zero = R.truncated_svd(rows_of(spark, np.zeros((4, 3))), 2)
    assert zero.S.count() == 0 and [r["v"] for r in zero.U.collect()] == [[]] * 4
    assert R.relative_error(rows_of(spark, np.zeros((4, 3))), np.eye(3)[:, :1]).first()["relative_error"] is None


def test_tsqr_keeps_small_singular_values(spark):
    u = np.linalg.qr(np.random.default_rng(10).standard_normal((400, 4)))[0]
    v = np.linalg.qr(np.random.default_rng(11).standard_normal((4, 4)))[0]
    exact = np.array([1.0, 1e-3, 1e-6, 1e-8])
    svd = R.truncated_svd(rows_of(spark, (u * exact) @ v.T).repartition(40), 4, "tsqr", rcond=1e-12)
    assert np.allclose([r["sigma"] for r in svd.S.orderBy("k").collect()], exact, rtol=1e-6)


def test_krylov_restarts_on_a_flat_spectrum(spark, monkeypatch):
    monkeypatch.setattr(factorize, "KRYLOV_BLOCKS", 4)
    a = np.random.default_rng(12).random((120, 60))
    svd = R.truncated_svd(rows_of(spark, a), 3, "krylov", tol=1e-4)
    exact = np.linalg.svd(a, compute_uv=False)[:3]
    assert np.allclose([r["sigma"] for r in svd.S.orderBy("k").collect()], exact, rtol=1e-6)
    with pytest.raises(RuntimeError, match="no convergence"):
        R.truncated_svd(rows_of(spark, a), 3, "krylov", tol=1e-14, max_passes=2)


def test_any_form_is_decomposed(spark):
    a = np.random.default_rng(15).standard_normal((30, 10))
    exact = np.linalg.svd(a, compute_uv=False)[:3]
    for matrix in (cells_of(spark, a), R.to_blocks(rows_of(spark, a), 8, 4)):
        svd = R.truncated_svd(matrix, 3)
        assert np.allclose([r["sigma"] for r in svd.S.orderBy("k").collect()], exact)
        error = R.reconstruction_error(matrix, svd.V).first()[0]
        assert np.isclose(error, np.square(a).sum() - np.square(exact).sum())


def test_svd_arguments(spark):
    rows = rows_of(spark, np.ones((3, 2)))
    for k in (0, 3):
        with pytest.raises(ValueError, match="k must lie"):
            R.truncated_svd(rows, k)
    with pytest.raises(ValueError, match="unknown method"):
        R.truncated_svd(rows, 1, "lanczos")


def test_size_limits(spark, monkeypatch):
    monkeypatch.setattr(limits, "DRIVER_BYTES", 100)
    with pytest.raises(ValueError, match="on the driver"):
        R.truncated_svd(rows_of(spark, np.ones((2, 12))), 1, "krylov")


def test_against_mllib(spark):
    from pyspark.mllib.linalg.distributed import IndexedRow, IndexedRowMatrix

    a = np.random.default_rng(13).random((50, 10))
    rows = rows_of(spark, a)
    theirs = IndexedRowMatrix(rows.rdd.map(lambda r: IndexedRow(r["i"], r["v"]))).computeSVD(4)
    ours = R.truncated_svd(rows, 4)
    assert np.allclose([r["sigma"] for r in ours.S.orderBy("k").collect()], theirs.s.toArray())
    v = theirs.V.toArray().copy()
    v *= np.sign(v[np.abs(v).argmax(axis=0), range(4)])
    assert np.allclose(dense_of(ours.V, 10, 4), v)


def test_reference_configuration(spark):
    """2000 x 1000 uniform matrix, rank 5: error equals the energy left out."""
    rows = R.random_matrix(spark, 2000, 1000).cache()
    svd = R.truncated_svd(rows, 5)
    sigma = np.array([r["sigma"] for r in svd.S.orderBy("k").collect()])
    a = dense_of(rows, 2000, 1000)
    exact = np.linalg.svd(a, compute_uv=False)
    assert np.allclose(sigma, exact[:5], rtol=1e-10)
    error = R.relative_error(rows, svd.V).first()
    assert np.isclose(error["squared_error"], np.square(exact[5:]).sum(), rtol=1e-9)
    rows.unpersist()


def test_row_batches_are_cut_for_wide_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"v": [[1.0]] * 5})
    assert [b.num_rows for b in kernels.row_slices(batch, 2 << 20)] == [2, 2, 1]
    assert [b.num_rows for b in kernels.row_slices(batch, 8 << 20)] == [1] * 5


def test_small_singular_values_survive_the_gram_matrix(spark):
    rng = np.random.default_rng(21)
    u, v = np.linalg.qr(rng.standard_normal((200, 64)))[0], np.linalg.qr(rng.standard_normal((64, 64)))[0]
    sigma = np.concatenate([np.linspace(2, 1, 60), [1e-3, 1e-6, 5e-8, 2e-10]])
    a = (u * sigma) @ v.T
    rows = rows_of(spark, a)
    found = R.truncated_svd(rows, 64, rcond=1e-11)
    values = np.array([r["sigma"] for r in found.S.orderBy("k").collect()])
    assert len(values) == 64 and np.allclose(values, np.linalg.svd(a, compute_uv=False), rtol=1e-5)
    assert np.allclose(np.abs(dense_of(found.V, 64, 64).T @ v), np.eye(64), atol=1e-3)
    assert len(R.truncated_svd(rows, 64).S.collect()) == 63


def test_right_factor_with_rows_outside(spark):
    a = rows_of(spark, np.ones((3, 2)))
    for index, message in (([-1, 0], "outside"), ([0, 0], "repeated")):
        with pytest.raises(Exception, match=message):
            R.project_rows(a, rows_of(spark, [[1.0], [2.0]], index)).collect()


def test_thin_by_wide_product(spark):
    a, b = np.arange(6.0).reshape(3, 2), np.arange(200_000.0).reshape(2, 100_000)
    found = R.project_rows(rows_of(spark, a), b)
    assert np.allclose(dense_of(found, 3, 100_000), a @ b)
