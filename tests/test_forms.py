"""Conversions, selection and comparison against numpy on awkward shapes."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

import rowloom as R
from pyspark.sql import functions as F


def rows_of(spark, matrix, index=None):
    matrix = np.asarray(matrix, dtype=float)
    index = range(len(matrix)) if index is None else index
    data = [(int(i), [float(x) for x in row]) for i, row in zip(index, matrix)]
    return spark.createDataFrame(data, "i bigint, v array<double>")


def dense_of(rows, m, n):
    out = np.full((m, n), np.nan)
    for r in rows.collect():
        assert np.isnan(out[r["i"]]).all(), "row returned twice"
        out[r["i"]] = r["v"]
    return out


SHAPES = [(1, 1), (1, 7), (9, 1), (33, 10)]


@pytest.mark.parametrize("shape", SHAPES)
def test_cells_blocks_transpose_round_trips(spark, shape):
    rng = np.random.default_rng(shape[0])
    a = rng.standard_normal(shape) * (rng.random(shape) < 0.7)
    rows = rows_of(spark, a)
    m, n = shape
    assert np.array_equal(dense_of(R.coo_to_rows(R.rows_to_coo(rows), n), m, n), a)
    for tile in ((4, 3), (64, 64)):
        blocks = R.to_blocks(rows, *tile)
        assert np.array_equal(dense_of(R.blocks_to_rows(blocks), m, n), a)
        assert np.array_equal(dense_of(R.coo_to_rows(R.blocks_to_cells(blocks), n), m, n), a)
        turned = R.blocks_to_rows(R.transpose(blocks))
        assert np.array_equal(dense_of(turned, n, m), a.T)
    assert np.array_equal(dense_of(R.transpose(rows, tile=4), n, m), a.T)
    cells = R.rows_to_coo(rows).where("x != 0")
    if (a != 0).any():
        assert np.array_equal(dense_of(R.densify(cells, m, n), m, n), a)
        tiled = R.cells_to_blocks(cells, 4, 3, m, n)
        filled = R.zero_fill(R.blocks_to_rows(tiled, n), m, n)
        assert np.array_equal(dense_of(filled, m, n), a)


def test_random_sparsity_patterns_fill_like_numpy(spark):
    """Two hundred sparse rows of different density in one matrix."""
    rng = np.random.default_rng(7)
    a = rng.integers(1, 9, (200, 23)) * (rng.random((200, 23)) < rng.random((200, 1)))
    i, j = np.nonzero(a)
    cells = spark.createDataFrame([(int(p), int(q), float(a[p, q])) for p, q in zip(i, j)], "i bigint, j bigint, x double")
    assert np.array_equal(dense_of(R.densify(cells, 200, 23), 200, 23), a)
    assert np.array_equal(dense_of(R.densify(cells, 200, 23, unique=True), 200, 23), a)


def test_repeated_cells_add_up_even_when_one_dominates(spark):
    cells = spark.range(0, 30_000).selectExpr("0L AS i", "2L AS j", "1D AS x")
    others = spark.createDataFrame([(0, 0, 5.0), (1, 1, 2.0)], "i bigint, j bigint, x double")
    found = dense_of(R.coo_to_rows(cells.union(others), 4), 2, 4)
    assert np.array_equal(found, [[5, 0, 30_000, 0], [0, 2, 0, 0]])


def test_column_outside_the_width_fails(spark):
    cells = spark.createDataFrame([(0, 5, 1.0)], "i bigint, j bigint, x double")
    with pytest.raises(Exception, match="outside a matrix of width 3"):
        R.coo_to_rows(cells, 3).collect()


def test_missing_rows_are_zero_and_stored_ones_unchanged(spark):
    rows = rows_of(spark, [[1, 2], [3, 4]], [1, 4])
    found = dense_of(R.zero_fill(rows, 6), 6, 2)
    assert np.array_equal(found, [[0, 0], [1, 2], [0, 0], [0, 0], [3, 4], [0, 0]])


def test_blocks_with_absent_rows_are_zero_filled(spark):
    rows = rows_of(spark, [[1, 2, 3], [4, 5, 6]], [1, 6])
    found = dense_of(R.zero_fill(R.blocks_to_rows(R.to_blocks(rows, 4, 2)), 8, 3), 8, 3)
    expected = np.zeros((8, 3))
    expected[[1, 6]] = [[1, 2, 3], [4, 5, 6]]
    assert np.array_equal(found[:7], expected[:7])


def test_repeated_rows_are_refused(spark):
    rows = rows_of(spark, [[1], [2], [3]], [3, 1, 3])
    with pytest.raises(Exception, match="repeated i"):
        R.to_blocks(rows, 2, 1).collect()
    assert [(r["i"], r["copies"]) for r in R.duplicate_rows(rows).collect()] == [(3, 2)]
    assert R.require_unique(rows_of(spark, [[1], [2]])).count() == 2


def test_blocks_refuse_ragged_rows_and_wrong_dimensions(spark):
    ragged = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "i bigint, v array<double>")
    with pytest.raises(Exception, match="does not have 2 elements"):
        R.to_blocks(ragged, 2, 2, 2, 2).collect()
    rows = rows_of(spark, np.ones((5, 4)))
    with pytest.raises(Exception, match="row index 4 outside 3 rows"):
        R.to_blocks(rows, 8, 2, 3, 4).collect()
    with pytest.raises(Exception, match="ends at column 4 of 3"):
        R.blocks_to_rows(R.to_blocks(rows, 2, 2), 3).collect()


def test_too_wide_rows_are_refused(spark):
    cells = spark.createDataFrame([(0, 1 << 23, 1.0)], "i bigint, j bigint, x double")
    with pytest.raises(ValueError, match="keep the matrix in cell or block form"):
        R.coo_to_rows(cells)


def test_info_and_ragged_rows(spark):
    a = [[0, 2, 0], [1, 0, 0]]
    info = R.matrix_info(rows_of(spark, a, [0, 4]), "a", "MC_MR", R.Grid(2, 2)).first()
    assert (info["num_rows"], info["num_cols"], info["stored_rows"], info["nnz"]) == (5, 3, 2, 2)
    assert info["density"] == 2 / 15 and info["num_partitions"] == 4 and info["layout_label"] == "MC/MR"
    ragged = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "i bigint, v array<double>")
    with pytest.raises(Exception, match="elements in one matrix"):
        R.matrix_info(ragged).collect()
    empty = R.matrix_info(rows_of(spark, np.zeros((0, 3)))).first()
    assert (empty["num_rows"], empty["num_cols"], empty["density"]) == (0, 0, 0.0)
    text = R.describe_matrix(R.matrix_info(rows_of(spark, a), "a")).first()["description"]
    assert text == "a: 2 x 3, 2 nonzero, layout VC/STAR, grid 1 x 1"
    blocks = R.to_blocks(rows_of(spark, a), 1, 2)
    assert R.matrix_density(blocks).first()["density"] == 2 / 6


# A 4 x 3 block with entries 1.11 * r for r = 3..14, row-major.
FIXED_BLOCK = np.array([1.11 * r for r in range(3, 15)]).reshape(4, 3)


@pytest.mark.parametrize("form", ["rows", "cells", "blocks"])
@pytest.mark.parametrize("rows,cols", [((0, 3, 1), (0, 2, 1)), ((1, 3, 2), (0, 2, 2)), ((2, 2, 1), (1, 1, 1)), ((3, 9, 1), (2, 5, 1))])
def test_block_slice(spark, form, rows, cols):
    matrix = rows_of(spark, FIXED_BLOCK)
    expected = {
        (i, j): FIXED_BLOCK[i, j]
        for i in range(rows[0], min(rows[1], 3) + 1, rows[2])
        for j in range(cols[0], min(cols[1], 2) + 1, cols[2])
    }
    if form == "rows":
        found = {
            (r["i"], cols[0] + q * cols[2]): x
            for r in R.block_slice(matrix, rows, cols).collect()
            for q, x in enumerate(r["v"])
        }
    else:
        source = R.rows_to_coo(matrix) if form == "cells" else R.to_blocks(matrix, 3, 2)
        found = {(r["i"], r["j"]): r["x"] for r in R.block_slice(source, rows, cols).collect()}
    assert found == expected


def test_block_slice_by_single_index(spark):
    matrix = rows_of(spark, FIXED_BLOCK)
    assert [tuple(r) for r in R.block_slice(R.rows_to_coo(matrix), 2, 1).collect()] == [(2, 1, FIXED_BLOCK[2, 1])]
    assert R.block_slice(matrix, 3, (0, 2, 1)).first()["v"] == list(FIXED_BLOCK[3])
    assert [r["v"] for r in R.block_slice(matrix, (0, 3, 1), 2).orderBy("i").collect()] == [[x] for x in FIXED_BLOCK[:, 2]]


def test_block_slice_refuses_bad_ranges(spark):
    for bad in ((0, 3, 0), (-1, 3, 1)):
        with pytest.raises(ValueError):
            R.block_slice(rows_of(spark, FIXED_BLOCK), bad, (0, 2, 1))
        with pytest.raises(ValueError):
            R.block_slice(rows_of(spark, FIXED_BLOCK), (0, 2, 1), bad)


def test_slice_range_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "rows")
    rows_of(spark, FIXED_BLOCK).write.parquet(path)
    R.block_slice(spark.read.parquet(path), (1, 2, 1), (0, 1, 1)).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(i,1)" in plan and "LessThanOrEqual(i,2)" in plan
    R.row_indices(spark.read.parquet(path)).explain("formatted")
    assert "ReadSchema: struct<i:bigint>" in capsys.readouterr().out


def test_select_rows_by_list_and_frame(spark):
    rows = rows_of(spark, np.arange(20).reshape(10, 2))
    ids = spark.createDataFrame([(3,), (3,), (7,), (99,)], "i bigint")
    assert sorted(r["i"] for r in R.select_rows(rows, ids).collect()) == [3, 7]
    assert sorted(r["i"] for r in R.select_rows(rows, [7, 3, 99]).collect()) == [3, 7]
    assert R.select_rows(rows, []).count() == 0
    assert sorted(r["i"] for r in R.select_rows(rows, range(4, 5000)).collect()) == [4, 5, 6, 7, 8, 9]


def test_common_rows_is_a_multiset_intersection(spark):
    a = spark.createDataFrame([(1,)] * 3 + [(2,)] * 2 + [(5,)], "i bigint")
    b = spark.createDataFrame([(1,)] * 2 + [(2,)] * 4 + [(6,)], "i bigint")
    assert sorted(r["i"] for r in R.common_rows(a, b).collect()) == [1, 1, 2, 2]
    many = spark.range(0, 25_001).selectExpr("4L AS i")
    more = spark.range(0, 30_000).selectExpr("4L AS i").union(b)
    found = R.common_rows(many, more)
    assert found.count() == 25_001
    assert found.distinct().count() == 1


def test_indices_must_not_be_negative(spark):
    rows = rows_of(spark, [[1, 2], [3, 4]], [-1, 0])
    cells = spark.createDataFrame([(0, -1, 9.0), (0, 1, 5.0)], "i bigint, j bigint, x double")
    for broken in (
        lambda: R.to_blocks(rows, 2, 2, 2, 2),
        lambda: R.cells_to_blocks(cells, 2, 2, 2, 2),
        lambda: R.coo_to_rows(cells, 2),
        lambda: R.layout_assign(rows, "VC_STAR", R.Grid(2, 2)),
        lambda: R.as_rows(rows, "i", "v"),
    ):
        with pytest.raises(Exception, match="negative"):
            broken().collect()


def test_rows_from_vectors(spark):
    table = spark.createDataFrame([(0, Vectors.dense([1.0, 2.0])), (1, Vectors.sparse(2, [1], [5.0]))], ["k", "f"])
    found = R.as_rows(table, "k", "f").collect()
    assert sorted((r["i"], r["v"]) for r in found) == [(0, [1.0, 2.0]), (1, [0.0, 5.0])]


def test_several_slices_in_one_scan(spark):
    a = np.arange(42.0).reshape(7, 6)
    rows = rows_of(spark, a)
    ranges = [((0, 2, 2), (1, 5, 2)), ((2, 3, 1), (0, 1, 1)), (6, 5)]
    wanted = {(i, j) for i in (0, 2) for j in (1, 3, 5)} | {(i, j) for i in (2, 3) for j in (0, 1)} | {(6, 5)}
    for matrix in (rows, R.rows_to_coo(rows), R.to_blocks(rows, 3, 2)):
        found = R.block_slices(matrix, ranges, (3, 2) if "bi" in matrix.columns else None).collect()
        assert sorted((r["i"], r["j"], r["x"]) for r in found) == sorted((i, j, a[i, j]) for i, j in wanted)


def test_absent_rows_are_zero_and_widths_must_agree(spark):
    a, b = rows_of(spark, [[3, 4], [1, 1]], [0, 2]), rows_of(spark, [[1, 0], [2, 2]], [1, 2])
    assert sorted(map(tuple, R.row_sqdist(a, b).collect())) == [(0, 25.0), (1, 1.0), (2, 2.0)]
    assert sorted(map(tuple, R.row_dots(a, b).collect())) == [(0, 0.0), (1, 0.0), (2, 4.0)]
    with pytest.raises(Exception, match="elements"):
        R.row_sqdist(a, rows_of(spark, [[1, 2, 3]], [0])).collect()


def test_matrix_diff(spark):
    a = rows_of(spark, [[1, np.nan, 3], [4, 5, 6], [0, 0, 0]])
    b = rows_of(spark, [[1, np.nan, 3.5], [4, np.nan, 6], [7, 0, 0]], [0, 1, 5])
    found = {(r["i"], r["j"]): (r["xa"], r["xb"]) for r in R.matrix_diff(a, b, 0.1).collect()}
    assert set(found) == {(0, 2), (1, 1), (5, 0)}
    assert found[5, 0] == (0.0, 7.0) and found[0, 2] == (3.0, 3.5)
    assert R.matrix_diff(a, a).count() == 0
    assert R.matrix_diff(a, b, 1.0).count() == 2
    twice = rows_of(spark, [[1], [1]], [0, 0])
    with pytest.raises(Exception, match="repeated i"):
        R.matrix_diff(twice, twice).collect()
    with pytest.raises(TypeError):
        R.matrix_diff(a, R.rows_to_coo(a))
    whole = rows_of(spark, FIXED_BLOCK)
    halves = R.rows_to_coo(whole).withColumn("x", F.col("x") / 2)
    assert R.matrix_diff(R.rows_to_coo(whole), halves.union(halves)).count() == 0
    assert R.matrix_diff(R.to_blocks(whole, 2, 2), R.to_blocks(whole, 3, 3)).count() == 0


def test_union_keeps_copies(spark):
    rows = rows_of(spark, [[1], [2]])
    assert R.union_rows(rows, rows, rows).count() == 6


def test_forms_are_recognised(spark):
    rows = rows_of(spark, FIXED_BLOCK)
    assert [R.form_of(x) for x in (rows, R.rows_to_coo(rows), R.to_blocks(rows, 2, 2))] == ["rows", "cells", "blocks"]
    with pytest.raises(TypeError):
        R.form_of(spark.range(3))
