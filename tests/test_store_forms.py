"""Moving between layouts, stored cells and tiles, reopening, compaction, batches of ranges, digests."""

import numpy as np
import pytest
from test_forms import dense_of, rows_of
from test_layouts import owner_coordinates
from test_products import cells_of, dense_cells

import rowloom as R

NAMES = sorted(R.LAYOUTS)


def owners(layout, i, j, r, c):
    return {a + b * r for a, b in owner_coordinates(layout, i, j, r, c)}


@pytest.mark.parametrize("layout", NAMES)
def test_moves_between_all_layouts(spark, layout):
    """Every cell that a worker needs and lacks comes from exactly one other worker."""
    from functools import reduce

    m, n, old, new = 7, 5, R.Grid(2, 3), R.Grid(3, 2)
    info = R.matrix_info(rows_of(spark, np.ones((m, n))))
    plans = [R.layout_moves(info, layout, old, to, new).selectExpr(f"'{to}' AS layout", "*") for to in NAMES]
    found = {}
    for r in reduce(lambda a, b: a.union(b), plans).collect():
        cells = [(i, j) for i in range(r["row_start"], m, r["row_step"]) for j in range(r["col_start"], n, r["col_step"])]
        assert len(cells) == r["cells"]
        for cell in cells if r["moves"] else []:
            found.setdefault((r["layout"], r["target"], cell), []).append(r["source"])
    for to in NAMES:
        for i in range(m):
            for j in range(n):
                had, needs = owners(layout, i, j, 2, 3), owners(to, i, j, 3, 2)
                for t in range(6):
                    senders = found.get((to, t, (i, j)), [])
                    assert len(senders) == (t in needs and t not in had) and set(senders) <= had


@pytest.mark.parametrize("k", range(len(NAMES)))
def test_redistribute(spark, tmp_path, k):
    """Two moves in a row, through other grids; what arrives is the matrix and lies with its owners."""
    a = np.random.default_rng(k).random((9, 7))
    paths = [str(tmp_path / x) for x in "abc"]
    first, second, third = NAMES[k], NAMES[(k + 3) % 14], NAMES[(k + 8) % 14]
    R.put_matrix(rows_of(spark, a), paths[0], first, R.Grid(2, 3))
    assert R.redistribute(spark, paths[0], paths[1], second, R.Grid(2, 2)) == 9
    R.redistribute(spark, paths[1], paths[2], third, R.Grid(3, 2))
    assert np.array_equal(dense_of(R.get_matrix(spark, paths[2]), 9, 7), a)
    for r in spark.read.parquet(f"{paths[2]}/pieces").collect():
        for p, x in enumerate(r["v"]):
            j = r["j0"] + p * r["jstep"]
            assert x == a[r["i"], j] and r["owner"] in owners(third, r["i"], j, 3, 2)
    assert sorted((r["i"], r["v"]) for r in R.get_rows(spark, paths[2], [2, 5]).collect()) == [(i, a[i].tolist()) for i in (2, 5)]


def test_many_column_classes_and_gaps(spark, tmp_path):
    a, path = np.arange(120.0).reshape(3, 40) + 1, str(tmp_path / "m")
    R.put_matrix(rows_of(spark, a, [0, 2, 5]), path, "STAR_VC", R.Grid(4, 5))
    expected = np.zeros((6, 40))
    expected[[0, 2, 5]] = a
    assert np.array_equal(dense_of(R.get_matrix(spark, path), 6, 40), expected)
    with pytest.raises(ValueError, match="already"):
        R.redistribute(spark, path, path, "VC_STAR", R.Grid(1, 1))


@pytest.mark.parametrize("layout", ["MC_MR", "STAR_STAR", "MD_STAR", "STAR_MR", "CIRC_CIRC"])
def test_cells_and_tiles(spark, tmp_path, layout):
    rng = np.random.default_rng(3)
    a = rng.random((11, 8)) * (rng.random((11, 8)) < 0.4)
    a[10, 7] = 1.0
    cells, tiles = str(tmp_path / "cells"), str(tmp_path / "tiles")
    assert R.put_cells(cells_of(spark, a), cells, layout, R.Grid(2, 3)) == np.count_nonzero(a)
    assert np.array_equal(dense_cells(R.get_cells(spark, cells), 11, 8), a)
    assert R.put_tiles(R.to_blocks(rows_of(spark, a), 4, 3), tiles, layout, R.Grid(2, 3)) == 9
    assert np.array_equal(dense_of(R.blocks_to_rows(R.get_tiles(spark, tiles)), 11, 8), a)
    with pytest.raises(ValueError, match="stored in blocks"):
        R.get_matrix(spark, tiles)
    with pytest.raises(ValueError, match="already"):
        R.put_cells(cells_of(spark, a), cells)
    twice = cells_of(spark, np.ones((2, 2))).union(cells_of(spark, np.ones((1, 1))))
    with pytest.raises(Exception, match="repeated i, j"):
        R.put_cells(twice, str(tmp_path / "twice"))


def test_reopen_and_compact(spark, tmp_path):
    root = str(tmp_path)
    R.put_matrix(rows_of(spark, [[1, 2], [3, 4]]), f"{root}/a", "MC_MR", R.Grid(2, 2), name="first")
    R.put_cells(cells_of(spark, np.eye(3)), f"{root}/b", name="second")
    for i in range(2, 5):
        R.append_rows(rows_of(spark, [[i, i]], [i]), f"{root}/a")
    listed = {r["name"]: (r["form"], r["writes"], r["num_rows"]) for r in R.stored_matrices(spark, root).collect()}
    assert listed == {"first": ("rows", 4, 5), "second": ("cells", 1, 3)}
    expected = np.array([[1, 2], [3, 4], [2, 2], [3, 3], [4, 4]])
    assert np.array_equal(dense_of(R.open_matrix(spark, root, "first"), 5, 2), expected)
    assert R.open_matrix(spark, root, "second").count() == 3
    with pytest.raises(KeyError, match="third"):
        R.open_matrix(spark, root, "third")
    assert R.compact_matrix(spark, f"{root}/a") == 4
    assert np.array_equal(dense_of(R.get_matrix(spark, f"{root}/a"), 5, 2), expected)
    assert R.remove_replaced(spark, f"{root}/a") > 0 and R.remove_replaced(spark, f"{root}/a") == 0
    assert np.array_equal(dense_of(R.open_matrix(spark, root, "first"), 5, 2), expected)
    assert R.append_rows(rows_of(spark, [[7, 7]], [5]), f"{root}/a") == 1
    assert R.get_matrix(spark, f"{root}/a").count() == 6
    with pytest.raises(ValueError, match="stored already"):
        R.append_rows(rows_of(spark, [[7, 7]], [2]), f"{root}/a")


def test_batch_of_ranges(spark, tmp_path, capsys):
    a, path = np.arange(260.0).reshape(20, 13), str(tmp_path / "tiles")
    R.put_tiles(R.to_blocks(rows_of(spark, a), 4, 5), path, "MC_MR", R.Grid(2, 2))
    rng = np.random.default_rng(5)
    asked = []
    for k in range(150):
        r, c = rng.integers(0, 25, 2), rng.integers(0, 16, 2)
        asked.append((k, *sorted(map(int, r)), int(rng.integers(1, 6)), *sorted(map(int, c)), int(rng.integers(1, 6))))
    asked += [(150, 7, 3, 1, 0, 5, 1), (151, 19, 19, 1, 12, 12, 1), (152, 100, 200, 1, 0, 5, 1)]
    columns = ["request", "row_start", "row_end", "row_step", "col_start", "col_end", "col_step"]
    frame = spark.createDataFrame(asked, ", ".join(f"{c} bigint" for c in columns))
    expected = [
        (k, i, j, a[i, j]) for k, r0, r1, rs, c0, c1, cs in asked
        for i in range(r0, min(r1, 19) + 1, rs) for j in range(c0, min(c1, 12) + 1, cs)
    ]
    for found in (R.get_ranges(spark, path, frame), R.block_ranges(R.to_blocks(rows_of(spark, a), 4, 5), frame, (4, 5))):
        assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    R.get_ranges(spark, path, frame.where("request = 151")).explain("formatted")
    assert "EqualTo(bi,4)" in capsys.readouterr().out
    with pytest.raises(Exception, match="positive step"):
        R.block_ranges(R.to_blocks(rows_of(spark, a), 4, 5), frame.selectExpr("request", *columns[1:3], "0L AS row_step", *columns[4:]), (4, 5)).collect()


def test_differences_by_digests(spark, capsys):
    a = np.random.default_rng(6).random((12, 9))
    b = a.copy()
    b[3, 4], b[11, 8] = -1.0, np.nan
    left, right = R.to_blocks(rows_of(spark, a), 4, 4), R.to_blocks(rows_of(spark, b), 4, 4)
    found = {(r["i"], r["j"]): r["xa"] for r in R.matrix_diff(left, right).collect()}
    assert found == {(3, 4): a[3, 4], (11, 8): a[11, 8]}
    assert R.matrix_diff(left, left).count() == 0
    other = R.to_blocks(rows_of(spark, b), 3, 9)
    assert {(r["i"], r["j"]) for r in R.matrix_diff(left, other).collect()} == set(found)
    missing = right.where("bi <> 0 OR bj <> 2")
    absent = {(r["i"], r["j"]): r["xb"] for r in R.matrix_diff(left, missing).collect()}
    assert {k for k in absent if k not in found} == {(i, 8) for i in range(4)} and absent[(0, 8)] == 0.0
