"""Ownership of every cell, ranges, volumes, message chunks and physical routing."""


import numpy as np
import pytest
from test_forms import dense_of, rows_of

import rowloom as R

GRIDS = [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3)]


def owner_coordinates(layout, i, j, r, c):
    """Brute force: the set of grid positions that hold cell (i, j)."""
    p = r * c

    def one(kind, x):
        return {
            "MC": lambda a, b: a == x % r,
            "MR": lambda a, b: b == x % c,
            "VC": lambda a, b: a + b * r == x % p,
            "VR": lambda a, b: b + a * c == x % p,
            "MD": lambda a, b: (a, b) == (x % r, x % c),
            "CIRC": lambda a, b: (a, b) == (0, 0),
            "STAR": lambda a, b: True,
        }[kind]

    row, col = layout.split("_")
    return {(a, b) for a in range(r) for b in range(c) if one(row, i)(a, b) and one(col, j)(a, b)}


@pytest.mark.parametrize("grid", GRIDS)
def test_every_cell_has_the_right_owners(spark, grid):
    m, n = 20, 5
    rows = rows_of(spark, np.arange(m * n).reshape(m, n))
    r, c = grid
    for layout in R.LAYOUTS:
        expected = sorted(
            (i, j, a, b) for i in range(m) for j in range(n) for a, b in owner_coordinates(layout, i, j, r, c)
        )
        cells = R.layout_assign(R.rows_to_coo(rows), layout, R.Grid(r, c)).collect()
        assert sorted((x["i"], x["j"], x["a"], x["b"]) for x in cells) == expected, layout
        assert all(x["owner"] == x["a"] + x["b"] * r and x["x"] == x["i"] * n + x["j"] for x in cells)
        pieces = R.layout_assign(rows, layout, R.Grid(r, c)).collect()
        spread = [
            (x["i"], x["j0"] + t * x["jstep"], x["a"], x["b"], value)
            for x in pieces
            for t, value in enumerate(x["v"])
        ]
        assert sorted(s[:4] for s in spread) == expected, layout
        assert all(value == i * n + j for i, j, _, _, value in spread)


@pytest.mark.parametrize("shape", [(20, 5), (1, 7), (6, 1), (2, 2)])
def test_ranges_describe_the_owned_cells(spark, shape):
    m, n = shape
    r, c = 2, 3
    info = R.matrix_info(rows_of(spark, np.ones(shape)))
    for layout in R.LAYOUTS:
        for w in R.layout_ranges(info, layout, R.Grid(r, c)).collect():
            owned = {
                (i, j) for i in range(m) for j in range(n) if (w["a"], w["b"]) in owner_coordinates(layout, i, j, r, c)
            }
            assert w["cells"] == len(owned), (layout, w)
            if owned:
                listed = {
                    (i, j)
                    for i in range(w["row_start"], w["row_end"] + 1, w["row_step"])
                    for j in range(w["col_start"], w["col_end"] + 1, w["col_step"])
                }
                assert listed == owned, (layout, w)


def test_blocks_are_dealt_like_cells(spark):
    rows = rows_of(spark, np.arange(35).reshape(7, 5))
    cells = R.layout_assign(R.rows_to_coo(rows), "MC_MR", R.Grid(2, 2)).collect()
    blocks = R.layout_assign(R.to_blocks(rows, 3, 2), "MC_MR", R.Grid(2, 2)).collect()
    assert sorted(map(tuple, cells)) == sorted(map(tuple, blocks))
    volumes = [R.layout_volume(m, "MC_MR", R.Grid(2, 2)) for m in (rows, R.to_blocks(rows, 3, 2))]
    assert sorted(map(tuple, volumes[0].collect())) == sorted(map(tuple, volumes[1].collect()))


def test_layouts_without_copies_own_each_cell_once(spark):
    rows = rows_of(spark, np.ones((13, 4)))
    for layout in ("MC_MR", "MR_MC", "VC_STAR", "VR_STAR", "MD_STAR", "STAR_VC", "STAR_VR", "STAR_MD", "CIRC_CIRC"):
        cells = R.layout_assign(R.rows_to_coo(rows), layout, R.Grid(2, 3))
        assert cells.count() == 52 and cells.select("i", "j").distinct().count() == 52


def test_unknown_layout_and_grid_are_refused(spark):
    rows = rows_of(spark, np.ones((2, 2)))
    with pytest.raises(ValueError, match="unknown layout"):
        R.layout_assign(rows, "VC_VC", R.Grid(1, 1))
    with pytest.raises(ValueError):
        R.Grid(0, 2)


@pytest.mark.parametrize("layout", sorted(R.LAYOUTS))
def test_store_and_fetch_is_the_identity(spark, tmp_path, layout):
    a = np.random.default_rng(1).random((20, 5))
    path = str(tmp_path / "m")
    assert R.put_matrix(rows_of(spark, a).repartition(7), path, layout, R.Grid(2, 3)) == 20
    assert np.array_equal(dense_of(R.get_matrix(spark, path), 20, 5), a)


@pytest.mark.parametrize("grid", GRIDS)
@pytest.mark.parametrize("shape", [(1, 6), (6, 1), (3, 2)])
def test_store_and_fetch_small_shapes(spark, tmp_path, grid, shape):
    a = np.random.default_rng(2).random(shape)
    for layout in ("MC_MR", "STAR_VR"):
        path = str(tmp_path / layout)
        R.put_matrix(rows_of(spark, a), path, layout, R.Grid(*grid), buckets=2)
        assert np.array_equal(dense_of(R.get_matrix(spark, path), *shape), a)


def test_many_owners_are_written_through_a_shuffle(spark, tmp_path):
    a = np.random.default_rng(3).random((150, 4))
    for layout in ("MC_MR", "CIRC_CIRC"):
        path = str(tmp_path / layout)
        R.put_matrix(rows_of(spark, a), path, layout, R.Grid(9, 8))
        assert np.array_equal(dense_of(R.get_matrix(spark, path), 150, 4), a)


def test_store_fills_gaps_appends_and_refuses_repeats(spark, tmp_path):
    path = str(tmp_path / "m")
    R.put_matrix(rows_of(spark, [[1, 2], [3, 4]], [0, 3]), path, "MR_MC", R.Grid(2, 2), name="a")
    assert R.append_rows(rows_of(spark, [[5, 6]], [5]), path) == 1
    expected = np.zeros((6, 2))
    expected[[0, 3, 5]] = [[1, 2], [3, 4], [5, 6]]
    assert np.array_equal(dense_of(R.get_matrix(spark, path), 6, 2), expected)
    assert R.get_matrix(spark, path, fill=False).count() == 3
    with pytest.raises(ValueError, match="stored already"):
        R.append_rows(rows_of(spark, [[9, 9]], [3]), path)
    with pytest.raises(ValueError, match="cannot extend"):
        R.append_rows(rows_of(spark, [[9]], [9]), path)
    with pytest.raises(ValueError, match="repeated row index"):
        R.put_matrix(rows_of(spark, [[1], [2]], [4, 4]), str(tmp_path / "twice"))
    ragged = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "i bigint, v array<double>").coalesce(1)
    with pytest.raises(Exception, match="does not have 2 elements"):
        R.put_matrix(ragged, str(tmp_path / "ragged"))
    with pytest.raises(ValueError, match="empty matrix"):
        R.put_matrix(rows_of(spark, np.zeros((0, 2))), str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="already"):
        R.put_matrix(rows_of(spark, [[1]]), path)


def test_a_write_without_its_record_is_not_read(spark, tmp_path, monkeypatch):
    from rowloom.sources import store

    path = str(tmp_path / "broken")
    R.put_matrix(rows_of(spark, [[1, 2], [3, 4]]), path)
    with monkeypatch.context() as broken:
        broken.setattr(store, "INFO_SCHEMA", "nothing int")
        with pytest.raises(Exception):
            store._write(rows_of(spark, [[5, 6]], [2]), path, "", 2, "VC_STAR", R.Grid(1, 1), None, "append")
    assert R.get_matrix(spark, path).count() == 2
    assert R.append_rows(rows_of(spark, [[5, 6]], [2]), path) == 1
    assert sorted(tuple(r["v"]) for r in R.get_matrix(spark, path).collect()) == [(1, 2), (3, 4), (5, 6)]


@pytest.mark.parametrize("layout", sorted(R.LAYOUTS))
def test_rows_by_index_read_their_owners_only(spark, tmp_path, layout, capsys):
    a, path = np.arange(60.0).reshape(20, 3), str(tmp_path / "rows")
    R.put_matrix(rows_of(spark, a), path, layout, R.Grid(2, 3))
    found = R.get_rows(spark, path, [3, 9, 77])
    assert sorted((r["i"], tuple(r["v"])) for r in found.collect()) == [(3, tuple(a[3])), (9, tuple(a[9]))]
    found.explain("formatted")
    assert "PartitionFilters: [" in capsys.readouterr().out


def test_replicated_layouts_read_one_copy(spark, tmp_path, capsys):
    path = str(tmp_path / "m")
    R.put_matrix(rows_of(spark, np.ones((4, 3))), path, "STAR_STAR", R.Grid(2, 2))
    assert spark.read.parquet(f"{path}/pieces").count() == 16
    R.get_matrix(spark, path, fill=False).explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters:")]
    assert len(filters) == 1 and "(owner" in filters[0] and "write" in filters[0]


def test_route_puts_each_owner_in_its_own_partitions(spark):
    rows = rows_of(spark, np.ones((200, 2)))
    pieces = R.layout_assign(rows, "CIRC_CIRC", R.Grid(1, 2))
    moved = R.route(pieces, R.Grid(1, 2), buckets=4)
    used = {r[0] for r in moved.selectExpr("spark_partition_id()").distinct().collect()}
    assert moved.rdd.getNumPartitions() == 8 and used == {0, 1, 2, 3}


@pytest.mark.parametrize("layout", ["VC_STAR", "MC_MR", "MR_STAR", "STAR_STAR"])
def test_volume(spark, layout):
    index = [0, 1, 2, 5, 9, 14, 15, 16, 17, 40, 41, 90]
    rows = rows_of(spark, np.ones((len(index), 5)), index)
    r, c = 2, 2
    held = {}
    for i in index:
        for j in range(5):
            for a, b in owner_coordinates(layout, i, j, r, c):
                held.setdefault(a + b * r, {}).setdefault(i, []).append(j)
    volume = {x["owner"]: x for x in R.layout_volume(rows, layout, R.Grid(r, c)).collect()}
    assert set(volume) == set(held)
    for owner, by_row in held.items():
        elements = sum(len(js) for js in by_row.values())
        found = volume[owner]
        assert (found["rows"], found["elements"], found["bytes"]) == (len(by_row), elements, 8 * elements)


def test_files_are_few_and_sorted(spark, tmp_path):
    rows = rows_of(spark, np.ones((200, 2))).repartition(8)
    R.put_matrix(rows, str(tmp_path / "m"), "VC_STAR", R.Grid(4, 4))
    pieces = spark.read.parquet(str(tmp_path / "m" / "pieces"))
    assert len(pieces.inputFiles()) == 16


def test_grid_table(spark):
    found = {(x["worker"], x["a"], x["b"]) for x in R.grid_table(spark, R.Grid(2, 3)).collect()}
    assert found == {(a + b * 2, a, b) for a in range(2) for b in range(3)}
