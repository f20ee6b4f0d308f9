"""libsvm files, text vectors, random matrices, SQL functions and the scratch folder."""

import numpy as np
import pytest
from test_forms import dense_of, rows_of

import rowloom as R
from rowloom.sources.scratch import scratch_path


@pytest.fixture
def libsvm(tmp_path):
    def write(*lines):
        path = tmp_path / "data.libsvm"
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def test_libsvm_label_is_the_row_index(spark, libsvm):
    path = libsvm("2.9 1:1.5 3:2.5", "0 2:4", "16777217 1:1")
    rows = {r["i"]: r["v"] for r in R.read_libsvm_matrix(spark, path).collect()}
    assert rows == {2: [1.5, 0.0, 2.5], 0: [0.0, 4.0, 0.0], 16777217: [1.0, 0.0, 0.0]}
    wide = R.read_libsvm_matrix(spark, path, num_features=5)
    assert {len(r["v"]) for r in wide.collect()} == {5}
    assert R.matrix_info(wide).first()["num_rows"] == 16777218


def test_libsvm_repeated_labels(spark, libsvm):
    path = libsvm("3 1:1 2:2", "1 1:5", "3 2:7")
    read = lambda how: sorted((r["i"], r["v"]) for r in R.read_libsvm_matrix(spark, path, 2, how).collect())
    with pytest.raises(Exception, match="repeated i"):
        read("error")
    assert read("keep") == [(1, [5.0, 0.0]), (3, [0.0, 7.0]), (3, [1.0, 2.0])]
    assert read("sum") == [(1, [5.0, 0.0]), (3, [1.0, 9.0])]
    assert read("first") == [(1, [5.0, 0.0]), (3, [1.0, 2.0])]
    with pytest.raises(ValueError, match="on_duplicate"):
        read("last")


def test_parse_vectors(spark):
    texts = ["[1.0,2.5,-3e2]", " [ 1 , 2 ,3 ] ", "(3,[0,2],[1.5,2.5])", "(3,[],[])", "[NaN,0,1]", "(3,[2,0],[9,8])", "( 3 , [ 1 ] , [4] )"]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = {r["i"]: r["v"] for r in R.parse_vectors(table, "id", "t").collect()}
    assert rows[0] == [1.0, 2.5, -300.0] and rows[1] == [1.0, 2.0, 3.0]
    assert rows[2] == [1.5, 0.0, 2.5] and rows[3] == [0.0] * 3
    assert np.isnan(rows[4][0]) and rows[4][1:] == [0.0, 1.0]
    assert rows[5] == [8.0, 0.0, 9.0] and rows[6] == [0.0, 4.0, 0.0]
    empty = spark.createDataFrame([(0, "[]")], "id int, t string")
    assert R.parse_vectors(empty, "id", "t").first()["v"] == []


@pytest.mark.parametrize("text", ["1,2", "[1,x]", "(2,[0],[1,2])", "(2,[5],[1])", "[1,2", "", None])
def test_parse_vectors_refuses_anything_else(spark, text):
    table = spark.createDataFrame([(0, text)], "id int, t string")
    with pytest.raises(Exception, match="not a vector|differ in number|outside a matrix|CAST_INVALID_INPUT|repeat"):
        R.parse_vectors(table, "id", "t").collect()


def test_random_matrix_is_uniform_and_reproducible(spark):
    a = dense_of(R.random_matrix(spark, 200, 50), 200, 50)
    again = dense_of(R.random_matrix(spark, 200, 50).repartition(3), 200, 50)
    other = dense_of(R.random_matrix(spark, 200, 50, seed=1), 200, 50)
    assert np.array_equal(a, again) and not np.array_equal(a, other)
    assert 0 <= a.min() and a.max() < 1 and abs(a.mean() - 0.5) < 0.01 and abs(a.var() - 1 / 12) < 0.003
    assert np.linalg.svd(a - a.mean(), compute_uv=False)[-1] > 0.5


def test_random_rows_neither_repeat_nor_shift(spark):
    far = spark.createDataFrame([(5,), (6,), (5 + 2147483647,), (5 + 2147483629,), (5 + 2**40,)], "i bigint")
    found = [r["v"] for r in R.random_rows(far, 100_050).collect()]
    assert len({tuple(v[:20]) for v in found}) == 5 and len({v[k] for v in found for k in range(200)}) == 1000
    first, second = found[:2]
    assert not set(first) & set(second) and len(set(first)) == 100_050


@pytest.mark.parametrize("text", ["(2,[1,1],[5,6])", "(4,[1,1],[5,6])", "(3,[-1],[5])"])
def test_sparse_text_needs_distinct_places(spark, text):
    with pytest.raises(Exception, match="repeat|outside"):
        R.parse_vectors(spark.createDataFrame([(0, text)], "id int, t string"), "id", "t").collect()


def test_sql_functions(spark):
    names = R.register_functions(spark)
    assert set(names) == {"vec_norm", "vec_dot", "vec_sqdist", "vec_cells"}
    R.register_matrix(rows_of(spark, [[3, 4], [6, 8]]), "two_rows")
    row = spark.sql(
        "SELECT vec_norm(v) AS n, vec_dot(v, v) AS d, vec_sqdist(v, array(0D, 0D)) AS s FROM two_rows WHERE i = 0"
    ).first()
    assert (row["n"], row["d"], row["s"]) == (5.0, 25.0, 25.0)
    cells = spark.sql("SELECT i, j, x FROM two_rows, LATERAL vec_cells(v)").collect()
    assert sorted(tuple(c) for c in cells) == [(0, 0, 3.0), (0, 1, 4.0), (1, 0, 6.0), (1, 1, 8.0)]
    with pytest.raises(KeyError, match="unknown vector functions"):
        R.register_functions(spark, ["vec_cross"])


def test_blocks_are_stored_and_read(spark, tmp_path):
    a = np.arange(35.0).reshape(7, 5)
    path = str(tmp_path / "blocks")
    R.put_blocks(R.to_blocks(rows_of(spark, a), 3, 2), path)
    assert np.array_equal(dense_of(R.blocks_to_rows(R.get_blocks(spark, path)), 7, 5), a)
    with pytest.raises(Exception, match="already exists"):
        R.put_blocks(R.to_blocks(rows_of(spark, a), 3, 2), path)


def test_slice_bounds_reach_the_scan(spark, tmp_path, capsys):
    a = np.arange(400.0).reshape(20, 20)
    path = str(tmp_path / "blocks")
    R.put_blocks(R.to_blocks(rows_of(spark, a), 4, 4), path)
    cut = R.block_slice(R.get_blocks(spark, path), (9, 13, 1), (17, 19, 1), tile=(4, 4))
    assert sorted(r["x"] for r in cut.collect()) == sorted(a[9:14, 17:20].ravel())
    cut.explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line)
    assert all(f"{sign}({name}," in pushed for sign in ("GreaterThan", "LessThanOrEqual") for name in ("i0", "j0"))


def test_scratch_is_under_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
