"""Stored matrices read through Spark's data source interface."""

import numpy as np
import pytest

import rowloom as R
from rowloom.operators.grids import LAYOUTS, coordinates
from rowloom.operators.layouts import Grid
from rowloom.sources.matrix_source import first_copy


def stored(spark, path, layout="VC_STAR", n=40, width=7):
    values = np.arange(n * width, dtype=float).reshape(n, width)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "i bigint, v array<double>")
    R.put_matrix(rows, path, layout, Grid(2, 3))
    return values


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_every_layout_is_read_once(spark, tmp_path, layout):
    path = str(tmp_path / "m")
    values = stored(spark, path, layout)
    found = spark.read.format(R.register_source(spark)).load(path).collect()
    cells = [(r["i"], r["j0"] + k * r["jstep"] if "j0" in r else k, x) for r in found for k, x in enumerate(r["v"])]
    assert sorted(cells) == [(i, j, values[i, j]) for i in range(40) for j in range(7)]


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_first_copies_are_those_of_the_layout(spark, layout):
    a, b = coordinates(layout, 5, 5, Grid(2, 3)) if not set(layout.split("_")) & {"VC", "VR", "CIRC"} else (0, 0)
    owners = first_copy(layout, 2, 3)
    assert (owners is None) == (a is not None and b is not None)
    assert owners is None or len(owners) == (2 if a is not None else 3 if b is not None else 1)


@pytest.mark.parametrize(
    "where, kept",
    [
        ("i >= 5 AND i < 9", range(5, 9)),
        ("i IN (3, 11, 99)", [3, 11]),
        ("i = 7 AND v[0] > 1000", []),
        ("i > 30 OR i <= 2", [0, 1, 2, *range(31, 40)]),
        ("i IS NULL", []),
    ],
)
def test_filters(spark, tmp_path, where, kept):
    path = str(tmp_path / "m")
    values = stored(spark, path)
    spark.read.format(R.register_source(spark)).load(f"file:{path}").createOrReplaceTempView("stored_matrix")
    found = spark.sql(f"SELECT i, v FROM stored_matrix WHERE {where} ORDER BY i").collect()
    assert [(r["i"], r["v"]) for r in found] == [(i, values[i].tolist()) for i in kept]


def test_filter_reaches_the_source(spark, tmp_path):
    path = str(tmp_path / "m")
    stored(spark, path)
    found = spark.read.format(R.register_source(spark)).load(path).where("i >= 5")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan rowloom" in plan and "Filter " not in plan


def test_appended_compacted_and_failed_writes(spark, tmp_path):
    path = str(tmp_path / "m")
    stored(spark, path)
    R.append_rows(spark.createDataFrame([(40, [1.0] * 7)], "i bigint, v array<double>"), path)
    spark.read.parquet(f"{path}/pieces").limit(3).drop("write").selectExpr("*", "'lost' AS write").write.mode(
        "append"
    ).partitionBy("owner", "write").parquet(f"{path}/pieces")
    source = spark.read.format(R.register_source(spark))
    assert source.load(path).count() == 41
    R.compact_matrix(spark, path)
    assert source.load(path).count() == source.load(path).select("i").distinct().count() == 41


def test_other_forms_fail(spark, tmp_path):
    path = str(tmp_path / "m")
    R.put_cells(spark.createDataFrame([(0, 0, 1.0)], "i bigint, j bigint, x double"), path)
    with pytest.raises(Exception, match="not stored in rows"):
        spark.read.format(R.register_source(spark)).load(path).collect()
