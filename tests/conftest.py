"""Shared session and the comparison of a Spark result with DuckDB's."""

import glob
import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def _key(row):
    return tuple((v is None, "nan" if isinstance(v, float) and math.isnan(v) else v) for v in row)


def compare(frame, con, sql):
    """Schema, row count and every value, with columns in name order and rows sorted."""
    names = sorted(frame.columns)
    mine = frame.select(*names)
    result = con.execute(f"SELECT {', '.join(names)} FROM ({sql})")
    types = {d[0]: str(d[1]) for d in result.description}
    expected_types = {n: SPARK_TYPES[t] for n, t in mine.dtypes}
    assert set(types) == set(expected_types)
    assert types == expected_types
    theirs = sorted((tuple(r) for r in result.fetchall()), key=_key)
    ours = sorted((tuple(c.as_py() for c in r) for r in zip(*mine.toArrow().columns)), key=_key)
    assert len(ours) == len(theirs)
    different = [(a, b) for a, b in zip(ours, theirs) if _key(a) != _key(b)]
    assert not different, f"{len(different)} rows differ, first: {different[:3]}"
