"""Nearest neighbours against all distances."""

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from rowloom.llm import neighbours as N

SCHEMA = "vec_id bigint, embedding array<double>, region int, id int, rank int"


def brute(rows, asks, count=10):
    held = {}
    for key, v in rows:
        good = key is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if good:
            held[key] = min(held.get(key, v), v)
    ids = np.array(sorted(held))
    vectors = np.array([held[k] for k in ids])
    out = {}
    for k in ids[[asks(i) for i in ids]]:
        distance = np.sqrt(((vectors - held[k]) ** 2).sum(axis=1))
        out[k] = [(int(ids[i]), distance[i]) for i in np.lexsort((ids, distance)) if ids[i] != k][:count]
    return out


def recall(found, expected):
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert set(got) == {k for k, v in expected.items() if v}
    hits = 0
    for key, best in got.items():
        assert [r for _, _, r in best] == list(range(1, len(expected[key]) + 1))
        assert best == sorted(best, key=lambda b: (b[1], b[0]))
        exact = dict(expected[key])
        hits += sum(v in exact for v, _, _ in best)
        assert all(abs(s - exact[v]) < 1e-12 for v, s, _ in best if v in exact)
    return hits / max(1, sum(len(v) for v in expected.values()))


def test_embeddings(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    found = N.nearest_neighbours(table, F.col("vec_id") % 100 == 0)
    assert recall(found, brute(rows, lambda i: i % 100 == 0)) >= 0.9


def test_many_shards_and_equal_vectors(spark, monkeypatch):
    """A third of the vectors equal, regions split by hash, ties by id."""
    monkeypatch.setattr(N, "SHARD_ROWS", 100)
    monkeypatch.setattr(N, "SAMPLE_ROWS", 320)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 12)) * 4
    rows = [(i, (centres[i % 6] + rng.standard_normal(12)).tolist()) for i in range(1000)]
    rows += [(i, [1.0] * 12) for i in range(1000, 1500)]
    table = spark.createDataFrame([(k, v, 1, 1, 1) for k, v in rows], SCHEMA)
    found = N.nearest_neighbours(table, F.col("vec_id") % 50 == 0)
    assert recall(found, brute(rows, lambda i: i % 50 == 0)) >= 0.95


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [3.0, 1.0]), (7, [3.0, 1.0]), (None, [1.0, 1.0]), (8, [])]
    table = spark.createDataFrame([(k, v, 1, 1, 1) for k, v in rows], SCHEMA)
    found = N.nearest_neighbours(table, F.col("vec_id") >= 0)
    assert recall(found, brute(rows, lambda i: True)) == 1.0
    other = table.union(spark.createDataFrame([(9, [1.0, 2.0, 3.0], 1, 1, 1)], SCHEMA))
    assert N.nearest_neighbours(other, F.col("vec_id") >= 0).count() == found.count()
    assert N.nearest_neighbours(table.limit(0), F.col("vec_id") >= 0).count() == 0
    assert N.nearest_neighbours(table.where("vec_id = 0"), F.col("vec_id") >= 0).count() == 0


def test_reach_is_the_chi_square_quantile():
    assert N.reach(0.95) == pytest.approx(15.50731, abs=1e-4)
    assert N.reach(0.99) == pytest.approx(20.09024, abs=1e-4)
