"""Hard negatives and Strassen products against plain ones."""

import math

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from rowloom.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<double>, label int, id int, score int, anchor string"


@pytest.mark.parametrize("shape", [(1, 1, 1), (0, 3, 2), (40, 64, 33), (129, 64, 200), (65, 257, 70), (300, 130, 140)])
def test_strassen(shape, monkeypatch):
    m, k, n = shape
    rng = np.random.default_rng(7)
    for most in (1000, 1 << 20, 1 << 28):
        a, b = rng.integers(-most, most, (m, k)), rng.integers(-most, most, (k, n))
        assert (H.strassen(a, b) == a @ b).all()
    monkeypatch.setattr(H, "LEAF", 4)
    assert (H.strassen(a, b) == a @ b).all()


def test_strassen_goes_deep(monkeypatch):
    leaves = []
    leaf = H._leaf
    monkeypatch.setattr(H, "_leaf", lambda a, b: leaves.append(a.shape) or leaf(a, b))
    H.strassen(np.ones((128, 128), dtype=np.int64), np.ones((128, 128), dtype=np.int64))
    assert len(leaves) == 49 and set(leaves) == {(32, 32)}


def brute(rows, asks, positives=5, count=10):
    held = []
    for key, v, label in rows:
        if key is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            one = (key, label, tuple(math.floor(256 * x) for x in v))
            if one not in held:
                held.append(one)
    out = set()
    for key, label, v in held:
        if not asks(key):
            continue
        scored = sorted({(-sum(x * y for x, y in zip(v, w)), k, o) for k, o, w in held})
        near = sorted({(s, k) for s, k, o in scored if o == label and k != key})[:positives]
        for p, positive in near:
            found = sorted({(s, k) for s, k, o in scored if o != label and 30 * -p <= 100 * -s <= 90 * -p})
            out |= {(key, positive, r + 1, k, -p, -s) for r, (s, k) in enumerate(found[:count])}
    return out


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def rows_of(found):
    return [tuple(r[n] for n in NAMES) for r in found.collect()]


def test_embeddings(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    found = rows_of(H.hard_negatives(table, F.col("vec_id") % 10 == 0))
    assert len(found) == len(set(found)) and set(found) == brute(rows, lambda k: k % 10 == 0)


def test_many_blocks_and_tiles(spark, monkeypatch):
    """Small integers, so ties everywhere; a third of the rows copies of one; anchors in many blocks and tiles."""
    monkeypatch.setattr(H, "ANCHOR_ROWS", 7)
    monkeypatch.setattr(H, "TILE_ROWS", 3)
    rng = np.random.default_rng(9)
    rows = [(i, (rng.integers(-2, 4, 5) / 256).tolist(), int(rng.integers(0, 3))) for i in range(150)]
    rows += [(i, [3 / 256] * 5, 1) for i in range(150, 220)]
    table = spark.createDataFrame([(*r, 1, 1, "a") for r in rows], SCHEMA).repartition(5)
    found = rows_of(H.hard_negatives(table, F.col("vec_id") % 9 == 0))
    assert len(found) == len(set(found)) and set(found) == brute(rows, lambda k: k % 9 == 0)


def test_odd_rows(spark):
    """Nulls everywhere, vectors of unequal length and none, equal rows, one key with several vectors."""
    v = [0.5, 0.25, -0.5]
    rows = [
        (0, v, 1), (0, v, 1), (1, [0.4, 0.3, -0.4], 1), (1, [0.4, 0.3, -0.4], 1), (2, [0.5], 2), (3, [], 1), (4, None, 1),
        (5, [0.1, None, 0.2], 2), (6, [float("nan"), 0.1, 0.1], 2), (7, [float("inf"), 0.1, 0.1], 2), (8, v, None),
        (None, v, 1), (9, [0.2, 0.1, -0.1], 2), (9, [0.3, 0.1, -0.1], 2), (9, [0.3, 0.1, -0.1], 2), (10, [0.4, 0.2, -0.4], 2),
        (10, [0.4, 0.2, -0.4], 1),
    ]
    table = spark.createDataFrame([(*r, 1, 1, "a") for r in rows], SCHEMA)
    found = rows_of(H.hard_negatives(table, F.lit(True)))
    assert set(found) == brute(rows, lambda k: True) and found
    assert H.hard_negatives(table.limit(0), F.lit(True)).count() == 0
    assert H.hard_negatives(table, F.lit(False)).count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        H.hard_negatives(spark.createDataFrame([(0, [1e12], 1, 1, 1, "a")], SCHEMA), F.lit(True))


def test_scores_too_large_for_one_word(spark):
    """Scores of 61 bits are ranked without their place in the word."""
    rng = np.random.default_rng(11)
    rows = [(i, (rng.integers(-(1 << 29), 1 << 29, 4) / 256).tolist(), i % 2) for i in range(40)]
    found = rows_of(H.hard_negatives(spark.createDataFrame([(*r, 1, 1, "a") for r in rows], SCHEMA), F.col("vec_id") < 8))
    assert set(found) == brute(rows, lambda k: k < 8)


def test_heaps_merge():
    heaps = H.Heaps.empty(1, 3)
    heaps.merge(slice(0, 1), np.array([[5, 3, 5]]), np.array([[9, 1, 4]]))
    heaps.merge(slice(0, 1), np.array([[5, 4]]), np.array([[4, 2]]))
    assert heaps.scores.tolist() == [[5, 5, 4]] and heaps.ids.tolist() == [[4, 9, 2]]
