"""Approximate nearest neighbours by stable projections, kd-trees over them and a chi-square stopping test."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.shared import map_arrow, store

#: Dimensions of the projection (an even number), and the chance with which a neighbour must lie within its reach.
PROJECTED, SURE = 8, 0.99
#: Vectors of the sample that places the shards, of one shard, and of one leaf of a shard's own tree.
SAMPLE_ROWS, SHARD_ROWS, LEAF_ROWS = 4096, 8192, 64


def usable(vector: Column) -> Column:
    """Whether a vector is neither null nor zero and has finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def reach(sure: float = SURE, dimensions: int = PROJECTED) -> float:
    """The value that a chi-square variable of an even number of degrees stays under with probability `sure`."""

    def beyond(x: float) -> float:
        term = total = 1.0
        for i in range(1, dimensions // 2):
            term *= x / 2 / i
            total += term
        return exp(-x / 2) * total

    low, high = 0.0, 1.0
    while beyond(high) > 1 - sure:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if beyond(middle) > 1 - sure else (low, middle)
    return high


def projection(dimensions: int, seed: int = 20240504) -> np.ndarray:
    """Standard normal directions: the squared length of a projected difference is chi-square times the true one."""
    return np.random.default_rng(seed).standard_normal((dimensions, PROJECTED))


def rounding(point: np.ndarray) -> float:
    """What rounding may add to the squared distance of equal projections."""
    return 1e-18 + 1e-12 * float(point @ point)


@dataclass(frozen=True)
class Regions:
    """The leaves of a kd-tree over projected points, as boxes that cover the whole space."""

    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def of(points: np.ndarray, leaves: int) -> Regions:
        """Halves the points at medians of their widest coordinate until there are `leaves` boxes or no more halves."""
        boxes = [(points, np.full(PROJECTED, -np.inf), np.full(PROJECTED, np.inf))]
        while len(boxes) < leaves:
            k = max(range(len(boxes)), key=lambda i: len(boxes[i][0]))
            held, low, high = boxes[k]
            cut = None
            for axis in np.argsort(-np.ptp(held, axis=0)) if len(held) > 1 else ():
                middle = np.median(held[:, axis])
                if held[:, axis].min() < middle:
                    cut = axis
                    break
            if cut is None:
                break
            below = held[:, cut] < middle
            upper, lower = high.copy(), low.copy()
            upper[cut] = lower[cut] = middle
            boxes[k : k + 1] = [(held[below], low, upper), (held[~below], lower, high)]
        return Regions(np.array([b[1] for b in boxes]), np.array([b[2] for b in boxes]))

    def place(self, points: np.ndarray) -> np.ndarray:
        """The box of each point."""
        out = np.zeros(len(points), dtype=np.int32)
        for k, (low, high) in enumerate(zip(self.low, self.high, strict=True)):
            out[((points >= low) & (points < high)).all(axis=1)] = k
        return out

    def squared_distance(self, point: np.ndarray) -> np.ndarray:
        """From a point to each box."""
        return (np.maximum(np.maximum(self.low - point, point - self.high), 0.0) ** 2).sum(axis=1)


class Index:
    """One shard: its vectors by the leaves of a kd-tree over their projections, with each leaf's bounding box."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, directions: np.ndarray) -> None:
        projected = vectors @ directions
        parts, waiting = [], [np.arange(len(ids))]
        while waiting:
            rows = waiting.pop()
            if len(rows) <= LEAF_ROWS:
                parts.append(rows)
                continue
            axis = np.ptp(projected[rows], axis=0).argmax()
            order = rows[np.argpartition(projected[rows, axis], len(rows) // 2)]
            waiting += [order[len(rows) // 2 :], order[: len(rows) // 2]]
        self.ids, self.vectors, self.projected, self.parts = ids, vectors, projected, parts
        self.boxes = Regions(
            np.array([projected[p].min(axis=0) for p in parts]), np.array([projected[p].max(axis=0) for p in parts])
        )

    def nearest(self, own: int, vector: np.ndarray, point: np.ndarray, count: int, bound: float, far: float):
        """ids and distances of the nearest found, never the row with the query's own id.

        Leaves come in the order of their boxes' distance to the projected query. Their points are verified on the
        vectors, until the next box is so far that, were it to hold a point nearer than the worst kept, the square of
        projected by true distance would exceed what a chi-square variable stays under with the stated probability.
        """
        best, ids = np.zeros(0), np.zeros(0, dtype=np.int64)
        edge = self.boxes.squared_distance(point)
        slack = rounding(point)
        for leaf in np.argsort(edge, kind="stable"):
            limit = far * bound * bound + slack
            if edge[leaf] > limit:
                break
            rows = self.parts[leaf]
            rows = rows[self.ids[rows] != own]
            rows = rows[((self.projected[rows] - point) ** 2).sum(axis=1) <= limit]
            if not len(rows):
                continue
            distance = np.sqrt(((self.vectors[rows] - vector) ** 2).sum(axis=1))
            best, ids = np.concatenate([best, distance]), np.concatenate([ids, self.ids[rows]])
            order = np.lexsort((ids, best))[:count]
            best, ids = best[order], ids[order]
            if len(best) == count:
                bound = min(bound, best[-1])
        return ids, best


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def nearest_neighbours(
    vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", count: int = 10
) -> DataFrame:
    """query_id, rank, <key>, score: the nearest found of every row where `queries` holds, among all other rows.

    Score is the Euclidean distance of the vectors themselves, ties go to smaller keys; all candidates come if there
    are fewer than `count`. A sample of SAMPLE_ROWS vectors (those whose keys hash lowest) places the regions of a
    kd-tree over PROJECTED normal projections; all vectors are dealt to them, and a region with more than SHARD_ROWS
    vectors is split by hash, however many of them are equal. A query goes to the shards of the regions that its test
    cannot rule out, given the `count`-th distance in the sample, so it is copied at most once a shard. Shards hold
    bounded rows, queries stream through them, and each shard returns at most `count` rows a query.

    Rows whose vector is null, zero, or has null or non-finite components take no part, nor do rows with a null key
    and vectors of other than the most frequent length (ties: the longer). Rows that repeat a key count once, with
    the smallest vector. Other columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    given = vectors.withColumn("_query", queries).select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vec"), F.coalesce("_query", F.lit(False)).alias("asks")
    )
    given = given.where(F.col("id").isNotNull() & usable(F.col("vec")))
    sizes = given.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dimensions = sizes["n"] if sizes else 1
    given = given.where(F.size("vec") == dimensions).groupBy("id").agg(F.min("vec").alias("vec"), F.max("asks").alias("asks"))
    given = store(given, "vectors")
    sample = given.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("id", "vec").toArrow()
    sample_ids = sample["id"].to_numpy()
    points = _matrix(sample["vec"].combine_chunks()).reshape(len(sample_ids), dimensions)
    directions, far = projection(dimensions), reach()
    rows = given.count()
    regions = Regions.of(points @ directions, max(1, min(-(-rows // SHARD_ROWS), SAMPLE_ROWS // 16)))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = regions.place(_matrix(batch.column(1)) @ directions) if len(batch) else np.zeros(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int32()), *batch.columns], names=["region", "id", "vec", "asks"]
            )

    kind = given.schema["vec"].dataType.simpleString()
    dealt = store(map_arrow(given, placed, f"region int, id bigint, vec {kind}, asks boolean"), "placed")
    held = {r["region"]: r["count"] for r in dealt.groupBy("region").count().collect()}
    splits = np.array([max(1, -(-held.get(k, 0) // SHARD_ROWS)) for k in range(len(regions.low))])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each query, the regions that may hold a neighbour, with a bound of the count-th distance."""
        for batch in batches:
            ids = batch.column(0).to_numpy()
            found = []
            for own, v in zip(ids, _matrix(batch.column(1)), strict=True):
                distance = np.sqrt(((points[sample_ids != own] - v) ** 2).sum(axis=1))
                bound = np.partition(distance, count - 1)[count - 1] if len(distance) >= count else np.inf
                point = v @ directions
                near = np.flatnonzero(regions.squared_distance(point) <= far * bound * bound + rounding(point))
                found.append([{"region": int(k), "splits": int(splits[k]), "bound": float(bound)} for k in near])
            kinds = pa.list_(pa.struct([("region", pa.int32()), ("splits", pa.int32()), ("bound", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kinds)], names=["id", "vec", "to"])

    asking = dealt.where("asks").select("id", "vec")
    to = "array<struct<region:int,splits:int,bound:double>>"
    asking = map_arrow(asking, routed, f"id bigint, vec {kind}, to {to}").withColumn("to", F.explode("to"))
    asking = asking.select(
        F.col("to.region").alias("region"),
        F.explode(F.sequence(F.lit(0), F.col("to.splits") - 1)).alias("split"),
        F.lit(1).alias("asks"),
        "id",
        "vec",
        F.col("to.bound").alias("bound"),
    )
    number = spark.createDataFrame([(k, int(n)) for k, n in enumerate(splits)], "region int, splits int")
    indexed = dealt.join(F.broadcast(number), "region").select(
        "region", F.pmod(F.xxhash64("id"), "splits").cast("int").alias("split"), F.lit(0).alias("asks"), "id", "vec", F.lit(None).cast("double").alias("bound")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, index, ids, parts = None, None, [], []
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in (0, 1)], axis=1)
            asks = batch.column(2).to_numpy()
            edges = np.flatnonzero((np.diff(where, axis=0) != 0).any(axis=1) | (np.diff(asks) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(batch)], strict=True):
                part = batch.slice(a, b - a)
                if a == b:
                    continue
                if tuple(where[a]) != shard:
                    shard, index, ids, parts = tuple(where[a]), None, [], []
                own, held = part.column(3).to_numpy(), _matrix(part.column(4))
                if not asks[a]:
                    ids.append(own)
                    parts.append(held)
                    continue
                if not parts:
                    continue
                index = index or Index(np.concatenate(ids), np.concatenate(parts), directions)
                bounds = part.column(5).to_numpy()
                found = [
                    index.nearest(k, v, v @ directions, count, bound * (1 + 1e-12), far)
                    for k, v, bound in zip(own, held, bounds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own, [len(f[0]) for f in found]), pa.int64()),
                        pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                        pa.array(np.concatenate([f[1] for f in found]), pa.float64()),
                    ],
                    names=["query_id", "id", "score"],
                )

    together = indexed.union(asking).repartition(int(splits.sum()), "region", "split")
    together = together.sortWithinPartitions("region", "split", "asks", "id")
    found = map_arrow(together, search, "query_id bigint, id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
