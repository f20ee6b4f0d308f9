"""Hard negatives by exact inner products: Strassen products of integer tiles, heaps that merge."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.shared import map_arrow, shared_folder, store

#: Anchors that one pass carries to every task, and how many of them meet a tile of candidates at once.
ANCHOR_ROWS, TILE_ROWS = 4096, 512
#: Edge below which a product is not split further.
LEAF = 32
#: Whole numbers of this size and less are exact in doubles.
EXACT = 1 << 53

_NONE = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two small tiles: in doubles where its size proves that exact, else in integers."""
    if a.size and b.size:
        most = max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min())) * a.shape[1]
        if most <= EXACT:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _strassen(a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    if not depth:
        return _leaf(a, b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = _strassen(a11 + a22, b11 + b22, depth - 1)
    p2 = _strassen(a21 + a22, b11, depth - 1)
    p3 = _strassen(a11, b12 - b22, depth - 1)
    p4 = _strassen(a22, b21 - b11, depth - 1)
    p5 = _strassen(a11 + a12, b22, depth - 1)
    p6 = _strassen(a21 - a11, b11 + b12, depth - 1)
    p7 = _strassen(a12 - a22, b21 + b22, depth - 1)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


def _padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    out = np.zeros((rows, columns), dtype=np.int64)
    out[: x.shape[0], : x.shape[1]] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices by Strassen's seven products, as deep as every edge stays at LEAF or more.

    Edges are padded with zeros to multiples of two to the depth. Sums wrap modulo 2**64, so that the product is exact
    wherever its own elements fit into 64 bits.
    """
    (m, k), n = a.shape, b.shape[1]
    depth = max(0, min(m, k, n) // LEAF).bit_length() - 1
    if depth <= 0:
        return _leaf(a, b)
    step = 1 << depth
    up = [-(-x // step) * step for x in (m, k, n)]
    return _strassen(_padded(a, up[0], up[1]), _padded(b, up[1], up[2]), depth)[:m, :n]


@dataclass
class Heaps:
    """For each of many slots, the `count` best (score, id): higher scores first, ties by smaller id, no entry twice."""

    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def empty(cls, *shape: int) -> Heaps:
        return cls(np.full(shape, _NONE), np.full(shape, _LAST))

    def merge(self, at: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merges other heaps into the slots `at`."""
        count = self.scores.shape[-1]
        scores, ids = np.concatenate([self.scores[at], scores], axis=-1), np.concatenate([self.ids[at], ids], axis=-1)
        for _ in range(2):  # entries that stood twice sink to the end in the second round
            order = np.lexsort((ids, ~scores), axis=-1)
            scores, ids = np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)
            again = (scores[..., 1:] == scores[..., :-1]) & (ids[..., 1:] == ids[..., :-1])
            if not (again & (scores[..., 1:] != _NONE)).any():
                break
            scores[..., 1:][again] = _NONE
            ids[..., 1:][again] = _LAST
        self.scores[at], self.ids[at] = scores[..., :count], ids[..., :count]


class Ranked:
    """The scores of one tile, each row's in descending order, ties by smaller id; `ids` ascend."""

    def __init__(self, scores: np.ndarray, taking_part: np.ndarray, ids: np.ndarray, most: int) -> None:
        self.ids, self.most, width = ids, most, 1 << max(1, len(ids) - 1).bit_length()
        self.width = width if (most + 1) * width < 1 << 62 else 0
        if self.width:  # score and place in one word: higher words come first
            self.words = np.where(taking_part, scores * width + (width - 1 - np.arange(len(ids))), _NONE)
            self.words.sort(axis=1)
        else:
            masked = np.where(taking_part, scores, _NONE)
            self.order = np.argsort(masked[:, ::-1], axis=1, kind="stable")
            self.words = np.take_along_axis(masked[:, ::-1], self.order, axis=1)

    def below(self, highest: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row and each of its bounds, the first `count` scores at or below the bound, and their ids."""
        bound = np.clip(highest, -self.most - 1, self.most)
        if self.width:
            bound = bound * self.width + (self.width - 1)
        ends = np.stack([np.searchsorted(w, x, side="right") for w, x in zip(self.words, bound, strict=True)])
        at = ends[..., None] - 1 - np.arange(count)
        rows = np.arange(len(ends))[:, None, None]
        words = np.where(at >= 0, self.words[rows, np.maximum(at, 0)], _NONE)
        good = words != _NONE
        if self.width:
            scores, place = words // self.width, self.width - 1 - words % self.width
        else:
            scores, place = words, len(self.ids) - 1 - self.order[rows, np.maximum(at, 0)]
        return np.where(good, scores, _NONE), np.where(good, self.ids[np.where(good, place, 0)], _LAST)


def _tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids in ascending order, labels and vectors (a column each, padded with zeros) of the rows; equal rows once."""
    for batch in batches:
        if not len(batch):
            continue
        ids, labels, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), width)
        one = np.argsort(ids, kind="stable")
        if (ids[one[1:]] == ids[one[:-1]]).any():
            _, one = np.unique(np.column_stack([ids, labels, vectors]), axis=0, return_index=True)
            one = one[np.lexsort((one, ids[one]))]
        yield ids[one], labels[one], np.ascontiguousarray(vectors[one].T)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of `width` integers, shorter vectors padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector.cast("array<double>"), finite)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    count: int = 10,
    window: tuple[int, int] = (30, 90),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every row where `anchors` holds.

    Components become floor(scale * x); a score is the integer inner product with the anchor, higher ones first, ties
    by smaller key. An anchor's positives are its first `positives` other keys of the same label. For each, the first
    `count` rows of other labels come whose score is from window[0] to window[1] percent of the positive's.

    Anchors are taken in blocks of about ANCHOR_ROWS by hash. Each block goes to every task twice, once for its
    positives and once for its windows; candidates stay where they are stored and stream past it in tiles. A task
    returns its heaps, at most `count` rows a window, and those of all tasks are merged by a window function.

    Rows with a null key, label, vector or component, or one that is not finite, take no part. Shorter vectors are
    padded with zeros. Equal rows, and rows of one key with equal scores, count once; rows that share a key with
    different labels or vectors are rows of their own, and such an anchor has the results of each. Scores that could
    leave 64 bits are an error. Other columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    whole = F.transform(F.col("given").cast("array<double>"), lambda x: F.floor(F.lit(scale) * x))
    given = vectors.withColumn("_anchor", anchors).select(
        F.col(key).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(vector).alias("given"),
        F.coalesce("_anchor", F.lit(False)).alias("anchor"),
    )
    given = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("given")))
    given = store(given.select("id", "label", whole.alias("v"), "anchor"), "integers")
    sizes = given.agg(F.max(F.size("v")), F.max(F.array_max("v")), F.min(F.array_min("v")), F.count_if("anchor")).first()
    width, most = sizes[0] or 0, max(sizes[1] or 0, -(sizes[2] or 0))
    if most * most * width >= 1 << 62:
        raise ValueError(f"scores of vectors of {width} components up to {most} may leave 64 bits")
    blocks = max(1, -(-sizes[3] // ANCHOR_ROWS))
    path = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
    place = F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks))
    for block in range(blocks):
        asked = given.where(F.col("anchor") & (place == block)).select("id", "label", "v").distinct()
        found = _mined(given, asked.toArrow(), block, width, most * most * width, positives, count, window)
        found.write.mode("append").parquet(path)
    return spark.read.schema(_RESULT).parquet(path)


_RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _best(found: DataFrame, slot: list[str], count: int) -> DataFrame:
    """The first `count` of each slot's merged heaps, with their rank."""
    order = Window.partitionBy(*slot).orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _mined(
    given: DataFrame, asked: pa.Table, block: int, width: int, most: int, positives: int, count: int, window: tuple[int, int]
) -> DataFrame:
    """The result for one block of anchors."""
    ids, labels = asked["id"].to_numpy(), asked["label"].to_numpy()
    vectors = _matrix(asked["v"].combine_chunks(), width)
    parts = [slice(a, min(a + TILE_ROWS, len(ids))) for a in range(0, len(ids), TILE_ROWS)]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps.empty(len(ids), positives)
        for own, kind, columns in _tiles(batches, width):
            for at in parts:
                same = (labels[at, None] == kind) & (ids[at, None] != own)
                ranked = Ranked(strassen(vectors[at], columns), same, own, most)
                scores, found = ranked.below(np.full((len(same), 1), most), positives)
                heaps.merge(at, scores[:, 0], found[:, 0])
        anchor, slot = np.nonzero(heaps.scores != _NONE)
        columns = [anchor, heaps.scores[anchor, slot], heaps.ids[anchor, slot]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "score", "id"])

    rows = map_arrow(given.select("id", "label", "v"), near, "anchor bigint, score bigint, id bigint")
    held = _best(rows, ["anchor"], positives).select("anchor", "rank", "score", "id").toArrow()
    positive = Heaps.empty(len(ids), positives)
    at = held["anchor"].to_numpy(), held["rank"].to_numpy() - 1
    positive.scores[at], positive.ids[at] = held["score"].to_numpy(), held["id"].to_numpy()
    low, high = np.full(positive.scores.shape, _LAST), np.full(positive.scores.shape, _NONE)
    for a, slot in zip(*at, strict=True):
        score = int(positive.scores[a, slot])
        low[a, slot], high[a, slot] = -(-window[0] * score // 100), window[1] * score // 100

    def hard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps.empty(len(ids), positives, count)
        for own, kind, columns in _tiles(batches, width):
            for at in parts:
                ranked = Ranked(strassen(vectors[at], columns), labels[at, None] != kind, own, most)
                scores, found = ranked.below(high[at], count)
                out = scores < low[at, :, None]
                heaps.merge(at, np.where(out, _NONE, scores), np.where(out, _LAST, found))
        anchor, slot, place = np.nonzero(heaps.scores != _NONE)
        where = anchor, slot, place
        columns = [
            anchor, ids[anchor], positive.ids[anchor, slot], positive.scores[anchor, slot], heaps.scores[where], heaps.ids[where]
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["anchor", "anchor_id", "positive_id", "positive_score", "score", "id"]
    rows = map_arrow(given.select("id", "label", "v"), hard, ", ".join(f"{n} bigint" for n in names))
    best = _best(rows, ["anchor", "positive_id", "positive_score"], count)
    return best.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def hard_negatives_sql() -> str:
    """DuckDB SQL for the registered query's rows."""
    return """
WITH given AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, a.label AS own, b.id AS id, b.label AS label,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM given a JOIN given b ON a.id % 100 = 0 AND a.id <> b.id),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""
