"""Ordinal regression on hashed text: one weight vector shared by all grades, ordered thresholds between them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.shared import map_arrow, store
from rowloom.llm.text import blocks, mix, polynomial, utf8

#: Hashed features, labelled rows that a fit reads at most, documents of those that a feature must occur in.
DIMENSIONS, SAMPLE_ROWS, LEAST_DOCUMENTS = 1 << 18, 10_000, 6
#: Weight of the squared norm of the weights in the fit, and its steps.
RIDGE, STEPS = 0.3, 60
#: A feature takes part if the grades of the texts that have it differ by so many standard errors from the rest's.
LEAST_DEVIATION = 3.0

Features = Callable[[np.ndarray, np.ndarray], Iterator[np.ndarray]]

_KIND = np.zeros(256, dtype=np.uint8)  # 0: no letter or digit
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 3, 2, 1, 1
_STYLE = np.arange(256, dtype=np.uint8)  # signs stand for themselves
_STYLE[48:58], _STYLE[65:91], _STYLE[97:123], _STYLE[128:] = 48, 65, 97, 97
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of a word's beginning that are features beside the word.
PREFIXES = (4, 5, 6, 7)


def _lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case."""
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    after = np.zeros(len(data), dtype=bool)
    after[1:] = data[:-1] == 0xC3
    low[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    return low


def _runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last (exclusive) positions of the runs of True that texts hold, and each text's first run."""
    n = len(inside)
    cut = np.ones(n + 1, dtype=bool)
    cut[1:] = ~inside
    cut[starts] = True
    first = np.flatnonzero(inside & cut[:-1])
    closed = np.ones(n + 1, dtype=bool)
    closed[:-1] = ~inside
    closed[starts] = True
    return first, np.flatnonzero(inside & closed[1:]) + 1, np.searchsorted(first, starts)


def _hashed(values: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(values + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(DIMENSIONS)


def word_features(data: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """Which words and word beginnings each text has."""
    low = _lowered(data)
    first, last, bounds = _runs(_KIND[data] > 0, starts)
    found = [_hashed(polynomial(low, first, last), 1)]
    found += [_hashed(polynomial(low, first, np.minimum(first + size, last)), size) for size in PREFIXES]
    every = np.stack(found, axis=1).astype(np.int32)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield np.unique(every[a:b])


def style_features(data: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """How each text is written: the shares of word shapes, of repeated words and of word lengths, in steps.

    A word's shape is the order of small letters, capitals, digits and signs in it.
    """
    low, style = _lowered(data), _STYLE[data]
    first, last, bounds = _runs(~_BLANK[data], starts)
    words = polynomial(low, first, last)
    change = np.ones(len(data) + 1, dtype=bool)
    change[1:-1] = style[1:] != style[:-1]
    change[first] = True
    place = np.concatenate([[0], np.cumsum(change[:-1])])
    shapes = polynomial(style[change[:-1]], place[first], np.maximum(place[last], place[first] + 1))
    lengths = last - first
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if a == b:
            yield np.zeros(1, dtype=np.int32)
            continue
        n = b - a
        kinds, count = np.unique(shapes[a:b], return_counts=True)
        share = np.floor(-np.log2(count / n)).clip(0, 12).astype(np.uint64)
        distinct = np.unique(words[a:b])
        whole = [
            np.uint64(int(10 * len(distinct) / n)),
            np.uint64(100 + min(int(lengths[a:b].mean()), 40)),
            np.uint64(200 + int(np.log2(n))),
            np.uint64(300 + int(-np.log2(count.max() / n))),
        ]
        with np.errstate(over="ignore"):
            found = [
                _hashed(kinds * np.uint64(31) + share, 11),
                _hashed(np.array(whole, dtype=np.uint64), 12),
            ]
        yield np.unique(np.concatenate(found)).astype(np.int32)


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade >= k) = 1 / (1 + exp(thresholds[k - 1] - sum of the weights of a text's features))."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.weights[features].sum() - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _loss(
    point: np.ndarray, rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, grade_count: int
) -> tuple[float, np.ndarray]:
    """Penalised negative log likelihood and its gradient. The thresholds are the first one and logs of their steps."""
    steps = grade_count - 1
    weights, free = point[:-steps], point[-steps:]
    thresholds = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
    score = np.bincount(rows, weights=weights[columns], minlength=len(grades))
    edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
    # P(grade) = tail at its lower edge minus tail at its upper edge
    lower, upper = score - edges[grades], score - edges[grades + 1]
    above, beyond = _sigmoid(lower), _sigmoid(upper)
    chance = np.maximum(above - beyond, 1e-12)
    slope_low, slope_high = above * (1 - above), beyond * (1 - beyond)
    by_score = -(slope_low - slope_high) / chance
    by_edge = np.bincount(grades, weights=slope_low / chance, minlength=grade_count + 1)
    by_edge[1:] -= np.bincount(grades + 1, weights=slope_high / chance, minlength=grade_count + 1)[1:]
    by_threshold = by_edge[1:grade_count]
    by_free = np.concatenate([[by_threshold.sum()], np.cumsum(by_threshold[::-1])[::-1][1:] * np.exp(free[1:])])
    by_weight = np.bincount(columns, weights=by_score[rows], minlength=len(weights)) + 2 * RIDGE * weights
    return -np.log(chance).sum() + RIDGE * weights @ weights, np.concatenate([by_weight, by_free])


def _minimise(loss: Callable, point: np.ndarray) -> np.ndarray:
    """L-BFGS with ten pairs and halved steps."""
    value, slope = loss(point)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        way, kept = slope.copy(), []
        for s, y in reversed(pairs):
            a = (s @ way) / (s @ y)
            kept.append(a)
            way -= a * y
        way *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(np.abs(slope).max(), 1)
        for (s, y), a in zip(pairs, reversed(kept), strict=True):
            way += (a - (y @ way) / (s @ y)) * s
        size, fall = 1.0, way @ slope
        for _ in range(30):
            tried = point - size * way
            new, new_slope = loss(tried)
            if new <= value - 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        if (tried - point) @ (new_slope - slope) > 1e-12:
            pairs = [*pairs[-9:], (tried - point, new_slope - slope)]
        done = value - new < 1e-6 * max(abs(value), 1)
        point, value, slope = tried, new, new_slope
        if done:
            break
    return point


def fit(features: list[np.ndarray], grades: np.ndarray) -> OrdinalModel:
    """The model of texts' features and grades 0, 1, ...; without rows, or with one grade only, it has no opinion.

    Rows are one text each. Grades that no row has between others get a narrow band of their own.
    """
    grade_count = max(int(grades.max()) + 1 if len(grades) else 1, 2)
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    columns = np.concatenate(features) if features else np.zeros(0, dtype=np.int32)
    held = np.bincount(columns, minlength=DIMENSIONS)
    excess = grades - (grades.mean() if len(grades) else 0.0)
    drawn = np.bincount(columns, weights=excess[rows], minlength=DIMENSIONS)
    deviation = np.abs(drawn) / np.sqrt(np.maximum(held * (excess @ excess) / max(len(grades), 1), 1e-12))
    used = np.flatnonzero((held >= min(LEAST_DOCUMENTS, max(len(features) // 4, 1))) & (deviation >= LEAST_DEVIATION))
    keep = np.isin(columns, used)
    rows, columns = rows[keep], np.searchsorted(used, columns[keep])
    share = np.array([(grades >= k).mean() if len(grades) else 0.5 for k in range(1, grade_count)])
    share = np.clip(share, 1e-3, 1 - 1e-3)
    first = -np.log(share / (1 - share))
    start = np.concatenate([np.zeros(len(used)), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    found = _minimise(lambda p: _loss(p, rows, columns, grades, grade_count), start)
    weights = np.zeros(DIMENSIONS)
    weights[used] = found[: len(used)]
    free = found[len(used) :]
    return OrdinalModel(weights, np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))]))


def _batches(column: pa.Array, features: Features) -> Iterator[np.ndarray]:
    data, starts = utf8(column)
    for a, b in blocks(starts):
        yield from features(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])


def fit_on(
    docs: DataFrame,
    labels: DataFrame,
    grade: Column,
    features: Features,
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> OrdinalModel:
    """A model fitted on at most `sample_rows` labelled documents, those whose keys hash lowest.

    `grade` is an expression on labels. A key with several labels counts with its highest grade; labels with a null
    key or grade, and those without a document, are ignored before the sample is taken. Rows that repeat a key are one
    document, the one with the smallest text. Documents are counted by feature on the executors; what reaches the
    driver are the sample's features of those that set grades apart.
    """
    graded = labels.select(F.col(key).alias("key"), grade.cast("int").alias("grade")).where("key IS NOT NULL AND grade >= 0")
    graded = graded.groupBy("key").agg(F.max("grade").alias("grade"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    present = graded.join(texts.select("key"), "key", "left_semi")
    sample = present.orderBy(F.xxhash64("key"), "key").limit(sample_rows)
    labelled = texts.join(F.broadcast(sample), "key").groupBy("key", "grade").agg(F.min("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_batches(batch.column(2), features))
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "grade", "features"])

    kind = labelled.schema["key"].dataType.simpleString()
    given = store(map_arrow(labelled, work, f"key {kind}, grade int, features array<int>"), "features")
    telling = _telling(given)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [f[telling[f]] for f in (x.values.to_numpy() for x in batch.column(2))]
            columns = [batch.column(0), batch.column(1), pa.array(kept, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "grade", "features"])

    table = map_arrow(given, narrow, f"key {kind}, grade int, features array<int>").orderBy("key").toArrow()
    rows = table["features"].combine_chunks()
    flat, cuts = rows.values.to_numpy(), rows.offsets.to_numpy()
    return fit([flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], table["grade"].to_numpy().astype(np.int64))


def _telling(given: DataFrame) -> np.ndarray:
    """Which features fit() would use, by their counts over the sample: a flag for each."""
    n, mean, spread = given.agg(F.count("*"), F.avg("grade"), F.var_pop("grade")).first()
    held = given.select("grade", F.explode("features").alias("f")).groupBy("f").agg(
        F.count("*").alias("held"), F.sum("grade").alias("drawn")
    )
    least = min(LEAST_DOCUMENTS, max(n // 4, 1))
    apart = F.abs(F.col("drawn") - F.col("held") * F.lit(mean or 0.0))
    # a little less than fit() asks for, which decides by its own sums
    enough = apart >= F.lit(LEAST_DEVIATION * (1 - 1e-6)) * F.sqrt(F.greatest(F.col("held") * F.lit(spread or 0.0), F.lit(1e-12)))
    out = np.zeros(DIMENSIONS, dtype=bool)
    out[[r["f"] for r in held.where((F.col("held") >= least) & enough).select("f").collect()]] = True
    return out


def grade_texts(docs: DataFrame, model: OrdinalModel, features: Features, text: str = "text") -> DataFrame:
    """docs with `expected_grade` and `tails` (P(grade >= k) for k = 1, 2, ...) behind its columns.

    Null and empty texts are graded as texts without words. Rows that repeat are graded each, and a column of docs
    that bears one of the two names is replaced.
    """
    rest = [c for c in docs.columns if c not in ("expected_grade", "tails")]
    given = docs.select(*[F.col(f"`{c}`") for c in rest])
    at = rest.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = [model.tails(f) for f in _batches(batch.column(at), features)]
            columns = [
                *batch.columns,
                pa.array([float(t.sum()) for t in tails], pa.float64()),
                pa.array([t.tolist() for t in tails], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "expected_grade", "tails"])

    schema = given.limit(0).select("*", F.lit(0.0).alias("expected_grade"), F.array(F.lit(0.0)).alias("tails")).schema
    return map_arrow(given, work, schema)
