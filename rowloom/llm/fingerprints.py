"""Similarity digests of texts: improbable byte windows in chained Bloom filters."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.shared import map_arrow
from rowloom.llm.text import BLOCK_BYTES, blocks, mix, polynomial, utf8

#: Bytes of a window; its neighbours among which it must be the rarest; how often it must be, to be a feature.
WINDOW, NEIGHBOURS, LEAST_WINS = 64, 64, 16
#: Classes of entropy that are counted over the corpus.
CLASSES = 1024
#: Bits of a filter, bits that a feature sets in it, features after which the next filter begins.
FILTER_BITS, FEATURE_BITS, FILTER_FEATURES = 2048, 5, 160
#: Bytes of text that one task should read.
TASK_BYTES = 16 << 20
#: Positions handled in one lane of the rolling entropy, and lanes side by side.
LANE, LANES = 512, 2048

_SHARE = np.arange(WINDOW + 1) / WINDOW
#: What a byte value that occurs c times in a window adds to its entropy, in whole 2**-24 bits: sums are exact.
_TERM = np.round(np.where(_SHARE > 0, -_SHARE * np.log2(np.maximum(_SHARE, 1e-9)), 0.0) * 2**24).astype(np.int64)
_GROWN = np.append(np.diff(_TERM), 0)
_SHRUNK = np.append(0, -np.diff(_TERM))
_UNIT = int(_TERM[1]) * WINDOW // CLASSES + 1


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """For each window of consecutive bytes the class of its entropy, from 0 to CLASSES - 1.

    A window's entropy follows from the one before it by one byte that leaves and one that enters; the windows are cut
    into lanes that roll side by side.
    """
    windows = len(data) - WINDOW + 1
    out = np.empty(max(windows, 0), dtype=np.int16)
    for begin in range(0, windows, LANE * LANES):
        end = min(begin + LANE * LANES, windows)
        out[begin:end] = _roll(data[begin : end + WINDOW - 1], end - begin)
    return out


def _roll(data: np.ndarray, windows: int) -> np.ndarray:
    lanes = -(-windows // LANE)
    padded = np.zeros(lanes * LANE + WINDOW, dtype=np.uint8)
    padded[: len(data)] = data
    columns = np.lib.stride_tricks.as_strided(padded, (lanes, LANE + WINDOW - 1), (LANE, 1)).T
    columns = np.ascontiguousarray(columns).astype(np.intp) + np.arange(lanes) * 256
    counts = np.zeros(lanes * 256, dtype=np.uint8)
    total = np.zeros(lanes, dtype=np.int64)
    out = np.empty((LANE, lanes), dtype=np.int64)
    for k, at in enumerate(columns):
        if k >= WINDOW:
            left = columns[k - WINDOW]
            held = counts[left]
            total += _SHRUNK[held]
            counts[left] = held - 1
        held = counts[at]
        total += _GROWN[held]
        counts[at] = held + 1
        if k >= WINDOW - 1:
            out[k - WINDOW + 1] = total
    return (out.T.ravel()[:windows] // _UNIT).astype(np.int16)


def _classes_of(parts: list[bytes]) -> list[np.ndarray]:
    """The entropy classes of the windows of each byte string, all rolled in one go."""
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    found, out, at = entropy_classes(data), [], 0
    for part in parts:
        out.append(found[at : at + max(len(part) - WINDOW + 1, 0)])
        at += len(part)
    return out


def features(data: np.ndarray, classes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows chosen from a text's bytes, in their order, each at its first place only.

    `ranks` orders entropy classes from the rarest on. Of every NEIGHBOURS consecutive windows the rarest (the first
    among equals) wins; windows that win LEAST_WINS times are
    features, or else the most frequent winners. A shorter text is one window, an empty one none.
    """
    if len(data) < WINDOW:
        return polynomial(data, *np.array([[0], [len(data)]])) if len(data) else np.zeros(0, dtype=np.uint64)
    rank = ranks[classes]
    n = len(rank)
    key = (rank << 40) | np.arange(n)
    span = min(NEIGHBOURS, n)
    reach, lowest = 1, key
    while reach * 2 <= span:
        lowest = np.minimum(lowest[: len(lowest) - reach], lowest[reach:])
        reach *= 2
    if reach < span:
        lowest = np.minimum(lowest[: len(lowest) - (span - reach)], lowest[span - reach :])
    winners, wins = np.unique(lowest & ((1 << 40) - 1), return_counts=True)
    chosen = winners[wins >= min(LEAST_WINS, wins.max())]
    hashes = polynomial(data, chosen, chosen + WINDOW)
    _, first = np.unique(hashes, return_index=True)
    return hashes[np.sort(first)]


def filters(hashes: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters, a row of bytes each, that hold the features in order."""
    chain = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((chain, FILTER_BITS), dtype=bool)
    row = np.arange(len(hashes)) // FILTER_FEATURES
    for k in range(FEATURE_BITS):
        bits[row, ((hashes >> np.uint64(11 * k)) % np.uint64(FILTER_BITS)).astype(np.int64)] = True
    return np.packbits(bits, axis=1)


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """How much of the shorter chain of filters the other one holds, from 0 to 1.

    Two filters' common bits are counted from what chance gives (0) to all bits of the emptier one (1). Each filter of
    the shorter chain takes its best partner, and the mean of these counts. Two empty chains are alike.
    """
    if not len(left) or not len(right):
        return float(len(left) == len(right))
    if len(left) > len(right):
        left, right = right, left
    if np.array_equal(left, right):
        return 1.0
    a, b = (np.unpackbits(x, axis=1).astype(np.float32) for x in (left, right))
    size_b = b.sum(axis=1)
    best = []
    for row in a:
        size, common = row.sum(), b @ row
        most, chance = np.minimum(size, size_b), size * size_b / FILTER_BITS
        best.append(np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0).max())
    return float(np.mean(best, dtype=np.float64))


def as_string(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def _with_edits(texts: list[str], ranks: np.ndarray) -> Iterator[tuple]:
    """(n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of all texts but the last.

    Each one's following document is the next in the list. Windows of an edited text that lie in one of its two parts
    have the classes that they have in the part's document; only those across the seam are rolled anew.
    """
    raw = [t.encode() for t in texts]
    classes = _classes_of(raw)
    heads, tails, seams = [], [], []
    for text, following in zip(texts[:-1], texts[1:], strict=True):
        half = len(text) // 2
        heads.append(text[: len(text) - half].encode())
        tails.append(following[:half].encode())
        seams.append(heads[-1][-(WINDOW - 1) :] + tails[-1][: WINDOW - 1])
    across = _classes_of(seams)

    def chain(data: bytes, of: np.ndarray) -> np.ndarray:
        return filters(features(np.frombuffer(data, dtype=np.uint8), of, ranks))

    own = [chain(data, of) for data, of in zip(raw, classes, strict=True)]
    for k, (head, tail) in enumerate(zip(heads, tails, strict=True)):
        data = head + tail
        parts = [classes[k][: max(len(head) - WINDOW + 1, 0)], across[k], classes[k + 1][: max(len(tail) - WINDOW + 1, 0)]]
        changed = own[k] if data == raw[k] else chain(data, np.concatenate(parts))
        yield (
            len(texts[k]),
            hashlib.sha256(data).hexdigest(),
            as_string(own[k]),
            as_string(changed),
            likeness(own[k], changed),
            likeness(own[k], own[k + 1]),
        )


def entropy_ranks(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Rank of each entropy class by how few of the corpus's windows have it (ties: the lower class first); its bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = np.zeros(CLASSES, dtype=np.int64), 0
        for batch in batches:
            data, starts = utf8(batch.column(0))
            size += len(data)
            for a, b in blocks(starts):
                part = data[starts[a] : starts[b]]
                inside = np.ones(max(len(part) - WINDOW + 1, 0), dtype=np.int16)
                for end in (starts[a + 1 : b] - starts[a]).tolist():
                    inside[max(end - WINDOW + 1, 0) : end] = 0
                counts += np.bincount(entropy_classes(part)[inside > 0], minlength=CLASSES)
        columns = [pa.array(np.arange(-1, CLASSES, dtype=np.int32)), pa.array(np.append(size, counts))]
        yield pa.RecordBatch.from_arrays(columns, names=["class", "n"])

    found = map_arrow(docs.select(text), work, "class int, n bigint").groupBy("class").agg(F.sum("n").alias("n"))
    counts, size = np.zeros(CLASSES, dtype=np.int64), 0
    for r in found.collect():
        if r["class"] < 0:
            size = r["n"]
        else:
            counts[r["class"]] = r["n"]
    ranks = np.empty(CLASSES, dtype=np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(CLASSES)
    return ranks, size


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row.

    The following document is the next one by key (null keys first, ties by text), and the first one follows the last.
    Rows are cut into ranges of keys, each of which also gets the first row of the next range; so texts are shuffled
    once, sorted only inside a range, and no range holds more than its share however often a key or text repeats
    (equal keys share a range). What reaches the driver is the histogram of entropies and the range borders, as many
    as there are tasks.

    Null texts are empty. Texts shorter than a window are one feature, empty ones none. A single row follows itself.
    Rows that repeat are fingerprinted each. Other columns are not read. An empty table gives an empty result.
    """
    given = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranks, size = entropy_ranks(given)
    tasks = max(1, -(-size // TASK_BYTES))
    cuts = given.where("key IS NOT NULL").approxQuantile("key", [k / (2 * tasks) for k in range(1, 2 * tasks)], 0.1 / tasks)
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="place", outputCol="range", handleInvalid="keep")
    placed = bucketizer.transform(given.withColumn("place", F.coalesce(F.col("key").cast("double"), F.lit(splits[0]))))
    placed = placed.select(F.col("range").cast("int").alias("range"), F.lit(0).alias("lent"), "key", "text")
    firsts = placed.groupBy("range").agg(F.min(F.struct("key", "text")).alias("first"))
    ranges = sorted(r["range"] for r in placed.select("range").distinct().collect())
    before = dict(zip(ranges, ranges[-1:] + ranges[:-1], strict=True))
    lender = docs.sparkSession.createDataFrame(list(before.items()), "range int, borrower int")
    lent = firsts.join(F.broadcast(lender), "range").select("borrower", F.lit(1), "first.key", "first.text")
    rows = placed.union(lent).repartition(tasks, "range").sortWithinPartitions("range", "lent", "key", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        texts: list[str] = []
        held = 0
        for batch in batches:
            for lent, k, t in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                keys.append(k)
                texts.append(t)
                held += len(t)
                if lent or held >= BLOCK_BYTES:
                    if len(texts) > 1:
                        yield _result(keys[:-1], list(_with_edits(texts, ranks)))
                    keys, texts, held = ([], [], 0) if lent else (keys[-1:], texts[-1:], len(t))

    def _result(keys: list, found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), _TYPES, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *columns], names=["key", *_NAMES])

    return map_arrow(rows, work, _SCHEMA).withColumnRenamed("key", key)


_NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_SCHEMA = (
    "key bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
