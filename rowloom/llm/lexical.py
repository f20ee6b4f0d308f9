"""Ranked lexical search: a sharded inverted index in compressed blocks, searched by Block-Max MaxScore."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.shared import map_arrow, shared_folder, store
from rowloom.llm.text import binaries, blocks, coded, runs, utf8

#: Documents and bytes of text of a shard (one longer text is a shard by itself), postings of a block.
SHARD_ROWS, SHARD_BYTES, BLOCK = 4096, 16 << 20, 128
#: Pairs of item and term that one pass carries to every task, about.
ASKED_PAIRS = 1 << 18
#: Percent of a document's length that counts, and what a term's occurrences and a weight are scaled by.
LENGTH_SHARE, LENGTH_SCALE, SCORE_SCALE, WEIGHT_SCALE = 75, 8, 1_000_000_000, 1000

_TERM = np.zeros(256, dtype=bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: A block: its first and last document, the most occurrences and the least length in it, bytes of a gap and of a count.
_HEAD = np.dtype(
    [("first", "<i4"), ("last", "<i4"), ("most", "<i8"), ("least", "<i8"), ("gap", "u1"), ("times", "u1")]
)
_SCHEMA = "kind int, shard bigint, term binary, documents bigint, terms bigint, heads binary, data binary"
_NAMES = [part.split()[0] for part in _SCHEMA.split(", ")]
_LISTS, _DOCUMENTS = 0, 1


def term_counts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """text, term (a number) and occurrences of the distinct terms of each text, and the terms by number."""
    low = _LOWER[data]
    first, last, bounds = runs(_TERM[data], starts)
    terms, names = coded(low, first, last)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(bounds))
    pairs, times = np.unique(text * np.int64(len(names) + 1) + terms, return_counts=True)
    return pairs // (len(names) + 1), pairs % (len(names) + 1), times, names


def _ragged(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _bytes_of(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4)).astype(np.uint8)


def compress(terms: np.ndarray, documents: np.ndarray, times: np.ndarray, lengths: np.ndarray):
    """Lists of postings, sorted by term and document, in blocks: (term starts, heads, block starts, data, data starts).

    A block holds the gaps between its documents and the occurrences, each in as few bytes as its largest one needs.
    """
    opens = np.flatnonzero(np.diff(terms, prepend=-1))
    in_list = np.arange(len(terms)) - np.repeat(opens, np.diff(opens, append=len(terms)))
    begin = np.flatnonzero(in_list % BLOCK == 0)
    count = np.diff(begin, append=len(terms))
    gaps = np.diff(documents, prepend=0)
    gaps[begin] = 0
    heads = np.zeros(len(begin), dtype=_HEAD)
    if len(begin):
        heads["first"], heads["last"] = documents[begin], documents[begin + count - 1]
        heads["most"], heads["least"] = np.maximum.reduceat(times, begin), np.minimum.reduceat(lengths[documents], begin)
        heads["gap"], heads["times"] = _bytes_of(np.maximum.reduceat(gaps, begin)), _bytes_of(heads["most"])
    size = count * (heads["gap"].astype(np.int64) + heads["times"])
    at = np.concatenate([[0], np.cumsum(size)])
    data = np.empty(at[-1], dtype=np.uint8)
    for values, width, where in ((gaps, heads["gap"], at[:-1]), (times, heads["times"], at[:-1] + count * heads["gap"])):
        for w in (1, 2, 4):
            held = width == w
            each = count[held]
            source = np.repeat(begin[held], each) + _ragged(each)
            target = np.repeat(where[held], each * w) + _ragged(each * w)
            data[target] = values[source].astype(f"<u{w}").view(np.uint8)
    first_block = np.searchsorted(begin, opens)
    return opens, heads, np.append(first_block, len(begin)), data, at[np.append(first_block, len(begin))]


class _Shard:
    """Documents gathered for one shard of the index."""

    def __init__(self) -> None:
        self.ids, self.lengths, self.parts, self.terms, self.rows, self.bytes = [], [], [], {}, 0, 0

    def add(self, ids: np.ndarray, data: np.ndarray, starts: np.ndarray) -> None:
        text, term, times, names = term_counts(data, starts)
        number = [self.terms.setdefault(n, len(self.terms)) for n in names.to_pylist()]
        self.parts.append((text + self.rows, np.array(number, dtype=np.int64)[term], times))
        self.lengths.append(np.bincount(text, weights=times, minlength=len(ids)).astype(np.int64))
        self.ids.append(ids)
        self.rows, self.bytes = self.rows + len(ids), self.bytes + len(data)

    def full(self) -> bool:
        return self.rows >= SHARD_ROWS or self.bytes >= SHARD_BYTES

    def batch(self, shard: int) -> pa.RecordBatch:
        """One row for each term's list and one for the documents."""
        documents, terms, times = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        lengths, ids = np.concatenate(self.lengths), np.concatenate(self.ids)
        order = np.argsort(terms, kind="stable")
        opens, heads, cuts, data, ends = compress(terms[order], documents[order], times[order], lengths)
        n = len(opens)
        names = pa.array(list(self.terms), pa.binary())
        held = np.diff(opens, append=len(order))
        columns = [
            pa.array(np.append(np.full(n, _LISTS), _DOCUMENTS), pa.int32()),
            pa.array(np.full(n + 1, shard), pa.int64()),
            pa.concat_arrays([names, pa.nulls(1, pa.binary())]),
            pa.array(np.append(held, np.count_nonzero(lengths)), pa.int64()),
            pa.array(np.append(np.zeros(n, dtype=np.int64), lengths.sum()), pa.int64()),
            _joined(heads.view(np.uint8), cuts * _HEAD.itemsize, ids),
            _joined(data, ends, lengths),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _joined(flat: np.ndarray, cuts: np.ndarray, last: np.ndarray) -> pa.Array:
    lists = binaries(flat, cuts).cast(pa.binary())
    return pa.concat_arrays([lists, pa.array([last.astype("<i8").tobytes()], pa.binary())])


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index of a text column, as a stored table: a row for each shard's term, and one for its documents.

    A term's row has its compressed blocks and their heads; bounds follow from a head's most occurrences and least
    length whatever the corpus's statistics are, so texts are read once. Rows with a null key are left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, starts = utf8(batch.column(1))
            for a, b in blocks(starts):
                for low in range(a, b, SHARD_ROWS):
                    high = min(low + SHARD_ROWS, b)
                    shard.add(ids[low:high], data[starts[low] : starts[high]], starts[low : high + 1] - starts[low])
                    if shard.full():
                        yield shard.batch(number)
                        number, shard = number + 1, _Shard()
        if shard.rows:
            yield shard.batch(number)

    given = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    return store(map_arrow(given, work, _SCHEMA), "index", partition_by="kind")


def lengths_scaled(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """100 for a document of average length, less for shorter and more for longer ones."""
    return 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * documents) // max(terms, 1)


def impact(times: np.ndarray, scaled: np.ndarray) -> np.ndarray:
    return (SCORE_SCALE * times) // (1000 * times + LENGTH_SCALE * scaled)


class Postings:
    """One term's list in one shard; a block is decompressed when it is first opened."""

    def __init__(self, documents: int, heads: bytes, data: bytes, scaled: np.ndarray, totals: tuple[int, int]) -> None:
        self.heads, self.data, self.scaled = np.frombuffer(heads, dtype=_HEAD), np.frombuffer(data, dtype=np.uint8), scaled
        self.count = np.full(len(self.heads), BLOCK)
        self.count[-1] = documents - BLOCK * (len(self.heads) - 1)
        self.gap, self.times = self.heads["gap"].astype(np.int64), self.heads["times"].astype(np.int64)
        size = self.count * (self.gap + self.times)
        self.at = np.cumsum(size) - size
        self.first, self.last = self.heads["first"].astype(np.int64), self.heads["last"].astype(np.int64)
        self.bounds = impact(self.heads["most"], lengths_scaled(self.heads["least"], *totals))
        self.bound = int(self.bounds.max())
        self.documents = np.repeat(self.first, self.count)  # a closed block's places hold its first document
        self.impacts = np.zeros(documents, dtype=np.int64)
        self.opened = np.zeros(len(self.heads), dtype=bool)

    def _values(self, blocks_of: np.ndarray, width: np.ndarray, at: np.ndarray) -> np.ndarray:
        count = self.count[blocks_of]
        out = np.empty(count.sum(), dtype=np.int64)
        place = np.cumsum(count) - count
        for w in (1, 2, 4):
            held = width[blocks_of] == w
            if held.any():
                each = count[held]
                source = np.repeat(at[blocks_of[held]], each * w) + _ragged(each * w)
                out[np.repeat(place[held], each) + _ragged(each)] = self.data[source].view(f"<u{w}")
        return out

    def open(self, blocks_of: np.ndarray) -> None:
        """Decompresses those of the blocks that are closed."""
        todo = blocks_of[~self.opened[blocks_of]]
        if not len(todo):
            return
        count = self.count[todo]
        gaps = np.cumsum(self._values(todo, self.gap, self.at))
        begin = np.cumsum(count) - count
        documents = gaps + np.repeat(self.first[todo] - gaps[begin], count)
        times = self._values(todo, self.times, self.at + self.count * self.gap)
        to = np.repeat(todo * BLOCK, count) + _ragged(count)
        self.documents[to], self.impacts[to] = documents, impact(times, self.scaled[documents])
        self.opened[todo] = True

    def open_all(self) -> None:
        self.open(np.arange(len(self.heads)))


def search_shard(lists: list[tuple[Postings, int]], least: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents (by place in the shard) whose score is `least` (above 0) or more, and their scores.

    `lists` has the query's terms with their weights. Lists whose global bounds together stay below `least` are not
    essential: only documents of the others are candidates. Those go through the remaining lists from the highest
    bound down, and one is dropped, and its block left closed, as soon as its score so far, the maximum of its block
    and the bounds of the lists to come stay below `least`.
    """
    none = np.zeros(0, dtype=np.int64)
    lists = sorted(lists, key=lambda held: held[1] * held[0].bound)
    upto = np.cumsum([weight * postings.bound for postings, weight in lists], dtype=np.int64)
    if not len(lists) or upto[-1] < least:
        return none, none
    split = int(np.searchsorted(upto, least))
    total = np.zeros(rows, dtype=np.int64)
    for postings, weight in lists[split:]:
        postings.open_all()
        total[postings.documents] += weight * postings.impacts
    rest = int(upto[split - 1]) if split else 0
    found = np.flatnonzero((total > 0) & (total + rest >= least))
    scores = total[found]
    for k in range(split - 1, -1, -1):
        postings, weight = lists[k]
        rest = int(upto[k - 1]) if k else 0
        block = np.searchsorted(postings.first, found, side="right") - 1
        inside = (block >= 0) & (found <= postings.last[np.maximum(block, 0)])
        room = np.where(inside, weight * postings.bounds[np.maximum(block, 0)], 0)
        alive = scores + room + rest >= least
        found, scores, block, inside = found[alive], scores[alive], block[alive], inside[alive]
        postings.open(np.unique(block[inside]))
        place = np.minimum(np.searchsorted(postings.documents, found), len(postings.documents) - 1)
        hit = inside & (postings.documents[place] == found)
        scores = scores + np.where(hit, weight * postings.impacts[place], 0)
    alive = scores >= least
    return found[alive], scores[alive]


class _Heap:
    """The best (score, document) of one item so far."""

    def __init__(self, count: int) -> None:
        self.count, self.scores, self.ids, self.least = count, np.zeros(0, np.int64), np.zeros(0, np.int64), 1

    def merge(self, ids: np.ndarray, scores: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.count]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.count:
            self.least = max(1, int(self.scores[-1]))


def _asked(items: DataFrame, key: str, text: str) -> DataFrame:
    """item, term and how often the item has it: a stored table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column(1))
            for a, b in blocks(starts):
                row, term, times, names = term_counts(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                ids = batch.column(0).slice(a, b - a).take(pa.array(row))
                columns = [ids, names.cast(pa.binary()).take(pa.array(term)), pa.array(times, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "term", "times"])

    given = items.select(F.col(key).cast("bigint").alias("item"), F.col(text).alias("text")).where("item IS NOT NULL")
    found = map_arrow(given.distinct(), work, "item bigint, term binary, times bigint")
    return store(found.groupBy("item", "term").agg(F.sum("times").alias("times")), "asked")


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    count: int = 10,
) -> DataFrame:
    """<item>, rank, <key>, score: the `count` best documents for each item, by scores above 0, ties by smaller key.

    Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. A score
    sums, over the item's terms with repeats, weight * ((10**9 * tf) div (1000 * tf + 8 * m)); weight is
    floor(1000 * ln((2N + 2) / (2df + 1))), m is 25 + (75 * n * N) div L, in 64-bit integers.

    Documents are indexed once, in shards of bounded rows and bytes, and stored. Items are taken in blocks of about
    ASKED_PAIRS terms by hash. For each block, the lists of its terms go to their shards, tasks search shard after
    shard with the thresholds of the heaps so far, and the heaps of all tasks are merged by a window function.

    Null and empty texts have no terms: as documents they are not counted and not found, as items they find nothing.
    Rows with a null key take no part. Documents that repeat a key are documents of their own; items that repeat a key
    are one item with all their terms, equal rows once. Other columns are not read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    index = build_index(docs, key, text)
    of_shards = index.where(F.col("kind") == _DOCUMENTS)
    totals = tuple(of_shards.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first())
    asked = _asked(items, item, item_text)
    passes = max(1, -(-asked.count() // ASKED_PAIRS))
    path = f"{shared_folder(spark)}/ranked-{uuid.uuid4().hex}"
    for k in range(passes):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k)
        _searched(index, block, totals, count).write.mode("append").parquet(path)
    found = spark.read.schema("item bigint, rank int, id bigint, score bigint").parquet(path)
    return found.select(F.col("item").alias(item), "rank", F.col("id").alias(key), "score")


def _searched(index: DataFrame, asked: DataFrame, totals: tuple[int, int], count: int) -> DataFrame:
    """The result for one block of items."""
    terms = F.broadcast(asked.select("term").distinct())
    lists = store(index.where(F.col("kind") == _LISTS).join(terms, "term", "left_semi").select(*_NAMES), "lists")
    held = {r["term"]: r["df"] for r in lists.groupBy("term").agg(F.sum("documents").alias("df")).collect()}
    weight = {bytes(t): weight_of(df, totals[0]) for t, df in held.items()}
    wanted: dict[int, list[tuple[bytes, int]]] = {}
    for r in asked.select("item", "term", "times").collect():
        term = bytes(r["term"])
        if weight.get(term):
            wanted.setdefault(r["item"], []).append((term, weight[term] * r["times"]))
    shards = index.where(F.col("kind") == _DOCUMENTS).join(lists.select("shard").distinct(), "shard", "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {q: _Heap(count) for q in wanted}
        shard, ids, scaled, opened = None, None, None, {}

        def finish() -> None:
            for q, own in wanted.items():
                present = [(opened[t], w) for t, w in own if t in opened]
                if present:
                    at, scores = search_shard(present, heaps[q].least, len(ids))
                    heaps[q].merge(ids[at], scores)

        for batch in batches:
            columns = [batch.column(c) for c in range(5)]
            for own, term, documents, heads, data in zip(*(c.to_pylist() for c in columns), strict=True):
                if own != shard:
                    if opened:
                        finish()
                    shard, opened = own, {}
                if term is None:
                    ids, lengths = np.frombuffer(heads, dtype="<i8"), np.frombuffer(data, dtype="<i8")
                    scaled = lengths_scaled(lengths, *totals)
                else:
                    opened[term] = Postings(documents, heads, data, scaled, totals)
        if opened:
            finish()
        found = [(q, i, s) for q, heap in heaps.items() for i, s in zip(heap.ids.tolist(), heap.scores.tolist(), strict=True)]
        rows = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=["item", "id", "score"])

    together = shards.select(*_NAMES).union(lists).select("shard", "term", "documents", "heads", "data")
    together = together.repartition("shard").sortWithinPartitions("shard", F.col("term").asc_nulls_first())
    found = map_arrow(together, work, "item bigint, id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("item", F.col("rank").cast("int").alias("rank"), "id", "score")


def weight_of(holders: int, documents: int) -> int:
    """A term's weight, by how many of all documents hold it."""
    return math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * holders + 1)))


def search_sql() -> str:
    """DuckDB SQL for the registered query's rows."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH given AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, '{pattern}') AS w FROM documents),
counted AS (SELECT r, doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, w, unnest(w) AS term FROM given) GROUP BY ALL),
whole AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM given WHERE len(w) > 0),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM counted, whole GROUP BY term, n_docs),
items AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({lower}, '{pattern}')) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, r, doc_id,
    CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM items JOIN counted USING (term) JOIN weights USING (term), whole GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""
