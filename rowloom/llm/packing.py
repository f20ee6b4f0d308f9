"""Packing of documents into fixed windows, each filled with lexical neighbours of the document that opens it."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm import bpe
from rowloom.llm.shared import BATCH_ROWS, map_arrow, store
from rowloom.llm.text import binaries, blocks

#: Rows of the index of one shard: so many remainders are searched together inside a task.
SHARD_ROWS = 1024
#: Used rows leave an index as soon as less than this share of its rows is left.
LEFT_ROWS = 7 / 8
#: Remainder bytes that one packing task should read.
TASK_BYTES = 16 << 20
#: Distinct pieces of text whose ids a task process remembers, and those that go to the library as one text.
CORE_PIECES, JOINED_PIECES = 500_000, 50_000
#: Bytes of text whose distinct pieces are found together, and pieces whose ids are laid out together.
ENCODE_BYTES, GATHERED_PIECES = 24 << 20, 100_000
#: The letters that byte-level vocabularies have for bytes; those without a visible one of their own have the
#: next ones after U+00FF.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTERS = np.zeros(256, dtype="<u2")
_LETTERS[_VISIBLE] = _VISIBLE
_LETTERS[[b for b in range(256) if b not in _VISIBLE]] = np.arange(0x100, 0x200 - len(_VISIBLE))
#: BM25's saturation and length weights.
K1, B = 1.2, 0.75

_FULL, _REST, _TERMS = 0, 1, 2
_SCHEMA = (
    "kind int, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "ids binary, place bigint, term int, documents bigint"
)
_NAMES = [part.strip().split()[0] for part in _SCHEMA.split(",")]
_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
_ARROW = pa.schema([(p.strip().split()[0], _TYPES[p.strip().split()[1]]) for p in _SCHEMA.split(",")])


class _Encoder:
    """The tokenizers library's ids of a text, as little-endian numbers, asked for once a distinct piece of the text.

    Pieces come from the scan that byte-level BPE uses here; the library splits and merges each piece like the same
    piece inside its text. A text that holds the string of one of its special tokens goes to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.path, self.merger = path, Tokenizer.from_file(path)
        self.special = [t.content for t in self.merger.get_added_tokens_decoder().values()]
        split = self.merger.pre_tokenizer
        self.joins = self.merger.normalizer is None and isinstance(split, pre_tokenizers.ByteLevel) and not split.add_prefix_space
        self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = self.merger.get_vocab()
        self.letters = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.letters[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.pieces = pa.array([], pa.large_binary())
        self.ids, self.size = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)

    @cached_property
    def tokenizer(self):
        return type(self.merger).from_file(self.path)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype="<u4") for f in found]

    def _merged(self, cut: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after the other, and how many each has.

        A call for each piece costs more than its merging. So pieces go to the library in its own letters for bytes,
        among which there is no blank, as texts that it splits at blanks only. Ids have as many letters as their
        pieces, which tells where one piece's ids end; where that does not hold, pieces are encoded one by one.
        """
        ids, size = [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.int64)]
        for at in range(0, len(cut), JOINED_PIECES):
            part = cut.slice(at, JOINED_PIECES)
            found = self._joined(part) if self.joins else None
            if found is None:
                each = self._encode([piece.decode() for piece in part.to_pylist()])
                found = np.concatenate(each), np.fromiter(map(len, each), dtype=np.int64, count=len(each))
            ids.append(found[0])
            size.append(found[1])
        return np.concatenate(ids), np.concatenate(size)

    def _joined(self, cut: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        _, offsets, data = cut.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[cut.offset : cut.offset + len(cut) + 1]
        flat, ends = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds[1:] - bounds[0]
        text = np.full(len(flat) + len(cut), ord(" "), dtype="<u2")
        text[np.arange(len(flat)) + np.repeat(np.arange(len(cut)), np.diff(bounds))] = _LETTERS[flat]
        found = self.merger.encode_batch_fast([text[:-1].tobytes().decode("utf-16-le")], add_special_tokens=False)
        ids = np.array(found[0].ids, dtype="<u4")
        read = np.cumsum(self.letters[ids])
        last = np.searchsorted(read, ends)
        if not len(read) or read[-1] != ends[-1] or (read[last] != ends).any():
            return None
        return ids, np.diff(last + 1, prepend=0)

    def _known(self, cut: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of many pieces one after the other, how many each has, and which of them the given ones are.

        The first CORE_PIECES distinct pieces that a process meets, among them the frequent ones, are remembered.
        """
        place = pc.index_in(cut, value_set=self.pieces)
        missing = place.is_null()
        new = cut.filter(missing)
        found, count = self._merged(new)
        ids, size = np.concatenate([self.ids, found]), np.concatenate([self.size, count])
        at = place.fill_null(0).to_numpy().astype(np.int64)
        at[missing.to_numpy(zero_copy_only=False)] = len(self.size) + np.arange(len(new))
        if len(new) and len(self.pieces) < CORE_PIECES:
            self.pieces = pa.concat_arrays([self.pieces, new.slice(0, CORE_PIECES - len(self.pieces))])
            self.size = size[: len(self.pieces)]
            self.ids = ids[: self.size.sum()]
        return ids, size, at

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each row and an id 0 after them.

        Each distinct piece of a block, told apart by its bytes, is looked up once.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = np.zeros(len(texts), dtype=bool)
        for content in self.special:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        row = 0
        for raw, cuts, rows in _gathered(texts):
            pieces = binaries(np.frombuffer(raw, dtype=np.uint8), cuts).dictionary_encode()
            flat, size, at = self._known(pieces.dictionary)
            place, begin = pieces.indices.to_numpy(), np.cumsum(size) - size
            for first, last in blocks(rows, GATHERED_PIECES):
                kind = at[place[rows[first] : rows[last]]]
                each = size[kind]
                end = np.cumsum(each)
                ids = flat[np.repeat(begin[kind] - (end - each), each) + np.arange(each.sum())]
                bounds = np.concatenate([[0], end])[rows[first : last + 1] - rows[first]].tolist()
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    if whole[row]:
                        yield np.concatenate([self._encode([texts[row].as_py()])[0], _END])
                    else:
                        yield np.concatenate([ids[a:b], _END])
                    row += 1


_END = np.zeros(1, dtype="<u4")


def _gathered(texts: pa.Array) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """What bpe.pieces gives, for several blocks of text as one."""
    raws, cuts, rows, size, count = [], [], [], 0, 0
    for raw, at, first in bpe.pieces(texts):
        raws.append(raw)
        cuts.append(at[:-1] + size)
        rows.append(first[:-1] + count)
        size, count = size + len(raw), count + len(at) - 1
        if size >= ENCODE_BYTES:
            yield b"".join(raws), np.concatenate([*cuts, [size]]), np.concatenate([*rows, [count]])
            raws, cuts, rows, size, count = [], [], [], 0, 0
    if raws:
        yield b"".join(raws), np.concatenate([*cuts, [size]]), np.concatenate([*rows, [count]])


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


#: Above all hashes of 21 bits.
_NO_HASH = 1 << 21


@lru_cache(maxsize=2)
def _hashes(bits: int) -> np.ndarray:
    """Three 21-bit hashes of each id of so many bits, _NO_HASH for the end id."""
    terms, found = np.arange(1 << bits, dtype=np.uint64), []
    for seed in (0x9E3779B97F4A7C15, 0x3C6EF372FE94F82A, 0xDAA66D2C7DDF743F):
        hashed = terms + np.uint64(seed)
        hashed = (hashed ^ (hashed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        hashed = (hashed ^ (hashed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        found.append(((hashed ^ (hashed >> np.uint64(31))) >> np.uint64(43)).astype(np.int64))
    hashes = np.array(found)
    hashes[:, 0] = _NO_HASH
    return hashes


def _place(terms: np.ndarray) -> int:
    """A key under which like vocabularies lie together: minima of three hashes of the ids, the end id left out."""
    place = 0
    if len(terms):
        for least in _hashes(max(16, int(terms.max()).bit_length()))[:, terms].min(axis=1).tolist():
            place = place << 21 | (least if least < _NO_HASH else 0)
    return place


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _NAMES]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _ARROW.types, strict=True)], names=_NAMES
    )


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Keys and texts of several batches as one."""
    held, size = [], 0
    for batch in batches:
        held.append((batch.column(0), batch.column(1).cast(pa.large_string())))
        size += held[-1][1].nbytes
        if size >= ENCODE_BYTES:
            yield tuple(map(pa.concat_arrays, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(pa.concat_arrays, zip(*held, strict=True)))


def _cut(docs: DataFrame, path: str, window: int) -> DataFrame:
    """Whole windows of every document, its remainder with its ids, and how many documents hold each id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sequence = _encoder(path), TaskContext.get().partitionId() << 32
        holders, latest = np.zeros((2, len(encode.letters)), dtype=np.int64)
        documents = 0
        for keys, texts in _together(batches):
            rows = []
            for key, ids in zip(keys.to_pylist(), encode(texts), strict=True):
                if len(rows) >= BATCH_ROWS:
                    yield _batch(rows)
                    rows = []
                data, at = ids.tobytes(), np.arange(len(ids))
                latest[ids] = at
                holders[ids[latest[ids] == at]] += 1  # each distinct id once
                documents += 1
                whole = len(ids) // window * window
                for start in range(0, whole, window):
                    crc = zlib.crc32(data[4 * start : 4 * (start + window)])
                    rows.append((_FULL, key, start, window, crc, len(ids), sequence, None, None, None, None))
                    sequence += 1
                if whole < len(ids):
                    rest = data[4 * whole :]
                    place = _place(ids[whole:])
                    rows.append((_REST, key, whole, len(rest) // 4, None, len(ids), None, rest, place, None, None))
            yield _batch(rows)
        counted = np.flatnonzero(holders).tolist()
        rows = [(_TERMS, *[None] * 8, t, int(holders[t])) for t in counted]
        yield _batch([*rows, (_TERMS, *[None] * 8, -1, documents)])

    return map_arrow(docs, work, _SCHEMA)


class Shard:
    """A BM25 inverted index over the remainders of one shard, with the idf of the whole corpus."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray) -> None:
        counted = [np.unique(r, return_counts=True) for r in rests]
        self.terms = [t for t, _ in counted]
        lengths = np.array([len(r) for r in rests], dtype=np.float64)
        scale = K1 * (1 - B + B * lengths / max(lengths.mean(), 1.0))
        row = np.repeat(np.arange(len(rests)), [len(t) for t in self.terms])
        term = np.concatenate(self.terms)
        count = np.concatenate([c for _, c in counted]).astype(np.float64)
        order = np.argsort(term, kind="stable")
        self.row = row[order]
        self.weight = (idf[term] * count * (K1 + 1) / (count + scale[row]))[order]
        self.vocabulary, self.begin = np.unique(term[order], return_index=True)
        self.end = np.append(self.begin[1:], len(order))
        self.rows = len(rests)

    def keep(self, rows: np.ndarray) -> None:
        """Leaves out the postings of all rows but those marked; their scores are 0 from now on."""
        kept = rows[self.row]
        before = np.concatenate([[0], np.cumsum(kept)])
        self.begin, self.end = before[self.begin], before[self.end]
        self.row, self.weight = self.row[kept], self.weight[kept]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of the seed's distinct terms in every row."""
        at = np.searchsorted(self.vocabulary, self.terms[seed])
        begin, length = self.begin[at], self.end[at] - self.begin[at]
        before = np.cumsum(length) - length
        posting = np.arange(int(length.sum())) + np.repeat(begin - before, length)
        found = np.bincount(self.row[posting], weights=self.weight[posting], minlength=self.rows)
        return found.astype(np.float64, copy=False)  # integers where no posting is left

    def ranked(self, seed: int) -> np.ndarray:
        """All rows by descending score, ties by row."""
        return np.argsort(-self.scores(seed), kind="stable")


def _fill(rows: list[dict], idf: np.ndarray, window: int, state: dict) -> Iterator[tuple]:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of one shard's remainders.

    The document that opens a window is its seed, and the seed's best unused neighbours follow until the window is
    full. Of the last one the front part fills it; the rest opens the next window and makes it the next seed. `state`
    carries an open window to the task's next shard.
    """
    shard = Shard([np.frombuffer(r["ids"], dtype="<u4") for r in rows], idf)
    used = np.zeros(len(rows), dtype=bool)
    scores: np.ndarray | None = None
    first, left, indexed = 0, len(rows), len(rows)
    for _ in rows:
        if scores is None:
            while used[first]:
                first += 1
            k, opens = first, True
        else:
            k, opens = int(scores.argmax()), False  # of equal ones the first
            scores[k] = -np.inf
        used[k], left = True, left - 1
        r, begin = rows[k], 0
        while begin < r["length"]:
            length = min(r["length"] - begin, window - state["offset"])
            crc = zlib.crc32(r["ids"][4 * begin : 4 * (begin + length)])
            yield r["doc_id"], r["start"] + begin, length, crc, r["doc_tokens"], state["sequence"], state["offset"]
            begin += length
            state["offset"] += length
            if state["offset"] == window:
                state["sequence"], state["offset"], opens = state["sequence"] + 1, 0, True
        if not state["offset"]:
            scores = None
        elif opens:
            if left < LEFT_ROWS * indexed:
                shard.keep(~used)
                indexed = left
            scores = shard.scores(k)
            scores[used] = -np.inf


def pack_documents(
    docs: DataFrame, path: str, window: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of documents laid into sequences of at most `window` tokens.

    doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens, sequence_id, offset (in its sequence)
    for each piece; every id of every row lies in exactly one piece, and offsets are gapless from 0. `path` is a
    tokenizers file that each executor can open; id 0 ends each document.

    A document fills as many whole windows as it can by itself, in the task that encodes it. Only remainders move:
    they are dealt by range of a key that puts like vocabularies side by side, so that every task gets its share
    however the documents are distributed, and each run of SHARD_ROWS remainders becomes a BM25 index whose idf counts
    all documents. The lists of document frequencies that reach the driver are as long as the vocabulary. Each task
    ends with at most one sequence that is not full.

    Null and empty texts have one id, the 0. Rows that repeat are packed each on their own, and ties in the key are
    ordered by id. A null key stays null. Other columns are not read. An empty table gives an empty result.
    """
    frame = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    cut = store(_cut(frame, path, window), "cut", partition_by="kind")
    counted = {
        r["term"]: r["n"]
        for r in cut.where(F.col("kind") == _TERMS).groupBy("term").agg(F.sum("documents").alias("n")).collect()
    }
    documents = counted.pop(-1, 0)
    held = np.zeros(max(counted, default=0) + 1)
    held[list(counted)] = list(counted.values())
    idf = np.log1p((documents - held + 0.5) / (held + 0.5))
    rests = cut.where(F.col("kind") == _REST)
    tokens = rests.agg(F.sum("length")).first()[0] or 0
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"sequence": (1 << 62) | (TaskContext.get().partitionId() << 32), "offset": 0}
        waiting: list[dict] = []
        for batch in batches:
            waiting += batch.to_pylist()
            while len(waiting) >= SHARD_ROWS:
                yield _pieces(_fill(waiting[:SHARD_ROWS], idf, window, state))
                del waiting[:SHARD_ROWS]
        if waiting:
            yield _pieces(_fill(waiting, idf, window, state))

    def _pieces(found: Iterator[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

    tasks = max(1, -(-4 * tokens // TASK_BYTES))
    dealt = rests.select("place", "doc_id", "start", "length", "doc_tokens", "ids")
    dealt = dealt.repartitionByRange(tasks, "place", "doc_id", "start").sortWithinPartitions("place", "doc_id", "start", "ids")
    packed = map_arrow(dealt, work, ", ".join(f"{n} bigint" for n in names))
    whole = cut.where(F.col("kind") == _FULL)
    return whole.select(*names[:6], F.lit(0).cast("bigint").alias("offset")).union(packed)
