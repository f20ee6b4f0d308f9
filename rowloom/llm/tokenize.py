"""Encoding of a text column with a byte-level BPE vocabulary, and decoding of ids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm import bpe
from rowloom.llm.shared import map_arrow


def _typed(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


@lru_cache(maxsize=4)
def _cached(path: str) -> bpe.Cache:
    """One cache a task process, which later tasks in the process go on with."""
    return bpe.Cache(bpe.merges(path))


@lru_cache(maxsize=4)
def _cached_digits(path: str) -> bpe.Cache:
    """The ids of a piece, and their decimal digits joined by spaces."""
    merge = bpe.merges(path)

    def both(piece: bytes) -> tuple[list[int], bytes]:
        ids = merge(piece)
        return ids, " ".join(map(str, ids)).encode()

    return bpe.Cache(both)



def encode_column(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids array<int>, offsets array<long> (byte offset of each piece of the pre-tokenisation in the text).

    `path` names a rank file that each executor can open. Null and empty texts have no ids. Rows that repeat are
    encoded each on their own; columns other than these two are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = _cached(path)
        for batch in batches:
            ids, offsets = [], []
            for found, at in bpe.encode(batch.column(1), merged):
                ids.append([i for piece in found for i in piece])
                offsets.append(at[:-1])
            columns = [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(offsets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "ids", "offsets"])

    frame = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = map_arrow(frame, work, f"key {_typed(frame, 'key')}, ids array<int>, offsets array<bigint>")
    return out.withColumnRenamed("key", key)


def decode_column(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and the decoded bytes (binary) of an id column. Null ids give empty bytes; an unknown id is an error."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = bpe.merges(path)
        for batch in batches:
            data = [merge.decode(row or ()) for row in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "data"])

    frame = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return map_arrow(frame, work, f"key {_typed(frame, 'key')}, data binary").withColumnRenamed("key", key)


def round_trip_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256, n_pieces: digests of each text's ids and of the bytes they decode to.

    Encoding and decoding meet in one task, so neither ids nor texts are shuffled. Null: as the empty text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged, token = _cached_digits(path), bpe.merges(path).tokens
        for batch in batches:
            rows = []
            for found, at in bpe.encode(batch.column(1), merged):
                digits = b" ".join([d for _, d in found])
                data = b"".join([token[i] for ids, _ in found for i in ids])
                if len(data) != (at[-1] if len(at) else 0):
                    raise ValueError("ids and offsets do not cover the same bytes")
                count = sum([len(ids) for ids, _ in found])
                rows.append((count, hashlib.sha256(digits).hexdigest(), hashlib.sha256(data).hexdigest(), len(found)))
            counts, ids, decoded, cuts = zip(*rows, strict=True) if rows else ((), (), (), ())
            columns = [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(ids, pa.string()),
                pa.array(decoded, pa.string()),
                pa.array(cuts, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "ids_sha256", "decoded_sha256", "n_pieces"])

    frame = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {_typed(frame, 'key')}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_pieces bigint"
    return map_arrow(frame, work, schema).withColumnRenamed("key", key)
