"""Texts of Arrow batches as flat numpy arrays: bytes, words and five-word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task; a longer text forms a block of its own.
BLOCK_BYTES = 1 << 20

SHINGLE_WORDS = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.default_rng(20240501)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of an odd number modulo 2**64, as far as they have been asked for."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.values = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.values):
            grown = np.full(max(n, BLOCK_BYTES + 1), self.base, dtype=np.uint64)
            grown[0] = 1
            self.values = np.multiply.accumulate(grown)
        return self.values[:n]


_POWERS, _INVERSE_POWERS = _Powers(_BASE), _Powers(_BASE_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits each depend on all input bits (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, nulls as empty texts, and where each row begins (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return flat[starts[0] : starts[-1]], starts - starts[0]


def blocks(starts: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold up to `limit` bytes each, or one row."""
    row, rows = 0, len(starts) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, side="right")) - 1)
        yield row, min(end, rows)
        row = end


def runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
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


def binaries(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The consecutive slices of `flat` as a binary array, without a Python object for any of them."""
    held = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, held)


def coded(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each slice data[first:last], equal for equal slices only, and the distinct slices by number.

    Slices do not overlap and stand in order.
    """
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[first] += 1
    edge[last] -= 1
    flat = data[np.cumsum(edge[:-1], dtype=np.int8) > 0]
    found = binaries(flat, np.concatenate([[0], np.cumsum(last - first)])).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def polynomial(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices data[first:last], alike for equal slices wherever they stand.

    For features only: unequal slices can be built whose hashes agree.
    """
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data] * _POWERS.upto(n), out=sums[1:])
        return mix((sums[last] - sums[first]) * _INVERSE_POWERS.upto(n + 1)[first] + (last - first).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of consecutive texts, ASCII letters lower-cased, and each text's first word.

    Each distinct word is hashed once, by a cryptographic hash: no two words can be built to agree.
    """
    first, last, bounds = runs(~_SEPARATOR[data], starts)
    words, names = coded(_LOWER[data], first, last)
    digests = b"".join([blake2b(name, digest_size=8).digest() for name in names.to_pylist()])
    return np.frombuffer(digests, dtype="<u8").astype(np.uint64)[words], bounds


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words none."""
    sets = []
    if len(words) >= size:
        run = words[: len(words) - size + 1]
        for k in range(1, size):
            run = run * _STEP + words[k : len(words) - size + 1 + k]
        run = mix(run)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            sets.append(np.unique(run[a : b - size + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for w in words[a:b]:
                whole = whole * _STEP + w
            sets.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            sets.append(words[:0])
    return sets


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each row of a text column, one block of text after the other."""
    with np.errstate(over="ignore"):
        data, starts = utf8(column)
        for a, b in blocks(starts):
            part = starts[a : b + 1]
            words, bounds = word_hashes(data[part[0] : part[-1]], part - part[0])
            yield from shingle_hashes(words, bounds)
