"""Byte-level BPE: encoding of whole texts into ranks, with offsets, and decoding.

Pre-tokenisation is a scan, not a regular expression. Every code point becomes one of a few symbols by its class and
its neighbours' classes; a symbol is a function from the kind of the open piece to the kind after it. Functions
compose associatively, so fixed-length runs of symbols are composed side by side, the runs' functions are scanned
in turn, and a second sweep gives the kind before every code point and thereby the piece boundaries. The pieces are
slices of the UTF-8 bytes; each distinct one is merged once and cached.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from rowloom.llm.text import BLOCK_BYTES, blocks, utf8

# The code points with Unicode's White_Space property.
WHITE_SPACE = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006,
    0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# Ranges of letters and numbers that Unicode 16 added, which Python's own tables may not have yet.
UNICODE_16_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
UNICODE_16_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
# Letters that make a piece of their own with an apostrophe before them.
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")

#: Distinct pieces in one generation of a task's cache.
CACHE_PIECES = 150_000
#: Bytes up to which a piece is merged by plain search.
SHORT_PIECE = 48
#: Symbols composed in one run of the scan.
RUN = 64

# Symbols.
LETTER, DIGIT, OTHER, APOSTROPHE_1, APOSTROPHE_2, SPACE, LAST_BLANK, LAST_SPACE = range(8)
# Kinds of the open piece: none, letters, digits, other, white space, a blank that the next piece takes in, and
# an apostrophe that takes in one or two more letters.
NONE, LETTERS, DIGITS, OTHERS, SPACES, BLANK, ONE_MORE, TWO_MORE = range(8)
KINDS = 8


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """kind x symbol -> next kind, and whether a piece begins there. Symbols 8 to 15 ignore the kind: a text begins."""
    after, begins = np.zeros((KINDS, 16), dtype=np.uint8), np.ones((KINDS, 16), dtype=bool)
    after[:, [LETTER, DIGIT, OTHER, SPACE]] = [LETTERS, DIGITS, OTHERS, SPACES]
    after[:, [APOSTROPHE_1, APOSTROPHE_2, LAST_BLANK, LAST_SPACE]] = [ONE_MORE, TWO_MORE, BLANK, NONE]
    for symbol, kind in ((LETTER, LETTERS), (DIGIT, DIGITS), (OTHER, OTHERS), (SPACE, SPACES)):
        begins[kind, symbol] = False
    begins[BLANK, [LETTER, DIGIT, OTHER]] = False
    for kind in (OTHERS, BLANK):
        after[kind, [APOSTROPHE_1, APOSTROPHE_2]] = OTHERS
        begins[kind, [APOSTROPHE_1, APOSTROPHE_2]] = False
    after[ONE_MORE, LETTER], begins[ONE_MORE, LETTER] = NONE, False
    after[TWO_MORE, LETTER], begins[TWO_MORE, LETTER] = ONE_MORE, False
    after[:, 8:] = after[NONE, :8]
    return after, begins


_AFTER, _BEGINS = _transitions()
_STEP = (_AFTER << 4).tobytes().ljust(256, b"\0")
_BEGIN = _BEGINS.tobytes().ljust(256, b"\0")


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """LETTER, DIGIT, OTHER or SPACE for every code point."""
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
    for kind, ranges in ((LETTER, UNICODE_16_LETTERS), (DIGIT, UNICODE_16_NUMBERS)):
        for first, last in ranges:
            table[first : last + 1] = kind
    table[list(WHITE_SPACE)] = SPACE
    return table


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The symbol of each code point; `first` marks where texts begin."""
    n = len(points)
    kind = class_table()[points]
    out = kind.copy()

    def following(k: int, values: np.ndarray, fill: int) -> np.ndarray:
        """The value k places on in the same text."""
        moved = np.full(n, fill, dtype=values.dtype)
        moved[: n - k] = values[k:]
        for j in range(1, k + 1):
            moved[: n - j][first[j:]] = fill
        return moved

    space = kind == SPACE
    last = space & (following(1, kind, SPACE) != SPACE)
    out[last] = LAST_SPACE
    out[last & (points == 0x20)] = LAST_BLANK
    quote = points == 0x27
    if quote.any():
        one, two = following(1, points, 0), following(2, points, 0)
        for ending in SHORT_ENDINGS:
            out[quote & (one == ord(ending))] = APOSTROPHE_1
        for ending in LONG_ENDINGS:
            out[quote & (one == ord(ending[0])) & (two == ord(ending[1]))] = APOSTROPHE_2
    out[first] += 8
    return out


def _step(kind: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Kinds after one column of symbols, for all runs (and all their possible first kinds) at once.

    Kinds are held times 16, so that kind and symbol make one byte that bytes.translate looks up.
    """
    return np.frombuffer((kind | column).tobytes().translate(_STEP), dtype=np.uint8).reshape(kind.shape)


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin, as positions of code points."""
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64)
    runs = -(-n // RUN)
    padded = np.zeros(runs * RUN, dtype=np.uint8)
    padded[:n] = symbols(points, first)
    columns = np.ascontiguousarray(padded.reshape(runs, RUN).T)
    kind = _scan(_compose(columns))
    begins = np.empty((RUN, runs), dtype=bool)
    for k, column in enumerate(columns):
        begins[k] = np.frombuffer((kind | column).tobytes().translate(_BEGIN), dtype=bool)
        kind = _step(kind, column)
    return np.flatnonzero(begins.T.ravel()[:n])


def _compose(columns: np.ndarray) -> np.ndarray:
    """The function of each run: for every kind before it the kind after it."""
    every = np.tile(np.arange(KINDS, dtype=np.uint8) << 4, (columns.shape[1], 1))
    for column in columns:
        every = _step(every, column[:, None])
    return every


def _scan(functions: np.ndarray) -> np.ndarray:
    """The kind before each run, by composing the functions of all runs before it pairwise (an exclusive scan)."""
    if len(functions) == 1:
        return np.zeros(1, dtype=np.uint8)
    pairs = len(functions) // 2
    left, right = functions[: 2 * pairs : 2], functions[1 : 2 * pairs : 2]
    joined = np.take_along_axis(right, (left >> 4).astype(np.intp), axis=1)
    if len(functions) % 2:
        joined = np.concatenate([joined, functions[-1:]])
    of_pairs = _scan(joined)
    out = np.empty(len(functions), dtype=np.uint8)
    out[::2] = of_pairs[: len(out[::2])]
    out[1::2] = left[np.arange(pairs), of_pairs[:pairs] >> 4]
    return out


def pieces(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Blocks of rows: their UTF-8 bytes, where pieces begin (and the last one ends), and each row's first piece."""
    data, starts = utf8(texts)
    for a, b in blocks(starts, limit):
        raw = data[starts[a] : starts[b]].tobytes()
        bounds = starts[a : b + 1] - starts[a]
        lead = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80
        at = np.append(np.flatnonzero(lead), len(raw))
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        first = np.zeros(len(points) + 1, dtype=bool)
        first[np.searchsorted(at, bounds[:-1])] = True
        cuts = at[piece_starts(points, first[:-1])]
        yield raw, np.append(cuts, len(raw)), np.searchsorted(cuts, bounds)


class Merges:
    """The ranks of a vocabulary, and the merging of one piece by them."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}

    def __call__(self, piece: bytes) -> list[int]:
        """Ranks of the piece's tokens: the lowest-ranked pair of neighbours merges first, the leftmost among equals."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) <= SHORT_PIECE:
            return self._short(piece)
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        following, previous = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        end = len(parts)
        get = self.ranks.get
        queue = []
        for i in range(end - 1):
            rank = get(piece[i : i + 2])
            if rank is not None:
                queue.append((rank, i, 2))
        heapq.heapify(queue)
        while queue:
            _, i, length = heapq.heappop(queue)
            left = parts[i]
            if left is None or following[i] >= end or len(left) + len(parts[following[i]]) != length:
                continue  # one of the two has merged with another meanwhile
            j = following[i]
            parts[i], parts[j] = left + parts[j], None
            following[i] = k = following[j]
            if k < end:
                previous[k] = i
                rank = get(parts[i] + parts[k])
                if rank is not None:
                    heapq.heappush(queue, (rank, i, len(parts[i]) + len(parts[k])))
            h = previous[i]
            if h >= 0:
                rank = get(parts[h] + parts[i])
                if rank is not None:
                    heapq.heappush(queue, (rank, h, len(parts[h]) + len(parts[i])))
        return [self.ranks[p] for p in parts if p is not None]

    def _short(self, piece: bytes) -> list[int]:
        """The same by plain search, which is quicker for a few bytes."""
        get, none = self.ranks.get, len(self.ranks)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (rank := min(pairs)) < none:
            i = pairs.index(rank)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Cache(dict):
    """What a function gives for each distinct piece, in two generations.

    When one holds CACHE_PIECES it becomes the older, and the older one goes, but for the pieces that are met again.
    """

    def __init__(self, function: Callable[[bytes], object]) -> None:
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, piece: bytes):
        if len(self) >= CACHE_PIECES:
            self.older = dict(self)
            self.clear()
        value = self.older.get(piece)
        if value is None:
            value = self.function(piece)
        self[piece] = value
        return value


def encode(texts: pa.Array, merged: Cache) -> Iterator[tuple[list, np.ndarray]]:
    """For each row, what `merged` gives for its pieces, and the pieces' byte offsets with the text's length."""
    for raw, cuts, row_pieces in pieces(texts):
        slices = cuts.tolist()
        found = [merged[raw[a:b]] for a, b in zip(slices[:-1], slices[1:], strict=True)]
        rows = row_pieces.tolist()
        for a, b in zip(rows[:-1], rows[1:], strict=True):
            yield found[a:b], cuts[a : b + 1] - cuts[a]


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    """A vocabulary is read once in each task process."""
    return Merges(path)
