"""Quality rules on repetition: how much of a text stands in duplicated n-grams and lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.shared import map_arrow
from rowloom.llm.text import blocks, coded, mix, runs, utf8

#: Words of the windows whose repeats the base rule counts, the least words, the most percent of words in repeats.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: A text is left out where duplicated n-grams of so many words hold more than so many percent of its characters.
GRAM_LIMITS = {5: 40, 8: 30, 12: 25}
#: The same for lines that occur more than once.
LINE_LIMIT = 40

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _places(position: np.ndarray, keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Which of `position` are alike in all `columns` with another one, where equal ones have equal keys.

    Neighbours in the order of the keys are compared in full; if keys of unequal ones agree, the columns are sorted.
    """
    order = np.argsort(keys)
    near = keys[order[1:]] == keys[order[:-1]]
    same = near.copy()
    for column in columns:
        same &= column[order[1:]] == column[order[:-1]]
    if (same != near).any():
        order = np.lexsort(columns)
        same = np.ones(len(order) - 1, dtype=bool)
        for column in columns:
            same &= column[order[1:]] == column[order[:-1]]
    held = np.zeros(len(position), dtype=bool)
    held[order[1:][same]] = True
    held[order[:-1][same]] = True
    return position[held]


def repeated_grams(words: np.ndarray, text: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    """For each of the ascending sizes, the word positions at which an n-gram starts that its text holds twice or more.

    Hashes roll from one length to the next, and only starts of repeated shorter n-grams go on.
    """
    with np.errstate(over="ignore"):
        value = mix(words.astype(np.uint64) + np.uint64(1))
        own = mix(text.astype(np.uint64) + _BASE)
        start, length = np.arange(len(words)), 0
        rolled = np.zeros(len(words), dtype=np.uint64)
        for size in sizes:
            start = start[start <= len(words) - size]
            start = start[text[start] == text[start + size - 1]]
            hashed = rolled[start]
            for k in range(length, size):
                hashed = hashed * _BASE + value[start + k]
            rolled[start], length = hashed, size
            if len(start):
                columns = [text[start], *(words[start + k] for k in range(size))]
                start = _places(start, mix(hashed + own[start]), columns)
            yield start


def _covered(start: np.ndarray, size: int, words: int) -> np.ndarray:
    """The words that an n-gram from `start` reaches."""
    edge = np.zeros(words + 1, dtype=np.int64)
    edge[start] += 1
    edge[start + size] -= 1
    return np.cumsum(edge[:-1]) > 0


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def measures(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars and each size's characters, by text."""
    rows = np.arange(len(starts) - 1)
    first, last, bounds = runs(~_BLANK[data], starts)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = points[last] - points[first]
    n_words = np.diff(bounds)
    words, _ = coded(data, first, last)
    text = np.repeat(rows, n_words)

    newline = data == 10
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    begin, end, of_text = runs(~newline, starts)
    from_word, to_word = np.searchsorted(first, begin), np.searchsorted(first, end)
    lines, _ = coded(data, begin, end)
    owner = np.repeat(rows, np.diff(of_text))
    kept = to_word > from_word
    lines, owner, from_word, to_word = lines[kept], owner[kept], from_word[kept], to_word[kept]
    _, one, kind, count = np.unique(owner * (len(begin) + 1) + lines, return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(lines), dtype=np.int64)
    later[one] = 0
    so_far = np.concatenate([[0], np.cumsum(chars)])
    in_lines = np.where(count[kind] > 1, so_far[to_word] - so_far[from_word], 0)

    sizes = sorted({WINDOW, *GRAM_LIMITS})
    found = dict(zip(sizes, repeated_grams(words, text, sizes), strict=True))
    reached = {size: _covered(found[size], size, len(words)) for size in sizes}
    return [
        n_words,
        _per_text(chars, bounds),
        symbols[starts[1:]] - symbols[starts[:-1]],
        np.bincount(owner, weights=later, minlength=len(rows)).astype(np.int64),
        _per_text(reached[WINDOW], bounds),
        np.bincount(owner, weights=in_lines, minlength=len(rows)).astype(np.int64),
        *(_per_text(np.where(reached[size], chars, 0), bounds) for size in GRAM_LIMITS),
    ]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["dup_line_chars", *(f"dup_{size}gram_chars" for size in GRAM_LIMITS)]


def repetition_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, COUNTS, base_failed, kept and SHARES (characters in words of duplicated lines and n-grams) for each row.

    Words are what ASCII blanks part, lines what newlines part; a line counts if it has a word. A word is repeated if
    a window of WINDOW words that its text holds twice or more reaches it. base_failed: fewer than LEAST_WORDS words,
    or more than MOST_REPEATED percent of them repeated. Of the others those are kept of whose characters no more than
    LINE_LIMIT percent stand in duplicated lines and no more than GRAM_LIMITS in duplicated n-grams, first occurrences
    included. Whole texts are read, each in one task, and nothing is shuffled.

    Null and empty texts have no words and fail. Rows that repeat are judged each; a null key stays null. Other columns
    are not read. An empty table gives an empty result.
    """
    frame = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column(1))
            parts = [
                measures(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]) for a, b in blocks(starts)
            ]
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)] or [np.zeros(0, dtype=np.int64)] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=["key", *names]
            )

    names = [*COUNTS, *SHARES]
    schema = f"key {frame.schema['key'].dataType.simpleString()}, " + ", ".join(f"{n} bigint" for n in names)
    found = map_arrow(frame, work, schema)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = ~failed
    for name, limit in zip(SHARES, [LINE_LIMIT, *GRAM_LIMITS.values()], strict=True):
        kept = kept & (100 * F.col(name) <= limit * F.col("word_chars"))
    return found.select(F.col("key").alias(key), *COUNTS, failed.alias("base_failed"), kept.alias("kept"), *SHARES)


def repetition_rules_sql() -> str:
    """DuckDB SQL for the rows of repetition_rules over documents."""
    sizes = sorted({WINDOW, *GRAM_LIMITS})
    grams = " UNION ALL ".join(
        f"SELECT r, {n} AS n, p, array_to_string(w[p:p + {n - 1}], ' ') AS gram "
        f"FROM (SELECT r, w, unnest(range(1, len(w) - {n - 2})) AS p FROM worded WHERE len(w) >= {n})"
        for n in sizes
    )
    shares = ", ".join(f"coalesce(sum(length(x)) FILTER (n = {n}), 0) AS dup_{n}gram_chars" for n in GRAM_LIMITS)
    limits = " AND ".join(
        f"100 * {name} <= {limit} * word_chars" for name, limit in zip(SHARES, [LINE_LIMIT, *GRAM_LIMITS.values()], strict=True)
    )
    columns = ", ".join(f"CAST({name} AS BIGINT) AS {name}" for name in [*COUNTS, *SHARES])
    return rf"""
WITH given AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
worded AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM given),
grams AS ({grams}),
twice AS (SELECT r, n, p FROM grams QUALIFY count(*) OVER (PARTITION BY r, n, gram) > 1),
reached AS (SELECT DISTINCT r, n, unnest(range(p, p + n)) AS p FROM twice),
of_grams AS (
  SELECT r, count(*) FILTER (n = {WINDOW}) AS n_repeat_words, {shares}
  FROM (SELECT r, n, w[p] AS x FROM reached JOIN worded USING (r)) GROUP BY r),
cut AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM given),
lined AS (
  SELECT r, count(*) AS times, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars FROM cut
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line),
of_lines AS (
  SELECT r, sum(times - 1) AS n_dup_lines, coalesce(sum(times * chars) FILTER (times > 1), 0) AS dup_line_chars
  FROM lined GROUP BY r),
found AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars,
    {", ".join(f"coalesce({name}, 0) AS {name}" for name in SHARES[1:])}
  FROM given JOIN worded USING (r) LEFT JOIN of_grams USING (r) LEFT JOIN of_lines USING (r)),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM found)
SELECT doc_id, {columns}, base_failed, NOT base_failed AND {limits} AS kept FROM judged"""
