"""Licence scans by a positional index of rare licence words, with DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Template:
    """A licence text as words, and the phrase of it that a file must hold word by word."""

    label: str
    key: str
    text: str
    base: bool = False

    def __post_init__(self) -> None:
        if f" {self.key} " not in f" {self.text} ":
            raise ValueError(f"the key phrase of {self.label} is not in its text")

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_place(self) -> int:
        """Words of the text before its key phrase."""
        return len(f" {self.text} ".split(f" {self.key} ")[0].split())


# The phrases that a scan must report, and short texts of licences in which they stand.
TEMPLATES = (
    Template("gpl", "gnu general public license", "licensed under the gnu general public license version 3", True),
    Template("apache", "apache license", "licensed under the apache license version 2 0", True),
    Template("cc-by", "cc by", "licensed under cc by 4 0", True),
    Template("mit", "mit license", "released under the mit license", True),
    Template("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    Template("agpl", "gnu affero general public license", "licensed under the gnu affero general public license version 3"),
    Template("lgpl", "gnu lesser general public license", "licensed under the gnu lesser general public license version 3"),
    Template("mpl", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    Template("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("reserved", "all rights reserved", "all rights reserved"),
)

#: Rarest words of a key phrase whose places are looked up and intersected.
INDEXED = 2

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text: runs of ASCII letters, digits and characters beyond ASCII; ASCII letters lower-cased.

    lower() also changes letters beyond ASCII; none of them becomes a word of ASCII letters, the Kelvin sign aside,
    which is replaced first.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.filter(F.split(plain, _BREAK), lambda w: w != "")


def word_idf(docs: DataFrame, vocabulary: Sequence[str], text: str = "text") -> dict[str, float]:
    """idf over all documents of each word of a fixed vocabulary."""
    held = docs.select(F.array_intersect(words(F.col(text)), F.array(*map(F.lit, sorted(vocabulary)))).alias("held"))
    counted = held.select(F.explode(F.array_append("held", F.lit(""))).alias("word")).groupBy("word").count()
    count = {r["word"]: r["count"] for r in counted.collect()}
    documents = count.get("", 0)
    return {w: math.log((documents + 1) / (count.get(w, 0) + 1)) for w in vocabulary}


def _rarest(template: Template, idf: dict[str, float]) -> list[tuple[str, int]]:
    """The key phrase's rarest words and their places in it (a word that repeats: its first place)."""
    key = template.key_words
    ranked = sorted(set(key), key=lambda w: (-idf[w], w))
    return [(w, key.index(w)) for w in ranked[:INDEXED]]


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values))


def _starts(template: Template, idf: dict[str, float]) -> Column:
    """Where the key phrase stands: the places that all its indexed words point to, verified word by word."""

    def pointed(word: str, at: int) -> Column:
        return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["place"] - at)

    common = reduce(F.array_intersect, [pointed(w, at) for w, at in _rarest(template, idf)])
    key = _strings(template.key_words)
    size = len(template.key_words)
    return F.array_sort(F.filter(common, lambda s: (s >= 0) & (F.slice("words", s + 1, size) == key)))


def _agreement(template: Template, starts: Column) -> Column:
    """The largest share of the template's words that stand where they should around one of the places."""
    expected = _strings(template.words)
    size, before = len(template.words), template.key_place

    def share(start: Column) -> Column:
        same = F.transform(expected, lambda w, i: F.get("words", start - before + i).eqNullSafe(w))
        return F.size(F.filter(same, lambda s: s)) / F.lit(float(size))

    return F.coalesce(F.array_max(F.transform(starts, share)), F.lit(0.0))


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Sequence[Template] = TEMPLATES
) -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of docs.

    n_base counts the places where a base template's key phrase stands, first_word and last_word are the least and
    largest of their starts in words from 0 (null without any). labels names every template whose key phrase stands
    somewhere, base_labels the base ones among them; both are sorted, distinct and joined by commas (empty without
    any). score is the largest share of a found template's words that agree around its key phrase, 0 without any.

    One pass counts how many documents hold each licence word, which picks the rarest words of each key phrase; the
    second looks those words up in each file that has any, intersects the phrase places they point to and verifies
    them. Only counts of the templates' own words reach the driver, and nothing is shuffled but them.

    Null and empty texts have no words. Rows that repeat are scanned each; a null key stays null. Other columns are
    not read. An empty table gives an empty result.
    """
    idf = word_idf(docs, {w for t in templates for w in t.key_words}, text)
    indexed = sorted({w for t in templates for w, _ in _rarest(t, idf)})
    read = docs.select(F.col(key).alias("key"), words(F.col(text)).alias("words"))
    places = F.transform("words", lambda w, i: F.struct(i.alias("place"), w.alias("word")))
    hits = F.filter(places, lambda h: h["word"].isin(indexed))
    none = F.array().cast("array<struct<place:int,word:string>>")
    looked_up = F.when(F.arrays_overlap("words", _strings(indexed)), hits).otherwise(none)
    any_hit = F.size("hits") > 0
    found = read.withColumn("hits", looked_up)
    empty = F.array().cast("array<int>")
    for n, t in enumerate(templates):
        found = found.withColumn(f"at{n}", F.when(any_hit, _starts(t, idf)).otherwise(empty))
    base = F.array_sort(F.flatten(F.array(*[f"at{n}" for n, t in enumerate(templates) if t.base])))

    def joined(of: Sequence[int]) -> Column:
        named = F.array(*[F.when(F.size(f"at{n}") > 0, F.lit(templates[n].label)) for n in of])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(named))), ",")

    shares = [F.when(F.size(f"at{n}") > 0, _agreement(t, F.col(f"at{n}"))).otherwise(0.0) for n, t in enumerate(templates)]
    return found.select(
        F.col("key").alias(key),
        F.size("words").cast("bigint").alias("n_words"),
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(base).cast("bigint").alias("first_word"),
        F.array_max(base).cast("bigint").alias("last_word"),
        joined([n for n, t in enumerate(templates) if t.base]).alias("base_labels"),
        joined(range(len(templates))).alias("labels"),
        F.greatest(F.lit(0.0), *shares).alias("score"),
    )


def scan_licenses_sql(table: str = "documents", templates: Sequence[Template] = TEMPLATES) -> str:
    """The same in DuckDB's SQL, by trying every place of every text."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def listed(values: Sequence[str]) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    starts = ",\n".join(
        f"CASE WHEN list_has_all(w, {listed(t.key_words)}) THEN list_filter(range(len(w)), "
        f"lambda s: w[s + 1 : s + {len(t.key_words)}] = {listed(t.key_words)}) ELSE [] END AS at{n}"
        for n, t in enumerate(templates)
    )
    shares = ",\n".join(
        f"coalesce(list_max(list_transform(at{n}, lambda s: len(list_filter(range({len(t.words)}), lambda i: "
        f"s - {t.key_place} + i >= 0 AND w[s - {t.key_place} + i + 1] IS NOT DISTINCT FROM {listed(t.words)}[i + 1])) "
        f"/ {len(t.words)}.0::DOUBLE)), 0.0)"
        for n, t in enumerate(templates)
    )

    def joined(of: Sequence[int]) -> str:
        named = ", ".join(f"CASE WHEN len(at{n}) > 0 THEN '{templates[n].label}' END" for n in of)
        return f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{named}], lambda x: x IS NOT NULL))), ','), '')"

    base = [n for n, t in enumerate(templates) if t.base]
    return f"""
WITH read AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}
), found AS (SELECT doc_id, w, {starts} FROM read),
gathered AS (SELECT *, flatten([{", ".join(f"at{n}" for n in base)}]) AS base FROM found)
SELECT doc_id, len(w)::BIGINT AS n_words, len(base)::BIGINT AS n_base,
  list_min(base)::BIGINT AS first_word, list_max(base)::BIGINT AS last_word,
  {joined(base)} AS base_labels, {joined(range(len(templates)))} AS labels,
  greatest({shares})::DOUBLE AS score
FROM gathered"""
