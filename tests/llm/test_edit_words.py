"""Edit similarity of lines by whole words first, against a plain edit distance."""

import random

from pyspark.sql import functions as F

from rowloom.llm.line_dedup import _alike, _within_by_words


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(words, draw):
    words = list(words)
    for _ in range(draw.randint(0, 6)):
        at, kind = draw.randrange(len(words) + 1), draw.random()
        if kind < 0.3:
            words.insert(at, draw.choice(["a", "bc", "longerword", "ü"]))
        elif kind < 0.6 and len(words) > 1:
            del words[min(at, len(words) - 1)]
        elif kind < 0.8:
            words[min(at, len(words) - 1)] = draw.choice(["x", "yz", "ende"])
        else:
            words[min(at, len(words) - 1)] += "q"
    return words


def test_alike_is_the_edit_distance(spark):
    draw = random.Random(5)
    pairs = [("a", "a"), ("a", "b"), ("a b", "a"), ("a a a a a a a", "a a a a a a"), ("b c d e f g h i", "b c d e f g h i j")]
    for _ in range(400):
        words = [draw.choice(["a", "b", "wort", "zwei", "längere", "x" * 12]) for _ in range(draw.randint(1, 30))]
        pairs.append((" ".join(words), " ".join(changed(words, draw))))
    table = spark.createDataFrame(pairs, "a string, b string").repartition(4)
    most = F.floor(F.greatest(F.char_length("a"), F.char_length("b")) * 15 / 100).cast("int")
    words = _within_by_words(F.split("a", " "), F.split("b", " "), most)
    found = table.select("a", "b", _alike(F.col("a"), F.col("b"), 15).alias("alike"), words.alias("words")).collect()
    seen = set()
    for r in found:
        near = distance(r["a"], r["b"]) <= max(len(r["a"]), len(r["b"])) * 15 // 100
        assert r["alike"] == near, r
        assert near or not r["words"], r  # whole words never show a far pair to be near
        seen.add((near, r["words"]))
    assert seen == {(True, True), (True, False), (False, False)}
