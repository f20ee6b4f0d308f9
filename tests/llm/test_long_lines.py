"""Long lines are compared whole: an insertion at the front shifts the rest and is counted once."""

import random

from pyspark.sql import functions as F
from rowloom.llm import line_dedup as L


def test_insertions(spark):
    rng = random.Random(5)
    base = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(450))[:3000]
    added = "".join(rng.choices("uvwxyz", k=700))
    pairs = [(base, added[:n] + base, True) for n in (100, 200, 500)]  # distance at most n
    pairs += [(base[200:], base, True), (base, added[:700] + base, False), (base, base[::-1], False)]
    table = spark.createDataFrame(pairs, "a string, b string, near boolean")
    found = table.select("near", L._alike(F.col("a"), F.col("b"), L.EDITS_PERCENT).alias("found")).collect()
    assert [r["found"] for r in found] == [r["near"] for r in found] == [p[2] for p in pairs]
