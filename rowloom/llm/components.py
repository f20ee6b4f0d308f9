"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.shared import cut_lineage

#: Edges of one task, at least: with one task a shuffle partition, small tables would be written as very many files.
TASK_EDGES = 200_000


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    moved = both.where("v > u").join(low, "u")
    return moved.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).coalesce(tasks).distinct().coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).coalesce(tasks).distinct().coalesce(tasks)


def _state(edges: DataFrame) -> tuple:
    """Equal for equal edge sets (up to a 128-bit collision)."""
    hashes = [F.sum(F.xxhash64(F.lit(seed), "u", "v").cast("decimal(38,0)")) for seed in (1, 2)]
    return tuple(edges.agg(F.count("*"), *hashes).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) of every node that an edge names.

    Each step moves one row per edge at most and ends in a reliable checkpoint, so nodes with very many neighbours
    are reduced before a join meets them. Loops only keep their node; repeated edges count once; an edge with a null
    end is ignored. No edges give no rows.
    """
    given = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    stars = cut_lineage(given.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _state(stars)
    while before[0]:
        tasks = -(-before[0] // TASK_EDGES)
        stars = cut_lineage(_small_star(_large_star(stars.coalesce(tasks), tasks), tasks))
        after = _state(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component"))
    loops = given.where("a = b").select(F.col("a").alias("node")).join(stars, F.col("node") == F.col("u"), "left_anti")
    found = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(roots).union(loops.select("node", F.col("node").alias("component"))).distinct()
