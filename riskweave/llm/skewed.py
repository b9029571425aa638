"""Joins with counted keys, safe for keys that hold a large share of the rows, and components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize

#: At most so many keys count as heavy.
HEAVY = 500


def share_join(many: DataFrame, counted: DataFrame, keys: list[str], count: str = "c") -> DataFrame:
    """Inner join with a table of unique keys that tells how often each occurs in ``many``.

    A key is heavy above 1/``HEAVY`` of all counted rows, so at most ``HEAVY`` keys are; they are
    joined by broadcast and their rows stay where they are. All others meet by shuffle.
    """
    total = counted.agg(F.sum(count)).first()[0] or 0
    limit = max(1000, total // HEAVY)
    light = counted.where(F.col(count) <= limit).drop(count)
    heavy = counted.where(F.col(count) > limit).drop(count)
    if heavy.isEmpty():
        return many.join(light, keys)
    heavy = F.broadcast(heavy.limit(HEAVY))
    spread = many.join(heavy, keys)
    return spread.unionByName(many.join(heavy, keys, "left_anti").join(light, keys))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge table ``a, b``; the root is the smallest node reached.

    Alternating large-star and small-star steps: every step replaces edges by edges to the smallest
    known neighbour, until the edges are stars. Each step is written to the shared scratch area.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        # large star: the larger neighbours of a node go to its smallest one
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("c")).withColumnRenamed("a", "b"), "least")
        large = share_join(edges, least, ["b"]).select("a", F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(large, "large")
        # small star: the smaller neighbours of a node, and itself, go to its smallest one
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a")
        edges = materialize(moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(moved.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        mark = now
