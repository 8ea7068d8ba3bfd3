"""Connected components of an edge table, by alternating star contractions.

Each round rewires every edge towards the smallest neighbour (large star over
the greater neighbours, small star over the lesser ones); the rounds needed
grow with the logarithm of the longest path, not with its length.  All state
is a table in the shared folder: nothing is collected but one row of counts.
A hub meets its edges in a join whose other side is unique, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    pairs = _both(edges)
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        pairs.join(least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``edges(a, b)`` -> ``(node, component)`` for every node with an edge;
    the component is the least node reachable.  Null ends and loops are
    ignored; an empty table gives an empty table."""
    now = staged(
        edges.select("a", "b")
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(rounds):
        now = staged(_small(_large(now)), "star")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (
        now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")))
        .distinct()
    )
