"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is one aggregation and one join over the edges, so no component is gathered
anywhere; edges are written to the shared folder between rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import dropped, staged


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; ``root`` is the least node of its component.

    ``edges`` has the columns a and b. An empty table gives an empty result.
    """
    edges = staged(edges.select("a", "b").dropna().filter("a <> b").distinct(), name)
    before = None
    for _ in range(rounds):
        former, edges = edges, staged(_small(_large(edges)), name)
        dropped(former)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
