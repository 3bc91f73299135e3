"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped minima and joins on vertices; a vertex with very
many neighbours is a plain join key, which adaptive execution splits. Every
round is written to the shared folder, so lineage stays short and a lost
executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

MAX_ROUNDS = 60


def _with_reverse(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to its smallest."""
    both = _with_reverse(edges)
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from larger to smaller; a vertex and its smaller
    neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(low.select("a", F.col("low").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every vertex of ``edges (a, b)``; the root is the
    smallest vertex of the component. Stops when a round changes nothing."""
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "cc-0")
    seen = _digest(now)
    for r in range(1, MAX_ROUNDS):
        now = stored(_small_star(_large_star(now)), f"cc-{r}")
        last, seen = seen, _digest(now)
        if last == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
