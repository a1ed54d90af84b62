"""Connected components by alternating stars over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.workspace import materialize


def join_apart(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join in which a hot key can be split.

    A second key, a function of the first, makes Spark exchange both sides right
    below the join even where one side is already dealt by ``key``; adaptive
    execution splits a skewed partition only between such exchanges.
    """

    def apart(df: DataFrame) -> DataFrame:
        return df.withColumn("_apart", F.pmod(F.hash(F.lit(key), key), F.lit(1 << 20)))

    return apart(left).join(apart(right), [key, "_apart"], how).drop("_apart")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, rounds: int = 100, rows: int | None = None) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long); root is the smallest node reachable.

    Each round hangs the larger neighbours of every node on its smallest neighbour,
    then the smaller ones; the number of edges never grows by more than the number
    of nodes, and rounds grow with the logarithm of the longest path. A round's
    edges are written to the shared folder, which cuts the lineage. Self-loops and
    repeated edges are allowed and change nothing, null ends are ignored. Running out
    of rounds raises an error. ``rows`` is about the number of different edges, if known.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = materialize(pairs.filter("a <> b").distinct(), "edges", rows)
    before = _state(now)
    for _ in range(rounds):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = join_apart(both.filter("b > a"), least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.filter("m < a").select("a", F.col("m").alias("b"))
        large = large.union(own).distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = join_apart(large, small_least, "a")
        hung = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(hung.union(small_least.select("a", F.col("m").alias("b"))).distinct(), "edges", before[0])
        after = _state(now)
        if after == before:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = after
    raise RuntimeError(f"no stable components after {rounds} rounds")
