"""Connected components of an edge table by alternating star contractions, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint")), F.sum(F.hash("b", "a").cast("bigint"))).first())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` for every node of ``edges`` (long columns ``a``, ``b``); the root is the least node reachable.

    Rounds grow with the logarithm of a component's size. Minima are taken before the shuffle, and the joins are
    plain equi-joins, which adaptive execution splits where one node has very many neighbours.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, k = scratch.keep(now, "stars-0"), 0
    before = _mark(now)
    while before[0]:
        k += 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = scratch.keep(least, f"least-{k}-large")  # written, so that the join can split a hot node
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.keep(large, f"stars-{k}-large")
        least = scratch.keep(large.groupBy("a").agg(F.min("b").alias("m")), f"least-{k}")
        small = large.join(least, "a").filter("b <> m").select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
        now = scratch.keep(small.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"stars-{k}")
        after = _mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
