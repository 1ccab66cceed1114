"""Connected components by alternating large and small stars, all in shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import discard, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (least node of its component) for every node of an edge between two nodes.

    Each round hooks a node's larger neighbours to its least one, then its smaller ones; the number of rounds
    grows with the logarithm of the nodes.  A hub's neighbours are never gathered: minima are partial aggregates.
    The driver sees two numbers a round, to tell whether the edges still change.
    """
    now = written(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        old, now = now, written(small.union(floor.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, mark = mark, _mark(now)
        discard(old)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
