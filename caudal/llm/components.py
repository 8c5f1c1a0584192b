"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import stored

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: a, b bigint. Gives node, component (the smallest node of its component) for every node that has an edge.

    Alternating large-star and small-star rounds: each links a node's neighbours to the smallest of them, so edges never
    grow in number and chains shorten by halves. Every round is written to the shared folder; the driver sees a count and a
    checksum. Self-loops, repeated edges and edges with NULL are allowed and change nothing.
    """
    now = edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(now, "edges")
    seen = _checksum(now)
    for _ in range(MAX_ROUNDS):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(low, "a")
        small = linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        now = stored(small, "edges")
        check = _checksum(now)
        if check == seen:
            break
        seen = check
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(now.select("b", "b").distinct())


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
