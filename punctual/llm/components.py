"""Connected components of an undirected graph by alternating large and small stars.

In each round every node first hands its larger neighbours, then its smaller ones, to the least node it knows; the edges
end as stars around the least node of each component. Rounds grow with the logarithm of the longest chain. A hub costs
one aggregate that tasks build up together and a join that adaptive execution splits; edges are written to the shared
folder after each round, so a lost executor costs at most a round. The number of edges is known by then, and the next
round is written in files of about ``EDGES_PER_FILE``, not in one for every partition of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

EDGES_PER_FILE = 1 << 16


def _to_least(directed: DataFrame) -> DataFrame:
    """With every edge (u, v), the least of u and all its v."""
    least = directed.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    # Without its own exchange the join would take over the aggregate's partitions, and a hub could not be split.
    return directed.join(least.hint("rebalance"), "u")


def connected(edges: DataFrame, first: str, second: str) -> DataFrame:
    """``node`` and ``root`` (least node of its component) for every node that has an edge and isn't the root itself."""
    spark = edges.sparkSession
    current = stored(
        spark,
        edges.filter(F.col(first) != F.col(second))
        .select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(current)
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = _to_least(large.distinct())
        joined = small.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
            small.select("u", F.col("least").alias("v"))
        )
        # A round makes two edges at most of each one.
        files = -(-2 * state[0] // EDGES_PER_FILE) or 1
        following = stored(spark, joined.filter(F.col("u") != F.col("v")).distinct().coalesce(files), "edges")
        now = _state(following)
        if now == state:
            return following.select(F.col("u").alias("node"), F.col("v").alias("root"))
        current, state = following, now


def _state(edges: DataFrame) -> tuple:
    """A fingerprint of the set of edges."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64(F.lit(1), "v", "u"))
        ).first()
    )
