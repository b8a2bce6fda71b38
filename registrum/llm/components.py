"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrum.llm.common import discard, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Join the neighbours of each node to the least of them. The least is a partially aggregated minimum,
    written before the join: both sides are then scans, so adaptive execution can split the partition of a node
    with very many neighbours (it cannot where a side is an aggregate's output). Written; the least goes at once."""
    if small:
        pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = written(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    joined = pairs.join(least, "u")
    if small:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    out = written(moved.where("a <> b").distinct(), "edges")
    discard(least)
    return out


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(node, component) for the nodes of edges (a, b): component is the least node reachable. Each step is
    written to the shared folder, so neither plan nor recomputation grows, and deleted after the next."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    for _ in range(max_steps):
        half = _star(now, False)
        after = _star(half, True)
        discard(now, half)
        now, before, state = after, state, _state(after)
        if before == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
    raise RuntimeError("components did not settle")
