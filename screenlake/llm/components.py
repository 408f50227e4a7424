"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum (combined map-side) and a join on the node, so no
task ever holds a whole component. The edges of each round are written to the
shared folder: lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.session import materialize


def _star(sym: DataFrame, large: bool) -> DataFrame:
    """``sym`` holds both directions (u, v). Large star: neighbours above u move to
    the smallest node around u. Small star: u and its neighbours below move there."""
    if large:
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return sym.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = sym.filter("v < u")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))))


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).head()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is
    its smallest node. Self loops, repeated and reversed edges do no harm; an edge
    with a null end is ignored. Raises if ``max_rounds`` do not suffice."""
    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = _state(e)
    if before[0] == 0:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = _star(both, large=True).filter("u <> v").distinct()
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = materialize(_star(both, large=False).distinct(), "cc")
        after = _state(e)
        if after == before:
            roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.distinct())
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
