"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a minimum by node (summed before the shuffle) and a join on the node. A node with very
many edges takes its minimum by broadcast (tables.hub_join), so no task holds its edges; no
neighbour list is ever collected. Every second step is written to the shared folder, so that the
plan stays short and a lost executor repeats one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.tables import drop_kept, hub_join, hub_level, keep, sweep


def _star(edges: DataFrame, large: bool, total: int, hubs: bool) -> DataFrame:
    """Large: each node hangs its larger neighbours on its least one. Small: the others, and itself."""
    both = edges.select("a", "b").union(edges.select("b", "a")) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("degree"))
    hung = hub_join(both, least, "a", "degree", total, hubs)
    if large:
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def _state(edges: DataFrame) -> tuple[bool, int, int]:
    """Whether each node hangs on one other that hangs on none, the most edges of a node, and all ends of edges."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(edges.select("b", F.lit(0), F.lit(1)))
    by_node = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.sum("holds").alias("holds"))
    odd, most, total = by_node.agg(F.count_if((F.col("hangs") > 1) | ((F.col("hangs") == 1) & (F.col("holds") > 0))), F.max(F.col("hangs") + F.col("holds")), F.sum(F.col("hangs") + F.col("holds"))).first()
    return not odd, most or 0, total or 0


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node that each node of an edge reaches. Each round hangs nodes lower, so it ends, however long the chains."""
    now = keep(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a != b").distinct())
    while True:
        done, degree, total = _state(now)
        if done:
            break
        hubs = degree > hub_level(total)  # no step gives a node more smaller neighbours
        then = keep(_star(_star(now, True, total, hubs), False, total, hubs))
        drop_kept(then.sparkSession, now)
        now = then
    sweep(now.sparkSession)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
