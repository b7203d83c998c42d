"""Connected components of an edge table by alternating star contractions.

Each round hangs neighbours under the smallest known node of their
neighbourhood, first the larger ones, then the smaller; it ends when only stars
around the smallest node are left. Rounds grow with the logarithm of the nodes,
not with the diameter. Only minima per node are aggregated (map-side), so a hub
costs one row per map task and its edges are joined with one row, which adaptive
skew handling can split. No link, node or label is collected.

A round is a dozen small shuffles, so its tasks follow the edges that are left, not the
session's partitions: a round over at most ``TASK_EDGES`` of them is one task without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridmart.llm.common import release, staged

#: Edges (two longs each) in a partition that a round starts from, on average at most.
TASK_EDGES = 1 << 16


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).distinct()


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()


def _tasks(edges: int) -> int:
    return max(1, -(-edges // TASK_EDGES))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node with an edge; component is the smallest node.

    ``edges`` has columns ``a`` and ``b`` of one orderable type, in any
    direction, repeats and loops allowed. Null ends are dropped. A node whose
    only edges are loops is absent, as it is its own component.
    """
    stored = staged(_clean(edges.select("a", "b").dropna()))
    before = _signature(stored)
    while before[0]:
        tasks = _tasks(before[0])
        e = stored.coalesce(tasks)
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        both = both.coalesce(1) if tasks == 1 else both
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m"))
        larger = both.where(F.col("b") > F.col("a"))
        e = _clean(larger.join(low, larger["a"] == low["u"]).select(larger["b"].alias("a"), F.col("m").alias("b")))
        # Every edge now points from a larger to a smaller node.
        low = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        hung = e.join(low, e["a"] == low["u"]).select(e["b"].alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        last, stored = stored, staged(_clean(hung.coalesce(1) if tasks == 1 else hung))
        release(last)  # this round's table holds all that is left
        after = _signature(stored)
        if after == before:
            break
        before = after
    e = stored.coalesce(_tasks(before[0]))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
