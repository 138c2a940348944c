"""Connected components of an edge list, as Spark jobs.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every round replaces the edges of a
vertex by edges to the smallest of its neighbours, and each is one
aggregation and one join.  A hub's edges are never gathered in one task: the
smallest neighbour is an aggregate, and Spark splits a skewed join.  Each
round is written to the shared folder; rounds end when nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiscope.llm.rows import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b) with b < a, distinct -> the same after one star step."""
    if large:  # all neighbours, in both directions
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # the smaller neighbours
        near = edges
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    joined = near.join(least, "a").withColumn("m", F.least("a", "m"))
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            joined.select("a", F.col("m").alias("b"))
        )
    return moved.filter("b < a").distinct()


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs of orderable ids -> (id, component): the smallest id
    reachable, for every id that is not itself the smallest.  Loops and
    repeated or reversed pairs are allowed; nulls are ignored."""
    now = cut_lineage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a is not null and b is not null and a <> b")
        .distinct()
    )
    seen = _digest(now)
    while seen[0]:
        now = cut_lineage(_star(_star(now, large=True), large=False))
        was, seen = seen, _digest(now)
        if seen == was:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
