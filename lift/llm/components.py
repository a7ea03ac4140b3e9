"""Connected components of a graph of longs, by contraction.

Each round gives every vertex a pseudo-random rank and merges it with the
neighbour (or itself) of the lowest rank; the merged graph is written out and is
smaller by a constant factor on average, whatever the graph looks like, chains
included. All state is in written tables, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lift.sources.shared import materialise


def component_map(edges: DataFrame) -> DataFrame:
    """``(v, component)`` for every vertex of the edges ``(a, b)``; the component is one of its vertices."""
    current = materialise(edges.where("a <> b").select("a", "b"), "graph")
    rounds: list[DataFrame] = []
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda name: F.struct(F.xxhash64(F.lit(len(rounds)), F.col(name)).alias("r"), F.col(name).alias("v"))  # noqa: E731, B023
        lowest = both.groupBy(F.col("a").alias("v")).agg(F.min(rank("b")).alias("best"))
        target = lowest.select("v", F.when(F.col("best") < rank("v"), F.col("best.v")).otherwise(F.col("v")).alias("w"))
        target = materialise(target, "graph-round")
        rounds.append(target)
        moved = current.join(target.select(F.col("v").alias("a"), F.col("w").alias("x")), "a").join(
            target.select(F.col("v").alias("b"), F.col("w").alias("y")), "b")
        current = materialise(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "graph")
    if not rounds:
        return current.select(F.col("a").alias("v"), F.col("b").alias("component"))
    found = rounds.pop().withColumnRenamed("w", "component")
    while rounds:  # name the vertices merged earlier after what they were merged into
        before = rounds.pop()
        later = found.select(F.col("v").alias("w"), "component")
        found = materialise(before.join(later, "w", "left").select("v", F.coalesce("component", "w").alias("component")), "graph-map")
    return found
