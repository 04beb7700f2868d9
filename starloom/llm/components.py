"""Connected components by alternating large-star and small-star rounds on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long); component is the least node.

    A large star hands the larger neighbours of every node to its least neighbour, a small star the
    smaller ones; both are one aggregation and one join, so a node with many neighbours is combined
    before the shuffle and split in the join. The number of rounds grows with the logarithm of the
    longest path. Every round is written to the shared folder. Loops and repeated edges do no harm.
    """
    now = materialise(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "edges")
    seen = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.filter("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = materialise(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        before, seen = seen, _mark(now)
        if before == seen:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select("v").distinct().select(
        F.col("v").alias("node"), F.col("v").alias("component")))


def _mark(edges: DataFrame) -> tuple:
    """Number and checksum of the edges: equal when a round changed nothing."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(
        F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
