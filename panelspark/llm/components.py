"""Connected components by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .base import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every node's larger (or smaller) neighbours to its smallest one."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    met = both.join(least, "a")
    if large:
        out = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.select("a", F.col("m").alias("b"))
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for the nodes of edges ``a``, ``b``.

    Each pass is two grouped minima, which combine before the shuffle, and joins on the
    node, which adaptive execution splits where a node has many edges.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    while True:
        edges = stored(_star(_star(edges, True), False), "stars")
        # done once every linked node has one centre and no centre is linked itself
        ends = edges.select("a", "b", F.lit(False).alias("centre")).unionByName(
            edges.select(
                F.col("b").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(True).alias("centre")
            )
        )
        bad = ends.groupBy("a").agg(
            F.min("b").alias("low"), F.max("b").alias("high"), F.bool_or("centre").alias("centre")
        )
        if bad.filter("low < high OR (low IS NOT NULL AND centre)").isEmpty():
            break
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(centres)
