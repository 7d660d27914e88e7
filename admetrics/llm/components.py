"""Connected components of a distributed edge list, by alternating large-star and small-star rounds.

Each round is a minimum per node, combined before it is shuffled, and a join of the edges with these minima; a node with very many
edges is split by adaptive execution. Every round is written to the shared folder, so no lineage grows and lost
executors cost one round at most. The number of rounds grows with the logarithm of the longest path.
"""

from pyspark.sql import DataFrame, functions as F

from admetrics.session import materialize


def _star(sides: DataFrame) -> DataFrame:
    """Adds to the neighbours (u, v) the smallest m of u and all its neighbours."""
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return sides.join(least, "u")


def _both(edges):
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _clean(edges):
    return edges.where("a > b").distinct()


def _size(edges):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node of the component.

    Loops, repeated and reversed edges change nothing; no edges give no rows.
    """
    edges = materialize(_clean(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "edges")
    seen = _size(edges)
    while True:
        sides = _both(edges)
        large = _star(sides).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = _clean(large)
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _star(down)
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = materialize(_clean(small), "edges")
        now = _size(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
