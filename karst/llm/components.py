"""Connected components of a link table, by alternating stars on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from karst.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point every node's larger (or smaller) neighbours at its smallest one."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("_m", "a"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).union(
            least.select("a", F.col("_m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes of ``links(a, b)``: the smallest node of each component.

    Rounds of large-star and small-star end when the table stops changing,
    after a number of rounds that grows with the logarithm of the longest
    chain.  A round is one written table.  Null ends, loops and repeated links
    are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = materialise(edges, "links")
    state = None
    while True:
        found = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(found) == state or not found[0]:
            break
        state = tuple(found)
        edges = materialise(_star(_star(edges, True), False), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
