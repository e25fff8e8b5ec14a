"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def mark(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum over their hashes, to see whether a round changed them."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; edges go from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``links`` (long ``u``, ``v``); the root is the smallest node.

    Nodes without a link don't appear, roots do. The rounds alternate two star
    operations until the edges are stars around the roots; each keeps at most as many
    edges as there are, so a component of any size stays spread out. Each round's
    edges are written to the shared folder. No links give no rows.
    """
    edges = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges, "links")
    before = mark(edges)
    while before[0]:
        edges = stored(small_star(large_star(edges)), "links")
        now = mark(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.withColumn("root", F.col("node")))
