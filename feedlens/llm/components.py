"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (both.join(low, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u")
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .filter(F.col("u") != F.col("v")).distinct())


def _mark(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; the root is the
    smallest node reachable.

    Minima are groupBy aggregates with map-side combination, and neighbours
    meet their minimum in a join, so a node with very many links is never
    gathered in one place.  Each round is written to the shared folder; the
    driver sees a count and a checksum.  Self-links and NULLs are ignored
    (a node with no other link has no row); an empty input gives no rows.
    """
    cur = save(edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    mark = _mark(cur)
    while mark[0]:
        cur = save(_small_star(_large_star(cur)), "edges")
        new = _mark(cur)
        if new == mark:
            break
        mark = new
    roots = cur.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
