"""Connected components of an edge table, by alternating large-star and small-star rounds; everything stays distributed.

Both stars are an aggregation (minimum neighbour, combined before the shuffle) and a join back, so a vertex with very many
edges is a skewed join that adaptive execution splits, never one group in one task. Each round is written to the shared checkpoint
folder; rounds end when no edge changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevault.session import cut


def stars(edges: DataFrame, centre: DataFrame) -> DataFrame:
    return edges.join(centre.groupBy("u").agg(F.min("v").alias("m")), "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the vertex' smallest neighbour (or to itself, if smaller)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return stars(both, both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are linked to the smallest of them. ``edges`` run from larger to smaller."""
    to_min = stars(edges, edges)
    return to_min.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(edges.groupBy("u").agg(F.min("v").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node in an edge between two different nodes; root is the smallest node reachable.

    NULL ends and loops are left out; repeated edges count once; no edges give no rows.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    now = cut(now)
    mark = digest(now)
    while True:
        now = cut(small_star(large_star(now)))
        after = digest(now)
        if after == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = after


def digest(edges: DataFrame) -> tuple:
    """Number and order-free hash of a set of edges."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)
