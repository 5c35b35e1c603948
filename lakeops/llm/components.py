"""Connected components of an edge table by alternating large-star and small-star steps.

Each step replaces edges by edges to the smallest known neighbour, until every
vertex points to the smallest one of its component.  Minima are pre-aggregated before the
shuffle, so a vertex with most of the edges is no burden; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.staging import staged


def _stars(edges: DataFrame) -> DataFrame:
    """Large-star: every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Small-star on edges u > v: all smaller neighbours of u, and u, are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(vertex, root) for each vertex of ``edges`` (u, v: longs); root is the smallest vertex reachable.

    An edge with a null end or with equal ends ties nothing.
    """
    now = edges.filter("u IS NOT NULL AND v IS NOT NULL AND u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, mark = staged(now, "edges"), None
    n_edges = now.count()
    for _ in range(max_rounds):
        now = staged(_small(_stars(now)), "components", n_edges)
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(new) == mark:
            break
        mark = tuple(new)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")).union(roots)
