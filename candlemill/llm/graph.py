"""Connected components of a graph of links, by alternating stars.

Each step hangs a node's neighbours on the smallest of them, once for the
larger and once for the smaller ones, until every component is one star around
its smallest node. A node of any degree is combined before the shuffle and
joined back, so no task gathers its neighbours; links never leave the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.session import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked with, itself included.

    Only nodes that some link names appear. Links with nulls, of a node with
    itself, and repeated ones change nothing.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
        .distinct(),
        "edges",
    )
    state = _state(edges)
    while state[0]:
        # Large star: larger neighbours of u go to the smallest of u and its neighbours.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        # Small star: smaller neighbours of u, and u, go to the smallest of them.
        large = stage(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = (
            hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where("u > v")
            .distinct()
        )
        edges = stage(small, "small-star")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return roots.union(edges.select("u", "v"))
