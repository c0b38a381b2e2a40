"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.sources.scratch import stage


def components(links: DataFrame, a: str, b: str, label: str = "components") -> DataFrame:
    """One row (``node``, ``root``) per linked node; ``root`` is the smallest node reachable.

    Distributed union-find by alternating stars: every node hands its smallest neighbour to
    its larger neighbours, then every node and its smaller neighbours hang below the smallest
    of them. Rounds grow with the logarithm of the longest path. Each round is written to the
    shared scratch folder, so a lost executor repeats one round at most. Only a row count and
    a checksum reach the driver.

    Links are undirected; nulls, self links and repeated links are ignored; nodes without a
    link have no row. No links: no rows.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = stage(
        links.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), label
    )
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        edges = stage(_below_smallest(_to_larger(edges)), label)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _to_larger(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours, linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _below_smallest(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.union(least.select("u", F.col("m").alias("v"))).distinct()
