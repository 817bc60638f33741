"""Connected components of a link table by alternating stars, each step a shuffle on node ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def component_roots(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` except roots themselves; the root is the smallest node.

    Each round links neighbours to the smallest neighbour, first the larger ones and then the smaller ones.
    When a round changes nothing every link points from a node to its root. Rounds grow with the logarithm of the
    links, and every round ends in a checkpoint. Null nodes and links of a node to itself are left out; no links,
    no rows.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = _signature(links)
    while before[0]:
        both = links.union(links.select("b", "a")).toDF("a", "b")
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(smallest, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l"))
        links = small.select("l.a", "l.b").where("a <> b").distinct().checkpoint()
        after = _signature(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
