"""Connected components of links, by star operations on a distributed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import staged


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """node, component: the smallest node that each linked node reaches.

    Every round points the neighbours of a node at the smallest among them (large stars),
    then does the same towards smaller nodes only (small stars). Each node sends
    one row per link, so a node with very many links costs no task more than a sum does.
    Rounds are written to the shared folder; their number grows with the logarithm of the longest chain.
    """
    pairs = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    pairs = staged(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _starred(both, both.where("v > u"))
        large = large.distinct()
        small = _starred(large, large).unionByName(large.groupBy("u").agg(F.min("v").alias("v")))
        pairs = staged(small.where("u <> v").distinct(), "links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = now


def _starred(neighbours: DataFrame, moved: DataFrame) -> DataFrame:
    """(v, m) for each moved (u, v), where m is the smallest of u and its neighbours."""
    least = neighbours.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    least = least.select("w", F.least("w", "m").alias("m"))
    joined = moved.join(least, F.col("u") == F.col("w"))
    return joined.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
