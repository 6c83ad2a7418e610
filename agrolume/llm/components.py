"""Connected components of a graph given by its links, by alternating stars.

Large star and small star in turn hang the neighbours of each node on the smallest
one, until the links are stars around the smallest node of each component.  Minima are
aggregates with a partial step, so a node with very many links costs one row per task;
every turn is stored, and the driver only sees a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.llm.common import stored


def _least(links: DataFrame) -> DataFrame:
    """The smallest node at each node, stored: a join with it can split the links of a hot one."""
    return stored(links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = both.join(_least(both), "u").where("v > u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = down.join(_least(down), "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node in ``links`` (u, v)."""
    links = stored(links.where("u <> v").select("u", "v").distinct(), "links")
    before = None
    while True:
        links = stored(_large(links), "large")
        links = stored(_small(links).where("u <> v").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
