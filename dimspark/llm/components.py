"""Connected components of a link table, by stars that grow and shrink.

Every round first hangs each node's larger neighbours on its smallest one, then
its smaller neighbours, until all links point at the smallest node of their
component. Rounds grow with the logarithm of the longest chain. A node with very
many links only ever meets one row of minima, so the planner can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.sources.shared import store


def _around(links: DataFrame) -> DataFrame:
    """(``u``, ``low``): the smallest of a node and its neighbours."""
    return links.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("_u"), F.least("u", "low").alias("low"))


def _larger_to_smallest(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = both.join(_around(both), F.col("u") == F.col("_u")).where("v > u")
    return met.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _smaller_to_smallest(links: DataFrame) -> DataFrame:
    """``links`` with u > v."""
    met = links.join(_around(links), F.col("u") == F.col("_u"))
    moved = met.where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(met.select("u", F.col("low").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) of every node in ``links`` (``u`` > ``v``) but the roots.

    ``root`` is the smallest node that can be reached. No links give no rows.
    """
    links = store(links.where("u > v").distinct())
    state = None
    while True:
        digest = links.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
        if tuple(digest) == state or digest[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(digest)
        links = store(_smaller_to_smallest(_larger_to_smallest(links)))
