"""Connected components of a table of links, by alternating large and small stars.

Every round rewrites the links as two grouped minima and joins; a node with very many links is combined
before each shuffle. The links of each round are written to the shared folder, so the lineage stays
short and only one number comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """(u, v) with u > v: every node's greater (large) or smaller (small) neighbours are linked to its least neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.join(least, "u")
    if large:
        moved = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") > F.col("v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that links reach; nodes without a link to another node are left out.
    Nulls and links of a node to itself are ignored; an empty table gives none."""
    links = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    links = written(links, "components")
    was, now = None, mark(links)
    while now != was and now[0]:
        links = written(_star(_star(links, True), False), "components")
        was, now = now, mark(links)
    least = links.groupBy("v").agg(F.count("*").alias("n")).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(least)
