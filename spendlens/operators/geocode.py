"""Geocoding as table operations.

The reference calls three web geocoders one after another, each on the
misses of the previous one. Here their answers arrive as tables
(key, provider, lat, long) and the cascade is one aggregate: per address the
highest-priority provider that returned both coordinates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.joins import anti_join


def found(lat: str = "lat", long: str = "long", require_both: bool = True):
    """A geocode counts as found when both coordinates are present.

    (``require_both=False`` accepts a row with one coordinate, which is what a
    literal reading of ``is.na(lat | long)`` does.)
    """
    a, b = F.col(lat).isNotNull(), F.col(long).isNotNull()
    return (a & b) if require_both else (a | b)


def geocode_cascade(hits: DataFrame, key: str = "full_addy", priority: str = "provider",
                    lat: str = "lat", long: str = "long") -> DataFrame:
    """One row per address that some provider found, best provider first (of its answers the least lat, long)."""
    best = (hits.filter(found(lat, long))
            .groupBy(key).agg(F.expr(f"min(struct(`{priority}`, `{lat}`, `{long}`))").alias("b")))
    return best.selectExpr(f"`{key}`", f"b.`{lat}`", f"b.`{long}`", f"b.`{priority}`")


def cascade_stats(hits: DataFrame, key: str = "full_addy", priority: str = "provider",
                  lat: str = "lat", long: str = "long") -> DataFrame:
    """Per provider: addresses asked, found and missed (G9 for every pass)."""
    per = hits.groupBy(priority, key).agg(F.max(found(lat, long).cast("int")).alias("ok"))
    return (per.groupBy(priority)
            .agg(F.count("*").alias("asked"), F.sum("ok").cast("bigint").alias("found"))
            .withColumn("missed", F.col("asked") - F.col("found")))


def ungeocoded(recipients: DataFrame, coordinates: DataFrame, key: str = "full_addy") -> DataFrame:
    """Recipients whose address no provider found; the method cannot place them."""
    return anti_join(recipients, coordinates, key)


def cache_misses(addresses: DataFrame, cache: DataFrame, key: str = "full_addy") -> DataFrame:
    """Addresses not yet in the geocode cache."""
    return anti_join(addresses, cache, key)


def update_cache(cache: DataFrame, new: DataFrame, key: str = "full_addy") -> DataFrame:
    """Cache rows plus newly found rows for addresses not yet cached."""
    add = anti_join(new, cache, key).select(*cache.columns)
    return cache.unionByName(add)
