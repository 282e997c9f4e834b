"""Sinks: delivery CSV and tables (K3); dumps (K2) are in ``snapshots``, the geocode cache (K1, K4) in ``geocode_cache``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_delivery_csv(df: DataFrame, path: str) -> None:
    """K3: one CSV with a header; NULL prints ``NA``, empty text prints nothing.

    The delivery table has one row per (place, year), so a single output
    file is cheap; rows are sorted by place and date like the grouped output
    of the reference.
    """
    (df.orderBy("place_id", "date").coalesce(1).write.mode("overwrite")
     .option("header", True).option("nullValue", "NA").option("emptyValue", "")
     .csv(path))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet output for chart/map tables, optionally partitioned."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
