"""ZCTA-to-place relationship file (delimited, with a header)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Header names of the used crosswalk columns -> our names.
CROSSWALK_COLUMNS = {
    "GEOID_PLACE_20": "geoid_place",
    "NAMELSAD_PLACE_20": "name_place",
    "GEOID_ZCTA5_20": "geoid_zcta",
}


def read_crosswalk(spark: SparkSession, path: str, sep: str = "|",
                   columns: dict[str, str] | None = None) -> DataFrame:
    """All columns as text (GEOIDs keep leading zeros); empty cells -> NULL."""
    columns = columns or CROSSWALK_COLUMNS
    raw = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    return raw.select(*[F.col(src).alias(dst) for src, dst in columns.items()])
