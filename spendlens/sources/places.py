"""City place metadata (one CSV row per city, several GEOIDs in one cell)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Header names of the place metadata file -> our column names.
PLACE_COLUMNS = {
    "SOLE Place ID": "place_id",
    "2020 Census GEOIDs": "geoid_list",
    "City name": "city",
    "State Code": "state_code",
    "State": "state",
    "SoLE region": "region",
    "Population 2021": "pop_21",
}


def read_city_places(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """S3: CSV scan that keeps and renames only the listed columns.

    Every column is read as text (GEOIDs keep their leading zeros); the
    population is cast afterwards. The ordinal records the file order so
    "first row per city" is well defined.
    """
    columns = columns or PLACE_COLUMNS
    raw = spark.read.option("header", True).option("inferSchema", False).option("escape", "\"").csv(path)
    df = raw.select(*[F.col(f"`{src}`").alias(dst) for src, dst in columns.items()])
    return typed_places(df).withColumn("ordinal", F.monotonically_increasing_id())


def typed_places(df: DataFrame) -> DataFrame:
    """The population as a number, thousands separators taken out."""
    if "pop_21" not in df.columns:
        return df
    return df.withColumn("pop_21", F.expr("try_cast(regexp_replace(pop_21, '[, ]', '') AS BIGINT)"))


def prepare_places(raw: DataFrame, list_col: str = "geoid_list", sep: str = ", ") -> DataFrame:
    """P3 + E2: add ``city_label`` and give every GEOID of a city its own row.

    ``place_order`` = file ordinal * 2^20 + position of the GEOID in its cell.
    """
    keep = [f"`{c}`" for c in raw.columns if c != list_col]
    sep_sql = sep.replace("\\", "\\\\").replace("'", "\\'")
    return (raw.selectExpr(*keep, "concat(coalesce(city, 'NA'), ', ', coalesce(state_code, 'NA')) AS city_label",
                           f"posexplode(split(`{list_col}`, '{sep_sql}')) AS (geoid_pos, geoid)")
            .selectExpr("*", "CAST(ordinal AS BIGINT) * 1048576 + geoid_pos AS place_order")
            .drop("geoid_pos"))
