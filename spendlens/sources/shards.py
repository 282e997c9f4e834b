"""S5 + U1: yearly transaction tables of the same schema as one DataFrame.

The reference opens one database per fiscal year and maps every query over
the list. Here the shards become one DataFrame with a ``shard_year`` column:
either a Parquet dataset partitioned by ``shard_year`` (a year filter then
prunes directories) or one database per year, read by key (``key_reads``) and
unioned by name.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Column names of the transaction tables -> our names.
TRANSACTION_COLUMNS = {
    "federal_action_obligation": "amount",
    "award_summary_unique_key": "award_key",
    "action_date_year_month": "ym",
    "primary_place_of_performance_state_name": "pop_state",
    "primary_place_of_performance_city_name": "pop_city",
}


# The standardized columns.
TRANSACTION_SCHEMA = ("id bigint, recipient_uei string, award_key string, action_date date, ym string, amount decimal(18,2), "
                      "pop_state string, pop_city string, awarding_agency_name string, shard_year int")


def standardize_transactions(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Rename the source's transaction columns to ours (only those present).

    ``amount`` becomes DECIMAL(18,2) and ``action_date`` a DATE, so sums are
    exact whatever type the source used.
    """
    columns = TRANSACTION_COLUMNS if columns is None else columns
    present = {k: v for k, v in columns.items() if k in df.columns}
    if present:
        df = df.withColumnsRenamed(present)
    if "amount" in df.columns:
        df = df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    if "action_date" in df.columns:
        df = df.withColumn("action_date", F.to_date("action_date"))
    return df


def read_parquet_shards(spark: SparkSession, base: str) -> DataFrame:
    """Parquet laid out as ``base/shard_year=YYYY/*.parquet``, columns standardized."""
    return standardize_transactions(spark.read.option("basePath", base).parquet(base))


def union_shards(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name (a shard may lack a column added later)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_by_year(df: DataFrame, years, col: str = "shard_year") -> list[DataFrame]:
    """The per-year shards of a DataFrame (used to build shard fixtures)."""
    return [df.filter(F.col(col) == y) for y in years]
