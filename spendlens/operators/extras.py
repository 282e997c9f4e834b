"""Measures the reference's documentation names but never computes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.money import money_out


def per_100k(totals: DataFrame, places: DataFrame, place: str = "city_label", fy: str = "fy",
             value: str = "total", pop: str = "pop_21") -> DataFrame:
    """Spending per 100,000 residents (``totals`` keep exact decimals)."""
    pops = places.groupBy(place).agg(F.min(pop).alias(pop))  # one row per place, whatever the table holds
    v = F.col(value).cast("decimal(38,6)") * 100000 / F.col(pop)
    return totals.join(pops, place).select(place, fy, money_out(v).alias("per_100k"))


def top_agencies(df: DataFrame, k: int = 3, place: str = "city_label", agency: str = "awarding_agency_name",
                 amount: str = "amount") -> DataFrame:
    """The k awarding agencies with the most money per place (ties share a rank).

    The window is partitioned by place over the per-(place, agency)
    aggregate, so no partition holds more than the agencies of one place.
    """
    per = df.groupBy(place, agency).agg(F.sum(amount).alias("__t"))
    w = Window.partitionBy(place).orderBy(F.col("__t").desc())
    return (per.withColumn("agency_rank", F.rank().over(w).cast("bigint")).filter(F.col("agency_rank") <= k)
            .select(place, agency, money_out("__t").alias("total"), "agency_rank"))
