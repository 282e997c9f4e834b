"""Delivery series: one value per (place, fiscal year) in four fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.fiscal import fy_delivery_date
from spendlens.functions.money import money_out


def place_fy_totals(df: DataFrame, place: str = "place_id", fy: str = "fy",
                    amount: str = "amount", out: str = "total_obligations") -> DataFrame:
    """Sum of amounts by (place, fy) (partial + final hash aggregate)."""
    return df.groupBy(place, fy).agg(money_out(F.sum(amount)).alias(out))


def delivery(totals: DataFrame, place: str = "place_id", fy: str = "fy", value: str = "total_obligations",
             negative_to_null: bool = True) -> DataFrame:
    """``date, value, place_id, category_id``.

    ``date`` is ``YYYY-01-01 00:00:00`` text; negative values become NULL
    (printed ``NA``); ``category_id`` is an empty string.
    """
    v = F.col(value).cast("double")
    if negative_to_null:
        v = F.when(v >= 0, v)
    return totals.select(fy_delivery_date(fy).alias("date"), v.alias("value"),
                         F.col(place).alias("place_id"), F.lit("").alias("category_id"))
