"""Chart-ready tables (the reference draws PNGs; we hand out the numbers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.fiscal import fy_axis_date
from spendlens.functions.money import million_label, money_out


def city_order(df: DataFrame, place: str = "city_label", amount: str = "amount") -> DataFrame:
    """O3: places ranked by their total, largest first (ties by name).

    The window has no partition, but it runs on the per-place aggregate,
    which has one row per place (a few thousand at most), never on raw rows.
    """
    tot = df.groupBy(place).agg(F.sum(amount).alias("__t"))
    w = Window.orderBy(F.col("__t").desc(), F.col(place))
    return tot.select(place, money_out("__t").alias("total"), F.row_number().over(w).alias("city_rank"))


def chart_timeline(df: DataFrame, place: str = "city_label", fy: str = "fy",
                   amount: str = "amount") -> DataFrame:
    """Per (place, fy) total, axis date, million label, place rank.

    ``in_axis`` is FALSE for negative totals, which the single-place chart
    (axis from 0) does not show.
    """
    per = df.groupBy(place, fy).agg(F.sum(amount).alias("__t"))
    # rank places from the small per-(place, year) table, not from the rows again
    order = city_order(per, place, "__t").select(place, "city_rank")
    return (per.join(order, place)
            .select(place, F.col(fy), fy_axis_date(fy).alias("axis_date"), money_out("__t").alias("total"),
                    million_label("__t").alias("label_m"), F.col("city_rank"),
                    (F.col("__t") >= 0).alias("in_axis")))
