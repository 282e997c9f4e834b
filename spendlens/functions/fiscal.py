"""Fiscal-year columns.

Two meanings are kept apart:

* ``fiscal_year`` is the documented one: the federal year that starts in
  October, so 2017-10-01 belongs to FY2018.
* ``fiscal_year_as_coded`` reproduces the delivered code, which compares
  ``YYYY-M`` text with ``>=``/``<=``.  As text ``"2017-10" <= "2017-9"``, so
  October to December land in the earlier year.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_year(date_col, start_month: int = 10) -> Column:
    """Fiscal year of a date; the year is named after its last month."""
    if not 1 <= start_month <= 12:
        raise ValueError("start_month must be 1..12")
    shift = (13 - start_month) % 12
    d = _col(date_col)
    return F.year(F.add_months(d, shift) if shift else d).cast("int")


def fiscal_year_as_coded(ym_col, first: int = 2017, last: int = 2023,
                         start_month: int = 10) -> Column:
    """FY from a ``YYYY-M`` string by text ranges, NULL outside [first, last].

    Ranges are ``"{y-1}-{start}" <= ym <= "{y}-{start-1}"`` compared as
    strings, evaluated in year order like a chained CASE.
    """
    ym = _col(ym_col)
    out = None
    for y in range(first, last + 1):
        cond = (ym >= F.lit(f"{y - 1}-{start_month}")) & (ym <= F.lit(f"{y}-{start_month - 1}"))
        out = F.when(cond, F.lit(y)) if out is None else out.when(cond, F.lit(y))
    return out.cast("int")


def fy_delivery_date(fy_col) -> Column:
    """``YYYY-01-01 00:00:00`` text for the delivery file (NULL FY -> ``NA-…``)."""
    fy = _col(fy_col).cast("string")
    return F.concat(F.coalesce(fy, F.lit("NA")), F.lit("-01-01 00:00:00"))


def fy_axis_date(fy_col) -> Column:
    """January 1st of the FY as a DATE, for chart axes."""
    return F.make_date(_col(fy_col).cast("int"), F.lit(1), F.lit(1))
