"""``distinct(k, .keep_all = TRUE)``: keep the whole first row per key.

``dropDuplicates`` keeps an arbitrary row, so "first" needs an explicit order
column. ``min_by`` runs as a hash aggregate with a map-side partial step, so a
key that owns a third of all rows is reduced in every task before the
shuffle instead of being sorted in one task as a window would be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def first_per_key(df: DataFrame, keys: str | Sequence[str], order_by: str,
                  keep_order_col: bool = True) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order_by``.

    ``order_by`` must be unique within a key (a file ordinal, a row id);
    NULL keys form one group, as in dplyr.
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in ks]
    packed = "struct(" + ", ".join(_q(c) for c in rest) + ")"
    agg = df.groupBy(*ks).agg(F.expr(f"min_by({packed}, {_q(order_by)})").alias("__row"))
    return agg.selectExpr(*[_q(k) for k in ks],
                          *[f"__row.{_q(c)} AS {_q(c)}" for c in rest if keep_order_col or c != order_by])


def distinct_values(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """``distinct(k)``: the distinct values of the given columns."""
    cs = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*cs).distinct()
