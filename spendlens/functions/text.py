"""Text helpers that follow R's ``paste`` rules.

R's ``paste`` prints a missing value as the two letters ``NA`` where Spark's
``concat_ws`` would skip it and ``concat`` would return NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def r_paste(*cols, sep: str = " ") -> Column:
    """``paste(a, b, ..., sep=sep)``: NULL parts become ``NA``."""
    if all(isinstance(c, str) for c in cols):
        parts = ", ".join(f"coalesce(CAST({_q(c)} AS STRING), 'NA')" for c in cols)
        return F.expr(f"concat_ws({_lit(sep)}, {parts})")
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("NA")) for c in cols])


def r_paste0(*parts) -> Column:
    """``paste0(...)``: strings name columns (pass ``F.lit`` for text); NULL prints ``NA``."""
    return F.concat(*[F.coalesce(_col(p).cast("string"), F.lit("NA")) for p in parts])


def city_label(city="city", state_code="state_code") -> Column:
    """``"<city>, <state code>"``, the label the reference joins on."""
    return F.concat(F.coalesce(_col(city), F.lit("NA")), F.lit(", "),
                    F.coalesce(_col(state_code), F.lit("NA")))


def geocoder_query(line1="phys_address_01", city="phys_address_city", state="phys_address_st",
                   zip_code="phys_address_zip") -> Column:
    """``"<street>, <city>, <state>, <zip>"`` for a geocoder (line 2 left out).

    Built like R's ``paste0`` with literal ", " between parts: a NULL part
    prints ``NA``.
    """
    return r_paste(line1, city, state, zip_code, sep=", ")
