"""Money arithmetic that gives the same digits on every run.

Amounts are DECIMAL(18,2); sums stay decimal so they do not depend on row
order. A share (amount / n) is rounded half-up to 6 places once, so sums of
shares are exact decimals too. Values become DOUBLE only at the output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
SHARE = "decimal(38,6)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return _col(c).cast(MONEY)


def share(total, n) -> Column:
    """``total / n`` rounded half-up to 6 decimals; NULL when n is 0 or NULL."""
    n = _col(n)
    q = F.when(n != 0, _col(total).cast("decimal(28,2)") / n.cast("int"))
    return F.round(q, 6).cast(SHARE)


def money_out(c, digits: int = 2) -> Column:
    """Round an exact decimal half away from zero, then hand out a DOUBLE."""
    return F.round(_col(c).cast(SHARE), digits).cast("double")


def million_label(c) -> Column:
    """``"12 M"``: amount in millions, accuracy 1 (half away from zero)."""
    return F.concat(F.round(_col(c).cast(SHARE) / F.lit(1000000), 0).cast("bigint").cast("string"),
                    F.lit(" M"))
