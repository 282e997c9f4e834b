"""Data-quality rules, evaluated together in one aggregate pass.

The reference stops on the first failed assertion. Here every rule yields a
violation count (one row, one column per rule); ``assert_clean`` raises
when asked. Rules are parameters, because the reference's own allowed sets
leave out codes its code list has.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's registry checks.
UEI_PATTERN = "^[A-Z0-9]{12}$"
ENTITY_STRUCTURES = ("2A", "2F", "2R", "3I", "CY", "8H", "2L")
STATE_CODE_LENGTH = 2


@dataclass
class Rule:
    name: str
    column: str
    kind: str                     # regex | domain | length | not_null | true
    pattern: str | None = None
    allowed: tuple = field(default_factory=tuple)
    length: int | None = None

    def violation(self):
        c = F.col(self.column)
        if self.kind == "regex":       # V1: non-NULL values must match
            return c.isNotNull() & ~c.rlike(self.pattern)
        if self.kind == "domain":      # V2: NULL allowed, else in the set
            return c.isNotNull() & ~c.isin(list(self.allowed))
        if self.kind == "length":      # V3: non-NULL values of this length
            return c.isNotNull() & (F.length(c) != self.length)
        if self.kind == "not_null":    # V4
            return c.isNull()
        if self.kind == "true":        # J6 and others: a Boolean column that marks the rows
            return F.coalesce(c, F.lit(False))
        raise ValueError(f"unknown rule kind {self.kind}")


def registry_rules() -> list[Rule]:
    return [Rule("uei_format", "recipient_uei", "regex", pattern=UEI_PATTERN),
            Rule("entity_structure_domain", "entity_structure", "domain", allowed=ENTITY_STRUCTURES),
            Rule("state_code_length", "phys_address_st", "length", length=STATE_CODE_LENGTH)]


def transaction_rules() -> list[Rule]:
    """What the method needs of a transaction: without an award it belongs to no class."""
    return [Rule("award_key_missing", "award_key", "not_null")]


def check_quality(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: ``rows`` and one violation count per rule."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(r.violation()).alias(r.name) for r in rules]
    return df.agg(*aggs)


def null_counts(df: DataFrame, cols: list[str], total: str = "na_sum") -> DataFrame:
    """NULL count per column (``<col>_na_count``) and their sum."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"{c}_na_count") for c in cols]
    out = df.agg(*aggs)
    s = None
    for c in cols:
        s = F.col(f"{c}_na_count") if s is None else s + F.col(f"{c}_na_count")
    return out.withColumn(total, s)


def subset_violations(df: DataFrame, allowed: DataFrame, key: str, allowed_key: str | None = None) -> DataFrame:
    """Distinct keys of ``df`` that are missing from ``allowed`` (one row: count).

    The reference checks by eye that every transaction UEI belongs to the
    recipient set; here it is a left-anti join and a count that must be 0.
    """
    from spendlens.operators.joins import anti_join
    missing = anti_join(df.select(key).distinct(), allowed, key, allowed_key or key)
    return missing.agg(F.count(F.lit(1)).alias(f"{key}_missing"))


def assert_clean(counts: DataFrame, ignore: tuple = ("rows",)) -> None:
    """V4: raise when any count in the one-row result is above zero."""
    row = counts.first().asDict()
    bad = {k: v for k, v in row.items() if k not in ignore and v}
    if bad:
        raise AssertionError(f"data-quality violations: {bad}")
