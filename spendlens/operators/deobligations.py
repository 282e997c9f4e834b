"""Spreading deobligations (negative obligations) over the years of an award.

Every award of a place is one of three classes:

* ``none``      no negative transaction: its amounts count as they are;
* ``both``      negative and positive transactions: the negative total is
                divided by the number of fiscal years with a positive amount
                and charged to each of those years;
* ``only_neg``  only negative transactions: the total is divided over every
                year from ``first_fy`` to the award's last year.

Plan: two partial+final hash aggregates ((award, place, fy) then
(award, place)), a bounded per-award list of positive years (at most one
entry per fiscal year), a generator, and one tiny aggregate per (place, fy).
No join, no window, and no key can put more than a few rows in one group
after the map-side partial step, whatever the skew of the input.

Awards are classified per (award, place): an award in two places is charged
once in each place, never twice (the reference charged the whole award to
every place it touched).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("no_deobs", "deob_with_ob", "deob_without_ob")
SHARE = "DECIMAL(38,6)"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def share_sql(total: str, n: str) -> str:
    """``total / n`` rounded half-up to 6 decimals; NULL when n is 0 or NULL."""
    return (f"CAST(round(CASE WHEN {n} <> 0 THEN CAST({total} AS DECIMAL(28,2)) / CAST({n} AS INT) END, 6) "
            f"AS {SHARE})")


def money_out_sql(c: str) -> str:
    """Exact decimal -> rounded half away from zero to cents -> DOUBLE."""
    return f"CAST(round(CAST({c} AS {SHARE}), 2) AS DOUBLE)"


def award_year_totals(txn: DataFrame, award: str = "award_key", place: str = "city_label",
                      fy: str = "fy", amount: str = "amount") -> DataFrame:
    """One row per (award, place, fy) with the positive and negative sums."""
    a = _q(amount)
    return txn.groupBy(award, place, fy).agg(
        F.expr(f"sum(CASE WHEN {a} > 0 THEN {a} END)").alias("pos"),
        F.expr(f"sum(CASE WHEN {a} < 0 THEN {a} END)").alias("neg"))


def award_profile(txn: DataFrame, award: str = "award_key", place: str = "city_label",
                  fy: str = "fy", amount: str = "amount") -> DataFrame:
    """One row per (award, place): class, negative total, positive years.

    Columns: award, place, neg_total, n_pos_years, last_fy, pos_years (array
    of struct(fy, pos), at most one entry per fiscal year), award_class.
    """
    return profiles_of_years(award_year_totals(txn, award, place, fy, amount), award, place, fy)


def profiles_of_years(ayt: DataFrame, award: str = "award_key", place: str = "city_label", fy: str = "fy") -> DataFrame:
    """``award_profile`` from the totals by award, place and year."""
    prof = ayt.groupBy(award, place).agg(
        F.expr("sum(neg)").alias("neg_total"),
        F.expr("count(pos)").alias("n_pos_years"),
        F.expr(f"max({_q(fy)})").alias("last_fy"),
        F.expr(f"collect_list(CASE WHEN pos IS NOT NULL THEN named_struct('fy', {_q(fy)}, 'pos', pos) END)")
        .alias("pos_years"))
    return prof.selectExpr("*", "CASE WHEN neg_total IS NULL THEN 'none' WHEN n_pos_years > 0 THEN 'both' "
                                "ELSE 'only_neg' END AS award_class")


def award_class(txn: DataFrame, **cols) -> DataFrame:
    """The class of every (award, place) and the numbers that decide it."""
    award, place = cols.get("award", "award_key"), cols.get("place", "city_label")
    return award_profile(txn, **cols).select(
        award, place, "award_class", "neg_total", "n_pos_years", "last_fy")


def spread_contributions(txn: DataFrame, first_fy: int = 2017, mode: str = "documented",
                         award: str = "award_key", place: str = "city_label",
                         fy: str = "fy", amount: str = "amount") -> DataFrame:
    """Per-award yearly contributions after spreading.

    Columns: award, place, fy, kind, value (DECIMAL(38,6)). ``kind`` is one
    of ``KINDS``. ``mode='as_coded'`` also divides the positive yearly totals
    of a ``both`` award by its number of positive years, like the delivered
    code; the documented rule keeps them whole. An only-negative award whose
    last year is before ``first_fy`` is charged to that year alone, and one without
    any year to the NULL year, so no money is dropped.
    """
    return contributions_of(award_profile(txn, award, place, fy, amount), first_fy, mode, award, place, fy)


def contributions_of(prof: DataFrame, first_fy: int = 2017, mode: str = "documented", award: str = "award_key",
                     place: str = "city_label", fy: str = "fy") -> DataFrame:
    """``spread_contributions`` from the awards' profiles."""
    if mode not in ("documented", "as_coded"):
        raise ValueError("mode must be 'documented' or 'as_coded'")
    first = int(first_fy)
    neg_share = share_sql("neg_total", "n_pos_years")
    pos = f"CAST(e.pos AS {SHARE})" if mode == "documented" else share_sql("e.pos", "n_pos_years")
    lo = f"least({first}, last_fy)"
    entries = (
        "CASE "
        f"WHEN award_class = 'none' THEN transform(pos_years, e -> named_struct('fy', e.fy, 'kind', 'no_deobs', "
        f"'value', CAST(e.pos AS {SHARE}))) "
        f"WHEN award_class = 'both' THEN transform(pos_years, e -> named_struct('fy', e.fy, 'kind', 'deob_with_ob', "
        f"'value', CAST({pos} + {neg_share} AS {SHARE}))) "
        "WHEN last_fy IS NULL THEN array(named_struct('fy', last_fy, 'kind', 'deob_without_ob', "
        f"'value', CAST(neg_total AS {SHARE}))) "
        f"ELSE transform(sequence({lo}, last_fy), y -> named_struct('fy', y, 'kind', 'deob_without_ob', "
        f"'value', {share_sql('neg_total', f'(last_fy - {lo} + 1)')})) END")
    return (prof.selectExpr(_q(award), _q(place), f"explode({entries}) AS e")
            .selectExpr(_q(award), _q(place), f"e.fy AS {_q(fy)}", "e.kind AS kind", "e.value AS value"))


def place_year_parts(contrib: DataFrame, place: str = "city_label", fy: str = "fy") -> DataFrame:
    """Sum contributions by (place, fy) into one column per kind (missing = 0)."""
    aggs = [F.expr(f"coalesce(sum(CASE WHEN kind = '{k}' THEN value END), CAST(0 AS {SHARE}))").alias(k)
            for k in KINDS]
    return contrib.groupBy(place, fy).agg(*aggs)


def annual_net_totals(txn: DataFrame, first_fy: int = 2017, mode: str = "documented",
                      award: str = "award_key", place: str = "city_label",
                      fy: str = "fy", amount: str = "amount", as_double: bool = True) -> DataFrame:
    """Per (place, fy) the three parts and their total after spreading."""
    return totals_of_parts(place_year_parts(
        spread_contributions(txn, first_fy, mode, award, place, fy, amount), place, fy), place, fy, as_double)


def totals_of_parts(parts: DataFrame, place: str = "city_label", fy: str = "fy", as_double: bool = True) -> DataFrame:
    """The parts of each place and year with their total."""
    total = f"CAST(no_deobs + deob_with_ob + deob_without_ob AS {SHARE})"
    if not as_double:
        return parts.selectExpr("*", f"{total} AS total")
    return parts.selectExpr(_q(place), _q(fy), *[f"{money_out_sql(k)} AS {k}" for k in KINDS],
                            f"{money_out_sql(total)} AS total")


def spread_kind(txn: DataFrame, kind: str, first_fy: int = 2017, mode: str = "documented",
                award: str = "award_key", place: str = "city_label", fy: str = "fy",
                amount: str = "amount") -> DataFrame:
    """Per (place, fy) sum of one contribution kind (spread case 1 or 2)."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    c = spread_contributions(txn, first_fy, mode, award, place, fy, amount)
    return (c.filter(f"kind = '{kind}'").groupBy(place, fy)
            .agg(F.expr(money_out_sql("sum(value)")).alias(kind)))
