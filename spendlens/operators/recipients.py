"""Recipient identification: coarse ZIP filter -> active UEIs -> places.

Every step is a filtering join against a table that is small by nature
(city list, ZIP list, UEI list) or a hash aggregate; of the big transaction
table only the distinct UEIs are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.text import r_paste
from spendlens.operators.dedup import first_per_key
from spendlens.operators.joins import anti_join, semi_join

ADDRESS_PARTS = ("phys_address_01", "phys_address_02", "phys_address_city", "phys_address_st",
                 "phys_address_zip")


def city_zctas(crosswalk: DataFrame, places: DataFrame, place_geoid: str = "geoid_place",
               geoid: str = "geoid", zcta: str = "geoid_zcta") -> DataFrame:
    """Crosswalk rows of the listed cities, rows without a ZCTA dropped."""
    return (semi_join(crosswalk, places, place_geoid, geoid)
            .select(place_geoid, "name_place", zcta).dropna(subset=[zcta]))


def with_full_address(df: DataFrame, parts=ADDRESS_PARTS, out: str = "full_addy") -> DataFrame:
    """Address key, the parts joined by a blank and NULL printed as NA."""
    return df.withColumn(out, r_paste(*parts, sep=" "))


def coarse_recipients(registry: DataFrame, zctas: DataFrame, zip_col: str = "phys_address_zip",
                      zcta: str = "geoid_zcta", structure: str = "2A", country: str = "USA") -> DataFrame:
    """F1 + J2: government entities (``structure``) in ``country`` in a city ZIP."""
    f = registry.filter((F.col("entity_structure") == structure) & (F.col("phys_address_country") == country))
    return with_full_address(semi_join(f, zctas, zip_col, zcta))


def transaction_ueis(transactions: DataFrame, recipients: DataFrame, uei: str = "recipient_uei") -> DataFrame:
    """J3 + G1/U2: distinct UEIs of the transactions that belong to ``recipients``.

    The distinct comes first, as a partial aggregate in every scan task, so a
    UEI that owns a third of the transactions leaves each task as one row and
    the semi-join never shuffles raw transactions.
    """
    return semi_join(transactions.select(uei).distinct(), recipients, uei)


def active_recipients(recipients: DataFrame, ueis: DataFrame, uei: str = "recipient_uei") -> DataFrame:
    """Recipients with at least one transaction."""
    return semi_join(recipients, ueis, uei)


def inactive_recipients(recipients: DataFrame, ueis: DataFrame, uei: str = "recipient_uei") -> DataFrame:
    """Recipients without any transaction (a report)."""
    return anti_join(recipients, ueis, uei)


def recipients_in_places(recipients: DataFrame, located: DataFrame, key: str = "full_addy",
                         first_uei_only: bool = False, order_by: str = "ordinal") -> DataFrame:
    """D8 tail: UEIs whose geocoded address lies in a place.

    ``located`` holds (key, place_id, lat, long). By default every UEI at a
    located address is kept; ``first_uei_only`` keeps only the first UEI of an
    address as the reference's address dedup did.
    """
    r = first_per_key(recipients, key, order_by) if first_uei_only else recipients
    return r.join(located, key)


def uei_place(recipients_located: DataFrame, places: DataFrame, uei: str = "recipient_uei",
              place: str = "place_id", order_by: str = "ordinal",
              unique_ueis: bool = False) -> DataFrame:
    """One place row per UEI (first place row per place, first row per UEI).

    ``unique_ueis=True`` tells that the input already has one row per UEI
    (then the last dedup, a shuffle, is skipped).
    """
    first_place = first_per_key(places, place, "place_order").drop("ordinal", "place_order")
    j = recipients_located.select(uei, place, order_by).join(first_place, place)
    return j if unique_ueis else first_per_key(j, uei, order_by)
