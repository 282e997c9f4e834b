"""Federal money spent in cities by recipients that are no governments (the method's second question).

Such recipients are not placed by address (only government recipients are geocoded), so their money is attributed by
the place of performance: the state and the city's name as the award states them, normalised and looked up in the list of
places. A name that two listed places of a state share belongs to neither; it is reported (``ambiguous_names``).

The place list is small: both lookups are broadcast joins (size checked) and cut the transactions down to the listed cities
before anything is shuffled; the recipients' structure follows in one join, the sums are combined in each task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.joins import broadcast_if_small

GOVERNMENT_STRUCTURES = ("2A",)
# Kinds of municipalities, before or after a name.
KINDS = "CITY|TOWN|VILLAGE|BOROUGH|MUNICIPALITY|TOWNSHIP"
SHORT_FORMS = (("ST", "SAINT"), ("STE", "SAINTE"), ("FT", "FORT"), ("MT", "MOUNT"))


def name_key_sql(name: str) -> str:
    """The name in capitals, signs as single blanks, short forms written out, without ``CITY OF`` and its like before it."""
    out = f"trim(regexp_replace(upper({name}), '[^\\\\p{{L}}\\\\p{{N}}]+', ' '))"
    for short, long in SHORT_FORMS:
        out = f"regexp_replace({out}, '\\\\b{short}\\\\b', '{long}')"
    return f"nullif(regexp_replace({out}, '^({KINDS}) OF ', ''), '')"


def bare_key_sql(key: str) -> str:
    """A name key without the kind of municipality after it (``MESA CITY``); some names end so themselves (``IOWA CITY``)."""
    return f"regexp_replace({key}, ' ({KINDS})$', '')"


def place_names(places: DataFrame) -> DataFrame:
    """(state_key, name_key, bare): how the listed places may be written, with their number of places; states by name and by code."""
    named = (places.select("place_id", "city_label", "city", "state", "state_code").distinct()
             .selectExpr("place_id", "city_label", "explode(array_distinct(array(upper(state), upper(state_code)))) AS state_key", f"{name_key_sql('city')} AS k"))
    keys = named.selectExpr("*", f"explode(array(named_struct('bare', false, 'name_key', k), named_struct('bare', true, 'name_key', {bare_key_sql('k')}))) AS n")
    return (keys.filter("state_key IS NOT NULL AND n.name_key IS NOT NULL").groupBy("state_key", "n.name_key", "n.bare")
            .agg(F.countDistinct("place_id").alias("places"), F.min("place_id").alias("place_id"), F.min("city_label").alias("city_label")))


def ambiguous_names(places: DataFrame) -> DataFrame:
    """Whole names that several listed places of a state share."""
    return place_names(places).filter("NOT bare AND places > 1").select("state_key", "name_key", "places")


def performed_in_city(txn: DataFrame, places: DataFrame, city: str = "pop_city", state: str = "pop_state", broadcast_limit: int | None = None) -> DataFrame:
    """Transactions performed in a listed place, with ``place_id`` and ``city_label``: by the whole name, else by the bare one."""
    names = place_names(places).filter("places = 1")
    asked = txn.selectExpr("*", f"upper(trim(`{state}`)) AS state_key", f"{name_key_sql(f'`{city}`')} AS name_key")
    asked = asked.filter("state_key IS NOT NULL AND name_key IS NOT NULL").withColumn("bare_key", F.expr(bare_key_sql("name_key")))
    whole = names.filter("NOT bare").selectExpr("state_key", "name_key", "place_id AS p0", "city_label AS c0")
    bare = names.filter("bare").selectExpr("state_key", "name_key AS bare_key", "place_id AS p1", "city_label AS c1")
    out = (asked.join(broadcast_if_small(whole, broadcast_limit), ["state_key", "name_key"], "left")
           .join(broadcast_if_small(bare, broadcast_limit), ["state_key", "bare_key"], "left").filter("p0 IS NOT NULL OR p1 IS NOT NULL"))
    return out.selectExpr(*[f"`{c}`" for c in txn.columns], "coalesce(p0, p1) AS place_id", "CASE WHEN p0 IS NULL THEN c1 ELSE c0 END AS city_label")


def with_recipient_kind(txn: DataFrame, registry_first: DataFrame, government: Sequence[str] = GOVERNMENT_STRUCTURES,
                        broadcast_limit: int | None = None) -> DataFrame:
    """Add ``recipient_kind``: government, non_government, or unregistered (not in the registry, or without a structure)."""
    side = registry_first.select("recipient_uei", "entity_structure")
    listed = ", ".join(f"'{g}'" for g in government)
    kind = f"CASE WHEN entity_structure IN ({listed}) THEN 'government' WHEN entity_structure IS NULL THEN 'unregistered' ELSE 'non_government' END"
    joined = txn.drop("entity_structure").join(broadcast_if_small(side, broadcast_limit), "recipient_uei", "left")
    return joined.withColumn("recipient_kind", F.expr(kind)).drop("entity_structure")


def nongov_totals(txn: DataFrame) -> DataFrame:
    """Per city, fiscal year and kind: transactions, awards and the net amount of all that are no governments."""
    awards = (txn.filter("recipient_kind <> 'government'").groupBy("city_label", "fy", "recipient_kind", "award_key")
              .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n")))
    return awards.groupBy("city_label", "fy", "recipient_kind").agg(
        F.sum("n").alias("transactions"), F.count(F.lit(1)).alias("awards"), F.sum("amount").alias("total"))
