"""The attribution method as one chain of lazy DataFrames.

    registry + crosswalk + places ─► coarse recipients (ZIP semi-join)
    transactions ─────────────────► active UEIs (semi-join, distinct)
    geocoder answers ─────────────► coordinates per address (cascade)
    boundaries ───────────────────► edges ─► point in polygon ─► UEI -> place
    UEI -> place + registry codes ► city-government UEIs (small side)
    transactions ⋈ small side ────► FY, amount <> 0, place of performance
                                 ─► spreading ─► annual totals / delivery

All recipient-level work happens on small tables. Two of them are barriers,
written once to the checkpoint folder: the located addresses and the recipient
side (one row for each located UEI with its place, state, registry attributes and
city-government reason). The second one's measured size decides whether the one
join with the transactions is a broadcast; after it come only hash aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.fiscal import fiscal_year, fiscal_year_as_coded
from spendlens.operators import deobligations as deob
from spendlens.operators import recipients as rec
from spendlens.operators.cover import PlaceIndex, point_in_cover
from spendlens.operators.dedup import first_per_key
from spendlens.operators.filters import flag_city_gov, match_place_of_performance
from spendlens.operators.geocode import geocode_cascade, ungeocoded
from spendlens.operators.joins import broadcast_if_small, semi_join
from spendlens.operators.nongov import nongov_totals, performed_in_city, with_recipient_kind
from spendlens.operators.spatial import point_in_polygon
from spendlens.plans.params import Params
from spendlens.session import written_copy
from spendlens.sources.checked_sink import CheckReport
from spendlens.sources.colocated import CoLocated
from spendlens.sources.geojson import parse_geojson_text, to_edges
from spendlens.sources.places import prepare_places


@dataclass
class Inputs:
    registry: DataFrame          # S1 columns + ordinal
    crosswalk: DataFrame         # geoid_place, name_place, geoid_zcta
    places_raw: DataFrame        # place_id, geoid_list, city, state_code, state, region, pop_21, ordinal
    boundaries: DataFrame        # place_id, geojson (text) -- or edges via ``edges``
    hits: DataFrame              # full_addy, provider, lat, long
    transactions: DataFrame      # id, recipient_uei, award_key, action_date, ym, amount, pop_state, ...
    blacklist: DataFrame | None = None
    edges: DataFrame | None = None
    malformed: dict[str, CheckReport] = field(default_factory=dict)   # of the files read strictly


# Registry attributes that go on with a recipient's transactions (those the registry has).
REGISTRY_ATTRIBUTES = ("entity_structure", "bus_type_counter", "bus_type_string", "primary_NAICS", "NAICS_code_counter",
                       "NAICS_code_string", "PSC_code_counter", "PSC_code_string")

# Columns of the filtered transactions that later outputs use.
FILTERED_COLUMNS = ("id", "recipient_uei", "award_key", "action_date", "ym", "fy", "amount", "pop_state",
                    "awarding_agency_name", "shard_year", "place_id", "city_label", "geoid", "pop_21", "reason",
                    "state", "state_code", "region", "names")


def _step(fn):
    """Build a step once per chain so shared sub-plans are the same objects."""
    name = fn.__name__

    def wrapper(self, *a, **kw):
        key = (name, a, tuple(sorted(kw.items())))
        if key not in self._memo:
            self._memo[key] = fn(self, *a, **kw)
        return self._memo[key]
    wrapper.__name__ = name
    wrapper.__doc__ = fn.__doc__
    return wrapper


class Chain:
    """Lazily built steps of the method; each step returns a DataFrame."""

    def __init__(self, inp: Inputs, params: Params):
        self.inp, self.p = inp, params
        self._memo: dict = {}

    # -- places and boundaries -------------------------------------------
    @_step
    def places(self) -> DataFrame:
        return prepare_places(self.inp.places_raw)

    @_step
    def edges(self) -> DataFrame:
        if self.inp.edges is not None:
            return self.inp.edges
        return to_edges(parse_geojson_text(self.inp.boundaries, "geojson", "place_id"))

    @_step
    def place_index(self) -> PlaceIndex:
        """The hierarchical cover of the places' boundaries."""
        return PlaceIndex.build(self.edges())

    # -- recipients -------------------------------------------------------
    @_step
    def city_zctas(self) -> DataFrame:
        return rec.city_zctas(self.inp.crosswalk, self.places())

    @_step
    def coarse(self) -> DataFrame:
        return rec.coarse_recipients(self.inp.registry, self.city_zctas(),
                                     structure=self.p.structure, country=self.p.country)

    @_step
    def coarse_first(self) -> DataFrame:
        return first_per_key(self.coarse(), "recipient_uei", "ordinal")

    @_step
    def txn_ueis(self) -> DataFrame:
        return rec.transaction_ueis(self.inp.transactions, self.coarse_first())

    @_step
    def active(self) -> DataFrame:
        return rec.active_recipients(self.coarse_first(), self.txn_ueis())

    @_step
    def inactive(self) -> DataFrame:
        return rec.inactive_recipients(self.coarse_first(), self.txn_ueis())

    @_step
    def addresses(self) -> DataFrame:
        return first_per_key(self.active(), "full_addy", "ordinal")

    @_step
    def coordinates(self) -> DataFrame:
        """Best geocode per address of the active recipients (the cascade report)."""
        return geocode_cascade(semi_join(self.inp.hits, self.addresses(), "full_addy"))

    @_step
    def ungeocoded_recipients(self) -> DataFrame:
        """Active recipients whose address no provider found: their money is in no place."""
        return ungeocoded(self.active(), geocode_cascade(self.inp.hits))

    @_step
    def located(self) -> DataFrame:
        """Barrier 1: addresses inside a place: full_addy, lat, long, provider, place_id, n_hits.

        Points are the addresses of every coarse recipient that has a geocode
        (a location depends on the address only), so the transaction side
        never has to be scanned first to decide which recipients to place.
        """
        asked = semi_join(self.inp.hits, self.coarse_first(), "full_addy")
        if self.p.spatial_index == "cover":
            found = point_in_cover(geocode_cascade(asked), self.place_index(), id_col="full_addy", x="long", y="lat",
                                   how="inner", broadcast_limit=self.p.broadcast_limit)
        else:
            found = point_in_polygon(geocode_cascade(asked), self.edges(), id_col="full_addy", x="long", y="lat",
                                     cell=self.p.cell, band=self.p.band, how="inner", broadcast_limit=self.p.broadcast_limit)
        return written_copy(found, "located")

    @_step
    def located_recipients(self) -> DataFrame:
        """Every coarse recipient (first row per UEI) whose address lies in a place."""
        return rec.recipients_in_places(self.coarse_first(), self.located().drop("provider"))

    @_step
    def recipients_in_city(self) -> DataFrame:
        """Recipients with transactions whose address lies in a place."""
        if self.p.first_uei_only:
            # as coded: only the first active UEI of each address goes on
            return rec.recipients_in_places(self.active(), self.located().drop("provider"), first_uei_only=True)
        return semi_join(self.located_recipients(), self.txn_ueis(), "recipient_uei")

    @_step
    def uei_place(self) -> DataFrame:
        """UEI -> place of the recipients with transactions."""
        if self.p.first_uei_only:
            return self.recipient_side()
        return semi_join(self.recipient_side(), self.txn_ueis(), "recipient_uei")

    @_step
    def registry_reduced(self) -> DataFrame:
        keep = [c for c in REGISTRY_ATTRIBUTES if c in self.inp.registry.columns]
        return first_per_key(self.inp.registry.select("recipient_uei", "ordinal", *keep), "recipient_uei", "ordinal",
                             keep_order_col=False)

    @_step
    def recipient_side(self) -> DataFrame:
        """Barrier 2: one row per located UEI, active or not (without transactions it adds nothing): place,
        state, registry attributes, code names and the reason if it is a city government."""
        located = self.recipients_in_city() if self.p.first_uei_only else self.located_recipients()
        # located holds one row per address and the recipients one per UEI: each UEI once
        up = rec.uei_place(located, self.places(), unique_ueis=True).select(
            "recipient_uei", "place_id", "city_label", "geoid", "pop_21", "state", "state_code", "region")
        flagged = flag_city_gov(self.registry_reduced(), code_map=self.p.code_map,
                                blacklist=self.inp.blacklist, mode=self.p.code_mode).drop("is_city_gov")
        return written_copy(up.join(flagged, "recipient_uei"), "recipient_side")

    # -- transactions -----------------------------------------------------
    def fy(self):
        if self.p.fy_mode == "as_coded":
            return fiscal_year_as_coded("ym", self.p.first_fy, self.p.last_fy)
        return fiscal_year("action_date")

    def _with_recipients(self, transactions: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
        return transactions.join(broadcast_if_small(side, self.p.broadcast_limit), "recipient_uei", how)

    @_step
    def txn_placed(self) -> DataFrame:
        up = self.recipient_side().select("recipient_uei", "place_id", "city_label", "geoid", "pop_21", "state", "state_code")
        return self._with_recipients(self.inp.transactions, up, self.p.placement_join).withColumn("fy", self.fy())

    @_step
    def txn_registry(self) -> DataFrame:
        """Transactions with place and all registry attributes: both come from the recipient side in one join."""
        side = self.recipient_side().drop("reason", "names")
        return self._with_recipients(self.inp.transactions, side, self.p.placement_join).withColumn("fy", self.fy())

    @_step
    def city_gov_ueis(self) -> DataFrame:
        """One row per city-government UEI with place and state."""
        return self.recipient_side().filter(F.col("reason").isNotNull())

    @_step
    def filtered(self) -> DataFrame:
        """``city_trans_filtered``: city-government transactions, FY, amount <> 0,
        performed in the recipient's state or unknown."""
        return self._filtered(self.inp.transactions)

    def _filtered(self, transactions: DataFrame) -> DataFrame:
        t = transactions.filter(F.col("amount") != 0)
        j = self._with_recipients(t, self.city_gov_ueis())
        out = match_place_of_performance(j.withColumn("fy", self.fy()))
        # Spark cannot prune columns below a written relation, so the rows are narrowed before that.
        return out.select(*[c for c in FILTERED_COLUMNS if c in out.columns])

    # -- outputs ----------------------------------------------------------
    @_step
    def annual_net_totals(self, place: str = "city_label") -> DataFrame:
        return deob.annual_net_totals(self.filtered(), first_fy=self.p.first_fy, mode=self.p.spread_mode,
                                      place=place)

    @_step
    def nongov_totals(self) -> DataFrame:
        """Money performed in a listed city by recipients that are no governments (needs ``pop_city``)."""
        t = self.inp.transactions.filter(F.col("amount") != 0)
        t = performed_in_city(t, self.places(), broadcast_limit=self.p.broadcast_limit).withColumn("fy", self.fy())
        t = with_recipient_kind(t, self.registry_reduced(), (self.p.structure,), self.p.broadcast_limit)
        return nongov_totals(t)

    def colocated_totals(self, by_award: CoLocated, place: str = "city_label") -> DataFrame:
        """The annual net totals from transactions stored by award: the awards' sums need no shuffle, only the places' do.

        The recipient side is broadcast while its measured size allows; beyond that its join shuffles as usual.
        """
        def spread(t: DataFrame) -> DataFrame:
            years = deob.award_year_totals(self._filtered(t), place=place)
            return deob.contributions_of(deob.profiles_of_years(years, place=place), self.p.first_fy, self.p.spread_mode, place=place)

        return deob.totals_of_parts(deob.place_year_parts(by_award.by_key(spread), place), place)
