"""The whole method over real input files, with its sinks.

``load_inputs`` reads the reference's file layout (registry extract,
crosswalk, place metadata, boundary GeoJSON, geocoder answers, yearly
transaction shards); ``run`` builds every output as a lazy DataFrame and,
given an output folder, writes the sinks. Before the sinks only the two small
barriers of the chain, the checkpoint of the filtered rows and asked checks run.

The filtered transactions feed several outputs, so they are cut from their
lineage once (``checkpoint`` into the cluster's ``spark.checkpoint.dir``);
everything after that reads the checkpoint, not the shards again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators import deobligations as deob
from spendlens.operators.charts import chart_timeline, city_order
from spendlens.operators.delivery import delivery, place_fy_totals
from spendlens.operators.filters import NEVER_CITY_UEIS
from spendlens.operators.geocode import cache_misses, cascade_stats
from spendlens.operators.joins import semi_join
from spendlens.functions.text import geocoder_query
from spendlens.operators.quality import check_quality, registry_rules, transaction_rules
from spendlens.plans.attribution import Chain, Inputs
from spendlens.plans.incremental import IncrementalTotals
from spendlens.plans.params import Params
from spendlens.session import checkpoint_dir, cut_lineage, written_copy
from spendlens.sources import sinks
from spendlens.sources.business_types import code_map, read_business_types
from spendlens.sources.checked_sink import write_checked
from spendlens.sources.crosswalk import read_crosswalk
from spendlens.sources.geocode_cache import GeocodeCache, read_geocodes, with_provider
from spendlens.sources.geojson import places_without_edges, read_geojson_dir, to_edges
from spendlens.sources.key_reads import plan_keys, read_databases
from spendlens.sources.malformed import read_crosswalk_strict, read_places_strict, read_registry_strict
from spendlens.sources.registry import read_registry
from spendlens.sources.shards import read_parquet_shards
from spendlens.sources.snapshots import newest_snapshot, write_snapshot


@dataclass
class Paths:
    registry: str                   # pipe-delimited extract, no header
    crosswalk: str                  # ZCTA-place relationship file
    places: str                     # city metadata CSV
    boundaries: str                 # glob of GeoJSON files
    geocodes: str                   # full_addy, lat, long (+ provider when several): CSV, Parquet or a keyed cache
    transactions: str | Mapping[int, str]   # parquet base folder partitioned by shard_year, or one database URL for each year
    business_types: str | None = None
    blacklist: list[str] = field(default_factory=lambda: list(NEVER_CITY_UEIS))
    database_table: str = "transactions"
    database_properties: Mapping[str, str] = field(default_factory=dict)   # driver, user, password, fetchsize ...


def load_inputs(spark: SparkSession, paths: Paths, params: Params | None = None, checked_dir: str | None = None,
                max_malformed: int | None = 0, registry_fields: int = 142) -> tuple[Inputs, dict]:
    """Read every source; returns the inputs and the code lookup.

    Yearly databases are asked for the coarse recipients only (``key_reads``), which are known from the
    registry, the crosswalk and the places; ``params`` then names their structure and country.

    With ``checked_dir`` these three files are read strictly (``malformed``): rows that do not fit are kept there with
    their text, more than ``max_malformed`` of a file (None: any number) stop the job.
    """
    from spendlens.sources.places import read_city_places
    geoms = read_geojson_dir(spark, paths.boundaries)
    codes = code_map(read_business_types(spark, paths.business_types)) if paths.business_types else {}
    bl = (spark.createDataFrame([(u,) for u in paths.blacklist], "recipient_uei string")
          if paths.blacklist else None)
    hits = read_geocodes(spark, paths.geocodes)
    reports = {}
    if checked_dir:
        registry, reports["registry"] = read_registry_strict(spark, paths.registry, f"{checked_dir}/registry", registry_fields, max_malformed=max_malformed)
        crosswalk, reports["crosswalk"] = read_crosswalk_strict(spark, paths.crosswalk, f"{checked_dir}/crosswalk", max_malformed=max_malformed)
        places, reports["places"] = read_places_strict(spark, paths.places, f"{checked_dir}/places", max_malformed=max_malformed)
    else:
        registry, crosswalk = read_registry(spark, paths.registry), read_crosswalk(spark, paths.crosswalk)
        places = read_city_places(spark, paths.places)
    inp = Inputs(registry=registry, crosswalk=crosswalk, places_raw=places, malformed=reports, boundaries=geoms, hits=hits, transactions=None, blacklist=bl, edges=to_edges(geoms))
    if isinstance(paths.transactions, str):
        txns = read_parquet_shards(spark, paths.transactions)
    else:
        keys = written_copy(Chain(inp, params or Params()).coarse_first().select("recipient_uei"), "wanted_ueis")
        txns = read_databases(spark, paths.transactions, plan_keys(keys), keys, table=paths.database_table, properties=paths.database_properties)
    return replace(inp, transactions=txns), codes


def to_geocode(misses: DataFrame) -> DataFrame:
    """The list for the geocoder: address key and query string of each address that no answer covers yet."""
    return misses.select("full_addy", geocoder_query("phys_address_01", "phys_address_city", "phys_address_st",
                                                     "phys_address_zip").alias("query"))


class InputViolation(ValueError):
    """The inputs break a rule of the method; the message names the rules and counts."""


def violations(chain: Chain) -> dict[str, int]:
    """Counts of what the method stops on: registry rules, recipients without coordinates, places without boundary."""
    found = check_quality(chain.inp.registry, registry_rules()).first().asDict()
    found.pop("rows", None)
    found["ungeocoded_recipients"] = chain.ungeocoded_recipients().count()
    found["places_without_boundary"] = places_without_edges(chain.places(), chain.edges()).count()
    return found


def _kept(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Cut off from its lineage in the checkpoint folder, or kept where there is none."""
    return cut_lineage(df, spark) if checkpoint_dir(spark) else df.persist(StorageLevel.MEMORY_AND_DISK)


def run(spark: SparkSession, inp: Inputs, params: Params, out_dir: str | None = None,
        on_violation: str = "report", snapshot_base: str | None = None, snapshot_date: str | None = None,
        cache: GeocodeCache | None = None, answers: DataFrame | None = None,
        totals: IncrementalTotals | None = None, batch: str | None = None) -> dict[str, DataFrame]:
    """Build all outputs; write them under ``out_dir`` when given.

    ``on_violation="raise"`` stops before the transactions are read if the inputs
    break a rule; ``"report"`` goes on and leaves the rows in ``ungeocoded_recipients``,
    ``unbounded_places`` and ``registry_quality``. With ``snapshot_base`` and a date the placed
    transactions are dumped as that day's snapshot; with ``snapshot_base`` alone the
    newest complete one is read instead of the shards.

    ``on_violation="quarantine"`` writes the registry and the filtered transactions under ``out_dir``/checked by
    their rules, in the pass that reads them: rows that break one are left out and listed in ``quarantine_registry``
    and ``quarantine_transactions``, ``checks`` counts them.

    With a ``cache`` the geocodes are read from it in place of ``inp.hits``; ``answers`` (full_addy, lat, long,
    provider) that have come since the last run are added to it first. ``to_geocode`` then lists what is
    still to be asked: after a run that got all answers, nothing.

    With ``totals`` and a ``batch`` name the run's filtered transactions (a new shard's, say) are added to those
    running totals, once for each name, and ``running_totals`` holds all batches so far.
    """
    if (totals is None) != (batch is None):
        raise ValueError("running totals need the name of the batch")
    if on_violation not in ("report", "raise", "quarantine"):
        raise ValueError("on_violation must be 'report', 'raise' or 'quarantine'")
    if on_violation == "quarantine" and not out_dir:
        raise ValueError("quarantined rows need an out_dir")
    reports = {}
    if on_violation == "quarantine":
        reports["registry"] = write_checked(inp.registry, f"{out_dir}/checked/registry", registry_rules())
        inp = replace(inp, registry=reports["registry"].clean(spark))
    if answers is not None and cache is None:
        raise ValueError("answers need a cache to go into")
    if cache is not None:
        if answers is not None:
            cache.add(answers)
        inp = replace(inp, hits=with_provider(cache.read()))
    if snapshot_base and not snapshot_date:
        inp = replace(inp, transactions=newest_snapshot(spark, snapshot_base))
    chain = Chain(inp, params)
    if on_violation == "raise":
        broken = {k: v for k, v in violations(chain).items() if v}
        if broken:
            raise InputViolation(", ".join(f"{k}: {v}" for k, v in broken.items()))
    if snapshot_base and snapshot_date:
        placed = semi_join(inp.transactions, chain.recipient_side(), "recipient_uei")
        write_snapshot(placed, snapshot_base, snapshot_date)
    filtered = chain.filtered()
    # every output reads these rows: cut their lineage in the checkpoint folder, or keep them where there is none
    if on_violation == "quarantine":
        reports["transactions"] = write_checked(filtered, f"{out_dir}/checked/transactions", transaction_rules())
        filtered = reports["transactions"].clean(spark)
    else:
        filtered = _kept(filtered, spark)
    place = "city_label"
    contrib = deob.spread_contributions(filtered, params.first_fy, params.spread_mode, place="place_id")
    spread_totals = contrib.groupBy("place_id", "fy").agg(F.sum("value").alias("total"))
    out = {
        "recipients": chain.recipients_in_city(),
        "inactive_recipients": chain.inactive(),
        "award_class": deob.award_class(filtered, place=place),
        "annual_net_totals": deob.annual_net_totals(filtered, params.first_fy, params.spread_mode, place=place),
        "delivery": delivery(spread_totals, value="total"),
        "delivery_raw": delivery(place_fy_totals(filtered)),
        "chart_timeline": chart_timeline(filtered, place=place),
        "city_order": city_order(filtered, place=place),
        "registry_quality": check_quality(inp.registry, registry_rules()),
        "geocode_passes": cascade_stats(inp.hits),
        "ungeocoded_recipients": chain.ungeocoded_recipients(),
        "to_geocode": to_geocode(cache_misses(chain.addresses(), inp.hits)),
        "unbounded_places": places_without_edges(chain.places(), chain.edges()),
    }
    if "pop_city" in inp.transactions.columns:
        out["nongov_totals"] = chain.nongov_totals()
    out |= {f"malformed_{name}": r.quarantine(spark) for name, r in inp.malformed.items()}
    if reports:
        out["checks"] = spark.createDataFrame([(name, r.rows, r.quarantined, rule, n) for name, r in reports.items() for rule, n in r.counts.items()],
                                              "source string, rows bigint, quarantined bigint, rule string, violations bigint")
        out |= {f"quarantine_{name}": r.quarantine(spark) for name, r in reports.items()}
    if totals is not None:
        totals.apply(filtered, batch)
        out["running_totals"] = totals.totals()
    if out_dir:
        sinks.write_delivery_csv(out["delivery"], f"{out_dir}/delivery")
        sinks.write_table(out["chart_timeline"], f"{out_dir}/chart_timeline")
        sinks.write_table(out["annual_net_totals"], f"{out_dir}/annual_net_totals")
        sinks.write_table(out["recipients"].select("recipient_uei", "full_addy", "place_id", "lat", "long"),
                          f"{out_dir}/recipient_map", partition_by=["place_id"])
    return out
