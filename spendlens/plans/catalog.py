"""Registered queries: one Spark plan and one SQL oracle per operator key.

Every Spark query starts from the driver's tables in ``sf_dir`` (through the
synthetic views) and returns a lazy DataFrame; ``oracle()`` gives the DuckDB
SQL that must return the same rows. Keys follow SURVEY §2.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.functions.codes import has_any_code, has_code, replace_codes, words_all_present
from spendlens.functions.fiscal import fiscal_year, fiscal_year_as_coded
from spendlens.functions.money import money_out
from spendlens.operators import deobligations as deob
from spendlens.operators.charts import chart_timeline, city_order
from spendlens.operators.cover import point_in_cover
from spendlens.operators.dedup import first_per_key
from spendlens.operators.delivery import delivery, place_fy_totals
from spendlens.operators.filters import EXCLUDE_CODES, INCLUDE_CODE, RECOVER_WORDS, flag_city_gov, \
    match_place_of_performance
from spendlens.operators.geocode import cache_misses, cascade_stats, update_cache
from spendlens.operators.extras import per_100k, top_agencies
from spendlens.operators.joins import anti_join, broadcast_if_small, null_safe_join, semi_join
from spendlens.operators.quality import Rule, check_quality, null_counts, registry_rules, subset_violations
from spendlens.operators.recipients import with_full_address
from spendlens.operators.sampling import sample_n
from spendlens.operators.spatial import point_in_polygon
from spendlens.plans import oracle as O
from spendlens.plans import synthetic as syn
from spendlens.plans.attribution import REGISTRY_ATTRIBUTES, Chain
from spendlens.plans.incremental import IncrementalTotals
from spendlens.plans.pipeline import to_geocode
from spendlens.session import shared_folder, tune_session, written_copy
from spendlens.sources.business_types import code_map, read_business_types
from spendlens.sources.checked_sink import mark_unknown, write_checked
from spendlens.sources.colocated import CoLocated
from spendlens.sources.crosswalk import CROSSWALK_COLUMNS, read_crosswalk
from spendlens.sources.geocode_cache import GeocodeCache, read_geocode_csv
from spendlens.sources.key_reads import plan_keys, read_frames
from spendlens.sources.malformed import read_registry_strict
from spendlens.sources.places import PLACE_COLUMNS, prepare_places, read_city_places
from spendlens.sources.registry import parse_registry_lines, read_registry
from spendlens.sources.shards import union_shards
from spendlens.sources.snapshots import date_in_name, latest_snapshot, newest_snapshot, write_snapshot

_CHAINS: dict = {}


def chain(spark: SparkSession, d: str, **params) -> Chain:
    """One chain per (session, folder, params): its steps are shared by queries."""
    key = (spark.sparkContext.applicationId, id(spark), d, tuple(sorted(params.items())))
    if key not in _CHAINS:
        tune_session(spark)
        _CHAINS[key] = Chain(syn.inputs(spark, d), syn.test_params(**params))
    return _CHAINS[key]


def forget_chains() -> None:
    """Drop the shared chains: the next query builds its steps anew."""
    _CHAINS.clear()
    _COLOCATED.clear()
    syn._READS.clear()


Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
S: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            S[name] = sql
        return fn
    return deco


W = O.with_views

# ---------------------------------------------------------------- sources
register("geo_edges", W("SELECT * FROM edges", ["edges"]))(
    lambda spark, d: chain(spark, d).edges())


@register("place_meta", W("""
SELECT e.place_id, e.n_edges, p.city_label, p.pop_21
FROM (SELECT place_id, count(*) AS n_edges FROM edges GROUP BY place_id) e
LEFT JOIN place_first p ON e.place_id = p.place_id""", ["edges", "place_first"]))
def _place_meta(spark, d):
    c = chain(spark, d)
    geo = c.edges().groupBy("place_id").agg(F.count("*").alias("n_edges"))
    first = first_per_key(c.places(), "place_id", "place_order").select("place_id", "city_label", "pop_21")
    return geo.join(first, "place_id", "left")


@register("shard_union", W("SELECT id, shard_year, CAST(amount AS DOUBLE) AS amount FROM transactions",
                           ["transactions"]))
def _shard_union(spark, d):
    # one source for each fiscal year and one for the undated rows
    return union_shards(list(syn.yearly_shards(spark, d).values())).withColumn("amount", F.col("amount").cast("double"))


_WANTED_SQL = W("""SELECT id, recipient_uei, CAST(amount AS DOUBLE) AS amount, shard_year FROM transactions
WHERE recipient_uei IN (SELECT recipient_uei FROM coarse_first)""", ["transactions", "coarse_first"])


def _key_reads(spark, d, **limits):
    """The yearly shards read through a key plan of the coarse recipients."""
    keys = written_copy(chain(spark, d).coarse_first().select("recipient_uei"), "coarse_ueis")
    found = read_frames(syn.yearly_shards(spark, d, keyed=True), plan_keys(keys, **limits), keys)
    return found.withColumn("amount", F.col("amount").cast("double"))


register("shard_key_literals", _WANTED_SQL)(lambda spark, d: _key_reads(spark, d))
# more keys than the limit: ranges and a semi-join
register("shard_key_ranges", _WANTED_SQL)(lambda spark, d: _key_reads(spark, d, max_keys=10, ranges=16))


@register("latest_snapshot", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS snapshot_date FROM orders
WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""")
def _latest(spark, d):
    o = syn._t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("snapshot_date"))
    return latest_snapshot(o, "snapshot_date")


# ---------------------------------------------------------- projections
register("address_key", W(f"SELECT recipient_uei, ordinal, {O._ADDR} AS full_addy FROM registry", ["registry"]))(
    lambda spark, d: with_full_address(chain(spark, d).inp.registry).select("recipient_uei", "ordinal", "full_addy"))

register("city_label", W("SELECT place_id, city || ', ' || state_code AS city_label FROM places_raw", ["places_raw"]))(
    lambda spark, d: chain(spark, d).places().select("place_id", "city_label").distinct())

register("geoid_explode", W("SELECT place_id, geoid, place_order FROM places", ["places"]))(
    lambda spark, d: chain(spark, d).places().select("place_id", "geoid", "place_order"))

register("fiscal_year", W(f"SELECT id, action_date, {O.FY_SQL} AS fy FROM transactions", ["transactions"]))(
    lambda spark, d: chain(spark, d).inp.transactions.select("id", "action_date", fiscal_year("action_date").alias("fy")))

register("fiscal_year_as_coded", W(f"SELECT id, ym, {O.fy_as_coded_sql()} AS fy FROM transactions", ["transactions"]))(
    lambda spark, d: chain(spark, d).inp.transactions.select(
        "id", "ym", fiscal_year_as_coded("ym", syn.FIRST_FY, syn.LAST_FY).alias("fy")))

# -------------------------------------------------------------- filters
register("coarse_recipients", W("SELECT recipient_uei, ordinal, full_addy FROM coarse", ["coarse"]))(
    lambda spark, d: chain(spark, d).coarse().select("recipient_uei", "ordinal", "full_addy"))

register("biz_include", W("""SELECT recipient_uei, bus_type_string FROM registry_first
WHERE list_contains(string_split(bus_type_string, '~'), '12')""", ["registry_first"]))(
    lambda spark, d: chain(spark, d).registry_reduced().filter(has_code("bus_type_string", INCLUDE_CODE))
    .select("recipient_uei", "bus_type_string"))

register("biz_exclude", W("""SELECT recipient_uei, bus_type_string FROM registry_first
WHERE list_contains(string_split(bus_type_string, '~'), '12')
  AND NOT list_has_any(string_split(bus_type_string, '~'), ['C7', '2F', 'OH'])""", ["registry_first"]))(
    lambda spark, d: chain(spark, d).registry_reduced()
    .filter(has_code("bus_type_string", INCLUDE_CODE) & ~has_any_code("bus_type_string", EXCLUDE_CODES))
    .select("recipient_uei", "bus_type_string"))

register("replace_codes", W("""SELECT r.recipient_uei, n.names FROM registry_first r
LEFT JOIN names n ON r.recipient_uei = n.recipient_uei""", ["registry_first", "names"]))(
    lambda spark, d: chain(spark, d).registry_reduced().select(
        "recipient_uei", replace_codes("bus_type_string", syn.CODE_NAMES).alias("names")))

register("both_words", W("""SELECT recipient_uei, names FROM names
WHERE lower(names) LIKE '%city%' AND lower(names) LIKE '%county%'""", ["names"]))(
    lambda spark, d: chain(spark, d).registry_reduced()
    .select("recipient_uei", replace_codes("bus_type_string", syn.CODE_NAMES).alias("names"))
    .filter(words_all_present("names", RECOVER_WORDS)))

register("blacklist_anti", W("""SELECT recipient_uei FROM registry_first
WHERE recipient_uei NOT IN (SELECT recipient_uei FROM blacklist)""", ["registry_first", "blacklist"]))(
    lambda spark, d: anti_join(chain(spark, d).registry_reduced(), chain(spark, d).inp.blacklist,
                               "recipient_uei").select("recipient_uei"))

register("biz_union", W("SELECT recipient_uei, reason FROM flags WHERE reason IS NOT NULL", ["flags"]))(
    lambda spark, d: flag_city_gov(chain(spark, d).registry_reduced(), code_map=syn.CODE_NAMES,
                                   blacklist=chain(spark, d).inp.blacklist)
    .filter("is_city_gov").select("recipient_uei", "reason"))


@register("pop_match", W("""
SELECT t.id, t.pop_state FROM transactions t JOIN uei_place u ON t.recipient_uei = u.recipient_uei
WHERE t.pop_state = upper(u.state) OR t.pop_state = u.state_code OR t.pop_state IS NULL""", ["transactions", "uei_place"]))
def _pop_match(spark, d):
    return match_place_of_performance(chain(spark, d).txn_placed()).select("id", "pop_state")


register("city_gov_filter", W("""SELECT id, recipient_uei, city_label, fy, CAST(amount AS DOUBLE) AS amount, reason
FROM filtered""", ["filtered"]))(
    lambda spark, d: chain(spark, d).filtered().select(
        "id", "recipient_uei", "city_label", "fy", F.col("amount").cast("double").alias("amount"), "reason"))

# ---------------------------------------------------------------- joins
register("zcta_semi", W("SELECT * FROM city_zctas", ["city_zctas"]))(
    lambda spark, d: chain(spark, d).city_zctas())

register("txn_semi", W("""SELECT id, recipient_uei, CAST(amount AS DOUBLE) AS amount FROM transactions
WHERE recipient_uei IN (SELECT recipient_uei FROM coarse_first)""", ["transactions", "coarse_first"]))(
    lambda spark, d: semi_join(chain(spark, d).inp.transactions, broadcast_if_small(
        written_copy(chain(spark, d).coarse_first().select("recipient_uei"), "coarse_ueis")), "recipient_uei")
    .select("id", "recipient_uei", F.col("amount").cast("double").alias("amount")))

register("txn_ueis", W("SELECT recipient_uei FROM txn_ueis", ["txn_ueis"]))(
    lambda spark, d: chain(spark, d).txn_ueis())

register("active_recipients", W("SELECT recipient_uei, full_addy FROM active", ["active"]))(
    lambda spark, d: chain(spark, d).active().select("recipient_uei", "full_addy"))

register("inactive_recipients", W("""SELECT recipient_uei, full_addy FROM coarse_first
WHERE recipient_uei NOT IN (SELECT recipient_uei FROM txn_ueis)""", ["coarse_first", "txn_ueis"]))(
    lambda spark, d: chain(spark, d).inactive().select("recipient_uei", "full_addy"))

register("first_per_key", W("""SELECT recipient_uei, ordinal, recipient_name, phys_address_01, bus_type_string
FROM registry_first""", ["registry_first"]))(
    lambda spark, d: first_per_key(chain(spark, d).inp.registry, "recipient_uei", "ordinal")
    .select("recipient_uei", "ordinal", "recipient_name", "phys_address_01", "bus_type_string"))

register("first_per_address", W("SELECT full_addy, recipient_uei, ordinal FROM addresses", ["addresses"]))(
    lambda spark, d: chain(spark, d).addresses().select("full_addy", "recipient_uei", "ordinal"))


@register("cache_misses", W("""SELECT full_addy, recipient_uei FROM addresses
WHERE full_addy NOT IN (SELECT full_addy FROM geocode_cache)""", ["addresses", "geocode_cache"]))
def _cache_misses(spark, d):
    c = chain(spark, d)
    return cache_misses(c.addresses(), syn.geocode_cache(spark, d)).select("full_addy", "recipient_uei")


_PIP_SQL = W(f"""
SELECT p.vec_id, p.px, p.py, h.place_id, COALESCE(h.n_hits, 0) AS n_hits FROM emb_points p LEFT JOIN (
  SELECT pid, min(place_id) AS place_id, count(*) AS n_hits
  FROM ({O._pip('emb_points', 'vec_id', 'px', 'py')}) WHERE n_cross % 2 = 1 OR on_edge = 1 GROUP BY pid
) h ON p.vec_id = h.pid""", ["emb_points", "edges"])


@register("point_in_polygon", _PIP_SQL)
def _pip(spark, d):
    c = chain(spark, d)
    pts = syn.embedding_points(spark, d)
    return point_in_polygon(pts, c.edges(), id_col="vec_id", x="px", y="py", cell=0.25, band=0.125)


@register("point_in_cover", _PIP_SQL)
def _pip_cover(spark, d):
    """The same points by the quadtree cover of the places."""
    return point_in_cover(syn.embedding_points(spark, d), chain(spark, d).place_index(), id_col="vec_id", x="px", y="py")


register("recipients_by_cover", W("SELECT recipient_uei, full_addy, place_id, lat, long FROM recipients_in_city", ["recipients_in_city"]))(
    lambda spark, d: chain(spark, d, spatial_index="cover").recipients_in_city().select("recipient_uei", "full_addy", "place_id", "lat", "long"))

register("recipients_in_city", W("SELECT recipient_uei, full_addy, place_id, lat, long FROM recipients_in_city",
                                 ["recipients_in_city"]))(
    lambda spark, d: chain(spark, d).recipients_in_city().select("recipient_uei", "full_addy", "place_id", "lat", "long"))

register("recipients_in_city_first_uei", W("""SELECT a.recipient_uei, a.full_addy, l.place_id, l.lat, l.long
FROM addresses a JOIN located l ON a.full_addy = l.full_addy""", ["addresses", "located"]))(
    lambda spark, d: chain(spark, d, first_uei_only=True).recipients_in_city()
    .select("recipient_uei", "full_addy", "place_id", "lat", "long"))

register("uei_place", W("SELECT recipient_uei, place_id, city_label, geoid, pop_21 FROM uei_place", ["uei_place"]))(
    lambda spark, d: chain(spark, d).uei_place().select("recipient_uei", "place_id", "city_label", "geoid", "pop_21"))

register("txn_placed", W(f"""SELECT t.id, t.recipient_uei, u.place_id, u.city_label, {O.FY_SQL} AS fy,
CAST(t.amount AS DOUBLE) AS amount FROM transactions t JOIN uei_place u ON t.recipient_uei = u.recipient_uei""",
                         ["transactions", "uei_place"]))(
    lambda spark, d: chain(spark, d).txn_placed().select(
        "id", "recipient_uei", "place_id", "city_label", "fy", F.col("amount").cast("double").alias("amount")))

register("txn_registry", W(f"""SELECT t.id, t.recipient_uei, u.place_id, p.region, {', '.join('r.' + c for c in REGISTRY_ATTRIBUTES)}
FROM transactions t JOIN uei_place u ON t.recipient_uei = u.recipient_uei
JOIN registry_first r ON t.recipient_uei = r.recipient_uei JOIN place_first p ON u.place_id = p.place_id""",
                           ["transactions", "uei_place", "registry_first", "place_first"]))(
    lambda spark, d: chain(spark, d).txn_registry().select(
        "id", "recipient_uei", "place_id", "region", *REGISTRY_ATTRIBUTES))

# ---------------------------------------------------- geocoding, quality
register("geocode_cascade", W("SELECT * FROM coordinates", ["coordinates"]))(
    lambda spark, d: chain(spark, d).coordinates())

register("cascade_stats", W("""
SELECT provider, CAST(count(*) AS BIGINT) AS asked, CAST(sum(ok) AS BIGINT) AS found,
       CAST(count(*) - sum(ok) AS BIGINT) AS missed
FROM (SELECT provider, full_addy, max(CASE WHEN lat IS NOT NULL AND long IS NOT NULL THEN 1 ELSE 0 END) AS ok
      FROM provider_hits GROUP BY provider, full_addy) GROUP BY provider""", ["provider_hits"]))(
    lambda spark, d: cascade_stats(chain(spark, d).inp.hits))

register("null_counts", W("""
SELECT CAST(count_if(c.lat IS NULL) AS BIGINT) AS lat_na_count, CAST(count_if(c.long IS NULL) AS BIGINT) AS long_na_count,
       CAST(count_if(c.lat IS NULL) + count_if(c.long IS NULL) AS BIGINT) AS na_sum
FROM addresses a LEFT JOIN coordinates c ON a.full_addy = c.full_addy""", ["addresses", "coordinates"]))(
    lambda spark, d: null_counts(chain(spark, d).addresses().select("full_addy")
                                 .join(chain(spark, d).coordinates(), "full_addy", "left"), ["lat", "long"]))

_DQ = {"dq_regex": ("uei_format", "recipient_uei IS NOT NULL AND NOT regexp_full_match(recipient_uei, '[A-Z0-9]{12}')"),
       "dq_domain": ("entity_structure_domain",
                     "entity_structure IS NOT NULL AND entity_structure NOT IN ('2A','2F','2R','3I','CY','8H','2L')"),
       "dq_length": ("state_code_length", "phys_address_st IS NOT NULL AND length(phys_address_st) <> 2")}
for _key, (_rule, _cond) in _DQ.items():
    register(_key, W(f"SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count_if({_cond}) AS BIGINT) AS {_rule} FROM registry",
                     ["registry"]))(
        (lambda rule: lambda spark, d: check_quality(
            chain(spark, d).inp.registry, [r for r in registry_rules() if r.name == rule]))(_rule))

# ------------------------------------------------- spreading and totals
register("award_class", W("""SELECT award_key, city_label, award_class, CAST(ROUND(neg_total, 2) AS DOUBLE) AS neg_total,
n_pos_years, last_fy FROM prof""", ["prof"]))(
    lambda spark, d: deob.award_class(chain(spark, d).filtered())
    .withColumn("neg_total", money_out("neg_total")).withColumn("last_fy", F.col("last_fy").cast("int")))

register("year_expand", W("""SELECT award_key, city_label, fy, CAST(ROUND(value, 2) AS DOUBLE) AS value FROM contrib
WHERE kind = 'deob_without_ob'""", ["contrib"]))(
    lambda spark, d: deob.spread_contributions(chain(spark, d).filtered(), syn.FIRST_FY)
    .filter(F.col("kind") == "deob_without_ob").select("award_key", "city_label", "fy", money_out("value").alias("value")))

for _key, _kind, _view, _mode in (("spread_case1", "deob_without_ob", "contrib", "documented"),
                                  ("spread_case2", "deob_with_ob", "contrib", "documented"),
                                  ("spread_case2_as_coded", "deob_with_ob", "contrib_as_coded", "as_coded")):
    register(_key, W(f"""SELECT city_label, fy, CAST(ROUND(SUM(value), 2) AS DOUBLE) AS {_kind} FROM {_view}
WHERE kind = '{_kind}' GROUP BY city_label, fy""", [_view]))(
        (lambda kind, mode: lambda spark, d: deob.spread_kind(chain(spark, d).filtered(), kind, syn.FIRST_FY, mode))(
            _kind, _mode))

register("annual_net_totals", W(O.ANNUAL_SQL, ["contrib"]))(
    lambda spark, d: chain(spark, d).annual_net_totals())


register("annual_net_totals_fy_as_coded", W(O.ANNUAL_SQL.replace("FROM contrib ", "FROM contrib_fyc "), ["contrib_fyc"]))(
    lambda spark, d: chain(spark, d, fy_mode="as_coded").annual_net_totals())


_COLOCATED: dict = {}


def _stored(spark, d, key: str) -> CoLocated:
    """The transactions stored by ``key``, once for each session and folder."""
    at = (spark.sparkContext.applicationId, id(spark), d, key)
    if at not in _COLOCATED:
        _COLOCATED[at] = CoLocated.write(chain(spark, d).inp.transactions, f"{shared_folder(spark)}/by-{key}-{uuid.uuid4().hex}", key)
    return _COLOCATED[at]


register("colocated_totals", W(O.ANNUAL_SQL, ["contrib"]))(
    lambda spark, d: chain(spark, d).colocated_totals(_stored(spark, d, "award_key")))


@register("colocated_join", W("""SELECT t.id, t.recipient_uei, u.place_id, CAST(t.amount AS DOUBLE) AS amount
FROM transactions t JOIN uei_place u ON t.recipient_uei = u.recipient_uei""", ["transactions", "uei_place"]))
def _colocated_join(spark, d):
    """Transactions and recipients, both stored by recipient: a join without a shuffle."""
    side = chain(spark, d).recipient_side().select("recipient_uei", "place_id")
    stored = _stored(spark, d, "recipient_uei")
    by_uei = CoLocated.write(side, f"{shared_folder(spark)}/recipients-{uuid.uuid4().hex}", "recipient_uei", stored.n_buckets)
    return stored.join(by_uei).select("id", "recipient_uei", "place_id", F.col("amount").cast("double").alias("amount"))


@register("incremental_totals", W(O.ANNUAL_SQL, ["contrib"]))
def _incremental(spark, d):
    """The totals by batches: early years (every tenth amount doubled by mistake), the others, then the correction."""
    rows = written_copy(chain(spark, d).filtered().select("id", "award_key", "city_label", "fy", "shard_year", "amount"), "filtered")
    wrong = rows.withColumn("amount", F.when(F.col("id") % 10 == 0, F.col("amount") * 2).otherwise(F.col("amount")))
    early = F.coalesce(F.col("shard_year") < 1998, F.lit(False))
    t = IncrementalTotals(spark, f"{shared_folder(spark)}/totals-{uuid.uuid4().hex}", syn.FIRST_FY, n_buckets=16)
    t.apply(wrong.filter(early), "to 1997")
    t.apply(rows.filter(~early), "from 1998")
    t.apply(rows.filter(early).filter("id % 10 = 0"), "correction", removed=wrong.filter(early).filter("id % 10 = 0"))
    return t.totals()


@register("full_outer_totals", W(O.ANNUAL_SQL, ["contrib"]))
def _full_outer(spark, d):
    c = deob.spread_contributions(chain(spark, d).filtered(), syn.FIRST_FY)
    parts = [c.filter(F.col("kind") == k).groupBy("city_label", "fy").agg(F.sum("value").alias(k))
             for k in deob.KINDS]
    j = null_safe_join(null_safe_join(parts[0], parts[1], ["city_label", "fy"], "full"),
                       parts[2], ["city_label", "fy"], "full")
    filled = [F.coalesce(F.col(k), F.lit(0)).alias(k) for k in deob.KINDS]
    j = j.select("city_label", "fy", *filled)
    return j.select("city_label", "fy", *[money_out(k).alias(k) for k in deob.KINDS],
                    money_out(F.col("no_deobs") + F.col("deob_with_ob") + F.col("deob_without_ob")).alias("total"))


register("place_fy_totals", W("""SELECT place_id, fy, CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS total_obligations
FROM filtered GROUP BY place_id, fy""", ["filtered"]))(
    lambda spark, d: place_fy_totals(chain(spark, d).filtered()))

register("delivery", W("""SELECT coalesce(CAST(fy AS VARCHAR), 'NA') || '-01-01 00:00:00' AS date,
CASE WHEN t >= 0 THEN t END AS value, place_id, '' AS category_id
FROM (SELECT place_id, fy, CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS t FROM filtered GROUP BY place_id, fy)""",
                       ["filtered"]))(
    lambda spark, d: delivery(place_fy_totals(chain(spark, d).filtered())))


@register("delivery_spread", W("""
SELECT coalesce(CAST(fy AS VARCHAR), 'NA') || '-01-01 00:00:00' AS date, CASE WHEN t >= 0 THEN t END AS value, place_id,
       '' AS category_id
FROM (SELECT f.place_id, c.fy, CAST(ROUND(SUM(c.value), 2) AS DOUBLE) AS t
      FROM contrib c JOIN (SELECT DISTINCT city_label, place_id FROM filtered) f ON c.city_label = f.city_label
      GROUP BY f.place_id, c.fy)""", ["contrib", "filtered"]))
def _delivery_spread(spark, d):
    c = chain(spark, d)
    contrib = deob.spread_contributions(c.filtered(), syn.FIRST_FY, place="place_id")
    tot = contrib.groupBy("place_id", "fy").agg(money_out(F.sum("value")).alias("total"))
    return delivery(tot, value="total")


register("city_order", W("""SELECT city_label, CAST(ROUND(t, 2) AS DOUBLE) AS total,
row_number() OVER (ORDER BY t DESC, city_label) AS city_rank
FROM (SELECT city_label, SUM(amount) AS t FROM filtered GROUP BY city_label)""", ["filtered"]))(
    lambda spark, d: city_order(chain(spark, d).filtered()).withColumn("city_rank", F.col("city_rank").cast("bigint")))

register("chart_timeline", W("""
SELECT p.city_label, p.fy, make_date(p.fy, 1, 1) AS axis_date, CAST(ROUND(p.t, 2) AS DOUBLE) AS total,
       CAST(CAST(ROUND(p.t / 1000000, 0) AS BIGINT) AS VARCHAR) || ' M' AS label_m, o.city_rank, p.t >= 0 AS in_axis
FROM (SELECT city_label, fy, SUM(amount) AS t FROM filtered GROUP BY city_label, fy) p
JOIN (SELECT city_label, row_number() OVER (ORDER BY SUM(amount) DESC, city_label) AS city_rank
      FROM filtered GROUP BY city_label) o ON p.city_label = o.city_label""", ["filtered"]))(
    lambda spark, d: chart_timeline(chain(spark, d).filtered()).withColumn("city_rank", F.col("city_rank").cast("bigint")))

register("sample_n", W("""SELECT recipient_uei, full_addy, place_id FROM recipients_in_city
ORDER BY md5('42~' || recipient_uei), recipient_uei LIMIT 100""", ["recipients_in_city"]))(
    lambda spark, d: sample_n(chain(spark, d).recipients_in_city().select("recipient_uei", "full_addy", "place_id"),
                              100, "recipient_uei"))

register("ungeocoded_recipients", W("""SELECT recipient_uei, full_addy FROM active
WHERE full_addy NOT IN (SELECT full_addy FROM coordinates)""", ["active", "coordinates"]))(
    lambda spark, d: chain(spark, d).ungeocoded_recipients().select("recipient_uei", "full_addy"))

register("to_geocode", W("""SELECT full_addy, COALESCE(phys_address_01, 'NA') || ', ' || COALESCE(phys_address_city, 'NA') || ', '
|| COALESCE(phys_address_st, 'NA') || ', ' || COALESCE(phys_address_zip, 'NA') AS query FROM addresses
WHERE full_addy NOT IN (SELECT full_addy FROM geocode_cache)""", ["addresses", "geocode_cache"]))(
    lambda spark, d: to_geocode(cache_misses(chain(spark, d).addresses(), syn.geocode_cache(spark, d))))

register("cache_union", W("""SELECT full_addy, lat, long FROM geocode_cache
UNION ALL SELECT full_addy, lat, long FROM coordinates WHERE full_addy NOT IN (SELECT full_addy FROM geocode_cache)""",
                          ["geocode_cache", "coordinates"]))(
    lambda spark, d: update_cache(syn.geocode_cache(spark, d), chain(spark, d).coordinates()))

_CACHED_SQL = W("""SELECT full_addy, lat, long FROM (
  SELECT *, row_number() OVER (PARTITION BY full_addy ORDER BY lat, long) AS rn FROM geocode_cache) WHERE rn = 1
UNION ALL SELECT full_addy, lat, long FROM coordinates WHERE full_addy NOT IN (SELECT full_addy FROM geocode_cache)""",
                ["geocode_cache", "coordinates"])


@register("keyed_cache", _CACHED_SQL)
def _keyed_cache(spark, d):
    """The earlier cache, then the run's answers (twice: the second time adds nothing), in a keyed cache."""
    cache = GeocodeCache(spark, f"{shared_folder(spark)}/geocode-cache-{uuid.uuid4().hex}", n_buckets=16)
    answers = written_copy(chain(spark, d).coordinates(), "answers")
    cache.add(syn.geocode_cache(spark, d))
    cache.add(answers)
    cache.add(answers)
    return cache.read()


@register("geocode_csv", W("SELECT full_addy, provider, lat, long FROM provider_hits", ["provider_hits"]))
def _geocode_csv(spark, d):
    """Geocoder answers written as a CSV cache (NA for missing) and read back."""
    path = f"{shared_folder(spark)}/geocodes-{uuid.uuid4().hex}.csv"
    chain(spark, d).inp.hits.withColumn("note", F.lit('a "b", c')).write.options(header=True, nullValue="NA", quote='"', escape='"').csv(path)
    return read_geocode_csv(spark, path)


register("subset_violations", W("""SELECT CAST(count(DISTINCT recipient_uei) AS BIGINT) AS recipient_uei_missing FROM transactions
WHERE recipient_uei NOT IN (SELECT recipient_uei FROM coarse_first)""", ["transactions", "coarse_first"]))(
    lambda spark, d: subset_violations(chain(spark, d).inp.transactions, chain(spark, d).coarse_first(), "recipient_uei"))


@register("money_conserved", W("""SELECT city_label, CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS before, CAST(TRUE AS BOOLEAN) AS conserved
FROM filtered GROUP BY city_label""", ["filtered"]))
def _money_conserved(spark, d):
    """Per place: the amounts before spreading, and whether the contributions add up to them (shares are rounded to 6 places)."""
    c = chain(spark, d)
    before = c.filtered().groupBy("city_label").agg(F.sum("amount").alias("b"), F.count("*").alias("n"))
    after = deob.spread_contributions(c.filtered(), syn.FIRST_FY).groupBy("city_label").agg(F.sum("value").alias("a"))
    same = F.abs(F.col("b") - F.coalesce("a", F.lit(0))) <= F.col("n") * F.lit(0.00001)
    return before.join(after, "city_label", "left").select("city_label", money_out("b").alias("before"), same.alias("conserved"))


# one text line per row, written and read by the parser of the file's reader
register("registry_parse", W("SELECT recipient_uei, phys_address_zip, bus_type_string, recipient_name FROM registry", ["registry"]))(
    lambda spark, d: parse_registry_lines(syn.registry_lines(spark, d), "line").select(
        "recipient_uei", "phys_address_zip", "bus_type_string", "recipient_name"))

register("snapshot_name_date", """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS DATE) AS snapshot_date FROM orders""")(
    lambda spark, d: syn._t(spark, d, "orders").select("o_orderkey", date_in_name(
        F.concat(F.lit("trans_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv"))).alias("snapshot_date")))

@register("snapshot_file_names", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN TRY_CAST(CAST(1990 + o_orderkey % 30 AS VARCHAR) || '-' || lpad(CAST(1 + o_orderkey % 14 AS VARCHAR), 2, '0')
  || '-' || lpad(CAST(1 + o_orderkey % 31 AS VARCHAR), 2, '0') AS DATE) END AS snapshot_date FROM orders""")
def _file_names(spark, d):
    """File names with a date (some no days of the calendar), with other numbers, with a date in another form, without any."""
    digits = "concat_ws('-', 1990 + o_orderkey % 30, lpad(1 + o_orderkey % 14, 2, '0'), lpad(1 + o_orderkey % 31, 2, '0'))"
    name = (f"CASE o_orderkey % 4 WHEN 0 THEN concat('city_transactions_v2_', {digits}, '.csv') WHEN 1 THEN concat('part-', o_orderkey, '-0001.csv') "
            f"WHEN 2 THEN concat('trans_', replace({digits}, '-', ''), '.csv') ELSE 'readme.md' END")
    return syn._t(spark, d, "orders").select("o_orderkey", date_in_name(F.expr(name)).alias("snapshot_date"))


@register("published_snapshot", "SELECT o_orderkey, o_totalprice, 2 AS dump FROM orders")
def _published(spark, d):
    """Two dumps and a later one whose job died before its commit: the newest complete one."""
    base, orders = f"{shared_folder(spark)}/dumps-{uuid.uuid4().hex}", syn._t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    write_snapshot(orders.filter("o_orderkey % 2 = 0").withColumn("dump", F.lit(1)), base, "2024-01-31")
    write_snapshot(orders.withColumn("dump", F.lit(2)), base, "2024-02-29")
    orders.filter("o_orderkey % 3 = 0").withColumn("dump", F.lit(3)).write.parquet(f"{base}/snapshot_date=2024-03-31")
    return newest_snapshot(spark, base)


@register("quarantined_registry", W("""
SELECT recipient_uei, ordinal, violations FROM (
  SELECT recipient_uei, ordinal, concat_ws(',', CASE WHEN NOT regexp_full_match(recipient_uei, '[A-Z0-9]{12}') THEN 'uei_format' END,
         CASE WHEN entity_structure NOT IN ('2A','2F','2R','3I','CY','8H','2L') THEN 'entity_structure_domain' END,
         CASE WHEN length(phys_address_st) <> 2 THEN 'state_code_length' END,
         CASE WHEN recipient_uei NOT IN (SELECT recipient_uei FROM transactions) THEN 'without_transactions' END) AS violations FROM registry)
WHERE violations <> ''""", ["registry", "transactions"]))
def _quarantined(spark, d):
    """The registry written by its rules, with one more: recipients that no transaction names. The rows that break one."""
    c = chain(spark, d)
    marked = mark_unknown(c.inp.registry, c.inp.transactions, "recipient_uei", "without_transactions")
    rules = [*registry_rules(), Rule("without_transactions", "without_transactions", "true")]
    report = write_checked(marked, f"{shared_folder(spark)}/registry-{uuid.uuid4().hex}", rules)
    return report.quarantine(spark).select("recipient_uei", "ordinal", F.array_join("violations", ",").alias("violations"))


def _as_file(spark, df: DataFrame, name: str, **options) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.coalesce(1).write.options(**options).csv(path)
    return path


register("registry_file", W("""SELECT recipient_uei, phys_address_01, phys_address_zip, entity_structure, bus_type_string, PSC_code_string FROM registry_first""",
                            ["registry_first"]))(
    lambda spark, d: first_per_key(read_registry(spark, _lines_file(spark, d)), "recipient_uei", "ordinal").select(
        "recipient_uei", "phys_address_01", "phys_address_zip", "entity_structure", "bus_type_string", "PSC_code_string"))


def _lines_file(spark, d) -> str:
    path = f"{shared_folder(spark)}/registry-lines-{uuid.uuid4().hex}"
    lines = syn.registry_lines(spark, d, order="ordinal").orderBy("ordinal").select("line")
    lines.coalesce(1).write.text(path)
    return path


@register("torn_registry", W("""SELECT recipient_uei, CASE WHEN ordinal % 50 = 1 THEN 'too_many_fields' ELSE 'too_few_fields' END AS reason
FROM registry WHERE ordinal % 50 IN (1, 2)""", ["registry"]))
def _torn(spark, d):
    """The registry's file with lines cut off and lines with a field too many: the malformed ones, caught in the one read."""
    path = f"{shared_folder(spark)}/torn-{uuid.uuid4().hex}"
    torn = "CASE ordinal % 50 WHEN 1 THEN concat(line, '|x') WHEN 2 THEN substring_index(line, '|', 20) ELSE line END AS line"
    syn.registry_lines(spark, d, order="ordinal").selectExpr(torn).write.text(path)
    _, report = read_registry_strict(spark, path, f"{path}-checked", max_malformed=None)
    return report.quarantine(spark).selectExpr("substring_index(line, '|', 1) AS recipient_uei", "explode(violations) AS reason")


@register("crosswalk_file", W("SELECT geoid_place, name_place, geoid_zcta FROM crosswalk", ["crosswalk"]))
def _crosswalk_file(spark, d):
    headers = {v: k for k, v in CROSSWALK_COLUMNS.items()}
    df = syn.crosswalk(spark, d).withColumn("AREALAND_PART", F.lit(1)).withColumnsRenamed(headers)
    return read_crosswalk(spark, _as_file(spark, df, "crosswalk", sep="|", header=True))


@register("places_file", W("SELECT place_id, city_label, geoid, state_code, state, region, pop_21 FROM places", ["places"]))
def _places_file(spark, d):
    headers = {v: k for k, v in PLACE_COLUMNS.items()}
    df = syn.places_raw(spark, d).withColumn("pop_21", F.format_number("pop_21", 0)).withColumn("Note", F.lit('say "x", y')).drop("ordinal")
    path = _as_file(spark, df.withColumnsRenamed(headers), "places", header=True, quote='"', escape='"')
    return prepare_places(read_city_places(spark, path)).select("place_id", "city_label", "geoid", "state_code", "state", "region", "pop_21")


@register("code_list_file", "SELECT CAST(n_regionkey AS VARCHAR) AS code, min_by(n_name || ', \"x\"', n_nationkey) AS name FROM nation GROUP BY 1")
def _code_list_file(spark, d):
    """The nations as a code list (region = code): the first name of a code wins."""
    df = syn._t(spark, d, "nation").orderBy("n_nationkey").selectExpr("CAST(n_regionkey AS STRING) AS Code", "concat(n_name, ', \"x\"') AS Name")
    found = code_map(read_business_types(spark, _as_file(spark, df, "codes", header=True, quote='"', escape='"')))
    return spark.createDataFrame(sorted(found.items()), "code string, name string")


# ----------------------------------------------------- documented extras
@register("per_100k", W("""SELECT city_label, fy, CAST(ROUND(total * 100000 / pop_21, 2) AS DOUBLE) AS per_100k
FROM (SELECT city_label, fy, SUM(value) AS total FROM contrib GROUP BY city_label, fy) t
JOIN (SELECT city_label, min(pop_21) AS pop_21 FROM places GROUP BY city_label) p USING (city_label)""", ["contrib", "places"]))
def _per_100k(spark, d):
    c = chain(spark, d)
    tot = deob.annual_net_totals(c.filtered(), syn.FIRST_FY, as_double=False)
    return per_100k(tot, c.places())


@register("nongov_totals", W(f"""
SELECT p.city_label, {O.FY_SQL} AS fy, 'non_government' AS recipient_kind, CAST(count(*) AS BIGINT) AS transactions,
       CAST(count(DISTINCT t.award_key) AS BIGINT) AS awards, CAST(ROUND(SUM(t.amount), 2) AS DOUBLE) AS total
FROM (SELECT *, regexp_replace(regexp_replace(trim(regexp_replace(upper(pop_city), '[^A-Z0-9]+', ' ', 'g')), '^CITY OF ', ''), ' CITY$', '') AS k
      FROM transactions WHERE amount <> 0) t
JOIN (SELECT DISTINCT place_id, city_label, upper(state) AS s1, state_code AS s2, replace(city, '_', ' ') AS k FROM place_first) p
  ON t.k = p.k AND t.pop_state IN (p.s1, p.s2)
JOIN registry_first r ON t.recipient_uei = r.recipient_uei
WHERE r.entity_structure <> '2A' GROUP BY 1, 2""", ["transactions", "place_first", "registry_first"]))
def _nongov(spark, d):
    return chain(spark, d).nongov_totals().withColumn("total", money_out("total"))


register("top_agencies", W("""SELECT city_label, awarding_agency_name, CAST(ROUND(t, 2) AS DOUBLE) AS total,
rank() OVER (PARTITION BY city_label ORDER BY t DESC) AS agency_rank
FROM (SELECT city_label, awarding_agency_name, SUM(amount) AS t FROM filtered GROUP BY city_label, awarding_agency_name)
QUALIFY agency_rank <= 3""", ["filtered"]))(
    lambda spark, d: top_agencies(chain(spark, d).filtered(), 3))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle() -> dict[str, str]:
    return dict(S)
