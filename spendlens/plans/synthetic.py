"""The reference's inputs, derived from the driver's test tables.

The reference reads a registry extract, a ZIP-to-place crosswalk, city
metadata, boundary files, geocoder results and yearly transaction databases.
None of them ship, so every input here is derived by a fixed rule from the
TPC-H-like tables (nation, region, customer, orders, lineitem, embeddings).
The rules are written once more in SQL in ``plans.oracle`` for DuckDB.

Rules (n = nation key, c = customer key):

* places: one city per nation, ``place_id = 'p'||n``; cities with n % 5 = 0
  carry a second GEOID (like a consolidated city with two census places); the
  last city (n = 24) also lists the GEOID of city 20.
* crosswalk: city GEOID x ZIPs {2n, 2n+1, 2n+2}; second GEOIDs get ZIP
  1000+n; a non-city place per nation shares ZIP 2n+1 and owns 90000+n;
  one row has no ZIP.
* registry: one row per customer; c % 20 = 0 also has a later duplicate row
  with another address and codes, so "first row per UEI" matters. Suppliers
  are registered too (municipalities) but never receive money.
* transactions: one per line item; the award is the order; returned lines
  are deobligations; quantity 50 gives a zero amount; awards with order
  key % 23 = 5 have no dates.
* geocoder results: three providers in priority order over customers (c % 100 = 0
  is found by none); provider 1 answers twice for c % 6 = 1; an
  earlier cache holds the customers with a balance over 5000.
* place of performance: the recipient's own nation, written in four ways, or none, or one that is no listed place.
* blacklist: customers in debit (negative balance).
* boundaries: a 5 x 5 grid of places, squares, squares with a hole,
  two-part shapes and triangles (coordinates are multiples of 1/16 so they
  print and parse exactly).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendlens.functions.fiscal import fiscal_year
from spendlens.plans.params import Params
from spendlens.sources.places import prepare_places

# Business-type code names (first row per code of the code
# list the reference ships) for the codes the synthetic registry uses.
CODE_NAMES = {
    "2A": "U.S. Government Entity",
    "CY": "Country - Foreign Government",
    "2F": "U.S. State Government",
    "12": "U.S. Local Government",
    "2X": "For Profit Organization",
    "A8": "Non-Profit Organization",
    "C8": "City",
    "C7": "County",
    "OH": "State Controlled Institution of Higher Learning",
}

# Business-type strings by market segment of the customer.
SEGMENT_CODES = {
    "HOUSEHOLD": "12~C8",
    "MACHINERY": "12~C7~C8",
    "FURNITURE": "12~C7",
    "BUILDING": "12~C8~OH",
    "AUTOMOBILE": "2X~A8",
}

FIRST_FY = 1995   # stands for 2017 on the test tables
LAST_FY = 2002


def test_params(**kw) -> Params:
    base = dict(first_fy=FIRST_FY, last_fy=LAST_FY, cell=0.25, band=0.125, code_map=dict(CODE_NAMES))
    base.update(kw)
    return Params(**base)


_READS: dict = {}


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One reader per table and session (schema read once, plans share the scan)."""
    key = (spark.sparkContext.applicationId, id(spark), d, name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{d}/{name}.parquet")
    return _READS[key]


def places_raw(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "nation")
    r = _t(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return n.join(r, "n_regionkey").selectExpr(
        "concat('p', n_nationkey) AS place_id",
        "CASE WHEN n_nationkey % 5 = 0 THEN concat(lpad(n_nationkey, 7, '0'), ', ', lpad(n_nationkey + 100, 7, '0')) "
        "WHEN n_nationkey = 24 THEN '0000024, 0000020' ELSE lpad(n_nationkey, 7, '0') END AS geoid_list",
        "n_name AS city",
        "substring(r_name, 1, 2) AS state_code",
        "concat(upper(substring(r_name, 1, 1)), lower(substring(r_name, 2))) AS state",
        "r_name AS region",
        "CAST((n_nationkey + 1) * 100000 + n_nationkey * 1234 AS BIGINT) AS pop_21",
        "CAST(n_nationkey AS BIGINT) AS ordinal")


def places(spark: SparkSession, d: str) -> DataFrame:
    return prepare_places(places_raw(spark, d))


def crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """One nation scan; the rows of a nation come from one exploded array."""
    row = "named_struct('geoid_place', {}, 'name_place', {}, 'geoid_zcta', {})"
    city, other = "concat(n_name, ' city')", "concat(n_name, ' CDP')"
    rows = [row.format("lpad(n_nationkey, 7, '0')", city, f"lpad(n_nationkey * 2 + {i}, 5, '0')") for i in range(3)]
    rows.append("CASE WHEN n_nationkey % 5 = 0 THEN "
                + row.format("lpad(n_nationkey + 100, 7, '0')", city, "lpad(n_nationkey + 1000, 5, '0')") + " END")
    rows.append(row.format("lpad(n_nationkey + 200, 7, '0')", other, "lpad(n_nationkey * 2 + 1, 5, '0')"))
    rows.append(row.format("lpad(n_nationkey + 200, 7, '0')", other, "lpad(n_nationkey + 90000, 5, '0')"))
    rows.append("CASE WHEN n_nationkey = 0 THEN "
                + row.format("lpad(n_nationkey, 7, '0')", city, "CAST(NULL AS STRING)") + " END")
    return (_t(spark, d, "nation")
            .selectExpr(f"explode(filter(array({', '.join(rows)}), r -> r IS NOT NULL)) AS r")
            .selectExpr("r.geoid_place", "r.name_place", "r.geoid_zcta"))


_SEGMENT_SQL = ("CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_CODES.items())
                + " END")

# Address columns of a customer's registry row (dup = 1: the later duplicate row).
_CUSTOMER_ADDRESS = {
    "phys_address_01": "CASE WHEN dup = 1 THEN concat('PO BOX ', c_custkey) ELSE concat(c_custkey % 500, ' MAIN ST') END",
    "phys_address_02": "CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE 'STE 1' END",
    "phys_address_city": "concat('CITY ', c_nationkey)",
    "phys_address_st": "concat('S', c_nationkey)",
    "phys_address_zip": "CASE WHEN c_custkey % 7 = 3 THEN lpad(c_custkey % 1000 + 50000, 5, '0') "
                        "ELSE lpad(c_nationkey * 2 + c_custkey % 2, 5, '0') END",
}


def _full_addy_sql(parts: dict) -> str:
    """R ``paste(..., sep=' ')`` of the five address parts, NULL printed as NA."""
    return "concat_ws(' ', " + ", ".join(f"coalesce({parts[k]}, 'NA')" for k in (
        "phys_address_01", "phys_address_02", "phys_address_city", "phys_address_st", "phys_address_zip")) + ")"


def _more_attributes(key: str) -> list[str]:
    """Registry attributes that no rule reads but the transactions carry on."""
    return [f"CAST({key} % 4 AS STRING) AS bus_type_counter", f"lpad({key} % 1000, 6, '0') AS primary_NAICS",
            f"CAST({key} % 2 + 1 AS STRING) AS NAICS_code_counter", f"concat(lpad({key} % 1000, 6, '0'), 'Y') AS NAICS_code_string",
            f"CAST({key} % 3 AS STRING) AS PSC_code_counter",
            f"CASE WHEN {key} % 3 = 0 THEN CAST(NULL AS STRING) ELSE concat('P', {key} % 3) END AS PSC_code_string"]


def registry(spark: SparkSession, d: str) -> DataFrame:
    cust = (_t(spark, d, "customer")
            .selectExpr("*", "explode(CASE WHEN c_custkey % 20 = 0 THEN array(0, 1) ELSE array(0) END) AS dup")
            .selectExpr(
                "lpad(c_custkey, 12, '0') AS recipient_uei",
                "CAST(c_custkey + dup * 1000000 AS BIGINT) AS ordinal",
                "CASE WHEN dup = 1 THEN concat(c_name, ' OLD') ELSE c_name END AS recipient_name",
                *[f"{v} AS {k}" for k, v in _CUSTOMER_ADDRESS.items()],
                "CASE WHEN c_custkey % 97 = 11 THEN '2J' WHEN c_mktsegment = 'AUTOMOBILE' THEN '2L' ELSE '2A' END "
                "AS entity_structure",
                "CASE WHEN c_custkey % 50 = 7 THEN 'CAN' ELSE 'USA' END AS phys_address_country",
                f"CASE WHEN dup = 1 THEN '2X~A8' ELSE {_SEGMENT_SQL} END AS bus_type_string",
                *_more_attributes("c_custkey")))
    sup = _t(spark, d, "supplier").selectExpr(
        "concat('S', lpad(s_suppkey, 11, '0')) AS recipient_uei",
        "CAST(s_suppkey + 2000000 AS BIGINT) AS ordinal",
        "s_name AS recipient_name",
        "concat(s_suppkey % 500, ' OAK AVE') AS phys_address_01",
        "CAST(NULL AS STRING) AS phys_address_02",
        "concat('CITY ', s_nationkey) AS phys_address_city",
        "concat('S', s_nationkey) AS phys_address_st",
        "lpad(s_nationkey * 2 + s_suppkey % 2, 5, '0') AS phys_address_zip",
        "'2A' AS entity_structure",
        "'USA' AS phys_address_country",
        "'12~C6' AS bus_type_string", *_more_attributes("s_suppkey"))
    return cust.unionByName(sup)


def registry_lines(spark: SparkSession, d: str, order: str | None = None, width: int = 142) -> DataFrame:
    """The registry as lines of the extract (pipe-delimited, columns by position); with ``order`` that column beside them."""
    from spendlens.sources.registry import REGISTRY_COLUMNS
    r = registry(spark, d)
    cells = [f"coalesce(CAST(`{REGISTRY_COLUMNS[k]}` AS STRING), '')" if REGISTRY_COLUMNS.get(k) in r.columns else "''"
             for k in range(1, width + 1)]
    return r.selectExpr(f"concat_ws('|', {', '.join(cells)}) AS line", *([order] if order else []))


_AMOUNT = ("CAST(CASE WHEN l_quantity = 50 THEN 0D WHEN l_returnflag = 'R' THEN -l_extendedprice "
           "ELSE l_extendedprice END AS DECIMAL(18,2))")


def transactions(spark: SparkSession, d: str) -> DataFrame:
    """One row per line item, with ``shard_year`` = documented fiscal year."""
    li = _t(spark, d, "lineitem")
    o = _t(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    c = _t(spark, d, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey AS n_nationkey")
    n = _t(spark, d, "nation").select("n_nationkey", "n_regionkey", "n_name")
    r = _t(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    j = li.join(o, "l_orderkey").join(c, "o_custkey").join(n, "n_nationkey").join(r, "n_regionkey")
    return j.selectExpr(
        "CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id",
        "lpad(o_custkey, 12, '0') AS recipient_uei",
        "concat('AW', l_orderkey) AS award_key",
        "CASE WHEN l_orderkey % 23 <> 5 THEN to_date(l_shipdate) END AS action_date",
        "CASE WHEN l_orderkey % 23 <> 5 THEN concat(year(l_shipdate), '-', month(l_shipdate)) END AS ym",
        f"{_AMOUNT} AS amount",
        "CASE l_linenumber % 4 WHEN 1 THEN upper(r_name) WHEN 2 THEN substring(r_name, 1, 2) "
        "WHEN 3 THEN 'ELSEWHERE' END AS pop_state",
        "CASE l_orderkey % 6 WHEN 0 THEN n_name WHEN 1 THEN concat('City of ', n_name) WHEN 2 THEN concat(lower(n_name), ' city') "
        "WHEN 3 THEN concat(' ', replace(n_name, '_', '. '), ',') WHEN 5 THEN 'Nowhere' END AS pop_city",
        "concat('AGENCY ', l_suppkey % 7) AS awarding_agency_name",
    ).withColumn("shard_year", fiscal_year("action_date"))


def yearly_shards(spark: SparkSession, d: str, keyed: bool = False) -> dict[int | None, DataFrame]:
    """One source for each fiscal year (its own scan of the line items, the date range pushed) and one for the undated rows.

    The years are those that occur; ``keyed`` adds the recipient from the order.
    """
    li = _t(spark, d, "lineitem")
    dated = "l_orderkey % 23 <> 5 AND l_shipdate IS NOT NULL"
    lo, hi = li.filter(dated).selectExpr("min(l_shipdate) AS lo", "max(l_shipdate) AS hi").first()
    years = range(lo.year + (lo.month >= 10), hi.year + (hi.month >= 10) + 1) if lo else ()
    parts = {y: li.filter(f"l_shipdate >= DATE'{y - 1}-10-01' AND l_shipdate < DATE'{y}-10-01' AND l_orderkey % 23 <> 5") for y in years}
    parts[None] = li.filter(f"NOT ({dated})")
    o = _t(spark, d, "orders").selectExpr("o_orderkey AS l_orderkey", "lpad(o_custkey, 12, '0') AS recipient_uei")
    key = ["recipient_uei"] if keyed else []
    return {y: (p.join(o, "l_orderkey") if keyed else p).selectExpr(
        "CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id", *key, f"{_AMOUNT} AS amount",
        f"CAST({'NULL' if y is None else y} AS INT) AS shard_year") for y, p in parts.items()}


def provider_hits(spark: SparkSession, d: str) -> DataFrame:
    """Geocoder results: (full_addy, provider, lat, long); NULL coordinates = miss.

    Provider 1 is asked for every customer address, provider 2 for the
    misses of 1 (c % 4 = 0), provider 3 for the misses of 2 (c % 20 = 0).
    Coordinates depend on the address only, so equal addresses get equal
    points; each provider is off by 1e-4 from the previous one. A second answer of
    provider 1 lies 3e-4 before or after the first one.
    """
    asked = ("array(named_struct('provider', 1, 'found', c_custkey % 4 <> 0, 'off', 0), "
             "CASE WHEN c_custkey % 6 = 1 THEN named_struct('provider', 1, 'found', true, 'off', "
             "CASE WHEN c_custkey % 12 = 1 THEN 3 ELSE -3 END) END, "
             "CASE WHEN c_custkey % 4 = 0 THEN named_struct('provider', 2, 'found', c_custkey % 20 <> 0, 'off', 0) END, "
             "CASE WHEN c_custkey % 20 = 0 THEN named_struct('provider', 3, 'found', c_custkey % 100 <> 0, 'off', 0) END)")
    return (_t(spark, d, "customer")
            .selectExpr("*", "0 AS dup")
            .selectExpr(f"{_full_addy_sql(_CUSTOMER_ADDRESS)} AS full_addy",
                        "c_nationkey % 5 AS gx", "c_nationkey div 5 AS gy",
                        "((c_custkey % 500) * 37) % 100 AS kx",
                        "((c_custkey % 500) * 61 + CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 17 END) % 100 AS ky",
                        f"explode(filter({asked}, a -> a IS NOT NULL)) AS a")
            .selectExpr("full_addy", "a.provider AS provider",
                        "CASE WHEN a.found THEN CAST(gy * 10000 + ky * 100 + 29 + a.provider + a.off AS DOUBLE) / 10000D END AS lat",
                        "CASE WHEN a.found THEN CAST(gx * 10000 + kx * 100 + 29 + a.provider + a.off AS DOUBLE) / 10000D END AS long"))


def geocode_cache(spark: SparkSession, d: str) -> DataFrame:
    """A cache from an earlier run: provider-1 hits of customers with a balance over 5000."""
    keys = (_t(spark, d, "customer").filter("c_acctbal > 5000").selectExpr("*", "0 AS dup")
            .selectExpr(f"{_full_addy_sql(_CUSTOMER_ADDRESS)} AS full_addy"))
    return (provider_hits(spark, d).filter("provider = 1 AND lat IS NOT NULL")
            .join(keys, "full_addy", "left_semi").select("full_addy", "lat", "long").distinct())


def blacklist(spark: SparkSession, d: str) -> DataFrame:
    """Recipients that are never city governments: customers in debit (balance below 0)."""
    return _t(spark, d, "customer").filter("c_acctbal < 0").selectExpr("lpad(c_custkey, 12, '0') AS recipient_uei")


def _ring_sql(x0: int, x1: int, y0: int, y1: int, kind: str) -> str:
    """Closed ring text; corners at 1/16 steps of the grid cell (gx, gy).

    Outer rings run counter-clockwise, holes clockwise; the triangle is the
    lower-left half of the square.
    """
    xlo, xhi = f"(gx * 16 + {x0}) / 16D", f"(gx * 16 + {x1}) / 16D"
    ylo, yhi = f"(gy * 16 + {y0}) / 16D", f"(gy * 16 + {y1}) / 16D"
    pts = {"outer": [(xlo, ylo), (xhi, ylo), (xhi, yhi), (xlo, yhi), (xlo, ylo)],
           "hole": [(xlo, ylo), (xlo, yhi), (xhi, yhi), (xhi, ylo), (xlo, ylo)],
           "triangle": [(xlo, ylo), (xhi, ylo), (xlo, yhi), (xlo, ylo)]}[kind]
    fmt = "[" + ",".join("[%s,%s]" for _ in pts) + "]"
    args = ", ".join(f"{x}, {y}" for x, y in pts)
    return f"format_string('{fmt}', {args})"


def boundaries_geojson(spark: SparkSession, d: str) -> DataFrame:
    """One GeoJSON FeatureCollection text per place (place_id, geojson).

    Places sit on a 5 x 5 grid; shapes: triangle (n % 7 = 3), two-part
    MultiPolygon (n % 6 = 2), square with a hole (n % 4 = 1), square.
    """
    outer = _ring_sql(2, 14, 2, 14, "outer")
    coords = ("CASE shape "
              f"WHEN 'triangle' THEN concat('[', {_ring_sql(2, 14, 2, 14, 'triangle')}, ']') "
              f"WHEN 'multi' THEN concat('[[', {_ring_sql(2, 7, 2, 14, 'outer')}, '],[', "
              f"{_ring_sql(9, 14, 2, 14, 'outer')}, ']]') "
              f"WHEN 'holed' THEN concat('[', {outer}, ',', {_ring_sql(6, 10, 6, 10, 'hole')}, ']') "
              f"ELSE concat('[', {outer}, ']') END")
    doc = ("concat('{\"type\": \"FeatureCollection\", \"features\": [{\"type\": \"Feature\", "
           "\"properties\": {\"place_id\": \"', place_id, '\", \"census_year\": \"2022\"}, "
           "\"geometry\": {\"type\": \"', CASE WHEN shape = 'multi' THEN 'MultiPolygon' ELSE 'Polygon' END, "
           f"'\", \"coordinates\": ', {coords}, '}}}}]}}')")
    return (_t(spark, d, "nation")
            .selectExpr("concat('p', n_nationkey) AS place_id", "n_nationkey % 5 AS gx", "n_nationkey div 5 AS gy",
                        "CASE WHEN n_nationkey % 7 = 3 THEN 'triangle' WHEN n_nationkey % 6 = 2 THEN 'multi' "
                        "WHEN n_nationkey % 4 = 1 THEN 'holed' ELSE 'square' END AS shape")
            .selectExpr("place_id", f"{doc} AS geojson"))


def embedding_points(spark: SparkSession, d: str) -> DataFrame:
    """Points from the first two embedding dimensions, scaled onto the grid."""
    return _t(spark, d, "embeddings").selectExpr(
        "vec_id", "(CAST(element_at(embedding, 1) AS DOUBLE) + 0.5D) * 5D AS px",
        "(CAST(element_at(embedding, 2) AS DOUBLE) + 0.5D) * 5D AS py")


def inputs(spark: SparkSession, d: str):
    """All inputs of the method, derived from the tables in ``d``."""
    from spendlens.plans.attribution import Inputs
    return Inputs(registry=registry(spark, d), crosswalk=crosswalk(spark, d), places_raw=places_raw(spark, d),
                  boundaries=boundaries_geojson(spark, d), hits=provider_hits(spark, d),
                  transactions=transactions(spark, d), blacklist=blacklist(spark, d))
