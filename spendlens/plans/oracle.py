"""The synthetic inputs and the method, once more in plain SQL (DuckDB).

Each query of the catalogue gets an independent SQL statement built from
the CTEs below; the driver runs it on the same parquet tables and compares
the result with the Spark plan. The SQL is written the obvious way
(brute-force point-in-polygon over all point/edge pairs, window functions
for "first row", UNION ALL of the three spreading cases), not as a copy of
the Spark plan.
"""

from __future__ import annotations

from spendlens.plans.synthetic import CODE_NAMES, FIRST_FY, LAST_FY

_ADDR = ("concat_ws(' ', COALESCE(phys_address_01, 'NA'), COALESCE(phys_address_02, 'NA'), "
         "COALESCE(phys_address_city, 'NA'), COALESCE(phys_address_st, 'NA'), COALESCE(phys_address_zip, 'NA'))")

_CODES_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in CODE_NAMES.items())


def _first(src: str, key: str, order: str = "ordinal") -> str:
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS __rn "
            f"FROM {src}) WHERE __rn = 1")


def _pip(points: str, pid: str, px: str, py: str) -> str:
    """Brute force: every point against every edge, parity of crossings."""
    return f"""
SELECT p.{pid} AS pid, e.place_id,
       SUM(CASE WHEN (e.y1 > p.{py}) <> (e.y2 > p.{py})
                 AND p.{px} < (e.x2 - e.x1) * (p.{py} - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END) AS n_cross,
       MAX(CASE WHEN (e.x2 - e.x1) * (p.{py} - e.y1) - (e.y2 - e.y1) * (p.{px} - e.x1) = 0
                 AND p.{px} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                 AND p.{py} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) AS on_edge
FROM {points} p CROSS JOIN edges e
GROUP BY p.{pid}, e.place_id"""


V: dict[str, tuple[list[str], str]] = {}


def view(name: str, deps: list[str], sql: str) -> None:
    V[name] = (deps, sql)


view("places_raw", [], """
SELECT 'p' || CAST(n.n_nationkey AS VARCHAR) AS place_id,
       CASE WHEN n.n_nationkey % 5 = 0
            THEN lpad(CAST(n.n_nationkey AS VARCHAR), 7, '0') || ', ' || lpad(CAST(n.n_nationkey + 100 AS VARCHAR), 7, '0')
            WHEN n.n_nationkey = 24 THEN '0000024, 0000020'
            ELSE lpad(CAST(n.n_nationkey AS VARCHAR), 7, '0') END AS geoid_list,
       n.n_name AS city, substr(r.r_name, 1, 2) AS state_code,
       upper(substr(r.r_name, 1, 1)) || lower(substr(r.r_name, 2)) AS state,
       r.r_name AS region,
       CAST((n.n_nationkey + 1) * 100000 + n.n_nationkey * 1234 AS BIGINT) AS pop_21,
       CAST(n.n_nationkey AS BIGINT) AS ordinal
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

view("places", ["places_raw"], """
SELECT place_id, city, state_code, state, region, pop_21, ordinal, city || ', ' || state_code AS city_label,
       geoid, CAST(ordinal * 1048576 + geoid_pos AS BIGINT) AS place_order, geoid_pos
FROM (SELECT *, unnest(string_split(geoid_list, ', ')) AS geoid,
             unnest(range(0, len(string_split(geoid_list, ', ')))) AS geoid_pos
      FROM places_raw)""")

view("place_first", ["places"], _first("places", "place_id", "place_order"))

view("crosswalk", [], """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 7, '0') AS geoid_place, n_name || ' city' AS name_place,
       lpad(CAST(n_nationkey * 2 + k AS VARCHAR), 5, '0') AS geoid_zcta
FROM nation CROSS JOIN (VALUES (0), (1), (2)) t(k)
UNION ALL
SELECT lpad(CAST(n_nationkey + 100 AS VARCHAR), 7, '0'), n_name || ' city', lpad(CAST(n_nationkey + 1000 AS VARCHAR), 5, '0')
FROM nation WHERE n_nationkey % 5 = 0
UNION ALL
SELECT lpad(CAST(n_nationkey + 200 AS VARCHAR), 7, '0'), n_name || ' CDP', lpad(CAST(n_nationkey * 2 + 1 AS VARCHAR), 5, '0')
FROM nation
UNION ALL
SELECT lpad(CAST(n_nationkey + 200 AS VARCHAR), 7, '0'), n_name || ' CDP', lpad(CAST(n_nationkey + 90000 AS VARCHAR), 5, '0')
FROM nation
UNION ALL
SELECT lpad(CAST(n_nationkey AS VARCHAR), 7, '0'), n_name || ' city', NULL FROM nation WHERE n_nationkey = 0""")

_REG_COMMON = """
       CASE WHEN c_custkey % 97 = 11 THEN '2J' WHEN c_mktsegment = 'AUTOMOBILE' THEN '2L' ELSE '2A' END AS entity_structure,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'STE 1' END AS phys_address_02,
       'CITY ' || CAST(c_nationkey AS VARCHAR) AS phys_address_city,
       'S' || CAST(c_nationkey AS VARCHAR) AS phys_address_st,
       CASE WHEN c_custkey % 7 = 3 THEN lpad(CAST(c_custkey % 1000 + 50000 AS VARCHAR), 5, '0')
            ELSE lpad(CAST(c_nationkey * 2 + c_custkey % 2 AS VARCHAR), 5, '0') END AS phys_address_zip,
       CASE WHEN c_custkey % 50 = 7 THEN 'CAN' ELSE 'USA' END AS phys_address_country"""

_REG_MORE = """CAST({k} % 4 AS VARCHAR) AS bus_type_counter, lpad(CAST({k} % 1000 AS VARCHAR), 6, '0') AS primary_NAICS,
       CAST({k} % 2 + 1 AS VARCHAR) AS NAICS_code_counter, lpad(CAST({k} % 1000 AS VARCHAR), 6, '0') || 'Y' AS NAICS_code_string,
       CAST({k} % 3 AS VARCHAR) AS PSC_code_counter, CASE WHEN {k} % 3 <> 0 THEN 'P' || CAST({k} % 3 AS VARCHAR) END AS PSC_code_string"""

view("registry", [], f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS recipient_uei, CAST(c_custkey AS BIGINT) AS ordinal,
       c_name AS recipient_name, CAST(c_custkey % 500 AS VARCHAR) || ' MAIN ST' AS phys_address_01, {_REG_COMMON},
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '12~C8' WHEN 'MACHINERY' THEN '12~C7~C8' WHEN 'FURNITURE' THEN '12~C7'
            WHEN 'BUILDING' THEN '12~C8~OH' WHEN 'AUTOMOBILE' THEN '2X~A8' END AS bus_type_string,
       {_REG_MORE.format(k='c_custkey')}
FROM customer
UNION ALL
SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0'), CAST(c_custkey + 1000000 AS BIGINT), c_name || ' OLD',
       'PO BOX ' || CAST(c_custkey AS VARCHAR), {_REG_COMMON}, '2X~A8', {_REG_MORE.format(k='c_custkey')}
FROM customer WHERE c_custkey % 20 = 0
UNION ALL
SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 11, '0'), CAST(s_suppkey + 2000000 AS BIGINT), s_name,
       CAST(s_suppkey % 500 AS VARCHAR) || ' OAK AVE', '2A', NULL, 'CITY ' || CAST(s_nationkey AS VARCHAR),
       'S' || CAST(s_nationkey AS VARCHAR), lpad(CAST(s_nationkey * 2 + s_suppkey % 2 AS VARCHAR), 5, '0'), 'USA', '12~C6',
       {_REG_MORE.format(k='s_suppkey')}
FROM supplier""")

view("registry_first", ["registry"], _first("registry", "recipient_uei"))

view("transactions", [], """
SELECT CAST(l.l_orderkey * 8 + l.l_linenumber AS BIGINT) AS id,
       lpad(CAST(o.o_custkey AS VARCHAR), 12, '0') AS recipient_uei,
       'AW' || CAST(l.l_orderkey AS VARCHAR) AS award_key,
       CASE WHEN l.l_orderkey % 23 <> 5 THEN CAST(l.l_shipdate AS DATE) END AS action_date,
       CASE WHEN l.l_orderkey % 23 <> 5 THEN CAST(year(l.l_shipdate) AS VARCHAR) || '-' || CAST(month(l.l_shipdate) AS VARCHAR) END AS ym,
       CAST(CASE WHEN l.l_quantity = 50 THEN CAST(0 AS DOUBLE) WHEN l.l_returnflag = 'R' THEN -l.l_extendedprice
                 ELSE l.l_extendedprice END AS DECIMAL(18, 2)) AS amount,
       CASE l.l_linenumber % 4 WHEN 1 THEN upper(r.r_name) WHEN 2 THEN substr(r.r_name, 1, 2) WHEN 3 THEN 'ELSEWHERE' END
           AS pop_state,
       CASE l.l_orderkey % 6 WHEN 0 THEN n.n_name WHEN 1 THEN 'City of ' || n.n_name WHEN 2 THEN lower(n.n_name) || ' city'
            WHEN 3 THEN ' ' || replace(n.n_name, '_', '. ') || ',' WHEN 5 THEN 'Nowhere' END AS pop_city,
       'AGENCY ' || CAST(l.l_suppkey % 7 AS VARCHAR) AS awarding_agency_name,
       CASE WHEN l.l_orderkey % 23 <> 5 THEN CAST(year(CAST(l.l_shipdate AS DATE) + INTERVAL 3 MONTH) AS INTEGER) END AS shard_year
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
     JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")

view("blacklist", [], "SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS recipient_uei FROM customer WHERE c_acctbal < 0")

view("hit_base", [], f"""
SELECT c_custkey AS ck,
       {_ADDR.replace('phys_address_01', "(CAST(c_custkey % 500 AS VARCHAR) || ' MAIN ST')")
              .replace('phys_address_02', "(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'STE 1' END)")
              .replace('phys_address_city', "('CITY ' || CAST(c_nationkey AS VARCHAR))")
              .replace('phys_address_st', "('S' || CAST(c_nationkey AS VARCHAR))")
              .replace('phys_address_zip', "(CASE WHEN c_custkey % 7 = 3 THEN lpad(CAST(c_custkey % 1000 + 50000 AS VARCHAR), 5, '0') ELSE lpad(CAST(c_nationkey * 2 + c_custkey % 2 AS VARCHAR), 5, '0') END)")}
       AS full_addy,
       c_nationkey % 5 AS gx, c_nationkey // 5 AS gy,
       ((c_custkey % 500) * 37) % 100 AS kx,
       ((c_custkey % 500) * 61 + CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 17 END) % 100 AS ky
FROM customer""")

view("provider_hits", ["hit_base"], """
SELECT full_addy, provider,
       CASE WHEN found THEN CAST(gy * 10000 + ky * 100 + 30 + (provider - 1) + off AS DOUBLE) / CAST(10000 AS DOUBLE) END AS lat,
       CASE WHEN found THEN CAST(gx * 10000 + kx * 100 + 30 + (provider - 1) + off AS DOUBLE) / CAST(10000 AS DOUBLE) END AS long
FROM (SELECT *, 1 AS provider, ck % 4 <> 0 AS found, 0 AS off FROM hit_base
      UNION ALL SELECT *, 1, true, CASE WHEN ck % 12 = 1 THEN 3 ELSE -3 END FROM hit_base WHERE ck % 6 = 1
      UNION ALL SELECT *, 2, ck % 20 <> 0, 0 FROM hit_base WHERE ck % 4 = 0
      UNION ALL SELECT *, 3, ck % 100 <> 0, 0 FROM hit_base WHERE ck % 20 = 0)""")

view("geocode_cache", ["provider_hits", "hit_base"], """
SELECT DISTINCT full_addy, lat, long FROM provider_hits
WHERE provider = 1 AND lat IS NOT NULL
  AND full_addy IN (SELECT h.full_addy FROM hit_base h JOIN customer c ON h.ck = c.c_custkey WHERE c.c_acctbal > 5000)""")

view("grid", [], """
SELECT 'p' || CAST(n_nationkey AS VARCHAR) AS place_id, n_nationkey % 5 AS gx, n_nationkey // 5 AS gy,
       CASE WHEN n_nationkey % 7 = 3 THEN 'triangle' WHEN n_nationkey % 6 = 2 THEN 'multi'
            WHEN n_nationkey % 4 = 1 THEN 'holed' ELSE 'square' END AS shape
FROM nation""")

view("rects", ["grid"], """
SELECT place_id, shape, part, ring, CAST(gx * 16 + a AS DOUBLE) / 16 AS xlo, CAST(gy * 16 + c AS DOUBLE) / 16 AS ylo,
       CAST(gx * 16 + b AS DOUBLE) / 16 AS xhi, CAST(gy * 16 + d AS DOUBLE) / 16 AS yhi
FROM (SELECT g.*, 0 AS part, 0 AS ring, 2 AS a, 14 AS b, 2 AS c, 14 AS d FROM grid g WHERE shape <> 'multi'
      UNION ALL SELECT g.*, 0, 1, 6, 10, 6, 10 FROM grid g WHERE shape = 'holed'
      UNION ALL SELECT g.*, 0, 0, 2, 7, 2, 14 FROM grid g WHERE shape = 'multi'
      UNION ALL SELECT g.*, 1, 0, 9, 14, 2, 14 FROM grid g WHERE shape = 'multi')""")

# Vertex k of a ring: outer rings counter-clockwise, holes clockwise, the
# triangle is the lower-left half of its square.
view("ring_pts", ["rects"], """
SELECT place_id, part, ring, k,
       CASE WHEN kind = 'hole' THEN [xlo, xlo, xhi, xhi, xlo][k + 1]
            WHEN kind = 'tri' THEN [xlo, xhi, xlo, xlo][k + 1]
            ELSE [xlo, xhi, xhi, xlo, xlo][k + 1] END AS x,
       CASE WHEN kind = 'hole' THEN [ylo, yhi, yhi, ylo, ylo][k + 1]
            WHEN kind = 'tri' THEN [ylo, ylo, yhi, ylo][k + 1]
            ELSE [ylo, ylo, yhi, yhi, ylo][k + 1] END AS y,
       CASE WHEN kind = 'tri' THEN 4 ELSE 5 END AS npts
FROM (SELECT *, CASE WHEN ring > 0 THEN 'hole' WHEN shape = 'triangle' THEN 'tri' ELSE 'outer' END AS kind FROM rects)
     CROSS JOIN range(0, 5) t(k)""")

view("edges", ["ring_pts"], """
SELECT a.place_id, CAST(a.part AS INTEGER) AS part, CAST(a.ring AS INTEGER) AS ring, CAST(a.k AS INTEGER) AS seq,
       a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
FROM ring_pts a JOIN ring_pts b
  ON a.place_id = b.place_id AND a.part = b.part AND a.ring = b.ring AND b.k = a.k + 1
WHERE a.k < a.npts - 1 AND b.k < b.npts""")

view("emb_points", [], """
SELECT vec_id, (CAST(embedding[1] AS DOUBLE) + CAST(0.5 AS DOUBLE)) * CAST(5 AS DOUBLE) AS px,
       (CAST(embedding[2] AS DOUBLE) + CAST(0.5 AS DOUBLE)) * CAST(5 AS DOUBLE) AS py
FROM embeddings""")

view("codes", [], f"SELECT * FROM (VALUES {_CODES_VALUES}) t(code, name)")

# -- the method ----------------------------------------------------------
view("city_zctas", ["crosswalk", "places"], """
SELECT geoid_place, name_place, geoid_zcta FROM crosswalk
WHERE geoid_place IN (SELECT geoid FROM places) AND geoid_zcta IS NOT NULL""")

view("coarse", ["registry", "city_zctas"], f"""
SELECT *, {_ADDR} AS full_addy FROM registry
WHERE entity_structure = '2A' AND phys_address_country = 'USA'
  AND phys_address_zip IN (SELECT geoid_zcta FROM city_zctas)""")

view("coarse_first", ["coarse"], _first("coarse", "recipient_uei"))

view("txn_ueis", ["transactions", "coarse_first"], """
SELECT DISTINCT recipient_uei FROM transactions WHERE recipient_uei IN (SELECT recipient_uei FROM coarse_first)""")

view("active", ["coarse_first", "txn_ueis"], """
SELECT * FROM coarse_first WHERE recipient_uei IN (SELECT recipient_uei FROM txn_ueis)""")

view("addresses", ["active"], _first("active", "full_addy"))

view("coordinates", ["provider_hits", "addresses"], """
SELECT full_addy, lat, long, provider FROM (
  SELECT *, row_number() OVER (PARTITION BY full_addy ORDER BY provider, lat, long) AS __rn FROM provider_hits
  WHERE lat IS NOT NULL AND long IS NOT NULL AND full_addy IN (SELECT full_addy FROM addresses))
WHERE __rn = 1""")

view("located", ["coordinates", "edges"], f"""
SELECT c.full_addy, c.lat, c.long, h.place_id, h.n_hits FROM coordinates c JOIN (
  SELECT pid, min(place_id) AS place_id, count(*) AS n_hits
  FROM ({_pip('coordinates', 'full_addy', 'long', 'lat')}) WHERE n_cross % 2 = 1 OR on_edge = 1 GROUP BY pid
) h ON c.full_addy = h.pid""")

view("recipients_in_city", ["active", "located"], """
SELECT a.*, l.lat, l.long, l.place_id, l.n_hits FROM active a JOIN located l ON a.full_addy = l.full_addy""")

view("uei_place", ["recipients_in_city", "place_first"], _first(
    "(SELECT r.recipient_uei, r.place_id, r.ordinal, p.city_label, p.geoid, p.pop_21, p.state, p.state_code "
    "FROM recipients_in_city r JOIN place_first p ON r.place_id = p.place_id)", "recipient_uei"))

view("names", ["registry_first", "codes"], """
SELECT recipient_uei, string_agg(COALESCE(c.name, t.code), '~' ORDER BY t.pos) AS names
FROM (SELECT recipient_uei, unnest(string_split(bus_type_string, '~')) AS code,
             unnest(range(0, len(string_split(bus_type_string, '~')))) AS pos
      FROM registry_first WHERE bus_type_string IS NOT NULL) t
LEFT JOIN codes c ON t.code = c.code
GROUP BY recipient_uei""")

view("flags", ["registry_first", "names", "blacklist"], """
SELECT recipient_uei, bus_type_string, names,
       CASE WHEN inc AND NOT exc THEN 'include'
            WHEN inc AND exc AND NOT nev AND lower(names) LIKE '%city%' AND lower(names) LIKE '%county%' AND NOT bl
            THEN 'recovered' END AS reason
FROM (SELECT r.recipient_uei, r.bus_type_string, n.names,
             COALESCE(list_contains(string_split(r.bus_type_string, '~'), '12'), false) AS inc,
             COALESCE(list_has_any(string_split(r.bus_type_string, '~'), ['C7', '2F', 'OH']), false) AS exc,
             COALESCE(list_contains(string_split(r.bus_type_string, '~'), 'OH'), false) AS nev,
             r.recipient_uei IN (SELECT recipient_uei FROM blacklist) AS bl
      FROM registry_first r LEFT JOIN names n ON r.recipient_uei = n.recipient_uei)""")

view("city_gov_ueis", ["uei_place", "flags"], """
SELECT u.recipient_uei, u.place_id, u.city_label, u.geoid, u.pop_21, f.reason, u.state, u.state_code
FROM uei_place u JOIN flags f ON u.recipient_uei = f.recipient_uei
WHERE f.reason IS NOT NULL""")

FY_SQL = "CAST(year(action_date + INTERVAL 3 MONTH) AS INTEGER)"


def fy_as_coded_sql(col: str = "ym", first: int = FIRST_FY, last: int = LAST_FY) -> str:
    arms = " ".join(f"WHEN {col} >= '{y - 1}-10' AND {col} <= '{y}-9' THEN {y}" for y in range(first, last + 1))
    return f"CAST(CASE {arms} END AS INTEGER)"


view("filtered", ["transactions", "city_gov_ueis"], f"""
SELECT t.*, g.place_id, g.city_label, g.geoid, g.pop_21, g.reason, g.state, g.state_code, {FY_SQL} AS fy
FROM transactions t JOIN city_gov_ueis g ON t.recipient_uei = g.recipient_uei
WHERE t.amount <> 0
  AND (t.pop_state = upper(g.state) OR t.pop_state = g.state_code OR t.pop_state IS NULL)""")

view("ayt", ["filtered"], """
SELECT award_key, city_label, fy, SUM(CASE WHEN amount > 0 THEN amount END) AS pos,
       SUM(CASE WHEN amount < 0 THEN amount END) AS neg
FROM filtered GROUP BY award_key, city_label, fy""")

view("prof", ["ayt"], """
SELECT award_key, city_label, SUM(neg) AS neg_total, COUNT(pos) AS n_pos_years, CAST(MAX(fy) AS INTEGER) AS last_fy,
       CASE WHEN SUM(neg) IS NULL THEN 'none' WHEN COUNT(pos) > 0 THEN 'both' ELSE 'only_neg' END AS award_class
FROM ayt GROUP BY award_key, city_label""")


def share_sql(total: str, n: str) -> str:
    return f"CAST(ROUND({total} / {n}, 6) AS DECIMAL(38, 6))"


def contrib_sql(mode: str = "documented", first_fy: int = FIRST_FY) -> str:
    pos = "CAST(a.pos AS DECIMAL(38, 6))" if mode == "documented" else share_sql("a.pos", "p.n_pos_years")
    return f"""
SELECT a.award_key, a.city_label, a.fy, 'no_deobs' AS kind, CAST(a.pos AS DECIMAL(38, 6)) AS value
FROM ayt a JOIN prof p ON a.award_key = p.award_key AND a.city_label = p.city_label
WHERE p.award_class = 'none' AND a.pos IS NOT NULL
UNION ALL
SELECT a.award_key, a.city_label, a.fy, 'deob_with_ob', {pos} + {share_sql('p.neg_total', 'p.n_pos_years')}
FROM ayt a JOIN prof p ON a.award_key = p.award_key AND a.city_label = p.city_label
WHERE p.award_class = 'both' AND a.pos IS NOT NULL
UNION ALL
SELECT p.award_key, p.city_label, CAST(y.fy AS INTEGER), 'deob_without_ob',
       {share_sql('p.neg_total', f'(p.last_fy - {first_fy} + 1)')}
FROM prof p CROSS JOIN LATERAL generate_series({first_fy}, p.last_fy) y(fy)
WHERE p.award_class = 'only_neg' AND p.last_fy >= {first_fy}
UNION ALL
SELECT award_key, city_label, last_fy, 'deob_without_ob', CAST(neg_total AS DECIMAL(38, 6))
FROM prof p
WHERE award_class = 'only_neg' AND (last_fy IS NULL OR last_fy < {first_fy})"""


view("contrib", ["ayt", "prof"], contrib_sql("documented"))
view("contrib_as_coded", ["ayt", "prof"], contrib_sql("as_coded"))

# The same chain with the fiscal year as the delivered code computes it
# (text ranges on year-month), for the as-coded variant of the totals.
view("filtered_fyc", ["transactions", "city_gov_ueis"], V["filtered"][1].replace(FY_SQL, fy_as_coded_sql("t.ym")))
view("ayt_fyc", ["filtered_fyc"], V["ayt"][1].replace("FROM filtered ", "FROM filtered_fyc "))
view("prof_fyc", ["ayt_fyc"], V["prof"][1].replace("FROM ayt ", "FROM ayt_fyc "))
view("contrib_fyc", ["ayt_fyc", "prof_fyc"],
     contrib_sql("documented").replace("FROM ayt a JOIN prof p", "FROM ayt_fyc a JOIN prof_fyc p")
     .replace("FROM prof p", "FROM prof_fyc p"))

ANNUAL_SQL = """
SELECT city_label, fy,
       CAST(ROUND(no_deobs, 2) AS DOUBLE) AS no_deobs, CAST(ROUND(deob_with_ob, 2) AS DOUBLE) AS deob_with_ob,
       CAST(ROUND(deob_without_ob, 2) AS DOUBLE) AS deob_without_ob,
       CAST(ROUND(no_deobs + deob_with_ob + deob_without_ob, 2) AS DOUBLE) AS total
FROM (SELECT city_label, fy,
             COALESCE(SUM(CASE WHEN kind = 'no_deobs' THEN value END), 0) AS no_deobs,
             COALESCE(SUM(CASE WHEN kind = 'deob_with_ob' THEN value END), 0) AS deob_with_ob,
             COALESCE(SUM(CASE WHEN kind = 'deob_without_ob' THEN value END), 0) AS deob_without_ob
      FROM contrib GROUP BY city_label, fy)"""


def with_views(body: str, needs: list[str]) -> str:
    """``WITH`` clause holding ``needs`` and their dependencies, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in V[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({V[n][1].strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}"
