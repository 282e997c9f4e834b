"""The whole method over files in the reference's layout (tiny world)."""

import datetime as dt
import glob
import json

from spendlens.plans.params import Params
from spendlens.plans.pipeline import Paths, load_inputs, run


def _registry_line(uei, zip_, struct, biz, width=40):
    cells = [""] * width
    cells[0], cells[11], cells[15], cells[17], cells[18] = uei, f"NAME {uei}", "1 MAIN ST", "BALTIMORE", "MD"
    cells[19], cells[21], cells[27], cells[31] = zip_, "USA", struct, biz
    return "|".join(cells)


def _world(spark, d):
    with open(f"{d}/registry.txt", "w") as f:
        f.write("\n".join([_registry_line("U00000000001", "21201", "2A", "12~C8"),
                           _registry_line("U00000000002", "21201", "2A", "12~C7"),
                           _registry_line("U00000000003", "21201", "2L", "12~C8")]) + "\n")
    with open(f"{d}/crosswalk.txt", "w") as f:
        f.write("GEOID_ZCTA5_20|GEOID_PLACE_20|NAMELSAD_PLACE_20\n21201|2404000|Baltimore city\n")
    with open(f"{d}/places.csv", "w") as f:
        f.write("SOLE Place ID,2020 Census GEOIDs,City name,State Code,State,SoLE region,Population 2021\n"
                "c-us-md-bal,2404000,Baltimore,MD,Maryland,East,576498\n")
    fc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"place_id": "c-us-md-bal"},
          "geometry": {"type": "Polygon", "coordinates": [[[-77, 39], [-76, 39], [-76, 40], [-77, 40], [-77, 39]]]}}]}
    with open(f"{d}/c-us-md-bal.geojson", "w") as f:
        json.dump(fc, f)
    addy = "1 MAIN ST NA BALTIMORE MD 21201"
    spark.createDataFrame([(addy, 39.2904, -76.6122)], "full_addy string, lat double, long double") \
        .write.parquet(f"{d}/geocodes")   # a plain cache, as the method keeps it
    txn = [(1, "U00000000001", "A1", dt.date(2018, 3, 1), "2018-3", 100.0, "MARYLAND", "AG"),
           (2, "U00000000001", "A1", dt.date(2019, 5, 1), "2019-5", -40.0, None, "AG"),
           (3, "U00000000001", "A2", dt.date(2019, 6, 1), "2019-6", -30.0, "MD", "AG"),
           (4, "U00000000001", "A3", dt.date(2019, 6, 1), "2019-6", 500.0, "TEXAS", "AG"),
           (5, "U00000000003", "A4", dt.date(2019, 6, 1), "2019-6", 7.0, None, "AG")]
    # the upstream column names; the reader maps them to ours
    schema = ("id int, recipient_uei string, award_summary_unique_key string, action_date date, "
              "action_date_year_month string, federal_action_obligation double, "
              "primary_place_of_performance_state_name string, awarding_agency_name string")
    df = spark.createDataFrame(txn, schema)
    for y in (2018, 2019):
        df.filter(f"year(action_date) = {y}").write.parquet(f"{d}/txn/shard_year={y}")
    with open(f"{d}/bt.csv", "w") as f:
        f.write("Code,Name\n12,U.S. Local Government\nC8,City\nC7,County\n")
    return Paths(registry=f"{d}/registry.txt", crosswalk=f"{d}/crosswalk.txt", places=f"{d}/places.csv",
                 boundaries=f"{d}/*.geojson", geocodes=f"{d}/geocodes", transactions=f"{d}/txn",
                 business_types=f"{d}/bt.csv")


def test_pipeline_end_to_end(spark, tmp_dir):
    paths = _world(spark, tmp_dir)
    inp, codes = load_inputs(spark, paths)
    out = run(spark, inp, Params(first_fy=2017, code_map=codes, cell=0.25), out_dir=f"{tmp_dir}/out")
    tot = {r.fy: r.total for r in out["annual_net_totals"].collect()}
    assert tot == {2017: -10.0, 2018: 50.0, 2019: -10.0}
    assert [r.recipient_uei for r in out["recipients"].collect()] == ["U00000000001"]
    assert [r.recipient_uei for r in out["inactive_recipients"].collect()] == ["U00000000002"]
    lines = open(glob.glob(f"{tmp_dir}/out/delivery/*.csv")[0]).read().splitlines()
    assert lines == ["date,value,place_id,category_id", "2017-01-01 00:00:00,NA,c-us-md-bal,",
                     "2018-01-01 00:00:00,50.0,c-us-md-bal,", "2019-01-01 00:00:00,NA,c-us-md-bal,"]
    raw = {r.date: r.value for r in out["delivery_raw"].collect()}
    assert raw == {"2018-01-01 00:00:00": 100.0, "2019-01-01 00:00:00": None}
    assert spark.read.parquet(f"{tmp_dir}/out/recipient_map").count() == 1


def test_snapshots_checks_and_geocoding_list(spark, tmp_dir):
    import pytest

    from spendlens.plans.pipeline import InputViolation
    paths = _world(spark, tmp_dir)
    inp, codes = load_inputs(spark, paths)
    p = Params(first_fy=2017, code_map=codes, cell=0.25)
    snap = f"{tmp_dir}/snap"
    first = run(spark, inp, p, snapshot_base=snap, snapshot_date="2024-01-01", on_violation="raise")
    totals = sorted(tuple(r) for r in first["annual_net_totals"].collect())
    assert spark.read.parquet(snap).count() == 4      # the transactions of located recipients
    second = run(spark, inp, p, snapshot_base=snap)   # reads the newest dump, not the shards
    assert sorted(tuple(r) for r in second["annual_net_totals"].collect()) == totals
    assert first["ungeocoded_recipients"].count() == 0 and first["to_geocode"].count() == 0 and first["unbounded_places"].count() == 0
    # no answer for the address: listed, and an error on request
    lost = type(inp)(**{**inp.__dict__, "hits": inp.hits.limit(0)})
    out = run(spark, lost, p)
    assert [r.recipient_uei for r in out["ungeocoded_recipients"].collect()] == ["U00000000001"]
    assert [r.query for r in out["to_geocode"].collect()] == ["1 MAIN ST, BALTIMORE, MD, 21201"]
    with pytest.raises(InputViolation, match="ungeocoded_recipients: 1"):
        run(spark, lost, p, on_violation="raise")


def test_undated_deobligation_is_charged_to_the_null_year(spark):
    from decimal import Decimal

    from spendlens.operators.deobligations import annual_net_totals
    df = spark.createDataFrame([("A", "X", None, Decimal("-50.00")), ("B", "X", 2018, Decimal("10.00")), ("C", "X", 2015, Decimal("-3.00"))],
                               "award_key string, city_label string, fy int, amount decimal(18,2)")
    got = {r.fy: r.total for r in annual_net_totals(df, 2017).collect()}
    assert got == {None: -50.0, 2018: 10.0, 2015: -3.0}


def test_shards_of_all_years_and_undated_rows(spark):
    from spendlens.sources.shards import split_by_year, union_shards
    df = spark.createDataFrame([(1, 1990), (2, 2001), (3, None)], "id int, shard_year int")
    assert union_shards([*split_by_year(df, [1990, 2001]), df.filter("shard_year IS NULL")]).count() == 3
