"""Worked examples of the method (FIXTURES §2) as exact tests."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from spendlens.functions import codes, fiscal, text
from spendlens.operators import deobligations as deob
from spendlens.operators.delivery import delivery
from spendlens.operators.filters import flag_city_gov, match_place_of_performance
from spendlens.operators.recipients import city_zctas
from spendlens.plans.synthetic import CODE_NAMES

TXN = "award_key string, city_label string, fy int, amount decimal(18,2)"


def _totals(spark, rows, mode="documented", first_fy=2017):
    df = spark.createDataFrame(rows, TXN)
    out = deob.annual_net_totals(df, first_fy=first_fy, mode=mode)
    return {r["fy"]: r["total"] for r in out.collect()}


def test_spread_only_negative(spark):
    rows = [("A", "X", 2018, Decimal("-100000")), ("A", "X", 2022, Decimal("-500000"))]
    assert _totals(spark, rows) == {y: -100000.0 for y in range(2017, 2023)}


def test_spread_both_documented_and_as_coded(spark):
    rows = [("A", "X", 2017, Decimal("800000")), ("A", "X", 2020, Decimal("200000")),
            ("A", "X", 2019, Decimal("-300000")), ("A", "X", 2023, Decimal("-200000"))]
    assert _totals(spark, rows) == {2017: 550000.0, 2020: -50000.0}
    assert _totals(spark, rows, mode="as_coded") == {2017: 150000.0, 2020: -150000.0}


def test_award_in_two_cities_is_charged_once_per_city(spark):
    rows = [("A", "X", 2018, Decimal("-60")), ("A", "Y", 2019, Decimal("-90"))]
    df = spark.createDataFrame(rows, TXN)
    out = deob.annual_net_totals(df, first_fy=2017)
    by_city = {}
    for r in out.collect():
        by_city[r["city_label"]] = by_city.get(r["city_label"], 0) + r["total"]
    assert by_city == {"X": -60.0, "Y": -90.0}


def test_spreading_conserves_money_and_classes_partition(spark):
    rows = [("A", "X", 2017, Decimal("10.01")), ("A", "X", 2018, Decimal("-3.00")),
            ("B", "X", 2018, Decimal("-7.00")), ("B", "X", 2020, Decimal("-2.00")),
            ("C", "Y", 2019, Decimal("5.55")), ("C", "Y", 2019, Decimal("1.00")),
            ("D", "Y", 2021, Decimal("4.00")), ("D", "Y", 2022, Decimal("-1.00")), ("D", "Y", 2023, Decimal("2.00"))]
    df = spark.createDataFrame(rows, TXN)
    before = sum(float(r[3]) for r in rows)
    c = deob.spread_contributions(df, first_fy=2017)
    after = float(c.agg(F.sum("value")).first()[0])
    assert abs(before - after) < 1e-6
    classes = {r["award_key"]: r["award_class"] for r in deob.award_class(df).collect()}
    assert classes == {"A": "both", "B": "only_neg", "C": "none", "D": "both"}


def test_none_award_unchanged(spark):
    rows = [("C", "Y", 2019, Decimal("5.55")), ("C", "Y", 2020, Decimal("1.00"))]
    assert _totals(spark, rows) == {2019: 5.55, 2020: 1.0}


def test_fiscal_year_boundary(spark):
    df = spark.createDataFrame([(dt.date(2017, 9, 30), "2017-9"), (dt.date(2017, 10, 1), "2017-10"),
                                (dt.date(2016, 12, 31), "2016-12"), (dt.date(2024, 1, 1), "2024-1")],
                               "d date, ym string")
    got = df.select(fiscal.fiscal_year("d").alias("a"), fiscal.fiscal_year_as_coded("ym").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(2017, 2017), (2018, 2017), (2017, 2017), (2024, None)]


def test_code_lists_local_government(spark):
    df = spark.createDataFrame([("2X~8W~A2~HQ~XS",), ("A8",), ("12~H6",), (None,)], "s string")
    got = [r[0] for r in df.select(codes.has_code("s", "12")).collect()]
    assert got == [False, False, True, False]


def test_token_and_substring_agree_on_two_char_codes(spark):
    df = spark.createDataFrame([("12~C7",), ("C8~OH",), ("2F",), ("X12Y",)], "s string")
    tok = [r[0] for r in df.select(codes.has_any_code("s", ["C7", "2F", "OH"])).collect()]
    sub = [r[0] for r in df.select(codes.has_any_code("s", ["C7", "2F", "OH"], mode="substring")).collect()]
    assert tok == sub == [True, True, True, False]
    # a code that is not two characters long is where they differ
    assert [r[0] for r in df.select(codes.has_code("s", "12", mode="substring")).collect()][3] is True
    assert [r[0] for r in df.select(codes.has_code("s", "12")).collect()][3] is False


def test_replace_codes_names(spark):
    df = spark.createDataFrame([("12~C8~QQ~CY",), (None,)], "s string")
    got = [r[0] for r in df.select(codes.replace_codes("s", CODE_NAMES)).collect()]
    assert got == ["U.S. Local Government~City~QQ~Country - Foreign Government", None]


def test_recovered_consolidated_city_county(spark):
    rows = [("U1", "12~C7~C8"), ("U2", "12~C7"), ("U3", "12~C7~C8~OH"), ("U4", "12~C7~C8"), ("U5", "12~C8"),
            ("U6", None)]
    df = spark.createDataFrame(rows, "recipient_uei string, bus_type_string string")
    out = flag_city_gov(df, code_map=CODE_NAMES, blacklist=["U4"])
    got = {r.recipient_uei: r.reason for r in out.collect()}
    assert got == {"U1": "recovered", "U2": None, "U3": None, "U4": None, "U5": "include", "U6": None}


def test_blacklist_as_dataframe(spark):
    df = spark.createDataFrame([("U1", "12~C7~C8"), ("U4", "12~C7~C8")], "recipient_uei string, bus_type_string string")
    bl = spark.createDataFrame([("U4",), (None,)], "recipient_uei string")
    got = {r.recipient_uei: r.is_city_gov for r in flag_city_gov(df, code_map=CODE_NAMES, blacklist=bl).collect()}
    assert got == {"U1": True, "U4": False}


def test_address_key_null_line2(spark):
    df = spark.createDataFrame([("1 MAIN ST", None, "X", "MD", "01234")], "a string, b string, c string, d string, e string")
    assert df.select(text.r_paste("a", "b", "c", "d", "e")).first()[0] == "1 MAIN ST NA X MD 01234"
    assert df.select(text.r_paste(F.col("a"), F.col("b"))).first()[0] == "1 MAIN ST NA"


def test_geocoder_query_leaves_out_line2(spark):
    df = spark.createDataFrame([("1 MAIN ST", "BALTIMORE", "MD", None)],
                               "phys_address_01 string, phys_address_city string, phys_address_st string, "
                               "phys_address_zip string")
    assert df.select(text.geocoder_query()).first()[0] == "1 MAIN ST, BALTIMORE, MD, NA"


def test_place_of_performance(spark):
    rows = [(1, None), (2, "MARYLAND"), (3, "MD"), (4, "TEXAS")]
    df = spark.createDataFrame(rows, "id int, pop_state string").withColumn("state", F.lit("Maryland")) \
        .withColumn("state_code", F.lit("MD"))
    assert sorted(r.id for r in match_place_of_performance(df).collect()) == [1, 2, 3]


def test_negative_city_year_becomes_null(spark, tmp_dir):
    df = spark.createDataFrame([("p1", 2017, -1.0), ("p1", 2018, 5.0)], "place_id string, fy int, total_obligations double")
    out = delivery(df)
    got = {r.date: r.value for r in out.collect()}
    assert got == {"2017-01-01 00:00:00": None, "2018-01-01 00:00:00": 5.0}
    from spendlens.sources.sinks import write_delivery_csv
    write_delivery_csv(out, f"{tmp_dir}/d")
    import glob
    text_out = open(glob.glob(f"{tmp_dir}/d/*.csv")[0]).read().splitlines()
    assert text_out == ["date,value,place_id,category_id", "2017-01-01 00:00:00,NA,p1,", "2018-01-01 00:00:00,5.0,p1,"]


def test_zcta_in_two_places(spark):
    cw = spark.createDataFrame([("0446000", "Mesa city", "85282"), ("0473000", "Tempe city", "85282"),
                                ("0473000", "Tempe city", None), ("0999999", "Other", "85282")],
                               "geoid_place string, name_place string, geoid_zcta string")
    places = spark.createDataFrame([("0446000",), ("0473000",)], "geoid string")
    got = sorted((r.geoid_place, r.geoid_zcta) for r in city_zctas(cw, places).collect())
    assert got == [("0446000", "85282"), ("0473000", "85282")]


def test_placement_join_modes(spark):
    from spendlens.plans import synthetic as syn
    from spendlens.plans.attribution import Chain
    d = "/root/testdata/sf0.001"
    import os
    if not os.path.exists(d):
        return
    inner = Chain(syn.inputs(spark, d), syn.test_params()).txn_placed().count()
    left = Chain(syn.inputs(spark, d), syn.test_params(placement_join="left")).txn_placed().count()
    assert left == syn.transactions(spark, d).count() and inner < left
