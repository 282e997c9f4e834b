"""Money of non-governments by place of performance: names, ambiguous ones, kinds of recipients."""

from decimal import Decimal

from spendlens.operators.nongov import ambiguous_names, nongov_totals, performed_in_city, with_recipient_kind

PLACES = "place_id string, city_label string, city string, state string, state_code string, geoid string"
ROWS = [("mes", "Mesa, AZ", "Mesa", "Arizona", "AZ", "1"), ("mes", "Mesa, AZ", "Mesa", "Arizona", "AZ", "2"), ("iow", "Iowa City, IA", "Iowa City", "Iowa", "IA", "3"),
        ("stl", "St. Louis, MO", "St. Louis", "Missouri", "MO", "4"), ("mo1", "Troy, MO", "Troy", "Missouri", "MO", "5"), ("mo2", "Troy City, MO", "Troy City", "Missouri", "MO", "6"),
        ("d1", "Dup, TX", "Dup", "Texas", "TX", "7"), ("d2", "dup, TX", "DUP", "Texas", "TX", "8"), ("nul", "x", None, "Texas", "TX", "9"), ("ny", "New York, NY", "New York", "New York", "NY", "10")]


def placed(spark, pairs):
    txn = spark.createDataFrame([(i, c, s) for i, (c, s) in enumerate(pairs)], "id int, pop_city string, pop_state string")
    got = {r.id: r.place_id for r in performed_in_city(txn, spark.createDataFrame(ROWS, PLACES)).collect()}
    return [got.get(i) for i in range(len(pairs))]


def test_names_are_found_as_awards_write_them(spark):
    assert placed(spark, [("MESA", "ARIZONA"), ("City of Mesa", "az"), ("mesa  city", " Arizona "), ("Mesa", "TEXAS"), ("Town of MESA.", "AZ")]) == ["mes"] * 3 + [None, "mes"]
    assert placed(spark, [("Iowa City", "IOWA"), ("CITY OF IOWA CITY", "IA"), ("Iowa", "IA")]) == ["iow", "iow", "iow"]
    assert placed(spark, [("ST LOUIS", "MO"), ("Saint-Louis", "MISSOURI"), ("St. Louis City", "MO"), ("LOUIS", "MO")]) == ["stl", "stl", "stl", None]
    assert placed(spark, [(None, "MO"), ("Mesa", None), ("", "AZ"), ("!!", "AZ"), ("City of ", "AZ")]) == [None] * 5


def test_a_whole_name_comes_before_a_bare_one(spark):
    # two places whose bare names are equal: each only by its whole name
    assert placed(spark, [("Troy", "MO"), ("Troy City", "MO"), ("City of Troy", "MO"), ("Troy Town", "MO")]) == ["mo1", "mo2", "mo1", None]


def test_ambiguous_names_belong_to_no_place_and_are_listed(spark):
    assert placed(spark, [("Dup", "TX"), ("City of DUP", "TEXAS")]) == [None, None]
    rows = ambiguous_names(spark.createDataFrame(ROWS, PLACES)).collect()
    assert sorted((r.state_key, r.name_key, r.places) for r in rows) == [("TEXAS", "DUP", 2), ("TX", "DUP", 2)]


def test_kinds_and_totals(spark):
    txn = spark.createDataFrame([("G", "A1", 2018, Decimal("5.00")), ("N", "A2", 2018, Decimal("7.50")), ("N", "A2", 2018, Decimal("-2.25")), ("N", "A3", None, Decimal("1.00")),
                                 ("Z", "A4", 2018, Decimal("3.00")), (None, "A5", 2018, Decimal("4.00")), ("E", "A6", 2018, Decimal("1.00"))],
                                "recipient_uei string, award_key string, fy int, amount decimal(18,2)").selectExpr("*", "'Mesa, AZ' AS city_label")
    reg = spark.createDataFrame([("G", "2A"), ("N", "2L"), ("E", None), ("other", "2A")], "recipient_uei string, entity_structure string")
    for limit in (None, 0):
        rows = nongov_totals(with_recipient_kind(txn, reg, broadcast_limit=limit)).collect()
        assert {(r.fy, r.recipient_kind): (r.transactions, r.awards, float(r.total)) for r in rows} == {
            (2018, "non_government"): (2, 1, 5.25), (None, "non_government"): (1, 1, 1.0), (2018, "unregistered"): (3, 3, 8.0)}
