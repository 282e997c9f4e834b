"""Generic operators: dedup, NULL-safe joins, quality, sampling, geocoding."""

from pyspark.sql import functions as F

from spendlens.operators.dedup import first_per_key
from spendlens.operators.geocode import cache_misses, cascade_stats, geocode_cascade, update_cache
from spendlens.operators.joins import anti_join, broadcast_if_small, null_safe_join, semi_join
from spendlens.operators.quality import assert_clean, check_quality, null_counts, registry_rules, \
    subset_violations
from spendlens.operators.sampling import sample_n


def test_first_per_key_keeps_first_row(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"), (None, 3, "n1"), (None, 4, "n2")],
                               "k string, ord int, v string")
    got = {r.k: r.v for r in first_per_key(df, "k", "ord").collect()}
    assert got == {"a": "early", "b": "only", None: "n1"}


def test_null_safe_join_matches_null(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("y", 20)], "k string, b int")
    got = {r.k: (r.a, r.b) for r in null_safe_join(a, b, ["k"], "full").collect()}
    assert got == {None: (1, 10), "x": (2, None), "y": (None, 20)}


def test_semi_anti_with_nulls(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted(r.k for r in semi_join(left, right, "k").collect()) == ["a"]
    assert sorted(str(r.k) for r in anti_join(left, right, "k").collect()) == ["None", "b"]
    assert sorted(str(r.k) for r in semi_join(left, right, "k", null_safe=True).collect()) == ["None", "a"]


def test_broadcast_hint_only_when_small(spark):
    hinted = spark.range(10).join(broadcast_if_small(spark.range(10)), "id")
    assert "strategy=broadcast" in hinted._jdf.queryExecution().optimizedPlan().toString()
    capped = spark.range(10).join(broadcast_if_small(spark.range(10), limit=1), "id")
    assert "strategy=broadcast" not in capped._jdf.queryExecution().optimizedPlan().toString()


def test_quality_rules(spark):
    df = spark.createDataFrame([("ABCDEF123456", "2A", "MD"), ("bad", "ZZ", "MDX"), (None, None, None)],
                               "recipient_uei string, entity_structure string, phys_address_st string")
    r = check_quality(df, registry_rules()).first().asDict()
    assert r == {"rows": 3, "uei_format": 1, "entity_structure_domain": 1, "state_code_length": 1}
    n = null_counts(df, ["recipient_uei", "phys_address_st"]).first().asDict()
    assert n == {"recipient_uei_na_count": 1, "phys_address_st_na_count": 1, "na_sum": 2}
    try:
        assert_clean(check_quality(df, registry_rules()))
        raise RuntimeError("should have raised")
    except AssertionError:
        pass


def test_geocode_cascade_priority_and_stats(spark):
    hits = spark.createDataFrame([("A", 1, 1.0, 2.0), ("B", 1, None, None), ("B", 2, 3.0, 4.0),
                                  ("C", 1, None, None), ("C", 2, None, 5.0), ("C", 3, None, None)],
                                 "full_addy string, provider int, lat double, long double")
    got = {r.full_addy: (r.lat, r.long, r.provider) for r in geocode_cascade(hits).collect()}
    assert got == {"A": (1.0, 2.0, 1), "B": (3.0, 4.0, 2)}
    st = {r.provider: (r.asked, r.found, r.missed) for r in cascade_stats(hits).collect()}
    assert st == {1: (3, 1, 2), 2: (2, 1, 1), 3: (1, 0, 1)}


def test_cache_misses_and_update(spark):
    cache = spark.createDataFrame([("A", 1.0, 2.0)], "full_addy string, lat double, long double")
    addrs = spark.createDataFrame([("A",), ("B",)], "full_addy string")
    assert [r.full_addy for r in cache_misses(addrs, cache).collect()] == ["B"]
    new = spark.createDataFrame([("A", 9.0, 9.0), ("B", 3.0, 4.0)], "full_addy string, lat double, long double")
    got = sorted(tuple(r) for r in update_cache(cache, new).collect())
    assert got == [("A", 1.0, 2.0), ("B", 3.0, 4.0)]


def test_sample_is_reproducible_and_bounded(spark):
    df = spark.range(1000).withColumn("recipient_uei", F.format_string("U%05d", "id"))
    a = [r.recipient_uei for r in sample_n(df, 100).collect()]
    b = [r.recipient_uei for r in sample_n(df.repartition(7), 100).collect()]
    assert len(a) == 100 and a == b


def test_subset_violations(spark):
    t = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "recipient_uei string")
    allowed = spark.createDataFrame([("a",), ("b",)], "recipient_uei string")
    assert subset_violations(t, allowed, "recipient_uei").first()[0] == 1
    assert subset_violations(t.filter("recipient_uei <> 'c'"), allowed, "recipient_uei").first()[0] == 0
