"""Transactions stored by key: joins and award sums without a shuffle, hot keys beside the buckets."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlens.operators import deobligations as deob
from spendlens.sources import colocated
from spendlens.sources.colocated import CoLocated

TXN = "id int, recipient_uei string, award_key string, city_label string, fy int, amount decimal(18,2)"


def txns(spark, n=2000, hot=0):
    rows = [(i, "HOT" if i < hot else f"U{i % 40}", "AHOT" if i < hot else f"A{i % 70}" if i % 50 else None, f"C{i % 3}", 2015 + i % 6 if i % 9 else None,
             Decimal(i % 11 - 4)) for i in range(n)]
    return spark.createDataFrame(rows, TXN)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan_of(df).count("Exchange hashpartitioning")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_a_join_of_stored_tables_has_no_exchange(spark, tmp_dir, no_broadcast):
    t, side = txns(spark), spark.createDataFrame([(f"U{i}", f"p{i}") for i in range(0, 60, 2)] + [(None, "p")], "recipient_uei string, place_id string")
    assert exchanges(t.join(side, "recipient_uei")) > 0
    a, b = CoLocated.write(t, f"{tmp_dir}/t", "recipient_uei", 8), CoLocated.write(side, f"{tmp_dir}/s", "recipient_uei", 8)
    for how in ("inner", "left_semi"):
        got = a.join(b, how)
        assert exchanges(got) == 0 and "SortMergeJoin" in plan_of(got)
        assert rows_of(got.select(*sorted(got.columns))) == rows_of(t.join(side, "recipient_uei", how).select(*sorted(got.columns)))
    with pytest.raises(ValueError, match="does not lie beside"):
        a.join(CoLocated.write(side, f"{tmp_dir}/s4", "recipient_uei", 4))


def test_award_sums_have_no_exchange(spark, tmp_dir):
    t = txns(spark)
    a = CoLocated.write(t, f"{tmp_dir}/t", "award_key", 8, sort=("fy",))
    spread = a.by_key(lambda x: deob.contributions_of(deob.profiles_of_years(deob.award_year_totals(x)), 2016))
    assert exchanges(spread) == 0 and exchanges(deob.spread_contributions(t, 2016)) == 2
    totals = deob.totals_of_parts(deob.place_year_parts(spread))
    assert exchanges(totals) == 1                                   # the places' sums
    assert rows_of(totals) == rows_of(deob.annual_net_totals(t, 2016))


def test_hot_keys_lie_beside_the_buckets(spark, tmp_dir, no_broadcast):
    t = txns(spark, hot=1200)
    a = CoLocated.write(t, f"{tmp_dir}/t", "recipient_uei", 16, hot_rows=100)
    assert a.hot_keys == ["HOT"] and a.hot.count() == 1200 and a.bucketed.count() == 800
    assert a.bucketed.filter("recipient_uei = 'HOT'").isEmpty() and rows_of(a.read()) == rows_of(t)
    side = spark.createDataFrame([(u, f"p{u}") for u in ("HOT", "U1", "U2")], "recipient_uei string, place_id string")
    got = a.join(CoLocated.write(side, f"{tmp_dir}/s", "recipient_uei", 16))
    assert exchanges(got) == 0
    assert rows_of(got.select("id", "place_id")) == rows_of(t.join(side, "recipient_uei").select("id", "place_id"))
    by = CoLocated.write(t, f"{tmp_dir}/a", "award_key", 16, hot_rows=100)
    assert by.hot_keys == ["AHOT"]
    totals = deob.totals_of_parts(deob.place_year_parts(by.by_key(lambda x: deob.spread_contributions(x, 2016))))
    assert rows_of(totals) == rows_of(deob.annual_net_totals(t, 2016))


def test_a_null_key_may_be_hot(spark, tmp_dir):
    t = spark.createDataFrame([(None, i) for i in range(90)] + [(f"k{i}", i) for i in range(10)], "k string, v int")
    a = CoLocated.write(t, f"{tmp_dir}/t", "k", 16, hot_rows=20)
    assert a.hot_keys == [None] and a.hot.count() == 90
    got = a.by_key(lambda x: x.groupBy("k").agg(F.sum("v").alias("s")))
    assert rows_of(got) == rows_of(t.groupBy("k").agg(F.sum("v").alias("s")))
    empty = CoLocated.write(t.limit(0), f"{tmp_dir}/e", "k", 16)
    assert empty.hot_keys == [] and empty.read().count() == 0


def test_opened_again_and_only_when_whole(spark, tmp_dir):
    t = txns(spark, hot=1200)
    a = CoLocated.write(t, f"{tmp_dir}/t", "award_key", 16, hot_rows=100)
    spark.sql(f"DROP TABLE {a._table()}")                           # another session does not know it; the files stay
    b = CoLocated.open(spark, f"{tmp_dir}/t")
    assert (b.key, b.n_buckets, b.hot_keys, b.schema) == (a.key, a.n_buckets, a.hot_keys, a.schema) and rows_of(b.read()) == rows_of(t)
    assert exchanges(b.bucketed.groupBy("award_key", "fy").count()) == 0
    os.makedirs(f"{tmp_dir}/half/buckets")
    with pytest.raises(Exception, match="layout.json"):
        CoLocated.open(spark, f"{tmp_dir}/half")


def test_buckets_grow_with_the_rows(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(colocated, "BUCKET_ROWS", 100)
    for n in (500, 2000, 4000):
        a = CoLocated.write(txns(spark, n), f"{tmp_dir}/t{n}", "id")
        assert a.n_buckets == max(8, n // 100) and CoLocated.open(spark, f"{tmp_dir}/t{n}").n_buckets == a.n_buckets
        assert max(r["count"] for r in a.bucketed.groupBy(F.input_file_name()).count().collect()) < 200
        assert rows_of(a.read()) == rows_of(txns(spark, n))
