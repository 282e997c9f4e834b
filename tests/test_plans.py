"""Plan shape: what must hold for the operators to scale."""

import os
from decimal import Decimal

import pytest

from spendlens.operators import deobligations as deob

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spreading_pre_aggregates_before_every_shuffle(spark):
    rows = [("HOT", "X", 2017 + i % 7, Decimal(1 + i % 5) * (-1 if i % 3 == 0 else 1)) for i in range(3000)]
    rows += [(f"A{i}", "Y", 2018, Decimal("2.00")) for i in range(1500)]
    df = spark.createDataFrame(rows, "award_key string, city_label string, fy int, amount decimal(18,2)")
    out = deob.annual_net_totals(df, first_fy=2017)
    plan = _plan(out)
    assert "Window" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert plan.count("partial_") >= 3            # every Exchange is fed by a partial aggregate
    exact = deob.annual_net_totals(df, first_fy=2017, as_double=False)
    hot_total = sum(r.total for r in exact.collect() if r.city_label == "X")
    # shares are rounded to 6 places once per award and year
    assert abs(hot_total - sum(r[3] for r in rows if r[0] == "HOT")) <= Decimal("0.00001")


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_flagship_joins_transactions_once_with_broadcast(spark):
    from spendlens.plans import catalog
    df = catalog.queries()["annual_net_totals"](spark, SF)
    df.count()
    plan = _plan(df)
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin [recipient_uei" in plan


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_flagship_without_broadcast_gives_same_totals(spark):
    """Beyond the size limit the big join is a shuffle join; results do not change."""
    from spendlens.plans import synthetic as syn
    from spendlens.plans.attribution import Chain
    expected = sorted((tuple(r) for r in Chain(syn.inputs(spark, SF), syn.test_params()).annual_net_totals().collect()), key=str)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        ch = Chain(syn.inputs(spark, SF), syn.test_params(broadcast_limit=0))
        filtered = ch.filtered()
        filtered.count()
        assert "SortMergeJoin" in _plan(filtered)
        got = sorted((tuple(r) for r in ch.annual_net_totals().collect()), key=str)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_flagship_scans_transactions_once(spark):
    """The totals need no pre-scan for active recipients: one pass over the transactions."""
    from spendlens.plans import synthetic as syn
    from spendlens.plans.attribution import Chain
    ch = Chain(syn.inputs(spark, SF), syn.test_params())
    plan = ch.annual_net_totals()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_no_raw_transaction_shuffle_by_recipient(spark):
    """Whatever the registry's size: transactions are shuffled by UEI only as distinct UEIs, or not at all."""
    from spendlens.plans import synthetic as syn
    from spendlens.plans.attribution import Chain
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        ch = Chain(syn.inputs(spark, SF), syn.test_params())
        ueis = _plan(ch.txn_ueis())
        scan = ueis.index("l_orderkey")
        assert "partial" not in ueis or ueis.count("HashAggregate") >= 2
        assert "keys=[recipient_uei" in ueis[:scan]      # the distinct stands between the scan and the join
        for df in (ch.txn_placed(), ch.txn_registry(), ch.filtered()):
            assert "BroadcastHashJoin [recipient_uei" in _plan(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_hint_for_a_compressible_or_large_side(spark, tmp_dir):
    from pyspark.sql import functions as F

    from spendlens.operators.joins import broadcast_if_small, measured_bytes
    path = f"{tmp_dir}/repetitive"
    spark.range(200_000).select(F.concat(F.lit("x" * 400), F.col("id") % 3).alias("k")).write.parquet(path)
    side = spark.read.parquet(path)
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path))
    assert size < 4 << 20 < 64 << 20 < measured_bytes(side)
    assert "ResolvedHint" not in broadcast_if_small(side)._jdf.queryExecution().analyzed().toString()
    tiny = spark.range(3)
    assert "ResolvedHint" in broadcast_if_small(tiny)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(tiny, 0)._jdf.queryExecution().analyzed().toString()


def test_no_hint_for_a_large_spatial_index(spark):
    from spendlens.operators.spatial import containing_places, index_rows
    world = spark.createDataFrame([("w", 0, 0, k, *e) for k, e in enumerate([(-180.0, -90.0, 180.0, -90.0), (180.0, -90.0, 180.0, 90.0),
                                                                             (180.0, 90.0, -180.0, 90.0), (-180.0, 90.0, -180.0, -90.0)])],
                                  "place_id string, part int, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    cells, bands = index_rows(world, "place_id", 0.05, 0.0125)
    assert cells == 7201 * 3601 and bands > 25_000
    points = spark.createDataFrame([(1, 0.0, 0.0)], "point_id int, x double, y double")
    hints = lambda **kw: containing_places(points, world, **kw)._jdf.queryExecution().analyzed().toString().count("ResolvedHint")
    assert hints(cell=0.05) == 1      # the bands are few, the cells are not
    assert hints(cell=5.0, band=1.0) == 2 and hints(cell=5.0, band=1.0, broadcast_limit=0) == 0


def test_newest_snapshot_is_a_literal_partition_filter(spark, tmp_dir):
    from spendlens.sources.snapshots import latest_snapshot, write_snapshot
    for day, n in (("2024-01-01", 3), ("2024-02-01", 5)):
        write_snapshot(spark.range(n), f"{tmp_dir}/snap", day)
    df = latest_snapshot(spark.read.parquet(f"{tmp_dir}/snap"))
    assert df.count() == 5
    assert "PartitionFilters: [isnotnull(snapshot_date" in _plan(df) and "2024-02-01" in _plan(df)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_invariants_on_test_tables(spark):
    """§5 invariants: disjoint polygons give 0 or 1 place per point; award classes partition the groups;
    spreading conserves money per (award, place)."""
    from pyspark.sql import functions as F

    from spendlens.plans import catalog
    from spendlens.plans.synthetic import FIRST_FY
    q = catalog.queries()
    pip = q["point_in_polygon"](spark, SF)
    assert pip.agg(F.max("n_hits")).first()[0] <= 1
    filtered = catalog.chain(spark, SF).filtered()
    classes = deob.award_class(filtered)
    groups = filtered.select("award_key", "city_label").distinct().count()
    assert classes.count() == groups
    assert {r.award_class for r in classes.select("award_class").distinct().collect()} == {"none", "both", "only_neg"}
    assert filtered.where("fy IS NULL").count() > 0      # undated rows are part of the data
    before = filtered.groupBy("award_key", "city_label").agg(F.sum("amount").alias("a"))
    after = deob.spread_contributions(filtered, FIRST_FY).groupBy("award_key", "city_label").agg(F.sum("value").alias("b"))
    worst = before.join(after, ["award_key", "city_label"], "left").select(
        F.max(F.abs(F.col("a") - F.coalesce("b", F.lit(0))))).first()[0]
    assert worst <= Decimal("0.00001") * 8      # at most one 6-place rounding per year
