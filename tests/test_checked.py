"""Rules checked while a table is written, and dumps that are there only when complete."""

import os

import pytest

from spendlens.operators.quality import Rule, registry_rules
from spendlens.plans.params import Params
from spendlens.plans.pipeline import load_inputs, run
from spendlens.sources.checked_sink import QualityBreach, mark_unknown, write_checked
from spendlens.sources.snapshots import NoSnapshot, complete_snapshots, newest_snapshot, write_snapshot

from test_pipeline import _registry_line, _world

REG = "recipient_uei string, entity_structure string, phys_address_st string"


def registry(spark):
    return spark.createDataFrame([("ABCDEF123456", "2A", "MD"), ("bad", "ZZ", "MDX"), (None, None, None), ("ABCDEF123457", "2A", "M")], REG)


def test_counts_and_rows_in_one_pass(spark, tmp_dir):
    reads = spark.sparkContext.accumulator(0)
    source = registry(spark)
    counted = spark.createDataFrame(source.rdd.map(lambda r: (reads.add(1), r)[1]), source.schema)
    got = write_checked(counted, f"{tmp_dir}/r", registry_rules())
    assert (got.rows, got.quarantined) == (4, 2) and got.counts == {"uei_format": 1, "entity_structure_domain": 1, "state_code_length": 2}
    assert reads.value == 4                                          # every row was read once
    listed = {r.recipient_uei: r.violations for r in got.quarantine(spark).collect()}
    assert listed == {"bad": ["uei_format", "entity_structure_domain", "state_code_length"], "ABCDEF123457": ["state_code_length"]}
    assert sorted(str(r.recipient_uei) for r in got.clean(spark).collect()) == ["ABCDEF123456", "None"]
    assert sorted(map(str, got.all(spark).collect())) == sorted(map(str, source.collect())) and reads.value == 4


def test_too_many_stop_after_the_rows_are_listed(spark, tmp_dir):
    with pytest.raises(QualityBreach, match="2 of 4 rows.*state_code_length: 2") as e:
        write_checked(registry(spark), f"{tmp_dir}/r", registry_rules(), max_violations=1)
    assert e.value.report.quarantine(spark).count() == 2
    assert write_checked(registry(spark), f"{tmp_dir}/ok", registry_rules(), max_violations=2).quarantined == 2
    empty = write_checked(registry(spark).limit(0), f"{tmp_dir}/none", registry_rules(), max_violations=0)
    assert empty.rows == 0 and empty.all(spark).count() == 0 and empty.quarantine(spark).columns[-1] == "violations"
    with pytest.raises(ValueError, match="made by the check"):
        write_checked(registry(spark).withColumnRenamed("phys_address_st", "quality"), f"{tmp_dir}/x", [])


def test_unknown_keys_are_a_rule_of_the_same_pass(spark, tmp_dir):
    known = spark.createDataFrame([("ABCDEF123456",), ("ABCDEF123456",), (None,)], "recipient_uei string")
    for limit in (None, 0):
        marked = mark_unknown(registry(spark), known, "recipient_uei", "unknown", limit)
        got = write_checked(marked, f"{tmp_dir}/r{limit}", [Rule("unknown_recipient", "unknown", "true")])
        assert got.rows == 4 and got.counts == {"unknown_recipient": 3}


def test_the_run_leaves_out_and_lists_what_breaks_a_rule(spark, tmp_dir):
    paths = _world(spark, tmp_dir)
    with open(paths.registry, "a") as f:
        f.write(_registry_line("u-bad", "21201", "2A", "12~C8") + "\n")
    inp, codes = load_inputs(spark, paths)
    p = Params(first_fy=2017, code_map=codes, cell=0.25)
    want = sorted(tuple(r) for r in run(spark, inp, p)["annual_net_totals"].collect())
    out = run(spark, inp, p, out_dir=f"{tmp_dir}/out", on_violation="quarantine")
    assert [(r.recipient_uei, r.violations) for r in out["quarantine_registry"].collect()] == [("u-bad", ["uei_format"])]
    assert out["quarantine_transactions"].count() == 0 and sorted(tuple(r) for r in out["annual_net_totals"].collect()) == want
    assert {(r.source, r.rule): (r.rows, r.violations) for r in out["checks"].collect()} == {
        ("registry", "uei_format"): (4, 1), ("registry", "entity_structure_domain"): (4, 0), ("registry", "state_code_length"): (4, 0),
        ("transactions", "award_key_missing"): (3, 0)}
    with pytest.raises(ValueError, match="out_dir"):
        run(spark, inp, p, on_violation="quarantine")


def test_only_complete_dumps_count(spark, tmp_dir):
    base = f"{tmp_dir}/snap"
    with pytest.raises(NoSnapshot):
        newest_snapshot(spark, base)
    first = write_snapshot(spark.createDataFrame([(1, "a"), (2, None)], "id int, t string"), base, "2024-01-01")
    assert first.rows == 2
    second = write_snapshot(spark.createDataFrame([(3,)], "id bigint"), base, "2024-02-01")           # another schema
    spark.createDataFrame([(9,)], "id int").write.parquet(f"{base}/snapshot_date=2024-03-01")          # died before its commit
    assert [s.date for s in complete_snapshots(spark, base)] == ["2024-02-01", "2024-01-01"]
    assert newest_snapshot(spark, base).collect() == [(3,)] and newest_snapshot(spark, base).schema.simpleString() == "struct<id:bigint>"
    os.truncate(f"{base}/snapshot_date=2024-02-01/{next(iter(second.files))}", 10)                     # torn after its commit
    assert sorted(newest_snapshot(spark, base).collect()) == [(1, "a"), (2, None)]
    with pytest.raises(FileExistsError):
        write_snapshot(spark.range(1), base, "2024-01-01")
    write_snapshot(spark.createDataFrame([(4,)], "id int"), base, "2024-03-01")                        # the dead run's day, anew
    assert newest_snapshot(spark, base).collect() == [(4,)]
    with pytest.raises(ValueError):
        write_snapshot(spark.range(1), base, "March")
