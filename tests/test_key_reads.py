"""Key pushdown into yearly databases: plans, the statements they send, and the rows they keep."""

import duckdb
import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from spendlens.plans.params import Params
from spendlens.plans.pipeline import load_inputs, run
from spendlens.sources.key_reads import plan_keys, read_databases, read_frames

from test_pipeline import _world

ODD = ["A1", "A2", "B'1", "B\\1", "", "é", "Z9", "A1"]


def _keys(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "recipient_uei string")


def test_literals_in_chunks(spark):
    plan = plan_keys(_keys(spark, ["K3", "K1", None, "K2", "K1", "O'K"]), column="uei", chunk_keys=2)
    assert (plan.mode, plan.n_keys, plan.exact, plan.partitions(7)) == ("in", 4, True, 14)
    assert plan.statements("transactions", ["id", "uei"]) == [
        "SELECT id, uei FROM transactions WHERE uei IN ('K1', 'K2')",
        "SELECT id, uei FROM transactions WHERE uei IN ('K3', 'O''K')"]


def test_ranges_beyond_the_bound_do_not_overlap(spark):
    wanted = [f"K{i:04d}" for i in range(0, 3000, 3)]
    plan = plan_keys(_keys(spark, wanted), max_keys=999, ranges=8)
    assert plan.mode == "range" and not plan.exact and plan.n_keys is None and 1 < len(plan.parts) <= 8
    assert all(lo <= hi for lo, hi in plan.parts)
    assert all(a[1] < b[0] for a, b in zip(plan.parts, plan.parts[1:]))
    assert plan.parts[0][0] == "K0000" and plan.parts[-1][1] == "K2997"
    assert plan.statements("t")[0].startswith('SELECT * FROM t WHERE recipient_uei COLLATE "C" >= \'K0000\' AND recipient_uei COLLATE "C" <= \'')
    assert plan_keys(_keys(spark, wanted), max_keys=1000).mode == "in"       # the bound itself


@pytest.mark.parametrize("limits", [{"chunk_keys": 2}, {"max_keys": 3, "ranges": 3, "collation": None}])
def test_the_statements_keep_the_wanted_rows(spark, limits):
    """The text is run by another engine: together the partitions hold every wanted row once (ranges: and no row twice)."""
    con = duckdb.connect()
    rows = [(i, k) for i, k in enumerate(ODD + ["A3", "M", None, "zz"])]
    con.execute("CREATE TABLE transactions (id INT, recipient_uei VARCHAR)")
    con.executemany("INSERT INTO transactions VALUES (?, ?)", rows)
    plan = plan_keys(_keys(spark, ODD + [None, "absent"]), **limits)
    got = [r for q in plan.statements("transactions") for r in con.execute(q).fetchall()]
    assert len(got) == len(set(got))
    want = {r for r in rows if r[1] in ODD}
    assert set(got) == want if plan.exact else want <= set(got)


def test_frames_by_either_plan(spark):
    frames = {2019: spark.createDataFrame([(1, "A1", 5), (2, "Q", 5), (3, None, 5)], "id int, recipient_uei string, x int"),
              None: spark.createDataFrame([(4, "B'1", 1), (5, "B\\1", 1), (6, "A0", 2)], "id int, recipient_uei string, x int"),
              2018: spark.createDataFrame([(7, "A1")], "id int, recipient_uei string")}       # a column added later is missing
    keys = _keys(spark, ODD)
    for limits in ({}, {"max_keys": 2, "ranges": 2}):
        got = read_frames(frames, plan_keys(keys, **limits), keys)
        assert sorted((r.id, r.x) for r in got.collect()) == [(1, 5), (4, 1), (5, 1), (7, None)]
    with pytest.raises(ValueError, match="range plan needs the keys"):
        read_frames(frames, plan_keys(keys, max_keys=2))
    nobody = _keys(spark, [None])
    assert plan_keys(nobody).mode == "none" and read_frames(frames, plan_keys(nobody)).count() == 0
    with pytest.raises(ValueError, match="no shard"):
        read_frames({}, plan_keys(keys))


def test_the_run_asks_databases_for_its_recipients_only(spark, tmp_dir, monkeypatch):
    """Two yearly databases in place of files: same totals, and the predicates each is asked with (no server is needed)."""
    paths = _world(spark, tmp_dir)
    params = Params(first_fy=2017, cell=0.25)
    inp, codes = load_inputs(spark, paths)
    want = sorted(tuple(r) for r in run(spark, inp, params)["annual_net_totals"].collect())
    asked = []

    def jdbc(self, url, table, predicates=None, properties=None, **kw):
        asked.append((url, table, predicates, properties))
        year = int(url[-4:])
        cond = " OR ".join(f"({p})" for p in predicates)
        return spark.read.parquet(f"{tmp_dir}/txn/shard_year={year}").filter(F.expr(cond))

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    paths.transactions = {y: f"jdbc:postgresql://host/fy{y}" for y in (2019, 2018)}
    paths.database_table, paths.database_properties = "rpt.transactions", {"user": "u"}
    inp, codes = load_inputs(spark, paths, params)
    assert sorted(tuple(r) for r in run(spark, inp, params)["annual_net_totals"].collect()) == want
    one = ["recipient_uei IN ('U00000000001', 'U00000000002')"]               # the private company is not asked for
    assert asked == [(f"jdbc:postgresql://host/fy{y}", "rpt.transactions", one, {"user": "u"}) for y in (2018, 2019)]
    assert inp.transactions.filter("recipient_uei = 'U00000000003'").count() == 0


def test_no_wanted_key_opens_no_database(spark, monkeypatch):
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda *a, **k: pytest.fail("opened"))
    got = read_databases(spark, {2019: "jdbc:x"}, plan_keys(_keys(spark, [])))
    assert got.count() == 0 and "award_key" in got.columns
