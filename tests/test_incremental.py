"""Running totals: batches, corrections and replays give the totals of one run over all transactions."""

import random
from decimal import Decimal

import pytest

from spendlens.operators.deobligations import annual_net_totals, award_class
from spendlens.plans.incremental import IncrementalTotals, UnknownRows
from spendlens.plans.params import Params
from spendlens.plans.pipeline import load_inputs, run

from test_pipeline import _world

SCHEMA = "award_key string, city_label string, fy int, amount decimal(18,2)"


def txns(spark, rows):
    return spark.createDataFrame([(a, c, y, Decimal(str(x))) for a, c, y, x in rows], SCHEMA)


def made(seed, n):
    rng = random.Random(seed)
    return [(rng.choice(["A1", "A2", "A3", "A4", "A5", None]), rng.choice(["X", "Y"]), rng.choice([2015, 2017, 2018, 2019, 2020, None]),
             rng.choice([100, 33.33, -7.01, -50, 0.01])) for _ in range(n)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("mode", ["documented", "as_coded"])
def test_batches_equal_one_run(spark, tmp_dir, mode):
    parts = [made(1, 30), [("B", "X", 2019, -10)], [], made(2, 20)]
    t = IncrementalTotals(spark, f"{tmp_dir}/t", 2017, mode, n_buckets=4)
    seen = []
    for i, part in enumerate(parts):
        assert t.apply(txns(spark, part), f"shard {i}").applied
        seen += part
        assert rows_of(t.totals()) == rows_of(annual_net_totals(txns(spark, seen), 2017, mode))
    assert not t.apply(txns(spark, parts[0]), "shard 0").applied          # run again: nothing
    assert rows_of(t.totals()) == rows_of(annual_net_totals(txns(spark, seen), 2017, mode))
    assert rows_of(t.award_class()) == rows_of(award_class(txns(spark, seen)))
    with pytest.raises(ValueError, match="were made by"):
        IncrementalTotals(spark, f"{tmp_dir}/t", 2016, mode).apply(txns(spark, []), "other rule")


def test_corrections_move_and_end_awards(spark, tmp_dir):
    first = [("A", "X", 2018, 100), ("A", "X", 2019, -30), ("B", "X", 2019, -60), ("C", "Y", 2018, 5)]
    t = IncrementalTotals(spark, f"{tmp_dir}/t", 2017, n_buckets=8)
    t.apply(txns(spark, first), "one")
    # A's deobligation was in Y, B gets an obligation (another class), C goes altogether
    wrong, right = [("A", "X", 2019, -30), ("C", "Y", 2018, 5)], [("A", "Y", 2019, -30), ("B", "X", 2018, 10)]
    t.apply(txns(spark, right), "two", removed=txns(spark, wrong))
    now = [r for r in first if r not in wrong] + right
    assert rows_of(t.totals()) == rows_of(annual_net_totals(txns(spark, now), 2017))
    assert "C" not in {r.award_key for r in t.award_class().collect()}
    # a changed amount leaves the numbers of rows as they are
    t.apply(txns(spark, [("B", "X", 2019, -6)]), "amount", removed=txns(spark, [("B", "X", 2019, -60)]))
    now = [r for r in now if r != ("B", "X", 2019, -60)] + [("B", "X", 2019, -6)]
    assert rows_of(t.totals()) == rows_of(annual_net_totals(txns(spark, now), 2017))
    with pytest.raises(UnknownRows):
        t.apply(txns(spark, []), "wrong amount", removed=txns(spark, [("B", "X", 2018, 9)]))
    with pytest.raises(UnknownRows):
        t.apply(txns(spark, []), "three", removed=txns(spark, [("A", "X", 2018, -1)]))
    assert t.store.manifest().batches == ["one", "two", "amount"]                   # the refused batch left no version
    assert rows_of(t.totals()) == rows_of(annual_net_totals(txns(spark, now), 2017))


def test_a_batch_reads_its_own_awards_only(spark, tmp_dir):
    t = IncrementalTotals(spark, f"{tmp_dir}/t", 2017, n_buckets=32)
    t.apply(txns(spark, [(f"A{i}", "X", 2018, 10) for i in range(300)]), "many")
    got = t.apply(txns(spark, [("A5", "X", 2019, -4)]), "one award")
    assert got.files_read == 1 and len(got.buckets) == 1 and got.rows_written == 1
    assert {r.fy: r.total for r in t.totals().collect()} == {2018: 2996.0}


def test_yearly_shards_through_the_run(spark, tmp_dir):
    paths = _world(spark, tmp_dir)
    inp, codes = load_inputs(spark, paths)
    p = Params(first_fy=2017, code_map=codes, cell=0.25)
    whole = rows_of(run(spark, inp, p)["annual_net_totals"])
    t = IncrementalTotals(spark, f"{tmp_dir}/running", 2017)
    for year in (2018, 2019, 2019):
        part = type(inp)(**{**inp.__dict__, "transactions": inp.transactions.filter(f"shard_year = {year}")})
        out = run(spark, part, p, totals=t, batch=f"fy{year}")
    assert rows_of(out["running_totals"]) == whole
    with pytest.raises(ValueError, match="name of the batch"):
        run(spark, inp, p, totals=t)
