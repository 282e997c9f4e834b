"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_all_queries_match_oracle(spark):
    from spendlens.plans import catalog
    from tools.check_oracle import compare_all
    ok, failures, rows_only = compare_all(spark, SF, only=list(catalog.queries()), verbose=False)
    assert failures == []
    assert rows_only == []
    assert ok == len(catalog.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["city_label", "fy", "no_deobs", "deob_with_ob", "deob_without_ob", "total"]
    assert df.count() > 0
