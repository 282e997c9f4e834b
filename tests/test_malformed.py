"""Torn lines and records: none is lost, each is listed with its text and the reason, too many stop the job."""

import pytest

from spendlens.plans.params import Params
from spendlens.plans.pipeline import load_inputs, run
from spendlens.sources.checked_sink import QualityBreach
from spendlens.sources.crosswalk import read_crosswalk
from spendlens.sources.malformed import read_crosswalk_strict, read_places_strict, read_registry_strict
from spendlens.sources.registry import read_registry

from test_pipeline import _registry_line, _world


def test_registry_lines(spark, tmp_dir):
    good = [_registry_line(f"U{i:011d}", "21201", "2A", "12~C8") for i in range(4)]
    lines = [good[0].encode(), b"U00000000009|CUT", good[1].encode() + b"|more", b"", good[2].encode(), good[3].replace("MAIN", "MÄIN").encode("latin-1"), ("x|" * 39 + "é").encode()]
    with open(f"{tmp_dir}/reg.txt", "wb") as f:
        f.write(b"\n".join(lines) + b"\n")
    rows, report = read_registry_strict(spark, f"{tmp_dir}/reg.txt", f"{tmp_dir}/out", 40, max_malformed=None)
    assert report.rows == 6 and report.counts == {"too_few_fields": 1, "too_many_fields": 1, "bad_encoding": 1}
    assert [r.recipient_uei for r in rows.orderBy("ordinal").collect()] == ["U00000000000", "U00000000002", "x"]
    bad = {tuple(r.violations): r.line for r in report.quarantine(spark).filter("NOT array_contains(violations, 'bad_encoding')").collect()}
    assert bad == {("too_few_fields",): "U00000000009|CUT", ("too_many_fields",): good[1] + "|more"}
    with pytest.raises(QualityBreach, match="3 of 6 rows"):
        read_registry_strict(spark, f"{tmp_dir}/reg.txt", f"{tmp_dir}/out2", 40, max_malformed=2)
    with open(f"{tmp_dir}/ok.txt", "w") as f:
        f.write("\n".join(good) + "\n")
    same, _ = read_registry_strict(spark, f"{tmp_dir}/ok.txt", f"{tmp_dir}/out3", 40)
    plain = read_registry(spark, f"{tmp_dir}/ok.txt", 40)
    assert sorted(same.columns) == sorted(plain.columns)
    cols = [c for c in plain.columns if c != "ordinal"]
    assert [tuple(r) for r in same.orderBy("ordinal").select(cols).collect()] == [tuple(r) for r in plain.orderBy("ordinal").select(cols).collect()]


def test_records_that_do_not_fit_the_header(spark, tmp_dir):
    with open(f"{tmp_dir}/cw.txt", "w") as f:
        f.write("OID|GEOID_ZCTA5_20|GEOID_PLACE_20|NAMELSAD_PLACE_20\n1|85282|0446000|Mesa city\n2|85283\n3||0473000|Tempe city\n4|1|2|3|4\n")
    rows, report = read_crosswalk_strict(spark, f"{tmp_dir}/cw.txt", f"{tmp_dir}/cw", max_malformed=None)
    assert sorted((r.geoid_place, r.geoid_zcta) for r in rows.collect()) == [("0446000", "85282"), ("0473000", None)]
    assert sorted(r.line for r in report.quarantine(spark).collect()) == ["2|85283", "4|1|2|3|4"] and report.counts["not_as_the_header"] == 2
    assert rows.columns == read_crosswalk(spark, f"{tmp_dir}/cw.txt").columns
    with pytest.raises(QualityBreach):
        read_crosswalk_strict(spark, f"{tmp_dir}/cw.txt", f"{tmp_dir}/cw2")
    with open(f"{tmp_dir}/p.csv", "w") as f:
        f.write('SOLE Place ID,2020 Census GEOIDs,City name,State Code,State,SoLE region,Population 2021\n'
                'a,"1, 2","Say ""Hi"", Town",KY,Kentucky,South,"628,594"\nb,3,Cut,KY\n')
    rows, report = read_places_strict(spark, f"{tmp_dir}/p.csv", f"{tmp_dir}/p", max_malformed=1)
    assert [(r.place_id, r.geoid_list, r.city, r.pop_21) for r in rows.collect()] == [("a", "1, 2", 'Say "Hi", Town', 628594)]
    assert [r.line for r in report.quarantine(spark).collect()] == ["b,3,Cut,KY"]
    with open(f"{tmp_dir}/h.csv", "w") as f:
        f.write("Place,GEOIDs\na,1\n")
    with pytest.raises(ValueError, match="has no column"):
        read_places_strict(spark, f"{tmp_dir}/h.csv", f"{tmp_dir}/h")


def test_the_run_lists_malformed_rows(spark, tmp_dir):
    paths = _world(spark, tmp_dir)
    inp, codes = load_inputs(spark, paths)
    p = Params(first_fy=2017, code_map=codes, cell=0.25)
    want = sorted(tuple(r) for r in run(spark, inp, p)["annual_net_totals"].collect())
    with open(paths.registry, "a") as f:
        f.write("U00000000001|TORN\n")
    with pytest.raises(QualityBreach):
        load_inputs(spark, paths, checked_dir=f"{tmp_dir}/c0", registry_fields=40)
    inp, _ = load_inputs(spark, paths, checked_dir=f"{tmp_dir}/c1", registry_fields=40, max_malformed=5)
    out = run(spark, inp, p)
    assert [r.line for r in out["malformed_registry"].collect()] == ["U00000000001|TORN"] and out["malformed_places"].count() == 0
    assert sorted(tuple(r) for r in out["annual_net_totals"].collect()) == want
