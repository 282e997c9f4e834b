"""Readers and writers on small generated files."""

from pyspark.sql import functions as F

from spendlens.operators.dedup import first_per_key
from spendlens.sources.business_types import code_map, read_business_types
from spendlens.sources.crosswalk import read_crosswalk
from spendlens.sources.places import prepare_places, read_city_places
from spendlens.sources.registry import read_registry
from spendlens.sources.shards import read_parquet_shards, union_shards
from spendlens.sources.snapshots import latest_snapshot, read_named_snapshots, write_snapshot


def _registry_line(uei, name, zip_, struct, biz, width=40):
    cells = [""] * width
    cells[0], cells[11], cells[15], cells[17], cells[18] = uei, name, "1 MAIN ST", "BALTIMORE", "MD"
    cells[19], cells[21], cells[27], cells[31] = zip_, "USA", struct, biz
    return "|".join(cells)


def test_registry_positions_and_first_row(spark, tmp_dir):
    lines = [_registry_line("AAAAAAAAAAA1", "FIRST", "01234", "2A", "12~C8"),
             _registry_line("AAAAAAAAAAA2", "OTHER", "21201", "2L", "2X"),
             _registry_line("AAAAAAAAAAA1", "SECOND", "01234", "2A", "2X")]
    with open(f"{tmp_dir}/reg.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    reg = read_registry(spark, f"{tmp_dir}/reg.txt", n_columns=40)
    assert reg.columns[:3] == ["recipient_uei", "recipient_CAGE", "recipient_name"]
    r = {x.recipient_uei: x for x in first_per_key(reg, "recipient_uei", "ordinal").collect()}
    assert r["AAAAAAAAAAA1"].recipient_name == "FIRST"
    assert r["AAAAAAAAAAA1"].phys_address_zip == "01234"       # leading zero kept
    assert r["AAAAAAAAAAA2"].entity_structure == "2L"


def test_crosswalk_and_places(spark, tmp_dir):
    with open(f"{tmp_dir}/cw.txt", "w") as f:
        f.write("OID_ZCTA5_20|GEOID_ZCTA5_20|GEOID_PLACE_20|NAMELSAD_PLACE_20\n1|85282|0446000|Mesa city\n"
                "2||0473000|Tempe city\n")
    cw = read_crosswalk(spark, f"{tmp_dir}/cw.txt")
    assert sorted((r.geoid_place, r.geoid_zcta) for r in cw.collect()) == [("0446000", "85282"), ("0473000", None)]
    with open(f"{tmp_dir}/places.csv", "w") as f:
        f.write('SOLE Place ID,2020 Census GEOIDs,City name,State Code,State,SoLE region,Population 2021,Extra\n'
                'c-us-ky-lou,"2148000, 2148006",Louisville,KY,Kentucky,South,"628,594",x\n'
                'c-us-md-bal,2404000,Baltimore,MD,Maryland,East,576498,y\n')
    p = prepare_places(read_city_places(spark, f"{tmp_dir}/places.csv"))
    rows = sorted((r.place_id, r.geoid, r.city_label, r.pop_21) for r in p.collect())
    assert rows == [("c-us-ky-lou", "2148000", "Louisville, KY", 628594), ("c-us-ky-lou", "2148006", "Louisville, KY", 628594),
                    ("c-us-md-bal", "2404000", "Baltimore, MD", 576498)]


def test_business_types_first_code_wins(spark, tmp_dir):
    with open(f"{tmp_dir}/bt.csv", "w") as f:
        f.write('Code,Name\r\nCY,Country - Foreign Government\r\n12,U.S. Local Government\r\nCY,Foreign Government\r\n'
                '5,Alaskan Native Corporation Owned Firm\r\nG9,"Individual or concern, other"')
    m = code_map(read_business_types(spark, f"{tmp_dir}/bt.csv"))
    assert m["CY"] == "Country - Foreign Government"
    assert m["G9"] == "Individual or concern, other"
    assert m["5"].startswith("Alaskan")


def test_snapshots_newest_file_wins(spark, tmp_dir):
    for day, v in (("2024-01-01", "old"), ("2024-03-01", "new")):
        with open(f"{tmp_dir}/city_transactions_{day}.csv", "w") as f:
            f.write(f"id,v\n1,{v}\n2,{v}\n")
    with open(f"{tmp_dir}/notes_2025-01-01.csv", "w") as f:
        f.write("id,v\n9,ignored\n")
    df = read_named_snapshots(spark, tmp_dir, r"city_transactions_\d{4}-\d{2}-\d{2}\.csv", header=True)
    got = sorted((r.id, r.v) for r in latest_snapshot(df).collect())
    assert got == [("1", "new"), ("2", "new")]


def test_snapshot_partitions_and_cache_append(spark, tmp_dir):
    df = spark.createDataFrame([(1, 10.0)], "id int, amount double")
    write_snapshot(df, f"{tmp_dir}/snap", "2024-01-01")
    write_snapshot(df.withColumn("amount", F.lit(20.0)), f"{tmp_dir}/snap", "2024-06-01")
    back = spark.read.parquet(f"{tmp_dir}/snap")
    assert [r.amount for r in latest_snapshot(back).collect()] == [20.0]


def test_shards_union(spark, tmp_dir):
    for y in (2017, 2018):
        spark.createDataFrame([(y * 10, 1.5)], "id int, amount double").write.parquet(f"{tmp_dir}/t/shard_year={y}")
    t = read_parquet_shards(spark, f"{tmp_dir}/t")
    assert sorted((r.id, r.shard_year) for r in t.collect()) == [(20170, 2017), (20180, 2018)]
    pruned = t.filter("shard_year = 2018")
    assert "PartitionFilters: [isnotnull(shard_year" in pruned._jdf.queryExecution().executedPlan().toString()
    a = spark.createDataFrame([(1,)], "id int")
    b = spark.createDataFrame([(2, "x")], "id int, extra string")
    assert sorted((r.id, r.extra) for r in union_shards([a, b]).collect()) == [(1, None), (2, "x")]
