"""The keyed table: batches touch their own buckets, versions appear whole, replays and races change nothing."""

import pytest
from pyspark.sql import functions as F

from spendlens.plans.params import Params
from spendlens.plans.pipeline import load_inputs, run
from spendlens.sources.bucket_store import BucketStore, ConcurrentUpdate
from spendlens.sources.geocode_cache import GeocodeCache, read_geocode_csv, read_geocodes

from test_pipeline import _world

ROWS = "k string, v int"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), ROWS)


def state(store):
    return sorted(tuple(r) for r in store.read().collect())


def add_up(df):
    return df.groupBy("k").agg(F.sum("v").cast("int").alias("v"))


def test_a_batch_reads_and_writes_its_buckets_only(spark, tmp_dir):
    cache = GeocodeCache(spark, f"{tmp_dir}/c", n_buckets=32)
    many = spark.range(400).selectExpr("concat('addr ', id) AS full_addy", "CAST(id AS DOUBLE) AS lat", "CAST(-id AS DOUBLE) AS long")
    first = cache.add(many)
    m = cache.store.manifest()
    assert first.rows_written == 400 and sum(len(f) for f in m.files.values()) == len(m.files) == 32
    answers = spark.createDataFrame([("addr 7", 2, 1.0, 1.0), ("new", 2, 5.0, 6.0), ("new", 1, 3.0, 4.0), ("lost", 1, None, 2.0), (None, 1, 1.0, 1.0)],
                                    "full_addy string, provider int, lat double, long double")
    second = cache.add(answers)
    assert second.rows_written == 1 and len(second.buckets) == 1 and second.files_read <= 2       # of 32 files
    after = cache.store.manifest()
    assert [b for b in after.files if after.files[b] != m.files[b]] == list(second.buckets)
    found, n = cache.store.lookup(spark.createDataFrame([("addr 7",)], "full_addy string"))
    assert n == len(found.inputFiles()) <= 2 and found.collect()[0].lat == 7.0                      # the first answer stays
    got = {r.full_addy: (r.lat, r.long) for r in cache.read().collect()}
    assert len(got) == 401 and got["new"] == (3.0, 4.0)
    again = cache.add(answers)
    assert not again.applied and again.version == second.version and cache.read().count() == 401
    assert sorted(r.full_addy for r in cache.misses(answers.filter("full_addy IS NOT NULL")).collect()) == ["lost"]
    assert cache.rebuild(answers).version == 3 and [tuple(r) for r in cache.read().orderBy("full_addy").collect()] == [("addr 7", 1.0, 1.0), ("new", 3.0, 4.0)]


def test_named_batches_are_applied_once_and_merged(spark, tmp_dir):
    s = BucketStore(spark, f"{tmp_dir}/s", ROWS, ["k"], n_buckets=4, max_files=3, merge=add_up)
    assert state(s) == [] and s.manifest().version == 0
    assert s.append(rows(spark, ("a", 1), ("b", 2)), "one").applied
    assert not s.append(rows(spark, ("a", 1), ("b", 2)), "one").applied
    assert s.append(rows(spark), "nothing").applied                     # an empty batch is in, too
    for i in range(5):
        s.append(rows(spark, ("a", 10), (f"c{i}", i)), f"more {i}")
    assert state(s) == [("a", 51), ("b", 2)] + [(f"c{i}", i) for i in range(5)]
    assert max(len(f) for f in s.manifest().files.values()) <= 3         # full buckets were rewritten
    assert s.manifest().batches == ["one", "nothing"] + [f"more {i}" for i in range(5)]


def test_compaction_and_vacuum_keep_the_state(spark, tmp_dir):
    s = BucketStore(spark, f"{tmp_dir}/s", ROWS, ["k"], n_buckets=2, merge=add_up)
    for i in range(4):
        s.append(rows(spark, ("a", 1), ("b", i), ("c", 5)))
    before = state(s)
    assert s.compact().applied and not s.compact().applied
    assert state(s) == before and all(len(f) == 1 for f in s.manifest().files.values())
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_dir}/s/data/orphan")
    assert s.vacuum(keep=1) >= 5 and state(s) == before
    assert "orphan" not in s.files.names("data") and s.vacuum(keep=1) == 0


def test_of_two_writers_one_fails_and_a_dead_one_leaves_no_trace(spark, tmp_dir):
    s = BucketStore(spark, f"{tmp_dir}/s", ROWS, ["k"], n_buckets=2, merge=add_up)
    s.append(rows(spark, ("a", 1)), "x")
    seen = s.manifest()
    s.append(rows(spark, ("a", 2)), "y")
    with pytest.raises(ConcurrentUpdate):
        s.append(rows(spark, ("a", 4)), "z", m=seen)                    # still sees version 1
    assert state(s) == [("a", 3)]
    assert s.append(rows(spark, ("a", 4)), "z").version == 3 and state(s) == [("a", 7)]
    s._write(rows(spark, ("a", 100)), s.manifest())                     # dies before its manifest
    with open(f"{tmp_dir}/s/.draft-dead", "w") as f:
        f.write('{"version": 4, "n_bu')
    assert state(s) == [("a", 7)] and not [n for n in s.files.names() if n.startswith("manifest") and n > "manifest-000000000003.json"]


def test_csv_cache_and_kinds_of_caches(spark, tmp_dir):
    with open(f"{tmp_dir}/latlong.csv", "w") as f:
        f.write('recipient_uei,full_addy,recipient_name,lat,long\n'
                'U1,"1 MAIN ST, ""A"" NA X MD 21201","X, INC",39.25,-76.5\nU2,2 OAK ST NA Y MD 21202,Y,NA,\nU3,"3 ELM\nST",Z,n/a,1e1\n')
    got = sorted((r.full_addy, r.provider, r.lat, r.long) for r in read_geocode_csv(spark, f"{tmp_dir}/latlong.csv").collect())
    assert got == [('1 MAIN ST, "A" NA X MD 21201', 1, 39.25, -76.5), ("2 OAK ST NA Y MD 21202", 1, None, None), ("3 ELM\nST", 1, None, 10.0)]
    plain = read_geocodes(spark, f"{tmp_dir}/latlong.csv")
    plain.write.parquet(f"{tmp_dir}/pq")
    GeocodeCache(spark, f"{tmp_dir}/kc").add(plain)
    assert read_geocodes(spark, f"{tmp_dir}/pq").count() == 3
    assert [r.full_addy for r in read_geocodes(spark, f"{tmp_dir}/kc").collect()] == ['1 MAIN ST, "A" NA X MD 21201']


def test_the_run_adds_answers_and_then_asks_nothing(spark, tmp_dir):
    paths = _world(spark, tmp_dir)
    inp, codes = load_inputs(spark, paths)
    p = Params(first_fy=2017, code_map=codes, cell=0.25)
    want = sorted(tuple(r) for r in run(spark, inp, p)["annual_net_totals"].collect())
    cache = GeocodeCache(spark, f"{tmp_dir}/cache")
    first = run(spark, inp, p, cache=cache)                             # an empty cache: everything is asked, nothing placed
    asked = first["to_geocode"].collect()
    assert [r.query for r in asked] == ["1 MAIN ST, BALTIMORE, MD, 21201"] and first["annual_net_totals"].count() == 0
    answers = spark.createDataFrame([(r.full_addy, 39.2904, -76.6122) for r in asked], "full_addy string, lat double, long double")
    second = run(spark, inp, p, cache=cache, answers=answers)           # answered: placed in the same run
    assert sorted(tuple(r) for r in second["annual_net_totals"].collect()) == want
    third = run(spark, inp, p, cache=cache, answers=answers)            # the answers again: no new version, nothing to ask
    assert third["to_geocode"].count() == 0 and cache.store.manifest().version == 1
    assert sorted(tuple(r) for r in third["annual_net_totals"].collect()) == want
    with pytest.raises(ValueError, match="cache"):
        run(spark, inp, p, answers=answers)
