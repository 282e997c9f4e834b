import hashlib
import random

from pyspark.sql import functions as F

from spendlens.llm import simhash as s
from .conftest import make_docs


def expected(rows):
    fp = s.Fingerprinter()
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (d, t) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + other[:half]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), fp(t).hex(), fp(edited).hex(), s.likeness(fp(t), fp(edited)), s.likeness(fp(t), fp(other))))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=str)


def test_next_document_over_ranges(spark, few):
    docs = spark.createDataFrame(few, "doc_id long, text string").withColumn("part", F.lit(1)).withColumn("at", F.lit(1))
    assert got(s.with_next(docs.repartition(7))) == expected(few)


def test_odd_rows(spark):
    texts = [None, "", "one", "one", "é ü", "x " * 30_000, "same text here", "same text here", "b"]
    ids = [3, 9, None, -4, 10**15, 12, 12, 12, None]
    assert got(s.with_next(make_docs(spark, texts, ids))) == expected(list(zip(ids, texts)))
    assert got(s.with_next(make_docs(spark, ["alone here"]))) == expected([(0, "alone here")])
    assert s.with_next(make_docs(spark, [])).count() == 0


def test_query_counts_neighbours(spark, few):
    out = s.op10_simhash(spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r)[:7] for r in out), key=str) == expected(few)
    all_fps = {int(r.fingerprint, 16) for r in out}
    for r in out:
        near = sum(0 < (int(r.fingerprint, 16) ^ x).bit_count() <= s.RADIUS for x in all_fps)
        assert r.n_near == (near if r.doc_id % 20 == 0 else None)


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(1)
    fps = set()
    for _ in range(30):
        base = rng.getrandbits(128)
        fps.add(base)
        for flips in (1, 2, 3, 4, 5):
            x = base
            for b in rng.sample(range(128), flips):
                x ^= 1 << b
            fps.add(x)
    df = spark.createDataFrame([(f"{x:032x}",) for x in fps], "fingerprint string")
    found = {(r.query, r.fingerprint, r.distance) for r in s.near(df, df, 3).collect()}
    assert found == {(f"{a:032x}", f"{b:032x}", (a ^ b).bit_count()) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 3}


def test_likeness_follows_the_edit():
    fp, rng = s.Fingerprinter(), random.Random(2)
    w = [f"w{rng.randrange(5000)}" for _ in range(400)]
    a = fp(" ".join(w))
    light = s.likeness(a, fp(" ".join(w[:390] + ["new"] * 10)))
    half = s.likeness(a, fp(" ".join(w[:200] + [f"v{k}" for k in range(200)])))
    other = s.likeness(a, fp(" ".join(f"u{k}" for k in range(400))))
    assert light > half > other and a == fp(" ".join(w).upper())


def test_a_replaced_word_stays_within_the_radius(spark):
    rng, fp, pairs = random.Random(3), s.Fingerprinter(), []
    for _ in range(40):
        w = [f"w{rng.randrange(5000)}" for _ in range(100)]
        pairs.append((fp(" ".join(w)).hex(), fp(" ".join(w[:50] + ["new"] + w[51:])).hex()))
    df = spark.createDataFrame([(x,) for p in pairs for x in p], "fingerprint string")
    found = {(r.query, r.fingerprint) for r in s.near(df, df).collect()}
    assert sum(p in found for p in pairs) >= 34


def test_tables_find_all_within_twelve(spark):
    rng, fps = random.Random(4), set()
    for _ in range(20):
        base = rng.getrandbits(128)
        fps |= {base} | {base ^ sum(1 << b for b in rng.sample(range(128), flips)) for flips in (1, 6, 11, 12, 13) for _ in range(3)}
    df = spark.createDataFrame([(f"{x:032x}",) for x in fps], "fingerprint string")
    found = sorted((r.query, r.fingerprint, r.distance) for r in s.near(df, df, 12).collect())
    assert found == sorted((f"{a:032x}", f"{b:032x}", (a ^ b).bit_count()) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 12)


def test_probes_are_not_broadcast(spark):
    """Each query makes over a hundred probes, which the planner cannot foresee: whatever the tables' sizes, they are shuffled."""
    rng = random.Random(6)
    df = spark.createDataFrame([(f"{rng.getrandbits(128):032x}",) for _ in range(50)], "fingerprint string")
    found = s.near(df, df)
    assert found.collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
