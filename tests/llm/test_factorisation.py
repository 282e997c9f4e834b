import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import factorisation as fm

from .conftest import make_docs

SF = "/root/testdata/sf0.01"


def labels_of(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int")


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_linear_time_sum_equals_all_pairs():
    rng = np.random.default_rng(1)
    m = fm.Machine(.3, rng.normal(size=50), rng.normal(size=(50, fm.RANK)))
    index = np.array([3, 9, 9, 20, 1, 7])       # two rows; a feature may come twice
    value = rng.normal(size=6)
    starts = np.array([0, 4])
    for got, (a, b) in zip(m.score(index, value, starts), ((0, 4), (4, 6))):
        z = m.bias + sum(m.weights[index[i]] * value[i] for i in range(a, b))
        z += sum(m.factors[index[i]] @ m.factors[index[j]] * value[i] * value[j] for i in range(a, b) for j in range(i + 1, b))
        assert got == pytest.approx(1 / (1 + np.exp(-z)))


def test_fit_learns_a_product_that_no_linear_model_can():
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(600):
        a, b = rng.integers(0, 2, 2)
        rows.append((np.array([a, 2 + b]), np.ones(2), int(a == b)))
    m = fm.fit(rows, 4)
    right = sum((m.score(i, x, np.array([0]))[0] >= .5) == y for i, x, y in rows)
    assert right == len(rows)


def test_held_out_accuracy(spark):
    got = fm.op11_quality(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= fm.KEEP_FROM)).all()
    assert (got["held_out"] == got["doc_id"].map(held)).all()
    both = got.merge(labels, on="doc_id")
    unseen = both[both["held_out"]]
    assert ((unseen["score"] >= .5) == (unseen["quality"] == 1)).mean() >= 0.95
    assert unseen[unseen["quality"] == 1]["predicted"].mean() >= 0.97


def good(i):
    return f"The quiet river number {i} runs past the old mill and the village wakes slowly in the morning light."


def bad(i):
    return f"BUY!! NOW{i}!! $$$ CLICK!! {i} | {i} | {i} !!!"


def small(spark):
    texts = [good(i) if i % 2 else bad(i) for i in range(80)]
    return make_docs(spark, texts), [(i, i % 2) for i in range(80)]


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, pairs = small(spark)
    one = {r["doc_id"]: r["score"] for r in fm.score_quality(docs, labels_of(spark, pairs)).collect()}
    flipped = [(i, 1 - y if held(i) else y) for i, y in pairs]
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.col("text")).withColumn("score", F.lit(1)).withColumn("held_out", F.lit(5))
    two = {r["doc_id"]: r["score"] for r in fm.score_quality(changed, labels_of(spark, flipped)).collect()}
    assert one == two
    assert all((one[i] >= .5) == (y == 1) for i, y in pairs)


def test_odd_rows(spark):
    docs, pairs = small(spark)
    odd = make_docs(spark, [None, "", "   ", "x" * 300_000, good(1), good(1), None], [900, 901, 902, 903, None, 904, 904])
    pairs += [(None, 1), (3, None), (5, 7), (2, 0), (904, 1), (904, 0)]
    rows = fm.score_quality(docs.unionByName(odd), labels_of(spark, pairs)).collect()
    assert len(rows) == 87 and all(0 <= r["score"] <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[900][0]["score"] == by[904][1]["score"] or by[900][0]["score"] == by[904][0]["score"]   # null text, null length
    assert not by[None][0]["held_out"] and by[None][0]["predicted"] == 1
    assert {r["score"] for r in rows if r["doc_id"] in (None, 1)} == {by[1][0]["score"]}               # equal texts


def test_without_labels_or_rows(spark):
    docs, _ = small(spark)
    none = labels_of(spark, [])
    assert {(r["score"], r["predicted"]) for r in fm.score_quality(docs, none).collect()} == {(0.5, 0)}
    assert fm.score_quality(docs.limit(0), none).count() == 0
    lean = fm.score_quality(docs, labels_of(spark, [(i, 1) for i in range(0, 80, 2)])).collect()
    assert min(r["score"] for r in lean) > .5


def test_the_fit_is_bounded(spark):
    docs, pairs = small(spark)
    machine = fm.learn(docs, labels_of(spark, pairs), fit_rows=10)
    assert machine.weights.shape == (fm.WORD_BUCKETS + fm.SHAPE_BUCKETS + fm.BINS * len(fm.STATISTICS),)
    whole = fm.learn(docs, labels_of(spark, pairs), fit_rows=1000)
    assert not np.array_equal(machine.weights, whole.weights)
