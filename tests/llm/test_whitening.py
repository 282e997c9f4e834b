import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from spendlens.llm import whitening as W

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])
SF = "/root/testdata/sf0.001"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in zip(ids, vectors)], SCHEMA)


def brute(vectors, k=8):
    """x, deviations and eigenvalues of the covariance by numpy."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    t = n * x - s
    cov = (t / n).astype(float)
    values, axes = np.linalg.eigh(cov.T @ cov / n)
    order = np.argsort(-values)[:k]
    return n, [int(v) for v in (t * t).sum(axis=1)], cov, values[order], axes[:, order].T, values.sum()


def check(rows, vectors, k):
    n, dev, centred, values, axes, trace = brute(vectors, k)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(got) == set(range(len(vectors)))
    for c in range(1, k + 1):
        w = np.array([got[i][c]["whitened"] for i in range(len(vectors))])
        want = centred @ axes[c - 1] / math.sqrt(values[c - 1])
        want *= np.sign((w * want).sum())
        assert np.allclose(w, want, atol=1e-6)
        assert all(got[i][c]["n"] == n and got[i][c]["deviation"] == dev[i] and got[i][c]["deviation_text"] == str(dev[i]) for i in got)
        assert got[0][c]["explained"] == pytest.approx(values[c - 1] / trace, rel=1e-9)
        assert got[0][c]["identity_error"] < 1e-9


def test_query_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    rows = W.op13_whitening(spark, SF).collect()
    assert len(rows) == 8 * len(table)
    ids = {r["vec_id"]: i for i, r in enumerate(table)}
    check([r.asDict() | {"vec_id": ids[r["vec_id"]]} for r in rows], [r["embedding"] for r in table], 8)


def test_polynomial_and_roots_are_exact(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(-9, 10, (7, 5)).astype(object)
    m = a.T @ a
    poly = W.characteristic_polynomial(spark, m)

    def det(t):
        rows = [[Fraction(int(t * (i == j) - m[i, j])) for j in range(5)] for i in range(5)]
        out = Fraction(1)
        for c in range(5):
            r = next((r for r in range(c, 5) if rows[r][c]), None)
            if r is None:
                return 0
            if r != c:
                rows[r], rows[c], out = rows[c], rows[r], -out
            out *= rows[c][c]
            for q in range(c + 1, 5):
                f = rows[q][c] / rows[c][c]
                rows[q] = [x - f * y for x, y in zip(rows[q], rows[c])]
        return out
    for t in range(-3, 4):
        assert sum(c * t ** i for i, c in enumerate(poly)) == det(t)
    roots = W.largest_roots(poly, 5)
    assert np.allclose([a / 2 ** s for a, s, _ in roots], sorted(np.linalg.eigvalsh(m.astype(float)))[::-1], rtol=1e-12)


def test_equal_roots_make_one_space():
    m = np.diag([4, 4, 1, 0]).astype(object)
    roots = W.largest_roots([0, -16, 24, -9, 1], 3)      # t (t - 1) (t - 4)^2
    assert [(round(a / 2 ** s, 12), n) for a, s, n in roots] == [(4.0, 2), (1.0, 1)]
    v = W.null_space(m, roots[0][0], roots[0][1], 2)
    assert np.allclose(v @ v.T, np.eye(2), atol=1e-15) and np.allclose(v[:, 2:], 0, atol=1e-15)


def test_equal_eigenvalues_whiten_to_the_identity(spark):
    vectors = [[1, 0, 0, 0], [-1, 0, 0, 0], [0, 1, 0, 0], [0, -1, 0, 0], [0, 0, .5, 0], [0, 0, -.5, 0]]
    rows = W.whiten(frame(spark, vectors)).collect()
    assert len(rows) == 6 * 3 and max(r["identity_error"] for r in rows) < 1e-12   # the fourth dimension is constant


def test_unusable_vectors_and_odd_ids(spark):
    good = [[.1, .2, .3], [.3, -.1, .2], [.5, .5, -.4], [.3, -.1, .2], [-.7, .2, .9]]
    bad = [None, [], [.1, None, .2], [float("nan"), 0, 0], [float("inf"), 0, 0], [1e30, 0, 0], [1, 2]]
    rows = W.whiten(frame(spark, good + bad, [None, 7, 7, 7, 1] + list(range(50, 57)))).collect()
    assert len(rows) == 15 and {r["n"] for r in rows} == {5}
    assert sum(r["vec_id"] is None for r in rows) == 3 and sum(r["vec_id"] == 7 for r in rows) == 9
    _, dev, *_ = brute(good)
    assert sorted(r["deviation"] for r in rows if r["component"] == 1) == sorted(dev)


def test_large_entries_stay_exact(spark):
    vectors = [[2.0 ** 40, 1.0], [2.0 ** 40 + 2.0 ** 20, -2.0 ** 38], [-2.0 ** 41, .5], [.25, 2.0 ** 37]]
    rows = W.whiten(frame(spark, vectors)).collect()
    _, dev, *_ = brute(vectors)
    assert {r["vec_id"]: r["deviation_text"] for r in rows} == {i: str(v) for i, v in enumerate(dev)}
    assert all(r["deviation"] is None for r in rows) and rows[0]["identity_error"] < 1e-4


def test_nothing_to_whiten(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [None, [float("nan")]])).count() == 0
    assert W.whiten(frame(spark, [[1, 2]])).count() == 0
    assert W.whiten(frame(spark, [[1, 2], [1, 2]])).count() == 0


def test_other_columns_are_ignored(spark):
    df = frame(spark, [[1, 2], [2, 1], [0, 0]]).selectExpr("vec_id", "embedding", "label AS n", "label AS id", "label AS w", "label AS y")
    assert W.whiten(df).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_text"]
    assert W.whiten(df).count() == 6
