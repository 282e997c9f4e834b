import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import katz as k
from .conftest import SF, make_docs


def brute(rows):
    """Katz backoff in a few lines over dictionaries."""
    texts = [(d, [*(t or "").encode().lower().split(), b"\nend"]) for d, t in rows]
    uni, bi = collections.Counter(), collections.defaultdict(collections.Counter)
    for d, t in texts:
        if d is None or zlib.crc32(str(d).encode()) % 5 != 1:
            uni.update(t)
            for a, b in zip([b"\nstart", *t], t):
                bi[a][b] += 1

    def discount(counts):
        n = collections.Counter(counts)
        try:
            common = 6 * n[6] / n[1]
            d = [((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) for r in range(1, 6)]
            assert all(0 < x < 1 for x in d)
        except (ZeroDivisionError, AssertionError):
            less = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
            d = [(r - less) / r for r in range(1, 6)]
        return lambda c: d[c - 1] * c if c <= 5 else c

    du, db = discount(uni.values()), discount([c for x in bi.values() for c in x.values()])
    n = sum(uni.values())
    left = n - sum(du(c) for c in uni.values())
    of, unseen = (n, left / n) if left > 1e-12 else (n + 1, 1 / (n + 1))
    one = lambda w: du(uni[w]) / of if uni[w] else unseen
    contexts = {}
    for v, seen in bi.items():
        c = sum(seen.values())
        mass = c - sum(db(x) for x in seen.values())
        contexts[v] = (c, mass) if mass > 1e-12 else (c + 1, 1)

    def two(v, w):
        if v not in bi:
            return one(w)
        c, mass = contexts[v]
        return db(bi[v][w]) / c if bi[v][w] else mass / c / (1 - sum(map(one, bi[v]))) * one(w)

    for v in list(bi)[:20]:  # sums to one over the seen words and the unseen one
        assert abs(sum(two(v, w) for w in [*uni, b"\nnever"]) - 1) < 1e-9
    out = []
    for d, t in texts:
        out.append((d, d is not None and zlib.crc32(str(d).encode()) % 5 == 1, len(t), sum(uni[w] > 0 for w in t), n,
                    sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (len(uni) + 1))) for w in t), sum(math.log10(two(a, b)) for a, b in zip([b"\nstart", *t], t))))
    return sorted(out, key=str)


def check(df, rows, **kw):
    got = sorted((tuple(r) for r in k.katz_scores(df, **kw).collect()), key=lambda r: str(r[:1]))
    want = sorted(brute(rows), key=lambda r: str(r[:1]))
    assert [g[:5] for g in sorted(got, key=str)] == [w[:5] for w in sorted(want, key=str)]
    for column in (5, 6):
        assert sorted(g[column] for g in got) == pytest.approx(sorted(w[column] for w in want), rel=1e-9, abs=1e-9)
    return got


def test_table_in_many_chunks(spark, few):
    df = spark.createDataFrame(few, "doc_id long, text string").withColumn("chunk", F.lit(1)).withColumn("part", F.lit(2))
    got = check(df.repartition(5), few, chunk_tokens=3000)
    held = [g for g in got if g[1]]
    assert held and sum(g[6] - g[5] for g in held) > 0  # better than the base on texts it has not seen


def test_hot_pair_and_odd_rows(spark):
    texts = ["the end " * 3000, None, "", "\t\n", "One one ONE", "é è", "the end of the end", "x " * 20_000] + [f"the end w{i}" for i in range(300)] + ["same text"] * 9
    ids = [0, 1, 2, 3, None, None, 6, 7, *range(8, 308), *[4] * 9]
    check(make_docs(spark, texts, ids), list(zip(ids, texts)), chunk_tokens=2000)


def test_small_and_empty(spark):
    for texts, ids in ((["a"], [0]), (["held out only"], [next(i for i in range(99) if k.held_out(i))]), (["b b b b b b b b"], [0])):
        check(make_docs(spark, texts, ids), list(zip(ids, texts)))
    assert k.katz_scores(make_docs(spark, [])).count() == 0


def test_query(spark, few):
    got = k.op9_katz(spark, SF)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert got.count() == len(few)


def test_discounts_fall_back():
    assert k.discounts([0] * 6)[1:] == pytest.approx([(r - 0.5) / r for r in range(1, 6)])
    d = k.discounts([1000, 300, 150, 90, 60, 40])
    assert np.all((d[1:] > 0) & (d[1:] < 1))
