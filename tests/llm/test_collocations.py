import random
import re
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendlens.llm import collocations as C

from .conftest import make_docs

SF = "/root/testdata/sf0.01"


def brute(rows, top, least, share):
    """The contract in plain Python; ``rows`` are (lang, text)."""
    counts = {}
    for lang, text in rows:
        c = counts.setdefault("und" if lang is None else lang, {k: Counter() for k in (1, 2, 3)})
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    c[k][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in counts.items():
        f = {**c[1], **c[2], **c[3]}
        n = sum(c[1].values())
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items() if len(q) > len(p)):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((score, a, " ".join(p), f[p[:k]], f[p[k:]]))
        kept.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s) for i, (s, a, p, l, r) in enumerate(kept[:top])]
    return sorted(out)


def texts(seed, n, words="ab cd ef gh ij kl mn".split()):
    rng = random.Random(seed)
    return [" ".join(rng.choices(words, weights=[9, 7, 5, 4, 3, 2, 1], k=rng.randint(0, 40))).replace("gh ij", "gh, ij") for _ in range(n)]


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("top,frontier,share,chunk", [(5, 1, 50, 300), (3, 1, 20, 10_000), (40, 2, 90, 2_000_000), (2000, 2, 50, 50)])
def test_against_brute_force(spark, top, frontier, share, chunk):
    docs = [(lang, t) for k, lang in enumerate(["en", "de", None]) for t in texts(k, 40)]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert rows_of(C.collocations(df, top, 4, share, frontier=frontier, chunk=chunk)) == brute(docs, top, 4, share)


def test_a_dropped_best_pair_makes_another_round(spark):
    """The best pairs all fall to triples, so the first threshold does not settle the language."""
    docs = [("en", "new york city. " * 20 + "los angeles county. " * 20 + "a b. a c. a d. e b. e c. e d. " * 12)]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert rows_of(C.collocations(df, 4, 10, 50, frontier=1)) == brute(docs, 4, 10, 50)


def test_repeated_words_ties_and_odd_texts(spark):
    docs = [("en", "x x x x x x"), ("en", "X x x. x x;x x"), ("en", None), ("en", ""), (None, "p q " * 30), ("und", "p q\tP  Q\x0bp q\x0cp q"),
            ("", "é É é É " * 9), ("zz", "\x00 a\x1fb \x00 a\x1fb " * 12), ("en", "long " * 5000 + "tail"), ("xx", ".,;:!? \n\r")] + [("tie", f"k{i} m{i} " * 12 + ".") for i in range(30)]
    df = spark.createDataFrame(docs, "lang string, text string")
    for top in (1, 7, 2000):
        assert rows_of(C.collocations(df, top, 10, 50)) == brute(docs, top, 10, 50)


def test_counts_beyond_64_bit_products(spark):
    one = spark.createDataFrame([(9_000_000_000, 9_000_000_001, 9_000_000_002)], "a long, l long, r long")
    assert one.selectExpr(C._score("a", "l", "r") + " AS s").first()["s"] == 10 ** 6 * 9_000_000_000 ** 2 // (9_000_000_001 * 9_000_000_002)


def test_empty_table_and_other_columns(spark):
    docs = make_docs(spark, ["a b " * 12, "a b " * 12])
    assert C.collocations(docs.limit(0)).count() == 0
    assert C.collocations(make_docs(spark, [None, ""])).count() == 0
    odd = docs.withColumn("phrase", F.lit("x")).withColumn("a", F.lit(1)).withColumn("rank", F.lit(1)).withColumn("f", F.lit(2))
    assert rows_of(C.collocations(odd)) == rows_of(C.collocations(docs)) == brute([("en", "a b " * 12)] * 2, 2000, 10, 50)


def test_bit_sets_hold_every_key(spark):
    keys = [("en", f"w{i} é{i}") for i in range(3000)]
    bits = C.bit_set(spark.createDataFrame(keys, "lang string, phrase string"))
    assert C._hits(bits, b"en", [p.encode() for _, p in keys]).all()
    assert C._hits(bits, b"de", [p.encode() for _, p in keys]).mean() < .01


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({C.ORACLE}) ORDER BY ALL").fetchall()
    assert want and rows_of(C.op12_collocations(spark, SF)) == sorted(want)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_phrases_of_a_chunk_come_in_slices(n):
    """A worker holds the numbers of a chunk's words, not all its phrases, and texts reach it in small batches."""
    ids = np.random.default_rng(n).integers(2, 2000, 300_000).astype(np.int32)
    words = pa.array([b"", b"\n"] + [b"word%05d" % i for i in range(2000)], pa.binary())
    grams = Counter(zip(*(ids[k:len(ids) - n + 1 + k].tolist() for k in range(n))))
    sizes, total, rows = [], 0, 0
    tracemalloc.start()
    for phrases, counts in C._phrases(ids, words, b"en", n, {}):
        sizes.append(len(phrases))
        rows, total = rows + len(counts), total + int(counts.sum())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (rows, total) == (len(grams), len(ids) - n + 1) and max(sizes) <= C.SLICE
    assert peak < 80 * len(ids)


def test_texts_come_in_small_batches(spark):
    name, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set(name, "10000")
        C.collocations(make_docs(spark, ["a b " * 12])).count()
        assert int(spark.conf.get(name)) <= 1000
    finally:
        spark.conf.set(name, before)
