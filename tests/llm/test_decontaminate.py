import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from spendlens.llm import decontaminate as d
from .conftest import SF, make_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items, n=10):
    grams = {}
    for i, t in items:
        w = words(t)
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[a:a + k]), set()).add(i)
    out = []
    for ident, t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(g) for g in grams}:
            for a in range(len(w) - k + 1):
                if (g := tuple(w[a:a + k])) in grams:
                    hit |= set(range(a, a + k))
                    found |= {str(x) for x in grams[g] if x is not None}
        out.append((ident, len(w), len(hit), sorted(found)))
    return out


def items_df(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def result(marked):
    return sorted(((r.row.doc_id, r.contamination.n_words, r.contamination.n_hit, r.contamination["items"]) for r in marked.collect()), key=str)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (10, "five six seven eight nine ten eleven twelve thirteen fourteen"),
         (2, "short item"), (3, ""), (4, None), (None, "no id here"), (5, "élan vital")]
TEXTS = ["x ONE two, three-four five six seven eight nine ten eleven twelve y", "one two three four five six seven eight nine", "a short item and short; item",
         None, "", "...", "ÉLAN vital élan vital", "no id here", "five six seven eight nine ten eleven twelve thirteen fourteen " * 3, "w " * 30_000 + "short item"]


def test_against_brute_force(spark):
    ids = [0, 0, 2, 3, None, None, 6, 7, 8, 9]  # equal and null ids
    marked = d.mark(make_docs(spark, TEXTS, ids).withColumn("contamination", F.lit(1)).withColumn("h", F.lit(2)), items_df(spark, ITEMS))
    assert result(marked) == sorted(brute(zip(ids, TEXTS), ITEMS), key=str)
    assert marked.select("row.contamination").distinct().count() == 1


def test_shuffled_set_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(d, "MAX_BROADCAST", 0)
    marked = d.mark(make_docs(spark, TEXTS), items_df(spark, ITEMS))
    assert result(marked) == sorted(brute(enumerate(TEXTS), ITEMS), key=str)


def test_empty_tables(spark):
    docs = make_docs(spark, TEXTS)
    assert d.mark(docs, items_df(spark, [])).where("contamination.n_hit > 0").count() == 0
    assert d.mark(docs.limit(0), items_df(spark, ITEMS)).count() == 0


def test_removal(spark):
    docs, items = make_docs(spark, TEXTS), items_df(spark, ITEMS)
    dirty = {i for i, _, hit, _ in brute(enumerate(TEXTS), ITEMS) if hit}
    kept = d.decontaminate(docs, items)
    assert {r.doc_id for r in kept.collect()} == set(range(len(TEXTS))) - dirty and kept.columns == docs.columns
    cut = {r.doc_id: r.text for r in d.decontaminate(docs, items, remove="spans").collect()}
    assert cut[0] == "x y" and cut[2] == "a and " and cut[3] is None and cut[1] == TEXTS[1] and words(cut[9]) == ["w"] * 30_000


def test_query_equals_oracle(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = sorted(tuple(r) for r in d.op3_decontamination(spark, SF).collect())
    assert got == sorted(con.sql(d.ORACLE).fetchall())
    assert all(r[4] == hashlib.sha256(b"").hexdigest() for r in got if not r[5])
