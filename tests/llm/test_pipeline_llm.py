"""The pipeline against brute-force stages on the smallest tables, and its behaviour on odd rows."""

import sys

from pyspark.sql import functions as F

import corpus_pipeline as p
from spendlens.llm import pii
from .conftest import SF, make_docs
from .test_decontaminate import brute as contaminated
from .test_jaccard import brute as components
from .test_packing import check as packed


def test_run_equals_brute_force_stages(spark, few):
    kept = dict(few)  # the language stage keeps every text of the table
    groups = components(few)
    kept = {d: kept[d] for d, n, c in groups if not n or d == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {d: kept[d] for d, _, hit, _ in contaminated(sorted(kept.items()), items) if not hit}
    final, keyed = {}, pii.Surrogates(pii.application_key(spark))
    for d, t in kept.items():  # entity by entity; collisions are drawn anew on other data only
        out, last = [], 0
        for a, b, kind, value in pii.find(t):
            out += [t[last:a], keyed.surrogate(kind, value)]
            last = b
        final[d] = "".join(out) + t[last:]
    docs = make_docs(spark, list(kept.values()), list(kept))
    assert pii.exceptions(pii.entities(docs), keyed.key) is None
    packed(p.run(spark, SF).collect(), final)


def test_stages_keep_columns_and_take_odd_rows(spark):
    texts = [None, "", "12345 !!!", "plain words that stand alone here " * 20, "plain words that stand alone here " * 20, "mail me at a.b@site.org " + "more words in this text " * 9]
    docs = make_docs(spark, texts, [1, None, 3, 4, 4, 5]).withColumn("private", F.lit("mine")).withColumn("kinds", F.lit(3))
    for data in (docs, docs.limit(0)):
        for name, stage in p.STAGES[:-1]:
            out = stage(spark, data, SF)
            assert out.columns == data.columns and out.dtypes == data.dtypes, name
            out.count()
        p.STAGES[-1][1](spark, data, SF).count()
    assert p.near_duplicates(spark, docs, SF).where(F.col("doc_id") == 4).count() == 1
    assert len(p.STAGES) == 5 and "corpus_pipeline" in sys.modules


def test_near_duplicates_by_five_words_from_eight_tenths_on(spark):
    words = [f"w{k}" for k in range(400)]
    edited = words[:200] + [f"x{k}" for k in range(32)] + words[232:]  # 360 of 432 runs of five words are shared, 362 of 432 of four
    docs = make_docs(spark, [" ".join(words), " ".join(edited), " ".join(reversed(words))])
    assert [r.doc_id for r in p.near_duplicates(spark, docs, SF).orderBy("doc_id").collect()] == [0, 2]
