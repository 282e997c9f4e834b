import random

from pyspark.sql import functions as F

from spendlens.llm import langid as g
from .conftest import DOCS, SF, make_docs

SYLLABLES = {"aa": ["ka", "ko", "mi", "ta", "ru"], "bb": ["schen", "ung", "keit", "ver", "zu"], "cc": ["eau", "oux", "ent", "que", "ille"]}


def text(rng, language, words=60):
    return " ".join("".join(rng.choice(SYLLABLES[language]) for _ in range(3)) for _ in range(words))


def rows(n=240, seed=0, wrong=0.1):
    rng, out = random.Random(seed), []
    for k in range(n):
        language = rng.choice(sorted(SYLLABLES))
        declared = rng.choice(sorted(SYLLABLES)) if rng.random() < wrong else language
        t = text(rng, language)
        out.append((k, t, declared, f"www.{language}.example.{language}", len(t), language))
    return out


def evidence(spark, data):
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, truth string")
    return df.select("doc_id", "truth", *g.document_evidence())


def test_held_out_accuracy_with_wrong_labels(spark):
    train = rows()
    held = [(1000 + k, t, None, None, n, truth) for k, (_, t, _, _, n, truth) in enumerate(rows(80, 1))]  # text alone
    out = [r for r in g.identify(evidence(spark, train + held).withColumnRenamed("host", "host")).collect()]
    assert sum(r.language == r.truth for r in out if r.doc_id >= 1000) >= 78
    assert all(r.accepted for r in out)


def test_evidence_decides_short_texts(spark):
    data = rows(wrong=0)
    data += [(2000, "x", "aa", "www.aa.example.aa", 1, "aa"), (2001, "x", None, "www.bb.example.bb", 1, "bb"), (2002, "x", "cc", None, 1, "cc")]
    out = {r.doc_id: r for r in g.identify(evidence(spark, data)).collect()}
    assert [out[k].language for k in (2000, 2001, 2002)] == ["aa", "bb", "cc"]


def test_rejections(spark):
    data = rows(wrong=0) + [(3000, None, "aa", None, None, None), (3001, "", None, None, 0, None), (3002, "123 456 !!!", "aa", "h", 11, None),
                            (3003, " ".join("wxzqvj"[k % 6] * 3 for k in range(200)), None, None, 5, None)]
    out = {r.doc_id: r for r in g.identify(evidence(spark, data)).collect()}
    assert not any(out[k].accepted for k in (3000, 3001, 3002, 3003))
    assert all(out[k].accepted for k in range(240))


def test_stage_keeps_rows_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("n", F.lit(1)).withColumn("mean", F.lit(2)).withColumn("row", F.lit(3))
    kept = g.keep_identified(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0 and kept.count() == docs.count()
    assert g.keep_identified(docs.limit(0)).count() == 0


def test_query_on_documents_and_pages(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = g.op7_language(spark, SF).collect()
    found = {r.doc_id: r.language for r in out if r.doc_id is not None}
    assert set(found) == set(docs) and sum(found[d] == docs[d] for d in docs) >= 0.97 * len(docs)
    pages = [r for r in out if r.page_id is not None]
    assert len(pages) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert sum(r.language == r.declared for r in pages if r.declared) >= 0.95 * len([r for r in pages if r.declared])


def test_page_parts(spark):
    html = '<!DOCTYPE html><HTML class="x" lang=\'fr-CA\'><script>var t="</p>";</script><style>p{}</style><!-- no --><p>bon <b>jour</b></p>'
    df = spark.createDataFrame([(1, "https://u:p@WWW.site.example.fr:80/a?b", html), (2, "nonsense", None), (3, None, "<p>x")], "page_id long, url string, html string")
    out = {r.page_id: r for r in g.page_rows(df).collect()}
    assert (out[1].declared, out[1].host, out[1].domain, out[1].suffix, out[1].text.split()) == ("fr", "www.site.example.fr", "example.fr", "fr", ["bon", "jour"])
    assert out[2].host is None and out[2].text is None and out[3].host is None


def test_host_prior_is_smoothed(spark):
    data = [(k, text(random.Random(k), "aa"), "aa", f"h{k % 3}.example.aa", 1, "aa") for k in range(60)]
    data += [(100 + k, text(random.Random(k), "bb"), "bb", "x.other.bb", 1, "bb") for k in range(60)]
    data += [(500, "q", None, "new.example.aa", 1, "aa")]  # a host of its own: its domain speaks for it
    out = {r.doc_id: r for r in g.identify(evidence(spark, data)).collect()}
    assert out[500].language == "aa"
    assert DOCS and make_docs


def test_a_small_language_stays_beside_a_hot_one(spark):
    rng = random.Random(11)
    data = [r for r in rows(wrong=0) if r[5] == "bb"] + [(4000 + k, text(rng, "cc"), "cc", "h", 5, "cc") for k in range(12)]
    hot = spark.range(25_000).select((F.col("id") + 10_000).alias("doc_id"), F.concat(F.lit(text(rng, "aa", 20) + " "), F.col("id") % 7).alias("text"),
                                     F.lit("aa").alias("lang"), F.lit("hot").alias("source"), F.lit(5).cast("long").alias("n_chars"), F.lit("aa").alias("truth"))
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, truth string").unionByName(hot)
    out = g.identify(df.select("doc_id", "truth", *g.document_evidence())).where("doc_id < 10000").collect()
    assert len(out) == len(data) and all(r.language == r.truth and r.accepted for r in out)


def test_more_languages_than_one_block(spark):
    rng = random.Random(12)
    syllables = {f"l{k:02d}": [chr(97 + k // 9) + "bcdfghklm"[k % 9] + v for v in "aeiou"] for k in range(70)}
    data = [(10 * k + i, " ".join("".join(rng.choice(x) for _ in range(3)) for _ in range(40)), language, "h", 5, language)
            for k, (language, x) in enumerate(syllables.items()) for i in range(4)]
    assert all(r.language == r.truth and r.accepted for r in g.identify(evidence(spark, data)).collect())
