import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SF = "/root/testdata/sf0.001"


def make_docs(spark, texts, ids=None, lang="en", source="src1"):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, source, len(t) if t is not None else None) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def few(spark):
    """The documents of the smallest tables, as rows."""
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
