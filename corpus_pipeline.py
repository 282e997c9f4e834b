"""The corpus pipeline: each stage applies one training-data operator to all rows its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of ``documents``.

* language: documents whose language cannot be told are rejected; all others stay as they are.
* near_duplicates: of each component of documents with a Jaccard similarity of 0.8 over runs of five words the one with the least id stays (of rows with that
  id the first text in order); a document without words stays.
* decontamination: documents that hold a window of a benchmark item go.
* private: personal data in the texts is replaced by surrogates; no document goes.
* packing: the texts are tokenised and packed; one row for each piece of a document in a sequence.

Nulls, empty and repeated rows: see each operator; a null id is its own group unless its text is like another's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import decontaminate, jaccard_join, langid, packing, pii
from spendlens.llm.common import small_batches, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return langid.keep_identified(docs)


NEAR_WORDS, NEAR_PERCENT = 5, 80


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard_join.keep_representatives(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = pii.replace_private(docs, into=None)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.placements(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("private", private), ("packing", pack)]
# the language model, the keyed surrogates and the tokenizer are not SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
