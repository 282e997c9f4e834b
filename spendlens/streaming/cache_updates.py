"""D11 as Structured Streaming: geocoder answers arrive as files; new
addresses are added to the geocode cache, already cached ones are not.

The reference re-reads its cache CSV, finds the addresses that are missing,
geocodes them and rewrites the whole file. Here the geocoder answers land in
a folder as they come; a file stream feeds micro-batches, and each batch reads
and writes only the buckets of its own addresses (``GeocodeCache.add``). An
address keeps its first answer, so a batch replayed after a failure adds
nothing; the stream's own progress is kept in ``checkpoint_location`` on
shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendlens.sources.bucket_store import Receipt
from spendlens.sources.geocode_cache import GeocodeCache

HITS_SCHEMA = T.StructType([
    T.StructField("full_addy", T.StringType()),
    T.StructField("provider", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
])


def append_new_geocodes(batch: DataFrame, cache_path: str) -> Receipt:
    """One micro-batch: best answer per address, then the uncached ones are added."""
    return GeocodeCache(batch.sparkSession, cache_path).add(batch)


def start_cache_stream(spark: SparkSession, answers_dir: str, cache_path: str, checkpoint_location: str,
                       available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    answers = spark.readStream.schema(HITS_SCHEMA).parquet(answers_dir)
    w = (answers.writeStream.foreachBatch(lambda df, epoch: append_new_geocodes(df, cache_path) and None)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
