"""Incremental geocode-cache update as a file stream."""

from spendlens.sources.geocode_cache import GeocodeCache
from spendlens.streaming.cache_updates import HITS_SCHEMA, start_cache_stream


def test_stream_appends_only_new_addresses(spark, tmp_dir):
    answers, cache, ckpt = f"{tmp_dir}/answers", f"{tmp_dir}/cache", f"{tmp_dir}/ckpt"
    spark.createDataFrame([("A", 1, 1.0, 2.0), ("B", 1, None, None), ("B", 2, 3.0, 4.0)], HITS_SCHEMA) \
        .write.mode("append").parquet(answers)
    q = start_cache_stream(spark, answers, cache, ckpt)
    q.awaitTermination(120)
    first = sorted(tuple(r) for r in GeocodeCache(spark, cache).read().collect())
    assert first == [("A", 1.0, 2.0), ("B", 3.0, 4.0)]
    # a later batch: A again (ignored, already cached) and a new address C
    spark.createDataFrame([("A", 1, 9.0, 9.0), ("C", 3, 5.0, 6.0)], HITS_SCHEMA).write.mode("append").parquet(answers)
    q = start_cache_stream(spark, answers, cache, ckpt)
    q.awaitTermination(120)
    second = sorted(tuple(r) for r in GeocodeCache(spark, cache).read().collect())
    assert second == [("A", 1.0, 2.0), ("B", 3.0, 4.0), ("C", 5.0, 6.0)]
