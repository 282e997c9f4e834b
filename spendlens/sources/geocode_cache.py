"""The cache of geocoded addresses.

The cache is a keyed table (``bucket_store``): answers for new addresses are added to their buckets and nothing else is
read or rewritten. An address keeps its first answer, so adding the same answers again changes nothing. Caches of other
kinds are read too: a CSV file with a header (``NA`` and empty cells are missing) or Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.geocode import cache_misses, geocode_cascade
from spendlens.sources.bucket_store import BucketStore, Receipt, _Files

CACHE_SCHEMA = "full_addy string, lat double, long double"


class GeocodeCache:
    def __init__(self, spark: SparkSession, base: str, n_buckets: int = 64):
        self.store = BucketStore(spark, base, CACHE_SCHEMA, ["full_addy"], n_buckets=n_buckets)

    def read(self) -> DataFrame:
        return self.store.read()

    def misses(self, addresses: DataFrame) -> DataFrame:
        """Rows of ``addresses`` without a cached answer; only the buckets of those addresses are read."""
        return cache_misses(addresses, self.store.lookup(addresses)[0])

    def add(self, answers: DataFrame) -> Receipt:
        """K1: the best answer of each address that is found and not cached yet. A null address is none."""
        best = geocode_cascade(with_provider(answers).filter("full_addy IS NOT NULL")).select("full_addy", "lat", "long").persist()
        try:
            m = self.store.manifest()
            known, n = self.store.lookup(best, m)
            return self.store.append(cache_misses(best, known), m=m, files_read=n)
        finally:
            best.unpersist()

    def rebuild(self, answers: DataFrame, n_buckets: int | None = None) -> Receipt:
        """K4: the cache anew from all answers, in place of what it holds."""
        best = geocode_cascade(with_provider(answers).filter("full_addy IS NOT NULL")).select("full_addy", "lat", "long")
        return self.store.rebuild(best, n_buckets)


def with_provider(answers: DataFrame) -> DataFrame:
    """A cache without providers counts as one provider's answers."""
    return answers if "provider" in answers.columns else answers.withColumn("provider", F.lit(1))


def parse_geocode_cells(raw: DataFrame) -> DataFrame:
    """full_addy, provider, lat, long from text cells; what is no number is missing."""
    number = lambda c: F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c)
    provider = F.expr("try_cast(`provider` AS INT)") if "provider" in raw.columns else F.lit(1)
    return raw.select("full_addy", provider.alias("provider"), number("lat"), number("long"))


def read_geocode_csv(spark: SparkSession, path: str) -> DataFrame:
    """A cache as CSV; columns are found by their header names and all others are left out."""
    raw = spark.read.options(header=True, inferSchema=False, nullValue="NA", quote='"', escape='"', multiLine=True).csv(path)
    return parse_geocode_cells(raw)


def read_geocodes(spark: SparkSession, path: str) -> DataFrame:
    """A cache of any kind: a bucket store, CSV (by its ending) or Parquet; full_addy, provider, lat, long."""
    if path.lower().endswith((".csv", ".csv.gz")):
        return read_geocode_csv(spark, path)
    if any(n.startswith("manifest-") for n in _Files(spark, path).names()):
        return with_provider(GeocodeCache(spark, path).read())
    return with_provider(spark.read.parquet(path))
