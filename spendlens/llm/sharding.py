"""Two-pass external shuffle into training shards. DataFrame functions only.

Pass 1 scatters every record with seeded hashes: the shard is the winner of a rendezvous hash of the key
(so the key and the number of shards decide, and one more shard takes rows only into itself), and inside
the shard a second seeded hash picks one of the buckets, of which there are so many that each holds
about ``bucket_bytes``. The scattered records are written to the shared folder. Pass 2 gathers each
bucket, permutes it with the built-in Fisher-Yates ``shuffle`` and numbers its rows.

The bucket hash also takes the row's own number, so repeated rows or one hot key spread over all
buckets of their shard: no task ever holds more than its few buckets.

Edge cases: a null key is a key like any other; null text counts 0 bytes; equal rows are separate records;
an empty table gives no rows; every input column, whatever its name, travels inside ``record``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, written

SHARDS, SEED, BUCKET_BYTES, ROW_BYTES = 40, 20177, 4 << 20, 16


def rendezvous(key, n_shards: int, seed: int = SEED) -> F.Column:
    """The shard whose seeded hash of the key is greatest."""
    scores = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)),
                         lambda s: F.struct(F.xxhash64(F.lit(seed), s, key).alias("score"), s.alias("shard")))
    return F.array_max(scores)["shard"]


def record_bytes(text) -> F.Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def scatter(df: DataFrame, key: str, text: str, n_shards: int, seed: int, bucket_bytes: int) -> tuple[DataFrame, int]:
    """Pass 1: records with their shard and bucket, written; and the number of buckets in all."""
    k = F.col("record")[key]
    total = df.agg(F.sum(record_bytes(F.col(text)))).first()[0] or 0
    per_shard = max(1, -(-total // (n_shards * bucket_bytes)))
    rows = (df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record"))
            .withColumn("row", F.monotonically_increasing_id())
            .select("record", "row", rendezvous(k, n_shards, seed).alias("shard"),
                    rendezvous(k, n_shards + 1, seed).alias("grown_shard"),
                    F.pmod(F.xxhash64(F.lit(seed + 1), k, "row"), F.lit(per_shard)).cast("int").alias("bucket")))
    return written(rows, "sharding-scatter"), per_shard * n_shards


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", n_shards: int = SHARDS, seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every row of ``df`` once, as ``shard, slot, grown_shard, record``; slots are gapless from 0 in each shard."""
    rows, n_buckets = scatter(df, key, text, n_shards, seed, bucket_bytes)
    within = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
             .select("shard", "bucket", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("first_slot")))
    parts = max(1, n_buckets // 4)
    buckets = (rows.repartition(parts, "shard", "bucket").groupBy("shard", "bucket")
               .agg(F.collect_list(F.struct("row", "grown_shard", "record")).alias("rows"))
               .withColumn("rows", F.array_sort("rows"))
               # the generator of ``shuffle`` runs through a partition's rows: a fixed order makes a repeated task give the same
               .sortWithinPartitions("shard", "bucket")
               .withColumn("rows", F.shuffle("rows", seed)))
    return (buckets.join(first, ["shard", "bucket"])
            .select("shard", "first_slot", F.posexplode("rows").alias("at", "r"))
            .select("shard", (F.col("first_slot") + F.col("at")).cast("long").alias("slot"),
                    F.col("r.grown_shard").alias("grown_shard"), F.col("r.record").alias("record")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard; inside, the records in the order of their slots over the files' names."""
    flat = sharded.select("shard", "slot", "record")
    (flat.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"))
    text = F.col("record.text")
    return out.select(F.col("record.doc_id").alias("doc_id"), record_bytes(text).alias("size"),
                      F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
                      "shard", "slot", "grown_shard")
