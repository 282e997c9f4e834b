"""Reproducible sample of n rows (the reference's ``slice_sample`` for eyeballing)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_n(df: DataFrame, n: int = 100, key: str | list[str] = "recipient_uei", seed: int = 42) -> DataFrame:
    """The n rows with the smallest md5 of seed and key.

    Runs as a top-n per partition plus a final top-n (TakeOrderedAndProject),
    so no task ever holds more than n rows, and the same input gives the
    same sample on every run.
    """
    keys = [key] if isinstance(key, str) else list(key)
    h = F.md5(F.concat_ws("~", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("__h", h).orderBy("__h", *keys).limit(n).drop("__h")
