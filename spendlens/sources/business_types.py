"""Business-type code list (Code, Name) -> bounded lookup map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CODES = 10000

SCHEMA = T.StructType([T.StructField("Code", T.StringType()), T.StructField("Name", T.StringType())])


def read_business_types(spark: SparkSession, path: str) -> DataFrame:
    """Read the code list as text with a file-order ordinal."""
    return (spark.read.schema(SCHEMA).option("header", True).option("quote", '"').option("escape", '"').csv(path)
            .withColumn("ordinal", F.monotonically_increasing_id()))


def code_map(codes: DataFrame, max_codes: int = MAX_CODES) -> dict[str, str]:
    """First name per code as a dict, for ``functions.replace_codes``.

    A code list is small by nature; the size is checked (at most
    ``max_codes`` distinct codes) before anything reaches the driver.
    """
    first = (codes.groupBy("Code").agg(F.min_by("Name", "ordinal").alias("Name"))
             .limit(max_codes + 1).collect())
    if len(first) > max_codes:
        raise ValueError(f"code list has more than {max_codes} codes")
    return {r["Code"]: r["Name"] for r in first if r["Code"] is not None}
