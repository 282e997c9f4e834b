"""The entity registry extract (pipe-delimited, no header).

Only 21 of the file's columns are used; they are picked by position and
named. Everything is read as text: UEIs, ZIPs and codes keep leading zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 1-based column positions of the registry extract and names.
REGISTRY_COLUMNS = {
    1: "recipient_uei", 4: "recipient_CAGE", 12: "recipient_name", 13: "recipient_dba",
    16: "phys_address_01", 17: "phys_address_02", 18: "phys_address_city", 19: "phys_address_st",
    20: "phys_address_zip", 21: "phys_address_zip2", 22: "phys_address_country",
    23: "phys_address_cong_dist", 27: "recipient_url", 28: "entity_structure",
    31: "bus_type_counter", 32: "bus_type_string", 33: "primary_NAICS", 34: "NAICS_code_counter",
    35: "NAICS_code_string", 36: "PSC_code_counter", 37: "PSC_code_string",
}


def read_registry(spark: SparkSession, path: str, n_columns: int = 142, sep: str = "|",
                  columns: dict[int, str] | None = None) -> DataFrame:
    """Read the extract with an all-text schema and keep the named positions.

    ``ordinal`` (file order) is kept so "first row per UEI" is defined: file
    offset from ``_metadata`` plus the row's position inside its split.
    """
    columns = columns or REGISTRY_COLUMNS
    width = max(n_columns, max(columns))
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    raw = (spark.read.schema(schema).option("sep", sep).option("header", False)
           .option("quote", "\u0000").option("mode", "PERMISSIVE").csv(path))
    df = raw.select(*[F.col(f"_c{pos - 1}").alias(name) for pos, name in sorted(columns.items())],
                    F.col("_metadata.file_path").alias("__file"),
                    F.col("_metadata.file_block_start").alias("__block"))
    return with_file_ordinal(df)


def parse_registry_lines(df: DataFrame, line: str = "line", sep: str = "|", columns: dict[int, str] | None = None,
                         keep: Sequence[str] = ()) -> DataFrame:
    """The named positions of extract lines held in a column (and the columns ``keep``); an empty field is NULL, as in the file reader."""
    cells = F.split(F.col(line), "\\Q" + sep + "\\E", -1)
    return df.select(*[F.when(F.get(cells, pos - 1) != "", F.get(cells, pos - 1)).alias(name)
                       for pos, name in sorted((columns or REGISTRY_COLUMNS).items())], *keep)


def with_file_ordinal(df: DataFrame) -> DataFrame:
    """Ordinal that follows file order: (file, split start, id inside split).

    ``monotonically_increasing_id`` grows inside a task, and a task reads
    one split in order, so (file, block start, id) sorts rows as in the file.
    """
    rid = F.monotonically_increasing_id()
    return (df.withColumn("__rid", rid)
            .withColumn("ordinal", F.struct("__file", "__block", "__rid"))
            .drop("__file", "__block", "__rid"))
