"""Input files whose torn rows are caught, counted and kept, not filled up with NULLs.

* The registry extract has no quotes: its lines are split at the separator, and a line with too few or too many fields, or
  with bytes that are no UTF-8, is malformed.
* Files with a header and quotes go through the CSV reader with a column for the records it cannot fit to the header.

Either file is read once and written by ``checked_sink``: the good rows go on, the others are kept with their raw text and the
reason, and more than ``max_malformed`` of them stop the job (after they were written, so they can be looked at).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.operators.quality import Rule
from spendlens.sources.checked_sink import CheckReport, write_checked
from spendlens.sources.crosswalk import CROSSWALK_COLUMNS
from spendlens.sources.places import PLACE_COLUMNS, typed_places
from spendlens.sources.registry import REGISTRY_COLUMNS, parse_registry_lines, with_file_ordinal

LINE_RULES = [Rule(n, n, "true") for n in ("too_few_fields", "too_many_fields", "bad_encoding")]
RECORD = "_record"
RECORD_RULES = [Rule("not_as_the_header", "not_as_the_header", "true"), Rule("bad_encoding", "bad_encoding", "true")]


def registry_lines(spark: SparkSession, path: str, n_columns: int = 142, sep: str = "|", columns: Mapping[int, str] | None = None) -> DataFrame:
    """The named columns of every line that is not empty, its raw text and what is wrong with it; ``ordinal`` follows the file."""
    raw = spark.read.text(path).filter("value <> ''").select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("__file"),
                                                             F.col("_metadata.file_block_start").alias("__block"))
    n = F.size(F.split("line", "\\Q" + sep + "\\E", -1))
    raw = with_file_ordinal(raw).select("line", "ordinal", (n < n_columns).alias("too_few_fields"), (n > n_columns).alias("too_many_fields"),
                                        (~F.is_valid_utf8("line")).alias("bad_encoding"))
    return parse_registry_lines(raw, "line", sep, dict(columns or REGISTRY_COLUMNS), keep=raw.columns)


def header_records(spark: SparkSession, path: str, columns: Mapping[str, str], **options) -> DataFrame:
    """The named columns of every record, its raw text where it does not fit the header, and what is wrong; ``ordinal`` follows the file."""
    options = {"header": True, "escape": '"', **options}
    names = spark.read.options(**options).csv(path).columns
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {missing}; its header is {names}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names] + [T.StructField(RECORD, T.StringType())])
    # the reader notices a wrong number of fields only when it parses all of them
    raw = spark.read.schema(schema).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD, enforceSchema=True, columnPruning=False).csv(path)
    valid = F.lit(True)
    for c in columns:
        valid = valid & F.coalesce(F.is_valid_utf8(F.col(f"`{c}`")), F.lit(True))
    return raw.select(*[F.col(f"`{src}`").alias(dst) for src, dst in columns.items()], F.col(RECORD).alias("line"),
                      F.monotonically_increasing_id().alias("ordinal"), F.col(RECORD).isNotNull().alias("not_as_the_header"), (~valid).alias("bad_encoding"))


def _good(spark: SparkSession, report: CheckReport, rules: list[Rule]) -> DataFrame:
    return report.clean(spark).drop("line", *[r.column for r in rules])


def read_registry_strict(spark: SparkSession, path: str, out: str, n_columns: int = 142, sep: str = "|", max_malformed: int | None = 0,
                         columns: Mapping[int, str] | None = None) -> tuple[DataFrame, CheckReport]:
    """The well-formed lines, as ``read_registry`` gives them, and the report with the others (in ``line``)."""
    report = write_checked(registry_lines(spark, path, n_columns, sep, columns), out, LINE_RULES, max_malformed)
    return _good(spark, report, LINE_RULES), report


def read_crosswalk_strict(spark: SparkSession, path: str, out: str, sep: str = "|", max_malformed: int | None = 0,
                          columns: Mapping[str, str] | None = None) -> tuple[DataFrame, CheckReport]:
    """The well-formed records and the report."""
    report = write_checked(header_records(spark, path, columns or CROSSWALK_COLUMNS, sep=sep), out, RECORD_RULES, max_malformed)
    return _good(spark, report, RECORD_RULES).drop("ordinal"), report


def read_places_strict(spark: SparkSession, path: str, out: str, max_malformed: int | None = 0,
                       columns: Mapping[str, str] | None = None) -> tuple[DataFrame, CheckReport]:
    """S3: the well-formed records and the report."""
    report = write_checked(header_records(spark, path, columns or PLACE_COLUMNS), out, RECORD_RULES, max_malformed)
    return typed_places(_good(spark, report, RECORD_RULES)), report
