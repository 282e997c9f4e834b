"""Rules checked while a table is written, in the same pass, with the offending rows kept apart.

    path/quality=clean/...          rows that break no rule
    path/quality=quarantined/...    rows that break one, each with the names of the rules (``violations``)

The counts are metrics of the write itself (``DataFrame.observe`` right before it), so no row is read a second time to be
counted or listed. With ``max_violations`` the job stops after the write: the quarantined rows can then be looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.operators.joins import broadcast_if_small
from spendlens.operators.quality import Rule

VIOLATIONS, QUALITY = "violations", "quality"


class QualityBreach(ValueError):
    """More rows break a rule than allowed; ``report`` holds the counts and where the rows are."""

    def __init__(self, report: CheckReport):
        super().__init__(f"{report.quarantined} of {report.rows} rows of {report.path}: "
                         + ", ".join(f"{k}: {v}" for k, v in report.counts.items() if v))
        self.report = report


@dataclass(frozen=True)
class CheckReport:
    """What the write counted; the rows are read from its folders."""
    path: str
    schema: T.StructType
    rows: int
    quarantined: int
    counts: dict[str, int]

    def clean(self, spark: SparkSession) -> DataFrame:
        return self._part(spark, "clean", self.rows - self.quarantined, self.schema)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return self._part(spark, "quarantined", self.quarantined, T.StructType([*self.schema, T.StructField(VIOLATIONS, T.ArrayType(T.StringType()))]))

    def all(self, spark: SparkSession) -> DataFrame:
        return self.clean(spark).unionByName(self.quarantine(spark).drop(VIOLATIONS))

    def _part(self, spark: SparkSession, name: str, rows: int, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.path}/{QUALITY}={name}") if rows else spark.createDataFrame([], schema)


def broken_rules(rules: Sequence[Rule]):
    """Array of the names of the rules a row breaks."""
    return F.filter(F.array(*[F.when(r.violation(), F.lit(r.name)) for r in rules]).cast("array<string>"), lambda x: x.isNotNull())


def mark_unknown(df: DataFrame, allowed: DataFrame, key: str, into: str, broadcast_limit: int | None = None) -> DataFrame:
    """J6 in the same pass: ``into`` is true where ``key`` is not in ``allowed`` (NULL is in no set)."""
    known = broadcast_if_small(allowed.select(F.col(key).alias("__known")).filter("__known IS NOT NULL").distinct(), broadcast_limit)
    return df.join(known, F.col(key) == F.col("__known"), "left").withColumn(into, F.col("__known").isNull()).drop("__known")


def write_checked(df: DataFrame, path: str, rules: Sequence[Rule], max_violations: int | None = None) -> CheckReport:
    """Write ``df`` to ``path`` (which must not exist) by its quality; returns the counts of every rule."""
    clash = {VIOLATIONS, QUALITY} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made by the check")
    seen = Observation()
    checked = df.withColumn(VIOLATIONS, broken_rules(rules)).withColumn(QUALITY, F.when(F.size(VIOLATIONS) > 0, "quarantined").otherwise("clean"))
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(VIOLATIONS) > 0).alias("quarantined")]
    metrics += [F.count_if(F.array_contains(VIOLATIONS, r.name)).alias(f"rule {r.name}") for r in rules]
    checked.observe(seen, *metrics).write.partitionBy(QUALITY).parquet(path)
    got = seen.get
    report = CheckReport(path, df.schema, got["rows"], got["quarantined"], {r.name: got[f"rule {r.name}"] for r in rules})
    if max_violations is not None and report.quarantined > max_violations:
        raise QualityBreach(report)
    return report
