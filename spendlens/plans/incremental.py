"""Annual net totals kept up to date by batches of transactions.

The state is a keyed table (``bucket_store``) of mergeable partial sums, one row for each (award, place, fiscal year): the sums and
numbers of its positive and of its negative amounts. They add up over batches and take away again, so a new yearly shard
is added and a correction removes the old rows and adds the right ones. Beside it stand the totals by (place, year, kind).

A batch reads the partial sums of its own awards only (their buckets), spreads those awards as they were and as
they are now, and adds the difference to the totals; awards that it does not touch are not read. Sums are decimals and shares are
rounded for each award, so the totals equal those of one run over all transactions, to the last digit. Partial sums, totals and
the batch's name are published in one version: a batch that is run again, or half, changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators import deobligations as deob
from spendlens.sources.bucket_store import BucketStore, Receipt

PARTIALS = "award_key string, city_label string, fy int, pos decimal(38,2), n_pos bigint, neg decimal(38,2), n_neg bigint"
TOTALS = f"city_label string, fy int, kind string, value {deob.SHARE.lower()}, n bigint"
GROUP, SUMS = ("award_key", "city_label", "fy"), ("pos", "n_pos", "neg", "n_neg")


class UnknownRows(ValueError):
    """A batch removes rows that were never added."""


def partial_sums(txn: DataFrame, sign: int = 1) -> DataFrame:
    """One row for each (award, place, year): sums and numbers of positive and negative amounts, times ``sign``."""
    one = lambda cond, v: F.expr(f"sum(CASE WHEN {cond} THEN {v} * {sign} ELSE 0 END)")
    return txn.groupBy(*GROUP).agg(
        one("amount > 0", "amount").cast("decimal(38,2)").alias("pos"), one("amount > 0", "1").alias("n_pos"),
        one("amount < 0", "amount").cast("decimal(38,2)").alias("neg"), one("amount < 0", "1").alias("n_neg"))


def merged(rows: DataFrame) -> DataFrame:
    """Partial sums of one group made one row; groups without any amount left are no more."""
    return (rows.groupBy(*GROUP).agg(*[F.sum(c).cast("decimal(38,2)" if c in ("pos", "neg") else "bigint").alias(c) for c in SUMS])
            .filter("n_pos <> 0 OR n_neg <> 0 OR pos <> 0 OR neg <> 0"))


def year_totals(partials: DataFrame) -> DataFrame:
    """The award-year totals that spreading starts from: no amount of a sign is NULL, not 0."""
    return partials.selectExpr(*GROUP, "CASE WHEN n_pos > 0 THEN CAST(pos AS DECIMAL(28,2)) END AS pos",
                               "CASE WHEN n_neg > 0 THEN CAST(neg AS DECIMAL(28,2)) END AS neg")


class IncrementalTotals:
    def __init__(self, spark: SparkSession, base: str, first_fy: int = 2017, mode: str = "documented", n_buckets: int = 64):
        self.spark, self.first_fy, self.mode = spark, first_fy, mode
        self.store = BucketStore(spark, base, PARTIALS, ["award_key"], n_buckets=n_buckets, merge=merged)

    def _contributions(self, partials: DataFrame) -> DataFrame:
        profiles = deob.profiles_of_years(year_totals(partials))
        return deob.contributions_of(profiles, self.first_fy, self.mode)

    def _totals(self, extra: dict) -> DataFrame:
        if "totals" not in extra:
            return self.spark.createDataFrame([], TOTALS)
        return self.spark.read.schema(TOTALS).parquet(f"{self.store.files.base}/{extra['totals']}")

    def apply(self, added: DataFrame, batch: str, removed: DataFrame | None = None) -> Receipt:
        """Take one batch in: filtered transactions (award_key, city_label, fy, amount) to add and, for corrections, to remove."""
        m = self.store.manifest()
        if batch in m.batches:
            return Receipt(m.version, False)
        rule = {"first_fy": self.first_fy, "mode": self.mode}
        if m.extra.get("rule", rule) != rule:
            raise ValueError(f"the totals were made by {m.extra['rule']}, not by {rule}")
        delta = partial_sums(added)
        if removed is not None:
            delta = merged(delta.unionByName(partial_sums(removed, -1)))
        delta = delta.persist()
        before, n_files = self.store.lookup(delta, m)
        before = before.persist()
        after = merged(before.unionByName(delta)).persist()
        try:
            wrong = after.filter("n_pos < 0 OR n_neg < 0 OR (n_pos = 0 AND pos <> 0) OR (n_neg = 0 AND neg <> 0)").count()
            if wrong:
                raise UnknownRows(f"batch {batch!r} removes amounts of {wrong} award years that do not hold them")
            change = (self._contributions(after).withColumn("n", F.lit(1).cast("bigint"))
                      .unionByName(self._contributions(before).withColumn("value", -F.col("value")).withColumn("n", F.lit(-1).cast("bigint"))))
            totals = (self._totals(m.extra).unionByName(change.select("city_label", "fy", "kind", "value", "n"))
                      .groupBy("city_label", "fy", "kind").agg(F.sum("value").cast(deob.SHARE).alias("value"), F.sum("n").alias("n")).filter("n <> 0"))
            folder = f"data/totals-{uuid.uuid4().hex}"
            totals.coalesce(1).write.parquet(f"{self.store.files.base}/{folder}")      # one row for each place, year and kind
            return self.store.append(delta, batch, m, {"totals": folder, "folders": [folder], "rule": rule}, n_files)
        finally:
            for df in (delta, before, after):
                df.unpersist()

    def totals(self) -> DataFrame:
        """The totals by place and year, as ``deobligations.annual_net_totals`` gives them."""
        return deob.totals_of_parts(deob.place_year_parts(self._totals(self.store.manifest().extra)))

    def award_class(self) -> DataFrame:
        """The class of every award, as ``deobligations.award_class`` gives it."""
        return deob.profiles_of_years(year_totals(self.store.read())).select(
            "award_key", "city_label", "award_class", "neg_total", "n_pos_years", "last_fy")
