"""Transactions stored by the key they are joined or grouped by, so that needs no shuffle.

The rows lie in a bucketed table: bucket = hash of the key. A join with another table of as many buckets, or an aggregate by
the key and more, then works inside the buckets: Spark plans no Exchange above the scans. Written once, read by every run.

A bucket is one task, so there is one for every ``BUCKET_ROWS`` rows: a task's memory stays the same however large the table. Keys that own more than ``HOT_BUCKETS`` buckets' worth of rows would make it long all the same. They
are at most ``n_buckets / HOT_BUCKETS`` by counting, are found by one aggregate when the table is written and are kept beside it, not
bucketed (``hot``): an aggregate over them shuffles partial sums of a few keys, a join broadcasts their few rows of the other
side. Keys are in one of the two parts, never in both, so the parts' results are just united.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.sources.bucket_store import _Files

HOT_BUCKETS, HOT_ROWS = 4, 100_000     # a hot key owns more than so many buckets' worth of rows, and more than so many rows
LEAST_BUCKETS, BUCKET_ROWS = 8, 200_000
META = "layout.json"


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, math.ceil(rows / BUCKET_ROWS))


@dataclass
class CoLocated:
    """A table by ``key`` in ``n_buckets`` buckets at ``path``, and the rows of its hot keys."""
    spark: SparkSession
    path: str
    key: str
    n_buckets: int
    schema: T.StructType
    hot_keys: list

    # -- writing and opening ----------------------------------------------
    @staticmethod
    def write(df: DataFrame, path: str, key: str, n_buckets: int | None = None, sort: tuple[str, ...] = (), hot_rows: int = HOT_ROWS) -> CoLocated:
        """``df`` written to ``path``, which must not exist, by its number of rows in as many buckets as ``buckets_for`` says or in
        ``n_buckets``. A NULL key is a key like others (it joins with nothing)."""
        spark = df.sparkSession
        counts = df.groupBy(key).count()
        total = counts.agg(F.sum("count")).first()[0] or 0
        out = CoLocated(spark, path.rstrip("/"), key, int(n_buckets or buckets_for(total)), df.schema, [])
        bound = max(hot_rows, total * HOT_BUCKETS / out.n_buckets)
        out.hot_keys = [r[key] for r in counts.filter(F.col("count") > bound).select(key).collect()]   # n_buckets / HOT_BUCKETS at most
        rest = df.filter(~out._is_hot()) if out.hot_keys else df
        if out.hot_keys:
            df.filter(out._is_hot()).write.parquet(f"{out.path}/hot")
        # rows meet by the table's own bucket function first: one file for each bucket, not one for each task and bucket
        w = rest.repartition(out.n_buckets, key).write.format("parquet").option("path", f"{out.path}/buckets").bucketBy(out.n_buckets, key)
        w.sortBy(key, *sort).saveAsTable(out._table())
        _Files(spark, out.path).publish(META, json.dumps({"key": key, "n_buckets": out.n_buckets, "schema": df.schema.json(),
                                                          "hot_keys": json.dumps(out.hot_keys, default=str), "hot": bool(out.hot_keys)}))
        return out

    @staticmethod
    def open(spark: SparkSession, path: str) -> CoLocated:
        """A table that another session wrote; one that was not written to the end has no layout file and fails."""
        meta = json.loads(_Files(spark, path).read(META))
        schema = T.StructType.fromJson(json.loads(meta["schema"]))
        out = CoLocated(spark, path.rstrip("/"), meta["key"], meta["n_buckets"], schema, json.loads(meta["hot_keys"]))
        if not spark.catalog.tableExists(out._table()):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(f"CREATE TABLE {out._table()} ({cols}) USING parquet CLUSTERED BY (`{out.key}`) INTO {out.n_buckets} BUCKETS LOCATION '{out.path}/buckets'")
        return out

    def _table(self) -> str:
        """The catalog's name of the table: from its path, so that it is the same in every session."""
        return f"colocated_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"

    def _is_hot(self) -> Column:
        known = [k for k in self.hot_keys if k is not None]
        return F.coalesce(F.col(self.key).isin(known), F.lit(False)) | (F.col(self.key).isNull() if None in self.hot_keys else F.lit(False))

    # -- reading ----------------------------------------------------------
    @property
    def bucketed(self) -> DataFrame:
        return self.spark.table(self._table())

    @property
    def hot(self) -> DataFrame | None:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/hot") if self.hot_keys else None

    def read(self) -> DataFrame:
        return self.bucketed.unionByName(self.hot) if self.hot_keys else self.bucketed

    def by_key(self, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``step`` on either part, united: for steps that treat every key by itself (filters, aggregates by the key and more,
        joins with broadcast tables)."""
        done = step(self.bucketed)
        return done.unionByName(step(self.hot)) if self.hot_keys else done

    def join(self, other: CoLocated, how: str = "inner") -> DataFrame:
        """Rows with those of ``other``, a table by the same key in as many buckets with few rows for each key; inner or semi."""
        if (other.key, other.n_buckets) != (self.key, self.n_buckets):
            raise ValueError(f"{other.key} in {other.n_buckets} buckets does not lie beside {self.key} in {self.n_buckets}")
        if how not in ("inner", "left_semi"):
            raise ValueError("how must be 'inner' or 'left_semi'")
        side = other.read() if other.hot_keys else other.bucketed
        done = self.bucketed.hint("merge").join(side.hint("merge"), self.key, how)
        if not self.hot_keys:
            return done
        few = F.broadcast(side.filter(self._is_hot()))              # rows of n_buckets / HOT_BUCKETS keys
        return done.unionByName(self.hot.join(few, self.key, how))
