"""S7 + K2: dated dumps, and the newest complete one.

A dump is written to ``<base>/snapshot_date=YYYY-MM-DD/`` and is there only when its commit is:
``<base>/_commits/<date>.json`` names its files with their sizes, its number of rows (counted while they were written) and a
hash of its schema. The newest dump is found by listing the commits, no row is read for it; a dump whose
commit is missing, or whose files are not as committed, is none. Frames that carry a date column, and files
named ``..._YYYY-MM-DD.csv``, are served by ``latest_snapshot`` and ``read_named_snapshots``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.sources.bucket_store import _Files

DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"
COMMITS = "_commits"


class NoSnapshot(LookupError):
    """No complete dump lies under the base folder."""


@dataclass(frozen=True)
class Snapshot:
    date: str
    rows: int
    schema: str                     # JSON
    schema_hash: str
    files: dict[str, int]           # name -> bytes


def schema_hash(schema_json: str) -> str:
    """Hash of the names and types, in order."""
    fields = [(f["name"], f["type"]) for f in json.loads(schema_json)["fields"]]
    return hashlib.sha256(json.dumps(fields).encode()).hexdigest()


def _sizes(files: _Files, folder: str) -> dict[str, int]:
    at = files.path(folder)
    found = files.fs.listStatus(at) if files.fs.exists(at) else []
    return {s.getPath().getName(): s.getLen() for s in found if not s.getPath().getName().startswith(("_", "."))}


def write_snapshot(df: DataFrame, base: str, snapshot_date: str) -> Snapshot:
    """Dump ``df`` as that day's snapshot; the date is passed in, not read from the clock.

    What a dead run left of that day is replaced; a committed day is not written again.
    """
    dt.date.fromisoformat(snapshot_date)
    files, folder = _Files(df.sparkSession, base), f"snapshot_date={snapshot_date}"
    if f"{snapshot_date}.json" in files.names(COMMITS):
        raise FileExistsError(f"the snapshot of {snapshot_date} is complete already: {base}/{folder}")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{base}/{folder}")
    schema = df.schema.json()
    done = Snapshot(snapshot_date, seen.get["rows"], schema, schema_hash(schema), _sizes(files, folder))
    files.fs.mkdirs(files.path(COMMITS))
    files.publish(f"{COMMITS}/{snapshot_date}.json", json.dumps(done.__dict__))
    return done


def complete_snapshots(spark: SparkSession, base: str) -> list[Snapshot]:
    """The complete dumps, newest first, by listing files only."""
    files, found = _Files(spark, base), []
    for name in sorted(files.names(COMMITS), reverse=True):
        if not name.endswith(".json") or name.startswith("."):
            continue
        s = Snapshot(**json.loads(files.read(f"{COMMITS}/{name}")))
        if _sizes(files, f"snapshot_date={s.date}") == s.files and schema_hash(s.schema) == s.schema_hash:
            found.append(s)
    return found


def read_snapshot(spark: SparkSession, base: str, snapshot: Snapshot) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(json.loads(snapshot.schema))).parquet(f"{base}/snapshot_date={snapshot.date}")


def newest_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """The rows of the newest complete dump, as they were written; without one ``NoSnapshot``."""
    for s in complete_snapshots(spark, base)[:1]:
        return read_snapshot(spark, base, s)
    raise NoSnapshot(f"no complete snapshot under {base}")


def latest_snapshot(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """Rows of the newest date of a frame that carries dates.

    The newest date, one value, comes to the driver first, so the rows are
    read through a literal filter: on a dataset partitioned by the date only that
    partition is listed. Without any date no row is the newest.
    """
    newest = df.agg(F.max(date_col)).first()[0]
    return df.filter(F.col(date_col) == F.lit(newest)) if newest is not None else df.filter(F.lit(False))


def date_in_name(name) -> Column:
    """The date in a snapshot's file name; NULL without one, or where it is no day of the calendar."""
    text = F.regexp_extract(name, DATE_IN_NAME, 1)
    return F.try_to_date(F.when(text != "", text))


def read_named_snapshots(spark: SparkSession, directory: str, name_regex: str,
                         fmt: str = "csv", **options) -> DataFrame:
    """Read every file whose name matches ``name_regex``; add ``snapshot_date``."""
    r = spark.read.format(fmt).options(**options)
    df = r.load(directory)
    name = F.col("_metadata.file_name")
    return (df.withColumn("__name", name).filter(F.col("__name").rlike(name_regex))
            .withColumn("snapshot_date", date_in_name(F.col("__name")))
            .drop("__name"))
