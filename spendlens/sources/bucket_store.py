"""A keyed table in hash buckets, changed by small batches and published version by version.

    base/data/<id>/bucket=<b>/part-*.parquet     written once, never changed
    base/manifest-<version>.json                 the files of every bucket, and which batches are in

A batch goes to the buckets its keys fall into: it reads and writes those and no others, whatever the size of the table.
The new files become visible when the next manifest does: it is written under another name and then renamed, which the
file system does at once and refuses if that version exists. So a reader sees all of a batch or nothing, a job that dies
leaves files that no manifest names, and of two writers one fails with ``ConcurrentUpdate`` and may try again. A batch with
a name is applied once: a second time its name is in the manifest and nothing happens.

Buckets gain one file for each batch and are rewritten into one (``compact``) when they have more than ``max_files``. Rows carry
the version they were written in; ``merge`` makes one state of the rows of a key (none is needed when keys are added once).

The driver handles names only: the manifest has at most ``n_buckets * (max_files + 1)`` of them. Listings and renames are as
safe as the file system's: HDFS and local folders rename at once; on object stores use a committer's or table format's lock.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.operators.joins import semi_join

N_BUCKETS, MAX_FILES = 64, 8
VERSION = "_version"


class ConcurrentUpdate(RuntimeError):
    """Another writer published this version first; the batch may be tried again."""


@dataclass
class Manifest:
    version: int = 0
    n_buckets: int = N_BUCKETS
    files: dict[int, list[str]] = field(default_factory=dict)      # bucket -> paths under the base folder
    batches: list[str] = field(default_factory=list)
    extra: dict = field(default_factory=dict)                       # what else a version publishes

    def text(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def parse(text: str) -> Manifest:
        m = Manifest(**json.loads(text))
        m.files = {int(b): f for b, f in m.files.items()}
        return m


@dataclass(frozen=True)
class Receipt:
    """What a batch did."""
    version: int
    applied: bool           # False: the batch was there already, or had no rows
    buckets: tuple[int, ...] = ()
    files_read: int = 0
    rows_written: int = 0


class _Files:
    """The few file operations of a manifest, by the cluster's own file system classes."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.base = base.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str = "") -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write under another name, then rename; fails if ``name`` exists."""
        draft = f".draft-{uuid.uuid4().hex}"
        out = self.fs.create(self.path(draft), False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        no_overwrite = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.path(draft), self.path(name), no_overwrite)
        except Py4JJavaError as e:
            self.fs.delete(self.path(draft), False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                raise ConcurrentUpdate(name) from None
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class BucketStore:
    """The table at ``base``; ``merge`` maps rows with their ``_version`` to one state for each key."""

    def __init__(self, spark: SparkSession, base: str, schema: str | T.StructType, key: Sequence[str], n_buckets: int = N_BUCKETS,
                 max_files: int = MAX_FILES, merge: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.key, self.max_files, self.merge = spark, list(key), max_files, merge
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.stored = T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType())])
        self.files, self._new_buckets = _Files(spark, base), n_buckets

    # -- manifests --------------------------------------------------------
    def manifest(self) -> Manifest:
        """The newest published version (an empty one before the first)."""
        found = [n for n in self.files.names() if n.startswith("manifest-") and n.endswith(".json")]
        return Manifest.parse(self.files.read(found[-1])) if found else Manifest(n_buckets=self._new_buckets)

    def _publish(self, m: Manifest) -> None:
        self.files.publish(f"manifest-{m.version:012d}.json", m.text())

    # -- reading ----------------------------------------------------------
    def bucket(self, m: Manifest) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(m.n_buckets)).cast("int")

    def touched(self, rows: DataFrame, m: Manifest) -> list[int]:
        """Buckets of the rows' keys, ``n_buckets`` numbers at most."""
        return sorted(r["b"] for r in rows.select(self.bucket(m).alias("b")).distinct().collect())

    def _stored_rows(self, m: Manifest, buckets: Iterable[int] | None = None) -> tuple[DataFrame, int]:
        names = [f for b in (sorted(m.files) if buckets is None else buckets) for f in m.files.get(b, [])]
        if not names:
            return self.spark.createDataFrame([], self.stored), 0
        return self.spark.read.schema(self.stored).parquet(*[f"{self.files.base}/{n}" for n in names]), len(names)

    def _state(self, rows: DataFrame) -> DataFrame:
        return (self.merge(rows) if self.merge else rows).select(*self.schema.names)

    def read(self, m: Manifest | None = None) -> DataFrame:
        """Every key's state."""
        return self._state(self._stored_rows(m or self.manifest())[0])

    def lookup(self, keys: DataFrame, m: Manifest | None = None) -> tuple[DataFrame, int]:
        """The state of the keys in ``keys``, and how many files hold their buckets: no other file is opened."""
        m = m or self.manifest()
        rows, n = self._stored_rows(m, self.touched(keys, m))
        return self._state(semi_join(rows, keys.select(*self.key).distinct(), self.key, null_safe=True)), n

    # -- writing ----------------------------------------------------------
    def _write(self, rows: DataFrame, m: Manifest) -> dict[int, list[str]]:
        """New files of the rows by bucket; one task writes a bucket."""
        folder = f"data/{uuid.uuid4().hex}"
        (rows.select(*self.schema.names, F.lit(m.version + 1).cast("long").alias(VERSION), self.bucket(m).alias("bucket"))
         .repartition(m.n_buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.files.base}/{folder}"))
        parts = [n for n in self.files.names(folder) if n.startswith("bucket=")]
        return {int(p[7:]): [f"{folder}/{p}/{n}" for n in self.files.names(f"{folder}/{p}") if n.endswith(".parquet")] for p in parts}

    def append(self, rows: DataFrame, batch: str | None = None, m: Manifest | None = None, extra: dict | None = None, files_read: int = 0) -> Receipt:
        """Publish ``rows`` as the next version; full buckets are rewritten in the same version."""
        m = m or self.manifest()
        if batch is not None and batch in m.batches:
            return Receipt(m.version, False)
        new = self._write(rows, m)
        if not new and batch is None and extra is None:
            return Receipt(m.version, False, files_read=files_read)
        files = {b: m.files.get(b, []) + new.get(b, []) for b in m.files.keys() | new.keys()}
        after = Manifest(m.version + 1, m.n_buckets, files, m.batches + ([batch] if batch is not None else []), {**m.extra, **(extra or {})})
        full = [b for b in new if len(files[b]) > self.max_files]
        if full:
            after.files |= self._compacted(after, full)
        self._publish(after)
        written = [f"{self.files.base}/{n}" for names in new.values() for n in names]
        count = self.spark.read.schema(self.stored).parquet(*written).count() if written else 0
        return Receipt(after.version, True, tuple(sorted(new)), files_read, count)

    def _compacted(self, m: Manifest, buckets: Sequence[int]) -> dict[int, list[str]]:
        """The buckets rewritten, one file each; ``m.version`` stays the version of their rows."""
        rows = self._state(self._stored_rows(m, buckets)[0])
        return {b: [] for b in buckets} | self._write(rows, Manifest(m.version - 1, m.n_buckets))

    def compact(self) -> Receipt:
        """Rewrite every bucket with more than one file."""
        m = self.manifest()
        many = [b for b, names in m.files.items() if len(names) > 1]
        if not many:
            return Receipt(m.version, False)
        after = Manifest(m.version + 1, m.n_buckets, dict(m.files), list(m.batches), dict(m.extra))
        after.files |= self._compacted(after, many)
        self._publish(after)
        return Receipt(after.version, True, tuple(sorted(many)), sum(len(m.files[b]) for b in many))

    def rebuild(self, rows: DataFrame, n_buckets: int | None = None) -> Receipt:
        """Replace the whole table; readers keep the old version until the new one is whole. Names of batches are forgotten."""
        m = self.manifest()
        after = Manifest(m.version + 1, n_buckets or m.n_buckets, {}, [], {})
        after.files = self._write(rows, Manifest(m.version, after.n_buckets))
        self._publish(after)
        return Receipt(after.version, True, tuple(sorted(after.files)))

    def vacuum(self, keep: int = 2) -> int:
        """Delete manifests but the newest ``keep`` and the data folders none of those names; run it while no writer does."""
        names = [n for n in self.files.names() if n.startswith("manifest-") and n.endswith(".json")]
        kept = [Manifest.parse(self.files.read(n)) for n in names[-keep:]]
        used = {f.split("/")[1] for m in kept for fs in m.files.values() for f in fs} | {f.split("/")[1] for m in kept for f in m.extra.get("folders", [])}
        gone = [f"data/{n}" for n in self.files.names("data") if n not in used] + names[:-keep] + [n for n in self.files.names() if n.startswith(".draft-")]
        for n in gone:
            self.files.delete(n)
        return len(gone)
