"""S5 + J3: read from the yearly databases only the rows of the wanted keys.

The method asks every yearly database for the transactions of a known set of recipients. Here a plan is made from that
set before anything is read:

* ``in``: up to ``max_keys`` different keys become chunks of literals; each shard gets one JDBC partition for each chunk,
  with ``key IN ('...', ...)`` as its predicate, so the database's index answers and the chunks are read in parallel.
* ``range``: more keys than that never come to the driver. Spark sorts them into ``ranges`` ranges and only the least and
  greatest key of each do; each shard gets one partition for each range (``key BETWEEN lo AND hi``) and Spark keeps the
  wanted rows by a semi-join. The database compares as Spark does, by bytes, when ``collation`` names its collation for that.
* ``none``: without keys no shard is opened at all.

The partitions of a shard never overlap, so no row is read twice; a NULL key is wanted by no one. The same plan also
filters shards that are DataFrames (``read_frames``): Parquet then skips row groups by the literals' range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.joins import semi_join
from spendlens.sources.shards import TRANSACTION_SCHEMA, standardize_transactions, union_shards

MAX_KEYS = 100_000      # literals that the driver holds and sends at most (12 bytes each for recipients)
CHUNK_KEYS = 1_000      # literals of one predicate; some databases take no more
RANGES = 64             # partitions of a shard when there are more keys than that


def quoted(value: str) -> str:
    """A SQL string literal; a quote is doubled, so no key can end its literal."""
    return "'" + value.replace("'", "''") + "'"


def in_predicate(column: str, keys: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(map(quoted, keys))})"


def range_predicate(column: str, lo: str, hi: str, collation: str | None = None) -> str:
    named = f"{column} COLLATE {collation}" if collation else column
    return f"{named} >= {quoted(lo)} AND {named} <= {quoted(hi)}"


@dataclass(frozen=True)
class KeyPlan:
    """Which predicates every shard is asked with; ``mode`` is ``in``, ``range`` or ``none``."""
    mode: str
    column: str
    parts: tuple[tuple[str, ...], ...]  # the literals of each chunk, or (least, greatest) of each range
    n_keys: int | None                  # known only when the keys were counted to the end
    collation: str | None = None        # of ranges in the databases

    @property
    def exact(self) -> bool:
        """The predicates alone keep the wanted rows (otherwise a semi-join follows)."""
        return self.mode != "range"

    def predicates(self, collation: str | None = None) -> list[str]:
        if self.mode == "range":
            return [range_predicate(self.column, lo, hi, collation) for lo, hi in self.parts]
        return [in_predicate(self.column, chunk) for chunk in self.parts]

    def partitions(self, shards: int) -> int:
        return shards * len(self.parts)

    def statements(self, table: str, columns: Sequence[str] = ("*",)) -> list[str]:
        """The queries a database receives, as text."""
        return [f"SELECT {', '.join(columns)} FROM {table} WHERE {p}" for p in self.predicates(self.collation)]


def plan_keys(keys: DataFrame, key: str = "recipient_uei", column: str | None = None, max_keys: int = MAX_KEYS,
              chunk_keys: int = CHUNK_KEYS, ranges: int = RANGES, collation: str | None = '"C"') -> KeyPlan:
    """The plan for the different values of ``keys[key]``; at most ``max_keys`` + 1 of them come to the driver.

    ``column`` is the key's name in the databases. Keys are taken as text.
    """
    column = column or key
    distinct = keys.select(F.col(key).cast("string").alias("k")).filter("k IS NOT NULL").distinct()
    found = [r["k"] for r in distinct.limit(max_keys + 1).collect()]
    if not found:
        return KeyPlan("none", column, (), 0)
    if len(found) <= max_keys:
        found.sort()
        chunks = [found[i:i + chunk_keys] for i in range(0, len(found), chunk_keys)]
        return KeyPlan("in", column, tuple(map(tuple, chunks)), len(found))
    ends = (distinct.repartitionByRange(ranges, "k").groupBy(F.spark_partition_id().alias("p"))
            .agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect())
    return KeyPlan("range", column, tuple((r["lo"], r["hi"]) for r in ends), None, collation)


def _wanted(read: DataFrame, plan: KeyPlan, keys: DataFrame | None, key: str) -> DataFrame:
    if plan.exact:
        return read
    if keys is None:
        raise ValueError("a range plan needs the keys: its predicates keep more rows than the wanted ones")
    return semi_join(read, keys.select(key).distinct(), key)


def read_databases(spark: SparkSession, shards: Mapping[int, str], plan: KeyPlan, keys: DataFrame | None = None, key: str = "recipient_uei",
                   table: str = "transactions", properties: Mapping[str, str] | None = None) -> DataFrame:
    """The wanted rows of every yearly database (``shards[year]`` is its URL): one JDBC partition for each predicate.

    Columns and filters of later steps are pushed into the same statements by the JDBC source. Credentials are in ``properties``.
    """
    if not shards:
        raise ValueError("no shard to read")
    if plan.mode == "none":
        return spark.createDataFrame([], TRANSACTION_SCHEMA)
    frames = [spark.read.jdbc(url, table, predicates=plan.predicates(plan.collation), properties=dict(properties or {})).withColumn("shard_year", F.lit(year))
              for year, url in sorted(shards.items())]
    return _wanted(standardize_transactions(union_shards(frames)), plan, keys, key)


def read_frames(frames: Mapping[int | None, DataFrame], plan: KeyPlan, keys: DataFrame | None = None, key: str = "recipient_uei") -> DataFrame:
    """The wanted rows of shards that are DataFrames (files by year): each is one scan, filtered by the whole plan."""
    if not frames:
        raise ValueError("no shard to read")
    if plan.mode == "range":
        wanted = F.col(key).between(F.lit(plan.parts[0][0]), F.lit(plan.parts[-1][1]))     # the ranges follow one another
    else:
        wanted = F.col(key).isin([k for part in plan.parts for k in part])
    parts = [f.filter(wanted) for _, f in sorted(frames.items(), key=lambda kv: (kv[0] is None, kv[0] or 0))]
    return _wanted(union_shards(parts), plan, keys, key)
