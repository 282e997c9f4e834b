"""Session helpers: one place for the settings every plan relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings the plans depend on. Timestamps and dates must not move with the
# machine's zone, and AQE re-plans joins/partition counts from runtime sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Same limit as ``operators.joins.DEFAULT_BROADCAST_LIMIT``: AQE may turn a
    # shuffle join into a broadcast when the runtime size is under it.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Plan texts of long lineages are only diagnostics; cap their size.
    "spark.sql.maxPlanStringLength": "200000",
}


def build_session(app: str = "spendlens", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster ``master`` stays None so spark-submit decides; locally pass
    ``local[N]`` and a matching ``shuffle_partitions``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


# SQL settings that can change on a running session (the driver of a job may
# hand us its own session).
RUNTIME_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.maxPlanStringLength": "200000",
}


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings above to an existing session."""
    for k, v in RUNTIME_SQL_CONF.items():
        try:
            spark.conf.set(k, v)
        except AnalysisException:  # a locked conf on a managed cluster stays as it is
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    The session setting wins; a directory already set on the context is used
    as is. Nothing machine-local is invented here: tests set their own folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current and conf:
        sc.setCheckpointDir(conf)
        current = sc.getCheckpointDir()
    return current or None


def shared_folder(spark: SparkSession) -> str:
    """A folder that every executor sees: the checkpoint folder; a temporary one only where it is unset and the master is local."""
    found = checkpoint_dir(spark)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spendlens-"))
        found = checkpoint_dir(spark)
    return found.rstrip("/")


def written_copy(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back; kept in memory and on disk without one."""
    spark = spark or df.sparkSession
    base = checkpoint_dir(spark)
    if not base:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{base.rstrip('/')}/spendlens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Materialise ``df`` reliably so later stages do not recompute its lineage.

    Uses ``checkpoint()`` into the shared checkpoint folder, which survives the
    loss of executors. Without a configured folder the plan is returned as is
    (still correct, only recomputed), never a machine-local copy.
    """
    spark = spark or df.sparkSession
    if checkpoint_dir(spark):
        return df.checkpoint(eager=True)
    return df
