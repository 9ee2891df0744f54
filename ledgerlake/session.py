"""Spark session settings the engine relies on.

Everything in the engine is a DataFrame plan; the session only pins the
settings that change results (time zone, ANSI) or the physical plan at scale
(AQE, skew handling). On a cluster the session is created by the platform and
:func:`configure` is applied to it; tests build a local one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that change *results*: every timestamp → date conversion and every
# parse of an offset-less timestamp uses the session zone (ledger L15).
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Parquet written by pandas stores nanosecond timestamps, which Spark
    # otherwise refuses to read (ledger L26); they arrive as BIGINT nanos and
    # sources.files.read_parquet turns declared timestamp columns back.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

# Settings that change the *plan*: runtime re-planning, broadcast of sides
# whose measured shuffle output is small, and splitting of skewed partitions.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's runtime settings to an existing session."""
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    for key, value in PLAN_CONF.items():
        if _set_by_deployment(spark, key):
            continue
        try:
            spark.conf.set(key, value)
        except Exception:  # a tuning knob the deployment does not let us change
            pass
    if _may_checkpoint(spark):
        ensure_checkpoint_dir(spark)
    return spark


def _set_by_deployment(spark: SparkSession, key: str) -> bool:
    """Whether the application was started with a value of its own: plan
    settings fit the executors' size, which the deployment knows."""
    try:
        conf = spark.sparkContext.getConf()
        if key == "spark.sql.adaptive.autoBroadcastJoinThreshold":
            # Spark's default for it is the general threshold
            return conf.contains(key) or conf.contains("spark.sql.autoBroadcastJoinThreshold")
        return conf.contains(key)
    except Exception:  # Spark Connect: no driver-side SparkContext
        return False


def _is_local(master: str) -> bool:
    """One JVM (``local``, ``local[8]``), where every task sees the same disk."""
    return master == "local" or master.startswith("local[")


def _may_checkpoint(spark: SparkSession) -> bool:
    """Whether a checkpoint folder is set or may be chosen here."""
    try:
        sc = spark.sparkContext
    except Exception:
        return False
    return bool(sc.getCheckpointDir() or _configured_dir(spark)) or _is_local(sc.master)


def _configured_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def parallelism(spark: SparkSession) -> int:
    """Cores of the cluster (default parallelism), or the shuffle partition
    count where no driver-side SparkContext exists (Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the checkpoint folder, setting a local one only in local mode.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value
    always wins. Where it is unset, a local master (tests) gets a fresh temp
    folder and any other raises: executors do not see each other's disks.
    Under Spark Connect the server owns this setting and nothing is changed.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side SparkContext
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = _configured_dir(spark)
    if not configured:
        if not _is_local(sc.master):
            raise ValueError(
                f"spark.checkpoint.dir is not set and the master is {sc.master}: name a folder that all executors share"
            )
        configured = tempfile.mkdtemp(prefix="ledgerlake-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "ledgerlake",
    warehouse: str | None = None,
    event_log_dir: str | None = None,
) -> SparkSession:
    """Local session for tests and the benchmark (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Remove checkpoint files once their DataFrame is garbage collected.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", event_log_dir
        )
    for key, value in {**RESULT_CONF, **PLAN_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
