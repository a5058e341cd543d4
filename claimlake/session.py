"""Session helpers: a local session for tests/bench, and the checkpoint folder.

On a cluster the session comes from the platform; ``local_session`` sets its
own values for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "claimlake") -> SparkSession:
    """A local session sized for tests and the bench (UI off, UTC, AQE on)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # No broadcast from file-size estimates; AQE may still broadcast a
        # side whose measured shuffle output is small, and our operators
        # broadcast only after measuring (operators.joins.probe_sizes).
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CLAIMLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # PySpark's per-call call-site capture costs three JVM round trips for
        # every Column built; plans here build hundreds of Columns.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session without one (tests) gets a scratch folder; on
    a cluster the shared folder named by the platform is used as is, and a
    missing setting is an error rather than a silent machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (all executors and "
                               "the driver must reach it) before running iterative or staged jobs")
        configured = tempfile.mkdtemp(prefix="claimlake-ckpt-")  # local test session only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a local one).

    Used by iterative operators so a lost executor recomputes from the
    checkpoint instead of replaying every earlier iteration.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint folder, for staged writes.

    Never a machine-local temp folder: on a cluster this is the shared
    location the platform names in ``spark.checkpoint.dir``.
    """
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/claimlake-{name}/{uuid.uuid4().hex}"


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Have the context cleaner remove the files of shuffles that nothing refers to any more.

    It does so when the driver's JVM collects garbage, and a driver with little
    to do may not collect any for half an hour (``spark.cleaner.periodicGC.interval``).
    """
    spark.sparkContext._jvm.System.gc()
