"""Session helpers: a tuned local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "textlabel") -> SparkSession:
    """Return (or create) a session with AQE on and the UI off."""
    master = master or os.environ.get("TEXTLABEL_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # text rows are CPU-heavy (regex passes per row): smaller input splits and shuffle
        # targets keep each task's work and memory bounded; AQE still merges tiny partitions
        .config("spark.sql.files.maxPartitionBytes", "64m")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TEXTLABEL_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application: a cluster's workers do not see the
    driver's source folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="textlabel-"), "textlabel.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("textlabel", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home.

    On a cluster the folder must be the shared one named by ``spark.checkpoint.dir``;
    only a local session (tests) may fall back to a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="textlabel-ckpt-")
        sc.setCheckpointDir(folder)
        return folder
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/DBFS)")


def spread(df):
    """Spread a DataFrame with fewer partitions than the cluster has cores (a small table
    after AQE coalescing, a one-row-group file) round-robin over the cores before CPU-heavy
    per-row work. Anything already split wider is returned as is (no shuffle)."""
    n = num_partitions(df)
    cores = default_parallelism(df.sparkSession)
    return df.repartition(cores) if n is not None and cores and n < cores else df


def num_partitions(df):
    """Partition count of the planned DataFrame, or None where the RDD view is unavailable
    (e.g. a Spark Connect session)."""
    try:
        return df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001
        return None


def default_parallelism(spark) -> int | None:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return None
