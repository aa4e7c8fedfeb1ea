"""Session helpers: building one for local runs, and reliable folders for cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(app: str, cpus: str = "8", partitions: str = "8", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # with their last reader
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC -XX:ReservedCodeCacheSize=512m")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the cluster for checkpoints and intermediate tables.

    A machine-local folder is only ever chosen for a local master; on a cluster a missing
    setting is an error, because executors would not see each other's files.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="refrain-")
        spark.conf.set(CHECKPOINT_KEY, folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/refrain-{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path made by ``scratch_path`` once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a frame on reliable storage, so that later reads all see the same rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
