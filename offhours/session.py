"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Settings the results depend on (UTC, ANSI) or that the plans count on (AQE).
# The number of shuffle partitions is left to the cluster: AQE merges small
# ones, so a deployment only has to set the upper limit.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What Spark and a Python worker each hold of a batch.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

# Settings that only a new application takes: checkpoints go with their DataFrames.
START_SETTINGS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(app: str = "offhours", master: str | None = None, **extra: str) -> SparkSession:
    """Get or create a session; ``extra`` holds further ``spark.*`` settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **START_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that someone else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, visible to all executors.

    It is the one that ``spark.checkpoint.dir`` names. Where that is unset it lies
    below the warehouse, which executors share as well. On a cluster a warehouse in a folder
    of the driver's own machine is refused: executors would not find each other's files there.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_offhours"
        if not context.master.startswith("local") and urlsplit(named).scheme in ("", "file"):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder; {named} is one machine's own")
    context.setCheckpointDir(named)
    _gone_at_exit(spark, context.getCheckpointDir())
    return context.getCheckpointDir()


def _gone_at_exit(spark: SparkSession, path: str) -> None:
    """Have a folder deleted when the application ends; nothing there is of use later."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(place)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder path below the shared one, which lasts as long as the application."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _gone_at_exit(spark, path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds, wherever Spark's file systems have it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which outlives executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def observed(seen: Observation) -> dict:
    """What an observation counted during a finished write; empty for an empty input.

    When AQE finds out that there are no rows it drops the counting along with
    the rest of the plan, and asking for the counts fails.
    """
    try:
        return seen.get
    except Py4JJavaError:
        return {}
