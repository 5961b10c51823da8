"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Days and hours of events are UTC. Adaptive execution sizes the shuffle partitions, splits
# the skewed ones and picks join strategies from measured sizes. Loads replace only the
# partitions they write. Checkpoints are removed once nothing refers to them. Without call-site capture a plan takes half as long to build, which
# shows in dashboard queries; turn it on to see the Python line in error messages.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "clickmetrics", master: str | None = None, **conf: str
) -> SparkSession:
    """Start or reuse a session with the settings the operators are written for.

    ``master`` is left to spark-submit when not given. Extra settings are passed by
    keyword with dots written as ``__``, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SESSION_CONF | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for data that must outlive an executor.

    Only a local session, where driver and executors share one disk, gets a folder of its
    own when the setting is missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="clickmetrics-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path, not yet created, inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def in_shared_folder(frame: DataFrame, name: str) -> DataFrame:
    """The frame as Parquet in the shared folder: computed once, and safe from lost executors."""
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
