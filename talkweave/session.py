"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "talkweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes (UTC, AQE, Arrow).

    Cluster sizing (executors, memory, shuffle partitions) belongs to
    ``spark-submit``; nothing here overrides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # call-site capture for every Column costs more than building the plan itself
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def text_batches(spark: SparkSession) -> None:
    """Where the session leaves Spark's default of 10,000 rows to an Arrow batch, 1,000 for the session.

    For rows that hold whole texts: the JVM and the worker each hold a batch several times over.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where that setting is absent, a single-machine session (tests, a laptop) gets a fresh local folder;
    on a cluster that would be a different disk for every executor, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="talkweave-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, kept when an executor is lost. ``codec`` overrides the session's.

    The planner knows the size of what it reads back, so it broadcasts a small table and sorts and
    merges a large one, whose skewed keys adaptive execution splits.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
