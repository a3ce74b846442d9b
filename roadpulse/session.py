"""Session helpers: engine settings and the shared checkpoint folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Instants are stored in UTC; calendar parts use the local zone explicitly."""
    for key, value in ENGINE_CONF.items():
        if key == "spark.sql.session.timeZone" or spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "roadpulse") -> SparkSession:
    """Session for tests and the local benchmark (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a scratch folder only when unset and all runs on one machine (tests)."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors and the driver share")
    scratch = tempfile.mkdtemp(prefix="roadpulse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def materialize(df, name: str = "table"):
    """Cut lineage at an intermediate that later steps read several times.

    The table is written once as parquet under the shared folder named by
    ``spark.checkpoint.dir`` (set by the cluster; a scratch folder only when
    unset, as in tests) and read back: the input is scanned and cleaned once,
    the optimizer sees a small plan, and a lost executor re-reads the written
    files instead of recomputing the lineage.  One job, unlike an eager
    ``checkpoint()`` which computes its input twice unless it is cached.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "roadpulse", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


TASK_ROWS = 100_000  # wide rows that a task sorts or writes at once


def task_count(df, rows: int, task_rows: int = TASK_ROWS) -> int:
    """As many tasks as a shuffle has, and more where one would get over ``task_rows`` of ``rows`` rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / task_rows))


def spread(df, tasks: int | None = None):
    """Rows dealt evenly over as many tasks as a shuffle has (or ``tasks``), before a step that makes many rows of each.

    Adaptive execution sizes partitions by what it reads, so a small table that is about to
    be expanded would otherwise be expanded by one task.
    """
    return df.repartition(tasks or task_count(df, 0))


def regroup(df, keys: list[str], rows: int, task_rows: int = TASK_ROWS):
    """Rows of equal ``keys`` brought together for a join, group or window, in tasks that hold about ``task_rows``.

    The session's number of shuffle tasks is fixed, so with it alone a task grows with the table;
    where it is enough, nothing is done here and the step shuffles as usual.
    """
    tasks = task_count(df, rows, task_rows)
    return df.repartition(tasks, *keys) if tasks > task_count(df, 0) else df
