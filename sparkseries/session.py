"""Session helpers: the settings every job here relies on, and where scratch tables go."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "sparkseries", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; `conf` overrides single settings."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Building wide plans is twice as fast without a call site per expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Rankings with a bound are cut before the shuffle up to this bound.
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are naive UTC, so conversions to epoch values need a UTC session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder; elsewhere a folder of one machine would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return os.path.dirname(active)
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="sparkseries-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for a table one job writes and reads back."""
    return f"{shared_dir(spark).rstrip('/')}/sparkseries/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to a scratch table and read back.

    It cuts the lineage as a checkpoint does, and what the optimizer has inferred about the rows as well: loops that join a table with itself
    gather so many constraints through checkpoints that planning takes longer with every step.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
