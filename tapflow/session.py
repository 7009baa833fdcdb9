"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Before AQE merges small ones; it never makes more than this.
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cpus: int | str = 8, app: str = "tapflow", **extra: str) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only where ``spark.checkpoint.dir`` is unset (a bare local session) a
    temporary folder stands in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "tapflow-checkpoints")
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tapflow-{label}-{uuid.uuid4().hex}"


def grown(df):
    """``df``, a side of a join that grows with the data: met by sort and merge, never held whole in a task.

    The planner takes the compressed size of a table's files for its size in memory. Stops of 5 MB on disk were
    broadcast as 670 MB that way, to every task and through the driver, and no run-time figure takes that back.
    """
    return df.hint("merge")


def cut(df):
    """Materialise ``df`` in the shared folder and drop its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
