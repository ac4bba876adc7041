"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that the plans rely on; sizes are left to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no stack capture per column call
}


def build_session(app_name: str = "touchline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session that names none, as in tests, gets a folder of its own,
    which is then also set as its checkpoint folder. On a cluster that is an
    error: executors would not share the folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="touchline-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# A table of up to this many short rows is broadcast.
BROADCAST_ROWS = 1_000_000


def keep_for_join(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Checkpoint a derived table and mark it for broadcast if its counted size allows.

    Beyond the bound it stays an ordinary join side, and adaptive execution splits hot keys.
    """
    scratch_root(df.sparkSession)
    table = df.checkpoint()
    return F.broadcast(table) if table.count() <= bound else table
