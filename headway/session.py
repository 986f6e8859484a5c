"""Session settings the jobs are written for, and where they may keep durable scratch data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a job submission should set. AQE chooses join strategies from measured shuffle sizes, splits
# skewed join partitions, and coalesces small shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "headway", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory below the shared folder the cluster names in spark.checkpoint.dir.

    Only a local session may fall back to the machine's own temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="headway-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: later reads neither recompute it nor depend on the
    executors that computed it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
