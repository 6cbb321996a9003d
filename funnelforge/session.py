"""Spark session and checkpoint-directory helpers.

The library never creates a cluster-level setting it does not own: on a cluster
``spark.checkpoint.dir`` is expected to name a shared folder and is read from the
session. Where it is unset, a local run gets a scratch folder and a cluster an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "funnelforge", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings every operator assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Session-level settings (take effect even when the session already existed).
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: a table that several passes
    read is computed once, and its lineage ends there."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # A folder of this machine serves local runs and tests; the nodes of a cluster cannot share it.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="funnelforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
