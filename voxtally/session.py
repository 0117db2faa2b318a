"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Beyond this size the JVM does not compile a generated method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "voxtally", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the package is written for; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that every executor can reach.

    The folder is `spark.checkpoint.dir`. Only a local session may fall back to a temporary folder,
    because there driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="voxtally-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
