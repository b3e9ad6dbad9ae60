"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

BUSINESS_ZONE = "Asia/Shanghai"


def build_session(master: str | None = None, app: str = "shopstrata", **conf: str) -> SparkSession:
    """A session with adaptive execution on. Partition counts are left to the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`, or the checkpoint folder set on the context.

    Where neither is set, a temporary folder stands in on a local master only, where driver and executors are
    one process.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shopstrata-"))
    return context.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name for one run, under the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
