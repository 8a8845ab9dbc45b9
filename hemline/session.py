"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.parquet.compression.codec": "snappy",
}

def build_session(app_name: str = "hemline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs were written for.

    Keyword settings use ``__`` for dots: ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Without it, only a local
    session, where driver and executors are one machine, gets a folder: below its warehouse,
    removed when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = f"{label}-{uuid.uuid4().hex}"
    if base:
        return f"{base.rstrip('/')}/{path}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:").rstrip("/")
    path = f"{warehouse}/_scratch/{path}"
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path
