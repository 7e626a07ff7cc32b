"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def get_spark(app: str = "chainmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on (UTC, AQE, dynamic overwrite)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # no call-site capture per Column call: plans with many expressions build faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Where that is unset, the session's warehouse takes its place: it is shared as well. Never a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
