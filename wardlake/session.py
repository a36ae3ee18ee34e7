"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build(master: str | None = None, cores: int | None = None) -> SparkSession:
    """Session for scripts and tests; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName("wardlake")
    if master:
        builder = builder.master(master)
    if cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, empty folder below ``spark.checkpoint.dir``.

    Every executor must see the folder, so the session's setting wins. A local
    temporary folder is used only by a ``local`` master without the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="wardlake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def use_utc(spark: SparkSession) -> None:
    """All timestamps in the lake are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
