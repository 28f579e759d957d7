"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "ratesheet", master: str | None = None, **conf) -> SparkSession:
    """Session for jobs, tests and the bench.

    Sizing (shuffle partitions, memory) is left to the cluster; adaptive execution
    coalesces small shuffles and splits skewed joins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # HotSpot leaves methods over 8,000 bytes of code uncompiled. Fall back to split
        # methods for a stage that would generate one, instead of interpreting it.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the one the cluster names for shared intermediate data.

    Without that setting only a local-mode session may fall back to a temporary
    folder: on a cluster the executors would not see it.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return "/".join([base.rstrip("/"), "ratesheet", uuid.uuid4().hex, *parts])
