"""Session settings the pipelines rely on, and shared scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates are derived from timestamps, so the zone is part of the results.
    "spark.sql.session.timeZone": "UTC",
    # Joins, shuffle sizes and skewed partitions are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "tellerline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword dots are written as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_time_zone(spark: SparkSession, expected: str) -> None:
    """Refuse to derive dates in another zone than the tables were built with."""
    actual = spark.conf.get("spark.sql.session.timeZone")
    if actual != expected:
        raise ValueError(f"session time zone is {actual}, the job's dates are defined in {expected}")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset it lies in the session's warehouse, which executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
