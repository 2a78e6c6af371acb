"""The session that the library expects: UTC, adaptive execution, ANSI with try_ functions where input is dirty."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "aeroperf", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build or get a session. Without ``shuffle_partitions`` the cluster's own setting holds; adaptive execution merges small ones."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.sql.python.filterPushdown.enabled", "true")
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()
