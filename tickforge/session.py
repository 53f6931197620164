"""One place that builds sessions."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tickforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with what the engine relies on: UTC, adaptive execution and ANSI errors.  Whatever else (number of shuffle
    partitions, memory) belongs to the cluster and is left to it or passed in ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }
    for k, v in (fixed | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
