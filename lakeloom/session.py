"""Session settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "lakeloom", **conf: str) -> SparkSession:
    """UTC, adaptive execution, dynamic partition overwrite; conf adds to these."""
    builder = SparkSession.builder.appName(app)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.sources.partitionOverwriteMode": "dynamic"}
    for k, v in (settings | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
