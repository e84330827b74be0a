"""Session settings the operators are tuned for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "shaftline", settings: Mapping[str, str] | None = None) -> SparkSession:
    """A session with ``SETTINGS``, overridden and extended by ``settings``."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
