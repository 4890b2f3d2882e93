"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Tags and slots are cut in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    # Joins and partition counts are settled from measured sizes; skewed keys are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Block aggregates are hashed per task before they fall back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # Call-site capture costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
