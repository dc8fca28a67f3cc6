"""Session settings the analysis relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # All wall-clock fields are read in this zone.
    "spark.sql.session.timeZone": "Etc/UTC",
    # Run-time re-planning: coalesced shuffles, skew splits, late broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call-site capture costs several JVM round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Target of rebalanced writes and of skew splits.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Rewriting one month or borough must leave the others alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "curbside", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
