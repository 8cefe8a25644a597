"""Session settings the operators are tuned for; any session with adaptive execution works."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits an oversized join partition at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Rank filters run per map task before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def build_session(app: str = "tierlake", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in (SETTINGS | settings).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
