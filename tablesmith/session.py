"""Session settings the operations expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that change results, so they are set rather than hoped for.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One key may hold a third of a table. Without this a split that needs one more shuffle
    # afterwards is not done, and the key's rows stay in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
