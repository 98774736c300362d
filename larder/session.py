"""Session construction and the runtime settings the plans rely on."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

DEFAULT_APP_NAME = "larder"

# A join on a key that holds a large share of the rows is split by adaptive
# execution, also where the rows of one key are aggregated right afterwards
# (there a split costs one more shuffle, which beats one task doing it all).
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}

DEFAULT_SHUFFLE_PARTITIONS = "400"


def get_spark(
    app_name: str = DEFAULT_APP_NAME,
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session pinned to this interpreter, with adaptive execution on.

    ``master`` is left to spark-submit unless given.
    """
    if not isinstance(app_name, str) or not app_name.strip():
        raise ValueError("app_name must be a non-empty string")
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = {
        "spark.pyspark.python": sys.executable,
        "spark.pyspark.driver.python": sys.executable,
        "spark.sql.shuffle.partitions": DEFAULT_SHUFFLE_PARTITIONS,
        "spark.sql.session.timeZone": "UTC",
        **RUNTIME_SETTINGS,
        **(settings or {}),
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
