"""Session settings the plans count on; all can be changed at run time."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins in a row on the same key share one shuffle, and Spark leaves a hot key in one
# task there unless it may add a shuffle. Forced, it does so only where it finds skew.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark
