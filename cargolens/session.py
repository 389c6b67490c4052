"""Session settings shared by the jobs, and the shared scratch location."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import SparkSession

# Runtime settings the results or the plans rely on. Sizes (shuffle partitions,
# broadcast threshold, executor memory) belong to the cluster and stay untouched.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joining on a key that already went through an aggregation would otherwise
    # keep a skewed partition whole when splitting it costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are folders that all executors share; a machine's own temporary folder is never used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/cargolens/{name}-{uuid.uuid4().hex[:12]}"


def free_shuffles(spark: SparkSession) -> None:
    """Call it between the steps of a job: Spark removes the shuffle files of finished ones when the driver collects its garbage, so it is asked to."""
    gc.collect()
    spark.sql("SELECT 1").collect()  # Spark's listeners hold the last query they have heard of, with its plan
    spark.sparkContext._jvm.System.gc()
