"""The size of Arrow batches on their way to Python workers."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's bound on Arrow batches to BATCH_BYTES, so that long texts do not pile up; a lower one stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now)) > BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)
