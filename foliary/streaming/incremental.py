"""Incremental forms: documents as a stream, change detection by content hash, idempotent upserts, windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliary.functions.ids import content_sha256


def stream_table(spark: SparkSession, folder: str, like: DataFrame, files_per_batch: int = 100) -> DataFrame:
    """Parquet files that arrive in a folder, with the schema of ``like``."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def new_bodies(stream: DataFrame, time_col: str, text_col: str, delay: str = "1 day") -> DataFrame:
    """Rows whose body was not seen within the delay; state is dropped behind the watermark, so it stays bounded."""
    hashed = stream.withColumn("content_sha256", content_sha256(F.col(text_col)))
    return hashed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["content_sha256"])


def event_counts(events: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Events and their values per window and type; late rows within the delay count."""
    timed = events.withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), "event_type")
    return timed.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def upsert(stream: DataFrame, folder: str, checkpoint: str, key: str, order: str, buckets: int = 64) -> StreamingQuery:
    """Keep the newest row per key (that of the greatest ``order``) in a Parquet table of hash buckets; a batch rewrites only the buckets it touches.

    Each batch writes new versions beside the old (folder/bucket=…/batch=…)
    and readers take the newest version of each bucket, so a batch that runs
    again after a failure overwrites its own output and nothing else.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = lambda df: df.groupBy(key).agg(F.max_by(F.struct("*"), F.col(order)).alias("r")).select("r.*")
        rows = newest(batch).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]
        if not touched:
            return
        old = read_upserted(spark, folder, before=number)
        if old is not None:
            kept = old.where(F.col("bucket").isin(touched))
            rows = newest(rows.unionByName(kept.select(*rows.columns)))
        rows.withColumn("batch", F.lit(number)).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(folder)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_upserted(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """The newest version of each bucket; null if nothing was written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path) or not any(s.isDirectory() for s in fs.listStatus(path)):
        return None
    rows = spark.read.parquet(folder)
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    newest = rows.groupBy("bucket").agg(F.max("batch").alias("batch"))
    return rows.join(F.broadcast(newest), ["bucket", "batch"]).drop("batch")
