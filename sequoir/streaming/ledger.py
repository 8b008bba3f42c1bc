"""Structured Streaming: a hash ledger that grows with each micro-batch, and windows over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sequoir.operators.dedup import ledger_update
from sequoir.operators.store import exists


def grow_ledger(stream: DataFrame, folder: str, checkpoint: str, key: str = "hash", id_: str = "original_id") -> StreamingQuery:
    """Write rows with hashes that no batch had before to folder/new, and those hashes to folder/ledger.

    The ledger is one table with a folder for each batch, of new hashes alone,
    so it grows with what is new and not with what comes. A batch's files are
    named by its number and overwritten if it runs again, and what it compares
    with are the batches before it; so a batch that is repeated after a failure
    leaves what it would have left.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        schema = T.StructType([df.schema[key], T.StructField("batch", T.LongType())])
        seen = spark.read.schema(schema).parquet(f"{folder}/ledger") if exists(spark, f"{folder}/ledger") else spark.createDataFrame([], schema)
        new, _ = ledger_update(df, seen.where(F.col("batch") < number).select(key), key, [id_])
        new.write.mode("overwrite").parquet(f"{folder}/new/batch={number}")
        spark.read.schema(df.schema).parquet(f"{folder}/new/batch={number}").select(key).write.mode("overwrite").parquet(f"{folder}/ledger/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Parquet files as they come into a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by time window and event type; for streams rows later than `late` are dropped."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    return timed.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each user, which end after `gap` without an event."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    return timed.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
