"""Incremental work as Structured Streaming: file streams, weekly counts, url deduplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.storage import scratch_path


def table_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A Parquet table of a folder as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{table}.parquet*")


def weekly_counts(stream: DataFrame, ts: str, keys: list[str], watermark: str | None = None) -> DataFrame:
    """week_start, keys, n in Monday weeks. With a watermark, weeks end and leave the state."""
    rows = stream.withColumn("week_ts", F.col(ts).cast("timestamp"))
    if watermark:
        rows = rows.withWatermark("week_ts", watermark)
    weeks = rows.groupBy(F.window("week_ts", "1 week", "1 week", "4 days").alias("week"), *keys).agg(F.count("*").alias("n"))
    return weeks.select(F.col("week.start").cast("timestamp_ntz").alias("week_start"), *keys, "n")


def sessions(stream: DataFrame, ts: str, key: str, gap: str, watermark: str) -> DataFrame:
    """key, session_start, session_end, n of closed sessions."""
    rows = stream.withColumn("session_ts", F.col(ts).cast("timestamp")).withWatermark("session_ts", watermark)
    made = rows.groupBy(F.session_window("session_ts", gap).alias("s"), key).agg(F.count("*").alias("n"))
    return made.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def run_available(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """Process what is there and return the result table; each complete result replaces the last."""
    path = scratch_path(spark, "stream")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{path}/table")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def ingest_stream(stream: DataFrame, table: str, checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame]):
    """Append to a Parquet table what ``merge(batch, stored)`` leaves of each batch.

    A batch's number names its files, so that a batch that runs again replaces its own.
    """
    spark = stream.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        from pyspark.errors import AnalysisException

        try:
            stored = spark.read.parquet(table).where(F.col("batch") != number)
        except AnalysisException:  # no table yet
            stored = spark.createDataFrame([], batch.schema)
        merge(batch, stored).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
