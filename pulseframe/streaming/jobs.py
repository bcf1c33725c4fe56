"""Structured Streaming forms of the counters; per-client state is in timers.py.

Each function takes a streaming (or batch) DataFrame and returns one; run() starts a query with a checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import filled


def bucket_counts(df: DataFrame, keys: list[Column], *, seconds: int = 60, rows: int = 1440) -> DataFrame:
    """Counts by event-time bucket and keys. The horizon of rows buckets is the watermark: what is older is dropped."""
    own = df.withWatermark("ts", f"{rows * seconds} seconds")
    counted = own.groupBy(F.window("ts", f"{seconds} seconds").alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("bucket"), *[c for c in counted.columns if c not in ("w", "n", "total")], "n", "total")


def unique_within(df: DataFrame, horizon: str = "2 days") -> DataFrame:
    """Each document once within the horizon."""
    return df.withWatermark("ts", horizon).dropDuplicatesWithinWatermark(["document_id"])


def run(df: DataFrame, path: str, checkpoint: str, *, mode: str = "append", every: str | None = None, partition_by: list[str] | None = None, fmt: str = "parquet", version: int = 1, roll_rows: int = 0):
    """Starts a query. every: a trigger interval such as `60 seconds`, else what there is and an end. A new version of
    a query's state has a new checkpoint folder, so that it starts afresh.

    Files roll by age with each trigger, since a micro-batch writes files of its own, and by size after roll_rows rows. Rows that make many
    small files are dealt out to all cores first, however few files or blocks they come from.
    """
    own = df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism) if roll_rows else df
    writer = own.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", f"{checkpoint}/v{version}")
    writer = writer.option("maxRecordsPerFile", roll_rows) if roll_rows else writer
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def run_filled(df: DataFrame, path: str, checkpoint: str, *, by: list[str], target: int = filled.TARGET, every: str | None = None):
    """Starts a query whose micro-batches are written under path/batch=N as filled.write_filled() has it: files roll by age with each trigger, and by
    bytes. A batch that is written again replaces itself. Staged rows are beside path, in a folder whose name ends in _staging."""

    def write(batch: DataFrame, number: int) -> None:
        filled.write_filled(batch, f"{path}/batch={number}", by=by, staging=f"{path}_staging/{number}-{uuid.uuid4().hex}", target=target)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def fan_out(df: DataFrame, sinks: list[tuple[str, Callable[[DataFrame], DataFrame]]], checkpoint: str):
    """One input to several tables, such as a summary and the original. Each micro-batch is read once; a batch that is written again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for path, transform in sinks:
            transform(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        batch.unpersist()

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def duplicate_counts(df: DataFrame, *, seconds: int = 86_400, horizon: str = "2 days") -> DataFrame:
    """Rows and documents by bucket, of which the difference is duplicates: an aggregate over (bucket, document) counts both."""
    own = df.withWatermark("ts", horizon)
    return own.groupBy(F.window("ts", f"{seconds} seconds").alias("w"), "document_id").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("bucket"), "document_id", (F.col("n") - 1).alias("repeats"))


def merged_hosts(df: DataFrame, *, hours: int = 24) -> DataFrame:
    """Counters of many hosts by bucket: the sums over hosts, kept for as long as a host may be late."""
    return df.withWatermark("ts", f"{hours} hours").groupBy(F.window("ts", "1 minute").alias("w"), "name").agg(F.sum("value").alias("value"), F.approx_count_distinct("host").alias("hosts")).select(F.col("w.start").alias("bucket"), "name", "value", "hosts")
