"""Structured Streaming over report lines: deliveries applied as snapshots, and daily counts with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.latest import snapshot_rows, winning_rows
from tidemark.store import Table


def apply_deliveries(batch: DataFrame, store: Table, keys: list[str]) -> None:
    """Replaces the scope-days of ``batch`` whose delivery is newer than the stored one.

    ``store`` is partitioned by scope_slug and day, and only the partitions of
    the batch are read and rewritten. Running the same batch again changes
    nothing, so a restarted query ends in the same table (exactly once by content).
    """
    if not store.exists():
        store.write(batch.limit(0))
    touched = store.partitions_of(batch)
    if not touched:
        return
    both = batch.unionByName(store.read_partitions(touched).select(*batch.columns))
    store.rewrite(touched, winning_rows(snapshot_rows(both), ["scope_slug", "day", *keys]))


def snapshot_stream(stream: DataFrame, store: Table, keys: list[str], checkpoint: str) -> StreamingQuery:
    """A query that keeps ``store`` at the newest delivery of every scope and day."""
    return (
        stream.writeStream.foreachBatch(lambda batch, _: apply_deliveries(batch, store, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def active_users_stream(events: DataFrame, time: str, user: str, lag: str = "2 days", window: str = "1 day", slide: str | None = None) -> DataFrame:
    """Approximate distinct users per (sliding) window, late rows accepted up to ``lag``."""
    span = F.window(time, window, slide) if slide else F.window(time, window)
    return (
        events.withWatermark(time, lag)
        .groupBy(span.alias("span"))
        .agg(F.approx_count_distinct(user, 0.02).alias("users"), F.count(F.lit(1)).alias("rows"))
        .select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), "users", "rows")
    )


def to_files(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A query that appends windows to parquet files once the watermark has passed them, each exactly once."""
    return counts.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def stream_parquet(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet files of a folder as a stream, one file per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
