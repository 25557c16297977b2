"""Structured Streaming over a landing folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.plans.ingest import ingest
from broadsheet.schemas import ARCHIVE_ITEM, RANKED_ITEM
from broadsheet.sources.store import Store


def landing_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None):
    """New Parquet files of a landing folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_items(
    items: DataFrame,
    store: Store,
    sources: DataFrame,
    checkpoint: str,
    run_ts: Callable[[int], str],
) -> StreamingQuery:
    """Store whatever landed since the last run, then stop.

    Each micro-batch is one run named after its batch id: a batch repeated
    after a failure replaces its own partitions. Seen urls are those in the
    store, however old, so no watermark bounds them.
    """
    spark = store.spark

    def run(batch: DataFrame, batch_id: int) -> None:
        nothing = spark.createDataFrame([], RANKED_ITEM)
        ingest(store, sources, batch.select(*ARCHIVE_ITEM.names), nothing,
               f"batch-{batch_id:08d}", run_ts(batch_id))

    return (
        items.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(run)
        .start()
    )


def stream_snapshots(
    items: DataFrame, store: Store, sources: DataFrame, checkpoint: str,
    run_ts: Callable[[int], str], run_time: Column | None = None,
) -> StreamingQuery:
    """Ranked items to the snapshots of their days; the last run of a day wins.

    ``run_time`` tells from a row when its run took place. Then a backlog of
    runs gives each its own day, and of the runs of one day, in one batch or in
    several and in any order, the last one stays. Without it a batch is one run
    at the time of ``run_ts``.
    """
    spark = store.spark

    def run(batch: DataFrame, batch_id: int) -> None:
        nothing = spark.createDataFrame([], ARCHIVE_ITEM)
        rows = batch.select(*RANKED_ITEM.names)
        if run_time is not None:
            stamp = F.date_format(run_time.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
            rows = batch.select(*RANKED_ITEM.names, stamp.alias("taken_at"))
        ingest(store, sources, nothing, rows, f"ranked-{batch_id:08d}", run_ts(batch_id))

    return (
        items.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(run)
        .start()
    )


def first_seen_within(items: DataFrame, event_time: str, horizon: str) -> DataFrame:
    """First occurrence of each (source, url) within a bounded horizon.

    Cheaper state than the store's memory of all urls, but forgets after
    ``horizon``; use it only where that is wanted.
    """
    return items.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(
        ["source_id", "url"]
    )


def daily_buckets(events: DataFrame, source: str, event_time: str, lateness: str) -> DataFrame:
    """Entries per source and UTC day; a day is final once it is ``lateness`` old."""
    return (
        events.withWatermark(event_time, lateness)
        .groupBy(F.window(event_time, "1 day"), F.col(source).alias("source_id"))
        .agg(F.count(F.lit(1)).alias("items"))
        .select(
            "source_id",
            F.date_format("window.start", "yyyy-MM-dd").alias("snapshot_date"),
            "items",
        )
    )
