"""Incremental runs: new files become new rows once, by Structured Streaming; the checkpoint makes a rerun do only what is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import exists


def append_new(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str, transform: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet") -> StreamingQuery:
    """``append_stream`` of the files that come into a folder."""
    return append_stream(spark.readStream.format(fmt).schema(schema).load(source), target, checkpoint, key, transform)


def append_stream(stream: DataFrame, target: str, checkpoint: str, key: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Appends a stream's new rows to ``target``, each key once over all runs, and ends when there is nothing more.

    A micro-batch drops its own duplicates and those already in the target; a batch that is repeated after a failure finds its rows there.
    """

    def write(batch: DataFrame, n: int) -> None:
        rows = (transform(batch) if transform else batch).dropDuplicates([key])
        spark = batch.sparkSession
        have = spark.read.parquet(target).select(key) if exists(spark, f"{target}/*.parquet") else None  # nothing yet at the first batch
        (rows if have is None else rows.join(have, key, "left_anti")).write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str = "ts", by: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, by, n) of a stream or table of events in tumbling windows; rows later than the watermark are dropped from streams."""
    marked = events.withWatermark(ts, late) if events.isStreaming else events
    return marked.groupBy(F.window(ts, width).start.alias("window_start"), by).agg(F.count(F.lit(1)).alias("n"))
