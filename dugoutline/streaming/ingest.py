"""Incremental runs: new files are taken once, merged into the store, and windows are counted with watermarks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugoutline.sources.store import append_new


def new_files(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stream over the parquet files of a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def run_once(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """All that is new since the checkpoint handed to ``each``, then the run ends. This is the high-water mark:
    a second run without new files does nothing."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def merge_into(spark: SparkSession, path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A batch writer that appends rows whose key is not stored; a batch that is run again adds nothing."""

    def each(batch: DataFrame, _: int) -> None:
        append_new(batch.sparkSession, path, batch, keys)

    return each


def deduplicated(stream: DataFrame, keys: list[str], event_time: str, late: str) -> DataFrame:
    """Rows once per key while their event times are within the watermark."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, event_time: str, key: str, length: str, late: str) -> DataFrame:
    """(window_start, key, n) per window of event time; rows later than the watermark are not counted."""
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, length).alias("_w"), key).agg(F.count("*").alias("n")).select(F.col("_w.start").alias("window_start"), key, "n")
