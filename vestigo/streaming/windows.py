"""The windowed aggregates over unbounded input, with watermarks for late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def metric_stream(readings: DataFrame, keys: list[str], at: str, value: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Tumbling windows of a stream; a window comes out once no row that late can still fall into it."""
    rows = readings.where(F.col(value).isNotNull()).withWatermark(at, late)
    agg = rows.groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n"), F.min(value).alias("value_min"), F.max(value).alias("value_max"), F.sum(value).alias("value_sum"))
    return agg.select(*keys, F.unix_millis(F.col("window.start").cast("timestamp")).alias("window_start_ms"), "n", "value_min", "value_max", "value_sum")


def first_delivery(rows: DataFrame, key: str, at: str, late: str = "1 hour") -> DataFrame:
    """Each key once, on its first delivery; keys are forgotten after the watermark."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def sessions(rows: DataFrame, keys: list[str], at: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    agg = rows.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys).agg(F.count("*").alias("n"))
    return agg.select(*keys, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Finished windows into Parquet files, exactly once; runs over what is there and ends."""
    return stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
