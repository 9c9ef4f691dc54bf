"""Text and Parquet files, bounded and streaming. File sinks of a stream are exactly-once by their commit log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from flowtables.functions.text import tuple_line
from flowtables.functions.times import hour_bucket


def write_lines(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Records as `(a,b)` lines."""
    df.select(tuple_line(columns or df.columns).alias("value")).write.text(path)


def with_bucket(df: DataFrame, ts: str, bucket: str = "bucket") -> DataFrame:
    """Add the hourly output folder of each row, taken from a time column."""
    return df.withColumn(bucket, hour_bucket(ts))


def rolling_files(stream: DataFrame, path: str, checkpoint: str, ts: str, text: Sequence[str] | None = None,
                  every: str = "5 seconds", records_per_file: int = 0, available_now: bool = False) -> StreamingQuery:
    """Files in hourly folders, new files with every trigger or after `records_per_file` records.

    `text` names the columns of a text line; without it Parquet files with all columns are written.
    """
    out = with_bucket(stream, ts)
    if text:
        out = out.select(tuple_line(text).alias("value"), "bucket")
    writer = (out.writeStream.format("text" if text else "parquet").outputMode("append")
              .partitionBy("bucket").option("checkpointLocation", checkpoint))
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start(path)


def parquet_files(stream: DataFrame, path: str, checkpoint: str, every: str = "60 seconds",
                  available_now: bool = False) -> StreamingQuery:
    """Parquet files, committed with every trigger."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start(path)


def console(stream: DataFrame, mode: str = "append", rows: int = 20) -> StreamingQuery:
    """Print every micro-batch."""
    return stream.writeStream.format("console").outputMode(mode).option("numRows", rows).start()
