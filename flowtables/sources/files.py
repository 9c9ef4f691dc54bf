"""Rows from literals, sequences and files; streams of files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def sequence(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Whole numbers from `first` to `last`, both included."""
    return spark.range(first, last + 1)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s), one row per line. Compressed files are read by their suffix, one task per file."""
    return spark.read.text(path)


def line_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """New text files of a folder as a stream of lines."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a network socket. Rows are lost on restart: for trying out only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def csv_table(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
              comment: str | None = None) -> DataFrame:
    """Delimited files; unreadable and missing fields become NULL."""
    reader = spark.read.schema(schema).option("sep", sep).option("mode", "PERMISSIVE")
    return (reader.option("comment", comment) if comment else reader).csv(path)


def csv_stream(spark: SparkSession, folder: str, schema: T.StructType, sep: str = ",",
               watermark: tuple[str, str] | None = None, files_per_batch: int | None = None) -> DataFrame:
    """New delimited files of a folder as a stream, with a watermark on one of its time columns if given."""
    reader = spark.readStream.schema(schema).option("sep", sep).option("mode", "PERMISSIVE")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    out = reader.csv(folder)
    return out.withWatermark(*watermark) if watermark else out
