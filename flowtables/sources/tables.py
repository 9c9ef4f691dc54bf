"""Registered and stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table `name` of a folder that holds one Parquet file or directory per table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def parquet_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """The same table as a stream of files. The name is given as a pattern, which may also match a single file."""
    return spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/{name}.parque[t]")


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Table of the catalog by one-, two- or three-part name; also temporary views."""
    return spark.table(name)


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def wide_scan(df: DataFrame, columns: Sequence[str], key: str = "rowkey", limit: int | None = None) -> DataFrame:
    """Row key and single fields of a column family (`info.item_id`); the scan reads only these fields."""
    out = df.select(key, *[F.col(c).alias(c.rsplit(".", 1)[-1]) for c in columns])
    return out if limit is None else out.limit(limit)


def with_instants(df: DataFrame, *columns: str) -> DataFrame:
    """Zone-free times as instants in the session zone; watermarks need instants."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})
