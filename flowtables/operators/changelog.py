"""Keyed tables from change records: newest row per key, folded change log, wide rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtables.functions.text import row_key


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last record of every key.

    Map tasks keep one record per key (Spark limits a filtered row number before the shuffle), so hot keys cost
    nothing extra. On a stream, where there are no row numbers, it is an aggregate that does the same.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    if not df.isStreaming:
        newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        return df.withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").drop("__rn")
    out = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("__r"))
    return out.select(*[F.col(c) if c in keys else F.col(f"__r.{c}").alias(c) for c in df.columns])


def apply_changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op",
                    deletes: Sequence[str] = ("d",)) -> DataFrame:
    """Current rows of a table: the last record per key, without keys whose last record is a delete."""
    return latest_per_key(df, keys, order).where(~F.col(op).isin(*deletes)).drop(op)


def flatten_changes(df: DataFrame, keys: Sequence[str], op: str = "op", before: str = "before",
                    after: str = "after") -> DataFrame:
    """Change records with `before` / `after` images as rows: a delete keeps its old image, all others the new one."""
    image = F.when(F.col(op) == "d", F.col(before)).otherwise(F.col(after))
    rest = [c for c in df.columns if c not in (before, after)]
    names = df.schema[after].dataType.names
    missing = [k for k in keys if k not in names]
    if missing:
        raise ValueError(f"key columns {missing} are not in {after!r}")
    return df.select(*rest, image.alias("__i")).select(*rest, *[F.col(f"__i.{n}").alias(n) for n in names])


def wide_rows(df: DataFrame, key: Sequence[str], family: Sequence[str], name: str = "info",
              row: str = "rowkey") -> DataFrame:
    """Wide-column form: joined row key and one struct per column family."""
    return df.select(row_key(*key).alias(row), F.struct(*family).alias(name))
