"""Several outputs of one input, several inputs to one output."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_outputs(df: DataFrame, outputs: Mapping[str, Column]) -> dict[str, DataFrame]:
    """One frame per tag, holding the rows its predicate accepts. A row may go to several tags or to none."""
    return {tag: df.where(accepts) for tag, accepts in outputs.items()}


def tag_rows(df: DataFrame, outputs: Mapping[str, Column], tag: str = "tag") -> DataFrame:
    """One row per accepted tag, to write all outputs in one pass with `partitionBy(tag)`."""
    tags = F.array_compact(F.array(*[F.when(p, F.lit(name)) for name, p in outputs.items()]))
    return df.withColumn(tag, F.explode(tags))


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all inputs, duplicates kept, columns matched by name."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def co_map(first: DataFrame, second: DataFrame, map_first: Callable[[DataFrame], DataFrame],
           map_second: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Two inputs of different type brought to one type by a function each, then put together."""
    return map_first(first).unionByName(map_second(second))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Make the frame, bounded or streaming, known to SQL under a name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
