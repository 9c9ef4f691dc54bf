"""Broadcast a side only when its size has been measured."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limit:
    rows: int = 500_000
    bytes: int = 64 * 1024 * 1024


def text_size(df: DataFrame) -> int:
    """Bytes of all rows as JSON text, summed where the rows are."""
    row = F.octet_length(F.to_json(F.struct(*df.columns))).cast("long")
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit: Limit = Limit()) -> DataFrame:
    """The frame with a broadcast hint when it fits the limit, unchanged otherwise.

    Unchanged means a shuffle join, where adaptive execution splits skewed partitions and may still turn to a
    broadcast by the sizes it sees. A streaming frame cannot be measured and stays unchanged.
    """
    if df.isStreaming:
        return df
    # Counting reads no columns; the rows are only looked at when there are few.
    if df.count() > limit.rows:
        return df
    return F.broadcast(df) if text_size(df) <= limit.bytes else df
