"""Explicit distribution of rows over tasks. Joins and aggregates place their rows themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_key(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """Rows of equal key to the same task."""
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def evenly(df: DataFrame, n: int) -> DataFrame:
    """Rows dealt out in turn, so that tasks get the same number whatever the values are."""
    return df.repartition(n)


def at_random(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Rows to random tasks."""
    return df.repartition(n, F.rand(seed))


def fewer_tasks(df: DataFrame, n: int) -> DataFrame:
    """Neighbouring partitions joined without a shuffle."""
    return df.coalesce(n)


def by_number(df: DataFrame, n: int, number: Column) -> DataFrame:
    """Rows to the task whose number the expression gives, e.g. `key % 2`; negative numbers count from the end."""
    return df.repartitionById(n, F.pmod(number, F.lit(n)).cast("int"))
