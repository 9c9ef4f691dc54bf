"""Aggregates with one result per group (the bounded form of keyed operators), top-k, row counters.

All of them aggregate partially before the shuffle, so a group of any size costs its task one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.text import ColumnLike, _col, is_blank, tokens
from flowtables.plans.chunks import Split
from flowtables.plans.scan import row_number, scan


@dataclass(frozen=True)
class Measure:
    """An aggregate that can be built from partial results: `sum`, `count`, `min` or `max` of a column.

    `exact` sums money as decimal, so that the result does not depend on the order of addition.
    """

    kind: str
    value: ColumnLike = "*"
    exact: bool = False

    def whole(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1) if isinstance(self.value, str) and self.value == "*" else _col(self.value))
        value = exact_money(self.value) if self.exact else _col(self.value)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](value)

    def again(self, partial: ColumnLike) -> Column:
        return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](_col(partial))


Measures = Mapping[str, Measure]


def exact_money(value: ColumnLike) -> Column:
    return _col(value).cast(T.DecimalType(18, 2))


def bigint_if_fits(df: DataFrame, value: str) -> DataFrame:
    """Whole decimals as BIGINT if each of them fits, else as they are. It runs the frame once to know."""
    low, high = df.agg(F.min(value), F.max(value)).first()
    fits = low is None or (low >= -2**63 and high < 2**63)
    return df.withColumn(value, F.col(value).cast("long")) if fits else df


def words(df: DataFrame, text: str, trim: bool = True, word: str = "word") -> DataFrame:
    """One row per word of every line that is not blank."""
    return df.where(~is_blank(text)).select(F.explode(tokens(text, trim=trim)).alias(word))


def word_count(df: DataFrame, text: str, trim: bool = True) -> DataFrame:
    """Occurrences per word. On a stream it is a running count, to be written in update or complete mode."""
    return words(df, text, trim).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def aggregate_by(df: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    return df.groupBy(*keys).agg(*[m.whole().alias(n) for n, m in measures.items()])


def grand_total(df: DataFrame, measures: Measures) -> DataFrame:
    """Totals over the whole input. A constant key would send every row to one task; no key sends partial sums."""
    return df.agg(*[m.whole().alias(n) for n, m in measures.items()])


def field_max(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], lowest: bool = False) -> DataFrame:
    """Extreme value of one field per group; the other fields are those of the group's first record."""
    rest = [c for c in df.columns if c not in keys and c != value]
    by = F.struct(*[F.col(c) for c in order])
    out = df.groupBy(*keys).agg(
        (F.min if lowest else F.max)(value).alias(value),
        F.min_by(F.struct(*rest), by).alias("__first"))
    return out.select(*keys, *[F.col(f"__first.{c}").alias(c) if c in rest else F.col(c)
                               for c in df.columns if c not in keys])


def _descending(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return -F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return -F.col(column)
    raise TypeError(f"order column {column!r} must be numeric or a time")


def rank_of_max(df: DataFrame, value: str, order: Sequence[str]) -> Column:
    """Sort key under which the largest value wins and, among equals, the earliest record."""
    return F.struct(F.col(value).alias("v"), *[_descending(df, c).alias(f"o{i}") for i, c in enumerate(order)])


def rank_of_min(value: str, order: Sequence[str]) -> Column:
    return F.struct(F.col(value).alias("v"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def record_max(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The whole record with the largest value per group; among equals the earliest."""
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), rank_of_max(df, value, order)).alias("r"))
    return out.select("r.*")


def record_min(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The whole record with the smallest value per group; among equals the earliest."""
    out = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), rank_of_min(value, order)).alias("r"))
    return out.select("r.*")


def reduce_by(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str],
              combine: Callable[[Column, Column], Column], fan_in: int = 1_024,
              split: Split = Split()) -> DataFrame:
    """Fold each group's values in order with an associative function of two columns.

    The fold is a tree: at most `fan_in` consecutive values are put into an array and folded, then the results of
    `fan_in` such runs, and so on, so no task ever holds more than `fan_in` values of a group at a time.
    """
    keys = list(keys)
    kind = df.schema[value].dataType
    numbered = scan(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, {"__n": row_number()}, split)
    level = numbered.select(*keys, (F.col("__n") - 1).alias("__n"), F.col(value).alias("__v"))
    levels, reach = 1, fan_in
    size = numbered.agg(F.max("__n")).first()[0] or 0
    while reach < size:
        levels, reach = levels + 1, reach * fan_in

    def fold(run: Column) -> Column:
        head = run[0]["__v"]
        tail = F.slice(run, 2, F.size(run))
        return F.aggregate(tail, head, lambda acc, item: combine(acc, item["__v"]).cast(kind))

    for _ in range(levels):
        run = F.array_sort(F.collect_list(F.struct("__n", "__v")))
        level = level.groupBy(*keys, F.expr(f"__n div {fan_in}").alias("__g")).agg(fold(run).alias("__v"))
        level = level.withColumnRenamed("__g", "__n")
    return level.select(*keys, F.col("__v").alias(value))


def combine_in_pandas(df: DataFrame, keys: Sequence[str], step: Callable[[pd.DataFrame], pd.DataFrame],
                      merge: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType,
                      spread: int = 64) -> DataFrame:
    """General user aggregate: `step` turns rows of one group into one partial row, `merge` several partials into one.

    Both get and give frames; `schema` is that of a partial, keys included. `step` sees one Arrow batch at a time
    and partials are merged in two rounds, so no group has to fit one task. Use it where no built-in aggregate does.
    """
    keys = list(keys)
    spread_schema = T.StructType([*schema.fields, T.StructField("__s", T.IntegerType())])

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for i, batch in enumerate(batches):
            parts = [step(rows) for _, rows in batch.groupby(keys, sort=False, dropna=False)]
            if parts:
                yield pd.concat(parts, ignore_index=True)[schema.names].assign(__s=i % spread)

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        return merge(rows[schema.names])[schema.names]

    def merged_spread(rows: pd.DataFrame) -> pd.DataFrame:
        return merged(rows).assign(__s=0)

    first = df.mapInPandas(partials, spread_schema)
    # The batch number alone would be 0 for every short partition: mix in the partition it comes from.
    first = first.withColumn("__s", F.pmod(F.col("__s") + F.spark_partition_id(), F.lit(spread)))
    second = first.groupBy(*keys, "__s").applyInPandas(merged_spread, spread_schema)
    return second.groupBy(*keys).applyInPandas(merged, schema)


def rated(df: DataFrame, item: str, rating: str, digits: int = 2) -> DataFrame:
    """Ratings and rounded mean rating per item."""
    return df.groupBy(item).agg(F.count(item).alias("ratings"), F.round(F.avg(rating), digits).alias("rating"))


def top_rated(df: DataFrame, item: str, rating: str, more_than: int, n: int = 10) -> DataFrame:
    """Best rated items with more than `more_than` ratings: by rating, then by number of ratings, then by item."""
    return (rated(df, item, rating)
            .where(F.col("ratings") > more_than)
            .orderBy(F.desc("rating"), F.desc("ratings"), item)
            .limit(n))


def counted(df: DataFrame, name: str, **predicates: Column) -> tuple[DataFrame, Observation]:
    """Row counters beside a job: `rows`, and one count per predicate. Read them after an action on the frame."""
    observation = Observation(name)
    extra = [F.count_if(p).alias(n) for n, p in predicates.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *extra), observation
