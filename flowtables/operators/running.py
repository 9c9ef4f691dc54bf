"""Keyed operators with one output row per input row: the value after that row (bounded form of keyed streams)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.text import ColumnLike, _col
from flowtables.functions.times import epoch_micros, micros
from flowtables.operators.aggregates import rank_of_max, rank_of_min
from flowtables.plans import scan as s
from flowtables.plans.chunks import CHUNK, Chunked, Split, ordered_chunks


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: ColumnLike,
                out: str = "running_sum", split: Split = Split()) -> DataFrame:
    """Sum so far per group; without keys, over the whole input."""
    return s.scan(df, keys, order, {out: s.total(value)}, split)


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  out: str = "running_count", split: Split = Split()) -> DataFrame:
    return s.scan(df, keys, order, {out: s.row_number()}, split)


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: ColumnLike,
                out: str = "running_max", split: Split = Split()) -> DataFrame:
    return s.scan(df, keys, order, {out: s.highest(value)}, split)


def running_min(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: ColumnLike,
                out: str = "running_min", split: Split = Split()) -> DataFrame:
    return s.scan(df, keys, order, {out: s.lowest(value)}, split)


def _records(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Split, best: s.Running,
             field: str | None) -> DataFrame:
    record = F.struct(*df.columns)
    values = {"__best": best}
    if field:
        values["__first"] = s.first(record, order)
    out = s.scan(df, keys, order, values, split)
    seq = [F.col(c).alias(f"seq_{c}") for c in order]
    if field:
        return out.select(*seq, *[F.col("__best").alias(c) if c == field
                                  else F.col(c) if c in keys
                                  else F.col("__first")[c].alias(c) for c in df.columns])
    return out.select(*seq, "__best.record.*")


def running_field_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, lowest: bool = False,
                      split: Split = Split()) -> DataFrame:
    """Extreme value so far, other fields from the group's first record. `seq_*` columns name the input row."""
    return _records(df, keys, order, split, s.lowest(value) if lowest else s.highest(value), value)


def running_record_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                       split: Split = Split()) -> DataFrame:
    """The whole record with the largest value so far; among equals the earliest."""
    best = s.highest(F.struct(rank_of_max(df, value, order).alias("rank"), F.struct(*df.columns).alias("record")))
    return _records(df, keys, order, split, best, None)


def running_record_min(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                       split: Split = Split()) -> DataFrame:
    """The whole record with the smallest value so far; among equals the earliest."""
    best = s.lowest(F.struct(rank_of_min(value, order).alias("rank"), F.struct(*df.columns).alias("record")))
    return _records(df, keys, order, split, best, None)


def _prefixes(df: DataFrame, by: Sequence[str], order: Sequence[str], combine: Callable[[Column, Column], Column],
              longest: int) -> DataFrame:
    """Replace __v by the fold of all __v up to its row: combine with the row 1, 2, 4, ... places before, in turn."""
    part = Window.partitionBy(*by).orderBy(*order)
    kind = df.schema["__v"].dataType
    out, step = df.withColumn("__n", F.row_number().over(part)), 1
    while step < longest:
        before = F.lag("__v", step).over(part)
        out = out.withColumn("__v", F.when(F.col("__n") > step, combine(before, F.col("__v"))).otherwise(F.col("__v")).cast(kind))
        step *= 2
    return out


def running_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: ColumnLike,
                   combine: Callable[[Column, Column], Column], out: str = "running_reduce",
                   split: Split = Split(rows=65_536)) -> DataFrame:
    """The fold of a group's values so far with a function of two columns, earlier first, one row per input row.

    The function must be associative; it sees NULL values as they are. A row is combined with ever longer runs before it, so
    a group of n rows takes log2(n) steps of the same sorted partition, and large groups are cut into chunks first.
    """
    keys, order = list(keys), list(order)
    chunked = ordered_chunks(df.withColumn("__v", _col(value)), keys, order, split)
    sizes = chunked.df.groupBy(*keys, CHUNK).count().agg(F.max("count")).first()[0] or 1
    local = _prefixes(chunked.df, [*keys, CHUNK], order, combine, sizes)
    if chunked.is_cut:
        # One row per chunk of a cut group: what all earlier chunks give.
        cut = Chunked(local, chunked.keys, chunked.order, chunked.rows, chunked.chunks, chunked.keys_cut).cut_rows()
        ends = cut.groupBy(*keys, CHUNK).agg(F.max_by(F.struct("__v"), "__n").alias("__e")).select(*keys, CHUNK, "__e.__v")
        along = Window.partitionBy(*keys).orderBy(CHUNK)
        carry = _prefixes(ends, keys, [CHUNK], combine, chunked.chunks).select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(CHUNK).alias("__kc"),
            F.lag(F.struct("__v")).over(along).alias("__c"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)],
                      F.col(CHUNK) == F.col("__kc"))
        whole = combine(F.col("__c.__v"), F.col("__v")).cast(local.schema["__v"].dataType)
        local = local.join(F.broadcast(carry), same, "left").withColumn(
            "__v", F.when(F.col("__c").isNotNull(), whole).otherwise(F.col("__v")))
    return local.select(*df.columns, F.col("__v").alias(out))


def expiring_sum(df: DataFrame, keys: Sequence[str], ts: str, ttl: str, value: ColumnLike | None = None,
                 tie: Sequence[str] = (), out: str = "running_count", split: Split = Split()) -> DataFrame:
    """Running sum (by default a count) that starts again when the group was silent for `ttl` or longer.

    This is keyed state with a time to live that every write renews and that is never read after expiry, with
    the time taken from `ts`. Values must be whole numbers or decimals, as the sum of a run is the
    difference of two running sums. A NULL value adds nothing; rows with a NULL time come before all others.
    """
    amount = F.lit(1).cast("long") if value is None else _col(value)
    if isinstance(df.select(amount.alias("v")).schema["v"].dataType, (T.DoubleType, T.FloatType)):
        raise TypeError("sums that expire need whole numbers or decimals")
    order = [ts, *tie]
    work = df.withColumn("__v", amount).withColumn("__us", epoch_micros(ts))
    chunked = ordered_chunks(work, keys, order, split)
    chunked = s.scan_chunked(chunked, {"__prev": s.highest("__us", before=True), "__all": s.total("__v")})
    starts = F.col("__prev").isNull() | (F.col("__us") - F.col("__prev") >= micros(ttl))
    marked = s.Chunked(
        chunked.df.withColumn("__base", F.when(
            starts, F.coalesce("__all", F.lit(0)) - F.coalesce("__v", F.lit(0)))),
        chunked.keys, chunked.order, chunked.rows, chunked.chunks, chunked.keys_cut)
    based = s.scan_chunked(marked, {"__from": s.latest("__base", order)})
    total = F.coalesce("__all", F.lit(0)) - F.col("__from")
    return based.df.select(*df.columns, total.cast(work.select(F.sum("__v")).schema[0].dataType).alias(out)).drop(CHUNK)
