"""Running (prefix) values over ordered groups, safe for groups of any size.

Inside a chunk a running value is a window frame. Across chunks it is the frame's value merged with a carry: the
aggregate of all earlier chunks of the group. There is one carry row per chunk of a cut group, at most
`2 * max_chunks` rows in all, so it is broadcast; rows are shuffled once, on (keys, chunk).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.functions.text import ColumnLike, _col
from flowtables.plans.chunks import CHUNK, Chunked, Split, ordered_chunks


@dataclass(frozen=True)
class Running:
    """One running value: how to aggregate a run of rows, and how to put an earlier run in front of a later one."""

    aggregate: Column
    merge: Callable[[Column, Column], Column]
    before: bool = False             # only the rows before the current one
    summary: Column | None = None    # aggregate of a chunk, where it differs from the frame's
    combine: Callable[[Column], Column] | None = None  # aggregate of summaries


def _add(carry: Column, local: Column) -> Column:
    return F.coalesce(carry + local, local, carry)


def total(value: ColumnLike) -> Running:
    v = _col(value)
    return Running(F.sum(v), _add, combine=F.sum)


def row_number() -> Running:
    return Running(F.count(F.lit(1)), _add, combine=F.sum)


def highest(value: ColumnLike, before: bool = False) -> Running:
    v = _col(value)
    return Running(F.max(v), lambda carry, local: F.greatest(carry, local), before, combine=F.max)


def lowest(value: ColumnLike, before: bool = False) -> Running:
    v = _col(value)
    return Running(F.min(v), lambda carry, local: F.least(carry, local), before, combine=F.min)


def latest(value: ColumnLike, order: Sequence[str], before: bool = False) -> Running:
    """Last non-null value so far."""
    v = _col(value)
    by = F.struct(*[F.col(c) for c in order])
    summary = F.max_by(F.struct(v.alias("v")), F.when(v.isNotNull(), by))
    return Running(
        F.last(F.when(v.isNotNull(), F.struct(v.alias("v"))), ignorenulls=True),
        lambda carry, local: F.coalesce(local, carry), before, summary,
        lambda c: F.last(c, ignorenulls=True))


def first(value: ColumnLike, order: Sequence[str]) -> Running:
    """Value of the group's first row, also where it is NULL."""
    v = F.struct(_col(value).alias("v"))
    by = F.struct(*[F.col(c) for c in order])
    return Running(
        F.first(v), lambda carry, local: F.coalesce(carry, local), False, F.min_by(v, by),
        lambda c: F.first(c, ignorenulls=True))


def scan_chunked(chunked: Chunked, values: Mapping[str, Running]) -> Chunked:
    """Add running values to an already chunked frame; calls can be stacked without another shuffle."""
    keys, order = list(chunked.keys), list(chunked.order)
    part = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    frames = {False: part.rowsBetween(Window.unboundedPreceding, 0),
              True: part.rowsBetween(Window.unboundedPreceding, -1)}
    if not chunked.is_cut:
        if not keys:
            part = Window.partitionBy(CHUNK).orderBy(*order)
        out = chunked.df.select(
            "*", *[_unwrap(r, r.aggregate.over(frames[r.before])).alias(n) for n, r in values.items()])
        return Chunked(out, chunked.keys, chunked.order, chunked.rows, chunked.chunks, chunked.keys_cut)

    per_chunk = chunked.cut_rows().groupBy(*keys, CHUNK).agg(
        *[(r.aggregate if r.summary is None else r.summary).alias(f"__s_{n}") for n, r in values.items()])
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col(CHUNK).alias("__k_chunk"),
        *[r.combine(F.col(f"__s_{n}")).over(earlier).alias(f"__c_{n}") for n, r in values.items()])
    local = chunked.df.select(
        "*", *[r.aggregate.over(frames[r.before]).alias(f"__l_{n}") for n, r in values.items()])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys],
                  F.col(CHUNK) == F.col("__k_chunk"))
    # Bounded: one row per chunk of a cut group (see the module text).
    joined = local.join(F.broadcast(carry), same, "left")
    out = joined.select(
        *chunked.df.columns,
        *[_unwrap(r, r.merge(F.col(f"__c_{n}"), F.col(f"__l_{n}")).cast(local.schema[f"__l_{n}"].dataType)).alias(n)
          for n, r in values.items()])
    return Chunked(out, chunked.keys, chunked.order, chunked.rows, chunked.chunks, chunked.keys_cut)


def _unwrap(running: Running, value: Column) -> Column:
    return value if running.summary is None else value["v"]


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Running],
         split: Split = Split()) -> DataFrame:
    """Add running values per group in the given order. `order` should be unique inside a group."""
    return scan_chunked(ordered_chunks(df, keys, order, split), values).df.drop(CHUNK)
