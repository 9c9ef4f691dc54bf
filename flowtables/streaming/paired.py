"""Joins of two streams, and deadlines, with a carry from batch to batch (see `streaming.carried`).

A join of two streams in Spark's state store writes every row to the store and looks it up there one by one, which takes
several times the time of a join of tables. Here a micro-batch is joined as bounded input with the rows that earlier batches
left, and a row leaves when nothing that may still come can meet it. Two streams come as one, made by `both`, so that a
`foreachBatch` function gets the rows of both.

Each side may be out of order by its bound. A row further behind is late: its window or deadline may be over, and then it is
left out; in interval joins it meets what is still there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.times import epoch_micros, floor_div, micros
from flowtables.operators.joins import interval_join, window_join
from flowtables.operators.timeouts import deadline
from flowtables.streaming.carried import Carry, OnBatch
from flowtables.streaming.timers import _after

_CLOCK = T.StructType([T.StructField(side, T.LongType()) for side in ("left", "right")])


def both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two streams as one, a row of either in the column of its side."""
    return left.select(F.struct(*left.columns).alias("left")).unionByName(
        right.select(F.struct(*right.columns).alias("right")), allowMissingColumns=True)


def _sides(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(batch.where(F.col(side).isNotNull()).select(f"{side}.*") for side in ("left", "right"))


def _clocks(carry: Carry, batch_id: int, left: Column, right: Column, batch: DataFrame) -> tuple[tuple, tuple]:
    """Highest event time of each side before this batch and after it, in microseconds; None as long as there was none."""
    before = carry.before("clock", batch_id, _CLOCK).agg(F.max("left"), F.max("right")).first()
    now = batch.agg(*[F.greatest(F.max(epoch_micros(c)), F.lit(b).cast("long")) for c, b in zip((left, right), before, strict=True)]).first()
    return tuple(before), tuple(now)


def _leave_clock(carry: Carry, batch_id: int, now: tuple) -> None:
    carry.leave("clock", batch_id, carry.spark.createDataFrame([tuple(now)], _CLOCK))


def _less(clock: int | None, bound: str) -> int | None:
    """The time that a side's rows still to come are not before."""
    return None if clock is None else clock - micros(bound)


def _reaches(time: Column, mark: int | None) -> Column:
    """Is the time at the mark or after it? Everything with a time is, as long as there is no mark."""
    return time.isNotNull() if mark is None else F.coalesce(time >= mark, F.lit(False))


def interval_batches(on: Sequence[str], left_ts: str, right_ts: str, lower: str, upper: str, write: OnBatch, state: str,
                     left_bound: str = "0 seconds", right_bound: str = "0 seconds") -> OnBatch:
    """For `foreachBatch` on `both`: `operators.joins.interval_join` of two streams; a pair is written by the batch that completes it."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        carry, batch = Carry(batch.sparkSession, state), batch.persist()
        try:
            _, now = _clocks(carry, batch_id, F.col(f"left.{left_ts}"), F.col(f"right.{right_ts}"), batch)
            left, right = _sides(batch)
            old_left, old_right = carry.before("left", batch_id, left.schema), carry.before("right", batch_id, right.schema)
            all_left, all_right = left.unionByName(old_left), right.unionByName(old_right)
            write(interval_join(left, all_right, on, left_ts, right_ts, lower, upper).unionByName(
                interval_join(old_left, right, on, left_ts, right_ts, lower, upper)), batch_id)
            carry.leave("left", batch_id, all_left.where(
                _reaches(epoch_micros(left_ts) + micros(upper), _less(now[1], right_bound))))
            carry.leave("right", batch_id, all_right.where(
                _reaches(epoch_micros(right_ts) - micros(lower), _less(now[0], left_bound))))
            _leave_clock(carry, batch_id, now)
        finally:
            batch.unpersist()
    return on_batch


def window_batches(on: Sequence[str], left_ts: str, right_ts: str, size: str, write: OnBatch, state: str, how: str = "inner",
                   defaults: Mapping[str, object] | None = None, left_bound: str = "0 seconds", right_bound: str = "0 seconds") -> OnBatch:
    """For `foreachBatch` on `both`: `operators.joins.window_join` of two streams; a pair is written by the batch that completes it.

    With `how="left"` a left row without a partner is written when the highest times of both sides have passed the end of
    its window by their bounds. Rows without a time have no window and are left out.
    """
    def end(ts: str) -> Column:
        return (floor_div(epoch_micros(ts), micros(size)) + 1) * micros(size)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        carry, batch = Carry(batch.sparkSession, state), batch.persist()
        try:
            before, now = _clocks(carry, batch_id, F.col(f"left.{left_ts}"), F.col(f"right.{right_ts}"), batch)

            def closed(clocks: tuple) -> int | None:
                marks = [_less(c, b) for c, b in zip(clocks, (left_bound, right_bound), strict=True)]
                return None if None in marks else min(marks)

            def is_open(ts: str, until: int | None) -> Column:
                return _reaches(end(ts), None if until is None else until + 1)

            left, right = _sides(batch)
            left, right = left.where(is_open(left_ts, closed(before))), right.where(is_open(right_ts, closed(before)))
            old_left, old_right = carry.before("left", batch_id, left.schema), carry.before("right", batch_id, right.schema)
            all_left, all_right = left.unionByName(old_left), right.unionByName(old_right)

            def joined(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
                return window_join(a, b, on, left_ts, right_ts, size, how, defaults)

            until = closed(now)
            out = joined(left, all_right).unionByName(joined(old_left, right))
            if how == "left" and until is not None:
                due = all_left.where(~is_open(left_ts, until)).withColumn("__w", end(left_ts))
                met = all_right.where(~is_open(right_ts, until)).select(*on, end(right_ts).alias("__w"))
                alone = due.join(met, [*on, "__w"], "left_anti").select(*left.columns)
                out = out.unionByName(joined(alone, right.where(F.lit(False)), "left"))
            write(out, batch_id)
            carry.leave("left", batch_id, all_left.where(is_open(left_ts, until)))
            carry.leave("right", batch_id, all_right.where(is_open(right_ts, until)))
            _leave_clock(carry, batch_id, now)
        finally:
            batch.unpersist()
    return on_batch


def overdue_batches(keys: Sequence[str], ts: str, is_open: Column, wait: str, write: OnBatch, state: str,
                    bound: str = "0 seconds", order: Sequence[str] = ()) -> OnBatch:
    """For `foreachBatch`: the rows of `timers.overdue`, by the same rules, written by the batch that passes their deadline.

    A row stays in the carry until its own deadline is over, as it may also be what follows another one.
    """
    columns = [*keys, *order]
    later = {c: f"__{i}" for i, c in enumerate(columns)}

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        carry, batch = Carry(batch.sparkSession, state), batch.persist()
        try:
            before, now = _clocks(carry, batch_id, F.col(ts), F.lit(None).cast("timestamp"), batch)
            ends = epoch_micros(deadline(ts, wait))
            rows = batch.where(_reaches(ends, _less(before[0], bound))).unionByName(carry.before("rows", batch_id, batch.schema))
            waits = _reaches(ends, _less(now[0], bound))
            due = rows.where(F.coalesce(is_open, F.lit(False)) & ~waits)
            follow = rows.select(F.col(ts).alias("__ts"), (~F.coalesce(is_open, F.lit(False))).alias("__closes"),
                                 *[F.col(c).alias(later[c]) for c in columns])
            same = reduce(lambda a, b: a & b, [F.col(k) == F.col(later[k]) for k in keys])
            tie = _after(order, later) if order else F.col("__closes")
            follows = (F.col("__ts") >= F.col(ts)) & (F.col("__ts") <= deadline(ts, wait)) & ((F.col("__ts") > F.col(ts)) | tie)
            write(due.join(follow, same & follows, "left_anti"), batch_id)
            carry.leave("rows", batch_id, rows.where(waits))
            _leave_clock(carry, batch_id, now)
        finally:
            batch.unpersist()
    return on_batch
