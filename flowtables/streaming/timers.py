"""Deadlines on streams in event time: what is still open when its time is up.

A deadline is a left outer join of the stream with itself: an open row waits for a later row of its key until the watermark
has passed its deadline, and comes out without a partner if there was none. State lies in Spark's state store under the
key, so a batch touches the keys it brings and the rows that fall due; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.times import micros, shift
from flowtables.operators.timeouts import CANCELLED, UNPAID, deadline


def _after(order: Sequence[str], later: dict[str, str]) -> Column:
    """Is the later row's order greater, by the first column that differs?"""
    out = F.lit(False)
    for c in reversed(order):
        out = (F.col(later[c]) > F.col(c)) | (F.col(later[c]).eqNullSafe(F.col(c)) & out)
    return F.coalesce(out, F.lit(False))


def overdue(stream: DataFrame, keys: Sequence[str], ts: str, is_open: Column, wait: str, bound: str = "0 seconds",
            order: Sequence[str] = ()) -> DataFrame:
    """Those open rows of a stream that no later row of their key follows until their deadline, that itself included.

    The deadline is `wait` after the row's time without its fraction of a second. A row comes out once, when the
    highest event time is more than `bound` past the deadline; rows that come later than that are too late to count. So the
    result does not depend on how the input is cut into batches, as long as rows are out of order by at most `bound`.
    Of rows of equal time the later by `order` follows the other; without `order` a row that isn't open follows one that is.
    Rows without a key or time have no deadline.
    """
    marked = stream.withWatermark(ts, f"{micros(bound)} microseconds")
    timed = F.col(ts).isNotNull()
    # Conditions that read the time stay above the watermark, so that all rows move it and not just open ones, or ones with a key.
    open_rows = marked.where(F.coalesce(F.when(timed, is_open), F.lit(False)))
    columns = [*keys, *order]
    later = {c: f"__{i}" for i, c in enumerate(columns)}
    rows = marked.select(F.col(ts).alias("__ts"), (~F.coalesce(is_open, F.lit(False))).alias("__closes"),
                         *[F.when(timed, F.col(c)).alias(later[c]) for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(later[k]) for k in keys])
    # The range with the whole `wait` is what lets Spark drop state; the deadline proper is up to a second earlier.
    in_time = (F.col("__ts") >= F.col(ts)) & (F.col("__ts") <= shift(ts, wait))
    tie = _after(order, later) if order else F.col("__closes")
    follows = in_time & (F.col("__ts") <= deadline(ts, wait)) & ((F.col("__ts") > F.col(ts)) | tie)
    return open_rows.join(rows, same & follows, "left").where(F.col("__ts").isNull()).select(*stream.columns)


def stream_cancel_unpaid(stream: DataFrame, order_id: str = "order_id", ordered_at: str = "order_time",
                         status: str = "order_status", wait: str = "15 seconds", bound: str = "0 seconds",
                         order: Sequence[str] = (), unpaid: str = UNPAID, cancelled: str = CANCELLED) -> DataFrame:
    """All orders, and a second row with the status `cancelled` for every one unpaid `wait` after its order time.

    Time is event time: `ordered_at` must be a timestamp, and later rows of an order (its payments) carry theirs.
    Write the result by key, so that the second row replaces the first. See `overdue` for ties and late rows.
    """
    due = overdue(stream, [order_id], ordered_at, F.col(status) == unpaid, wait, bound, order)
    return stream.unionByName(due.withColumn(status, F.lit(cancelled)).select(*stream.columns))
