"""Orders that stay unpaid for too long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.text import ColumnLike, _col
from flowtables.functions.times import shift
from flowtables.operators.changelog import latest_per_key

# Status texts of the order records.
UNPAID = "未付款"
CANCELLED = "取消"


def deadline(ordered_at: ColumnLike, wait: str = "15 seconds") -> Column:
    """Time at which an unpaid order is due; fractions of a second of the order time do not count."""
    return shift(F.date_trunc("second", _col(ordered_at)), wait)


def cancel_unpaid(orders: DataFrame, as_of: ColumnLike, order_id: str = "order_id", ordered_at: str = "order_time",
                  status: str = "order_status", wait: str = "15 seconds", unpaid: str = UNPAID,
                  cancelled: str = CANCELLED, statuses: DataFrame | None = None,
                  order: Sequence[str] = ()) -> DataFrame:
    """Updates for the orders that are due at `as_of` and whose newest status is still unpaid.

    `orders` has a row per order as it came in; `statuses`, if given, has status changes with the columns
    `order_id`, `status` and `order`. Without it the newest row per order in `orders` counts: the last by `order`, or
    by `ordered_at` if no order is given.
    """
    due = orders.where((F.col(status) == unpaid) & (deadline(ordered_at, wait) <= _col(as_of)))
    if statuses is not None:
        now = latest_per_key(statuses.select(order_id, *order, F.col(status).alias("__now")), [order_id], order)
        due = due.join(now.select(order_id, "__now"), order_id, "left")
        due = due.where(F.coalesce(F.col("__now"), F.col(status)) == unpaid).drop("__now")
    else:
        due = latest_per_key(orders, [order_id], order or [ordered_at]).where(
            (F.col(status) == unpaid) & (deadline(ordered_at, wait) <= _col(as_of)))
    return due.withColumn(status, F.lit(cancelled)).select(*orders.columns)
