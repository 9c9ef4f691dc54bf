"""Late data on event-time windows.

With bound `b`, allowed lateness `L`, window end `e` and `m` the highest event time of all earlier arrivals:

* `m < e + b`                the row is on time; the window has not fired yet
* `e + b <= m < e + b + L`   the window fires again with the new total
* `m >= e + b + L`           the row is late and belongs to no window

`m` is one maximum over the whole input. It needs the arrival order, given by columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.times import epoch_micros, micros, tumbling
from flowtables.operators.aggregates import Measures
from flowtables.plans.chunks import Split
from flowtables.plans.scan import highest, row_number, scan, total

ON_TIME, REFIRE, LATE = "on_time", "refire", "late"


@dataclass(frozen=True)
class Lateness:
    size: str
    bound: str = "0 seconds"
    allowed: str = "0 seconds"
    offset: str | None = None


def arrival_status(end_us: Column, seen_us: Column, rule: Lateness) -> Column:
    """Status of a row from its window end and the highest event time seen before it, both in microseconds."""
    fires = end_us + micros(rule.bound)
    return (F.when(seen_us >= fires + micros(rule.allowed), LATE)
            .when(seen_us >= fires, REFIRE)
            .otherwise(ON_TIME))


def classify(df: DataFrame, ts: str, arrival: Sequence[str], rule: Lateness, seen_before: int | None = None,
             split: Split = Split()) -> DataFrame:
    """Add `window_start`, `window_end` and `status` to every row.

    `seen_before` is the highest event time (epoch microseconds) of anything that arrived before this input.
    """
    work = df.withColumn("__us", epoch_micros(ts))
    work = scan(work, [], arrival, {"__seen": highest("__us", before=True)}, split)
    seen = F.greatest(F.col("__seen"), F.lit(seen_before).cast("long"))
    w = tumbling(ts, rule.size, rule.offset)
    return (work.withColumn("__w", w)
            .withColumn("status", arrival_status(epoch_micros(F.col("__w.end")), seen, rule))
            .select(*df.columns, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
                    "status"))


def split_late(df: DataFrame, ts: str, arrival: Sequence[str], rule: Lateness,
               split: Split = Split()) -> tuple[DataFrame, DataFrame]:
    """Rows that count for their window, and the late rows."""
    rows = classify(df, ts, arrival, rule, split=split)
    return rows.where(F.col("status") != LATE), rows.where(F.col("status") == LATE).drop("status")


def window_totals(rows: DataFrame, measures: Measures, keys: Sequence[str] = ()) -> DataFrame:
    """Last firing of every window, from classified rows."""
    by = [*keys, "window_start", "window_end"]
    return rows.where(F.col("status") != LATE).groupBy(*by).agg(
        *[m.whole().alias(n) for n, m in measures.items()])


def window_firings(rows: DataFrame, value: str, arrival: Sequence[str], keys: Sequence[str] = (),
                   out: str = "total", split: Split = Split()) -> DataFrame:
    """Every firing of every window: `firing` 0 is the first complete total, then one per row that came after it.

    A window all of whose rows came after its end time fires only for those rows, starting at `firing` 1.
    """
    by = [*keys, "window_start", "window_end"]
    # The highest event time only grows, so the rows of a window that are on time arrive before those that fire it again,
    # and one running total per window holds all its firings.
    again = F.when(F.col("status") == REFIRE, 1).otherwise(0)
    counted = rows.where(F.col("status") != LATE).select(*by, *arrival, F.col(value).alias("__v"), again.alias("__again"))
    firings = scan(counted, by, arrival, {"__total": total("__v"), "__no": total("__again"), "__n": row_number()}, split)
    return firings.groupBy(*by, F.col("__no").cast("long").alias("firing")).agg(F.max_by("__total", "__n").alias(out))
