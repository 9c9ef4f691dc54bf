"""Event-time streams: watermarks, windows with allowed lateness, late rows, joins with a changing dimension."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.functions.times import epoch_micros, micros
from flowtables.operators.aggregates import Measures
from flowtables.operators.joins import newest_lookup_join
from flowtables.operators.late import LATE, Lateness, classify
from flowtables.operators.windows import tumbling_agg
from flowtables.plans.broadcasting import Limit
from flowtables.plans.chunks import Split

OnBatch = Callable[[DataFrame, int], None]


def watermarked(stream: DataFrame, ts: str, bound: str = "0 seconds", allowed: str = "0 seconds") -> DataFrame:
    """Keep window state until the latest event time is `bound + allowed` past the window."""
    return stream.withWatermark(ts, f"{micros(bound) + micros(allowed)} microseconds")


def lateness_agg(stream: DataFrame, ts: str, rule: Lateness, measures: Measures, keys: Sequence[str] = ()) -> DataFrame:
    """Window totals of a stream.

    Written in update mode they come early and again with every change (the newest row per window counts); in
    append mode once, when the window is closed for good. Spark uses one watermark for all partitions, the
    largest event time seen, and moves it between micro-batches.
    """
    return tumbling_agg(watermarked(stream, ts, rule.bound, rule.allowed), ts, rule.size, measures, keys, rule.offset)


def split_late_batches(ts: str, arrival: Sequence[str], rule: Lateness, accepted: OnBatch, late: OnBatch,
                       state: str, split: Split = Split()) -> OnBatch:
    """For `foreachBatch`: sends rows that still count to `accepted` (with their status) and late rows to `late`.

    The highest event time so far is kept in the folder `state`, one value per micro-batch, written after
    both outputs: a repeated batch starts from the same value. Rows of a batch are judged in arrival order, so the
    outcome is that of the bounded form, however the input is cut into batches.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            seen = None
            if batch_id:
                seen = spark.read.parquet(f"{state}/batch={batch_id - 1}").first()["seen"]
            rows = classify(batch, ts, arrival, rule, seen, split)
            accepted(rows.where(F.col("status") != LATE), batch_id)
            late(rows.where(F.col("status") == LATE).drop("status"), batch_id)
            highest = batch.agg(F.greatest(F.max(epoch_micros(ts)), F.lit(seen).cast("long")).alias("seen"))
            highest.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        finally:
            batch.unpersist()
    return on_batch


def enrich_batches(read_dimension: Callable[[], DataFrame], on: Sequence[str], order: Sequence[str], write: OnBatch,
                   defaults: Mapping[str, object] | None = None, limit: Limit | None = Limit()) -> OnBatch:
    """For `foreachBatch`: join each micro-batch with the newest row per key of a dimension read at that moment."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write(newest_lookup_join(batch, read_dimension(), on, order, defaults, limit), batch_id)
    return on_batch


def without_repeats(stream: DataFrame, ids: Sequence[str], ts: str, bound: str = "0 seconds") -> DataFrame:
    """Each record once, however often and in what order it was delivered: the reader's side of an at-least-once sink.

    A record is known by `ids` for `bound` after its time, which is as long as a row may be behind the highest event
    time. A repeat has the time of its first delivery, so one that comes later still is too late and left out as such.
    State therefore holds the ids of the last `bound` only. NULL ids are equal to each other.
    """
    return stream.withWatermark(ts, f"{micros(bound)} microseconds").dropDuplicatesWithinWatermark(list(ids))
