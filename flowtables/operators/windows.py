"""Time windows: tumbling, sliding, day windows with an offset, sessions.

Results carry the keys, `window_start`, `window_end` and the measures. Windows are aggregated incrementally, rows
are never buffered. Without keys only partial aggregates meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.functions.times import floor_div, micros, shift, sliding, tumbling
from flowtables.operators.aggregates import Measures
from flowtables.plans.chunks import Split, ordered_chunks


def _windowed(df: DataFrame, window: Column, keys: Sequence[str], measures: Measures) -> DataFrame:
    out = df.groupBy(*keys, window.alias("w")).agg(*[m.whole().alias(n) for n, m in measures.items()])
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *measures)


def tumbling_agg(df: DataFrame, ts: str, size: str, measures: Measures, keys: Sequence[str] = (),
                 offset: str | None = None) -> DataFrame:
    """Measures per fixed window, and per key if there are keys."""
    return _windowed(df, tumbling(ts, size, offset), keys, measures)


def sliding_agg(df: DataFrame, ts: str, size: str, slide: str, measures: Measures,
                keys: Sequence[str] = ()) -> DataFrame:
    """Measures per overlapping window.

    Without keys, where panes are few, bounded rows are aggregated to slide-long panes first and only panes are
    repeated per window they belong to. With keys a second shuffle would cost more than repeating rows.
    """
    if df.isStreaming or keys or micros(size) % micros(slide):
        return _windowed(df, sliding(ts, size, slide), keys, measures)
    panes = tumbling_agg(df, ts, slide, measures, keys)
    n = micros(size) // micros(slide)
    back = F.explode(F.array(*[shift("window_start", f"-{i * micros(slide)} microseconds") for i in range(n)]))
    spread = panes.withColumn("window_start", back)
    return spread.groupBy(*keys, "window_start").agg(*[m.again(n).alias(n) for n, m in measures.items()]).select(
        *keys, "window_start", shift("window_start", size).alias("window_end"), *measures)


def daily_agg(df: DataFrame, ts: str, measures: Measures, keys: Sequence[str] = (),
              offset: str = "0 hours") -> DataFrame:
    """Measures per day, where a day starts at midnight UTC plus `offset` (`-8 hours`: midnight at UTC+8)."""
    return tumbling_agg(df, ts, "1 day", measures, keys, offset)


def session_agg(df: DataFrame, ts: str, gap: str, measures: Measures, keys: Sequence[str] = (),
                buckets: int = 4_096, split: Split = Split()) -> DataFrame:
    """Measures per session: rows at most `gap` apart belong together. `window_end` is the last row plus the gap.

    Spark's session windows sort each key in one task. That is the faster way for keys of a usual size; keys larger
    than `split.rows`, and bounded input without a key, are computed in pieces instead. The measures have the same
    types either way.
    """
    plain = F.session_window(F.col(ts), f"{micros(gap)} microseconds")
    if df.isStreaming:
        return _windowed(df, plain, keys, measures)
    df = df.where(F.col(ts).isNotNull())
    if not keys:
        return _pieced_sessions(df, ts, gap, measures, keys, buckets)
    chunked = ordered_chunks(df, keys, [ts], split)
    if not chunked.is_cut:
        return _windowed(df, plain, keys, measures)
    usual = _windowed(chunked.uncut_rows(), plain, keys, measures)
    return usual.unionByName(_pieced_sessions(chunked.cut_rows(), ts, gap, measures, keys, buckets))


def _pieced_sessions(df: DataFrame, ts: str, gap: str, measures: Measures, keys: Sequence[str],
                     buckets: int) -> DataFrame:
    """Sessions in three steps. Rows of one gap-long time bucket are always one session, so they are
    aggregated first. Sessions are then found inside runs of `buckets` time buckets. Only the first and the last
    session of a run can continue in a neighbour, so only these meet per key. A key, or the whole input if there
    is none, is thus never sorted by one task.
    """
    keys = list(keys)
    width = micros(gap)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    state = ["__first", "__last", *measures]

    def merged(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        return rows.groupBy(*by).agg(F.min("__first").alias("__first"), F.max("__last").alias("__last"),
                                     *[m.again(n).alias(n) for n, m in measures.items()])

    def numbered(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        part = Window.partitionBy(*by).orderBy("__first")
        before = F.lag("__last").over(part)
        starts = rows.withColumn("__starts", F.when(F.col("__first") - before <= width, 0).otherwise(1))
        return starts.withColumn("__sid", F.sum("__starts").over(part.rowsBetween(Window.unboundedPreceding, 0)))

    dense = (df.withColumn("__us", us)
             .groupBy(*keys, floor_div("__us", width).alias("__bucket"))
             .agg(F.min("__us").alias("__first"), F.max("__us").alias("__last"),
                  *[m.whole().alias(n) for n, m in measures.items()])
             .withColumn("__run", floor_div("__bucket", buckets)))
    run = [*keys, "__run"]
    local = numbered(dense, run).withColumn("__n", F.max("__sid").over(Window.partitionBy(*run)))
    pieces = merged(local, [*run, "__n", "__sid"])
    on_edge = (F.col("__sid") == 1) | (F.col("__sid") == F.col("__n"))
    inner = pieces.where(~on_edge).select(*keys, *state)
    edges = merged(numbered(pieces.where(on_edge).drop("__sid"), keys), [*keys, "__sid"]).select(*keys, *state)
    sessions = inner.unionByName(edges)
    kind = df.schema[ts].dataType
    # Merging adds decimal digits; how a key was computed must not show in the types.
    kinds = df.groupBy().agg(*[m.whole().alias(n) for n, m in measures.items()]).schema
    return sessions.select(
        *keys, F.timestamp_micros("__first").cast(kind).alias("window_start"),
        F.timestamp_micros(F.col("__last") + width).cast(kind).alias("window_end"),
        *[F.col(n).cast(kinds[n].dataType).alias(n) for n in measures])
