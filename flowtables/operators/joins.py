"""Window, interval and lookup joins. `on` columns have the same name on both sides, all others differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.times import epoch_micros, floor_div, micros, shift, tumbling, unmarked
from flowtables.operators.changelog import latest_per_key
from flowtables.plans.broadcasting import Limit, broadcast_if_small
from flowtables.plans.chunks import Split
from flowtables.plans.scan import latest, scan


HIT = "__hit"


def _marked(right: DataFrame) -> DataFrame:
    return right.withColumn(HIT, F.lit(True))


def _with_defaults(df: DataFrame, defaults: Mapping[str, object] | None) -> DataFrame:
    """Defaults for rows without a partner; a NULL of a partner that is there stays NULL."""
    if not defaults:
        return df
    return df.withColumns({c: F.when(F.col(HIT).isNull(), F.lit(v)).otherwise(F.col(c)) for c, v in defaults.items()})


def window_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, size: str,
                how: str = "inner", defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Pairs with equal key in the same calendar-aligned window of length `size`.

    `how="left"` is the left co-group: every left row, with `defaults` in the columns of a missing right row.
    The window is part of the join key, so a hot key is spread over its windows; adaptive execution splits what
    is still too large. On streams both sides need a watermark.
    """
    a = left.withColumn("__w", tumbling(left_ts, size))
    b = (_marked(right) if defaults else right).withColumn("__w", tumbling(right_ts, size))
    # A stream may have one event time only, and in this join it is the window.
    if left.isStreaming:
        a = a.withColumn(left_ts, unmarked(left_ts))
    if right.isStreaming:
        b = b.withColumn(right_ts, unmarked(right_ts))
    joined = a.join(b, [*on, "__w"], how)
    rest = [c for c in [*left.columns, *right.columns] if c not in on]
    return _with_defaults(joined, defaults).select(
        *on, *rest, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"))


def window_cogroup(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, size: str,
                   defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left outer window join with defaults."""
    return window_join(left, right, on, left_ts, right_ts, size, "left", defaults)


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str,
                  lower: str, upper: str) -> DataFrame:
    """Pairs with equal key and `left_ts + lower <= right_ts <= left_ts + upper`, both ends included.

    Bounded input joins on (key, time bucket) with buckets as wide as the interval: a left row reaches two
    buckets, a right row lies in one. A hot key is thereby cut along time and only close pairs are compared.
    A stream joins on the key; its range condition is what lets Spark drop old state.
    """
    reach = micros(upper) - micros(lower)
    if reach < 0:
        raise ValueError("lower must not exceed upper")
    if left.isStreaming or right.isStreaming:
        in_range = (F.col(right_ts) >= shift(left_ts, lower)) & (F.col(right_ts) <= shift(left_ts, upper))
        other = right
        for c in on:
            other = other.withColumnRenamed(c, f"__r_{c}")
            in_range = (F.col(c) == F.col(f"__r_{c}")) & in_range
        return left.join(other, in_range).drop(*[f"__r_{c}" for c in on])
    width = max(reach, 1)
    low, high = micros(lower), micros(upper)
    a = left.withColumn("__a", epoch_micros(left_ts)).withColumn(
        "__bucket", F.explode(F.sequence(floor_div(F.col("__a") + low, width), floor_div(F.col("__a") + high, width))))
    b = right.withColumn("__b", epoch_micros(right_ts)).withColumn("__bucket", floor_div("__b", width))
    both = a.join(b, [*on, "__bucket"])
    close = (F.col("__b") - F.col("__a")).between(low, high)
    return both.where(close).drop("__a", "__b", "__bucket")


def lookup_join(facts: DataFrame, dimension: DataFrame, on: Sequence[str],
                defaults: Mapping[str, object] | None = None, limit: Limit | None = Limit()) -> DataFrame:
    """Every fact row with its dimension row, `defaults` where there is none. Dimension keys must be unique.

    The dimension is broadcast only if it was measured to fit `limit`; `limit=None` leaves the choice to Spark.
    """
    side = _marked(dimension) if defaults else dimension
    side = side if limit is None else broadcast_if_small(side, limit)
    joined = facts.join(side, list(on), "left")
    rest = [c for c in [*facts.columns, *dimension.columns] if c not in on]
    return _with_defaults(joined, defaults).select(*on, *rest)


def newest_lookup_join(facts: DataFrame, versions: DataFrame, on: Sequence[str], order: Sequence[str],
                       defaults: Mapping[str, object] | None = None, limit: Limit | None = Limit()) -> DataFrame:
    """Lookup in a table that holds several versions per key: the newest one counts."""
    newest = latest_per_key(versions, on, order).drop(*[c for c in order if c not in on])
    return lookup_join(facts, newest, on, defaults, limit)


def asof_lookup(facts: DataFrame, versions: DataFrame, on: Sequence[str], order: Sequence[str],
                fields: Mapping[str, str | Column], defaults: Mapping[str, object] | None = None,
                split: Split = Split()) -> DataFrame:
    """Every fact row with the newest version of its key that came before it; facts never see later versions.

    Both inputs carry the key and the order columns. `fields` names the output columns and what they hold in
    `versions`. A version and a fact at the same place in the order: the version counts as earlier.
    """
    on, order = list(on), list(order)
    body = F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in fields.items()])
    fact = facts.select(*on, *order, F.lit(1).alias("__side"), F.struct(*facts.columns).alias("__fact"))
    version = versions.select(*on, *order, F.lit(0).alias("__side"), body.alias("__version"))
    both = fact.unionByName(version, allowMissingColumns=True)
    by = [*order, "__side"]
    seen = scan(both, on, by, {"__seen": latest("__version", by)}, split).where(F.col("__side") == 1)
    out = seen.select("__fact.*", F.col("__seen").isNotNull().alias(HIT), *[F.col("__seen")[n].alias(n) for n in fields])
    return _with_defaults(out.withColumn(HIT, F.when(F.col(HIT), True)), defaults).drop(HIT)
