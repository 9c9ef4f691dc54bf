"""Column functions for event time: parsing, rendering, window bounds, time keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowtables.functions.text import ColumnLike, _col

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
BUCKET_FORMAT = "yyyy-MM-dd--HH"

_MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """Microseconds of a fixed-length duration such as `5 seconds` or `-8 hours`."""
    total, rest = 0, duration.strip()
    for amount, unit in re.findall(r"(-?\d+)\s*([a-zA-Z]+)", rest):
        unit = unit.lower().rstrip("s")
        if unit not in _MICROS:
            raise ValueError(f"not a fixed-length duration: {duration!r}")
        total += int(amount) * _MICROS[unit]
    if not re.search(r"\d", rest):
        raise ValueError(f"not a duration: {duration!r}")
    return total


def floor_div(number: ColumnLike, by: int) -> Column:
    """Whole-number division that rounds down, for negative numbers too."""
    n = _col(number)
    return F.call_function("div", n - F.pmod(n, F.lit(by)), F.lit(by))


def shift(ts: ColumnLike, duration: str) -> Column:
    """Timestamp moved by a duration, which may be negative."""
    us = micros(duration)
    return _col(ts) + F.expr(f"INTERVAL '{us // 1_000_000}.{us % 1_000_000:06d}' SECOND")


def epoch_micros(ts: ColumnLike) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp"))


def unmarked(ts: ColumnLike) -> Column:
    """The same instant as plain data, without the event-time mark that a watermark puts on a stream's column."""
    return F.timestamp_micros(F.unix_micros(_col(ts)))


def ingest_time() -> Column:
    """Time at which a row (on a stream: its micro-batch) is read; windows on it are processing-time windows."""
    return F.current_timestamp()


def from_text(c: ColumnLike, pattern: str = TEXT_FORMAT) -> Column:
    """Event time of a text; a text that does not fit gives NULL."""
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def to_text(ts: ColumnLike, pattern: str = TEXT_FORMAT) -> Column:
    return F.date_format(_col(ts), pattern)


def from_epoch_millis(c: ColumnLike) -> Column:
    return F.timestamp_millis(_col(c))


def from_epoch_seconds(c: ColumnLike) -> Column:
    return F.timestamp_seconds(_col(c))


def time_keys(ts: ColumnLike, zone: str | None = None) -> Column:
    """Hour, day and month key of a time, as an array to explode."""
    at = F.from_utc_timestamp(_col(ts), zone) if zone else _col(ts)
    return F.array(*[F.date_format(at, p) for p in ("yyyy-MM-dd-HH", "yyyy-MM-dd", "yyyy-MM")])


def hour_bucket(ts: ColumnLike) -> Column:
    """Name of the hourly output folder of a time."""
    return F.date_format(_col(ts), BUCKET_FORMAT)


def tumbling(ts: ColumnLike, size: str, offset: str | None = None) -> Column:
    """Fixed windows; `offset` moves their start, e.g. `-8 hours` for midnight in a UTC+8 zone."""
    if offset is None:
        return F.window(_col(ts), size)
    start = micros(offset) % micros(size)
    return F.window(_col(ts), size, size, f"{start} microseconds")


def sliding(ts: ColumnLike, size: str, slide: str) -> Column:
    return F.window(_col(ts), size, slide)
