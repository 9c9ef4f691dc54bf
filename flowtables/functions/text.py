"""Column functions for text records: trimming, tokens, field lists, output lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str
_CONTROL = "".join(map(chr, range(0x21)))


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_control(c: ColumnLike) -> Column:
    """Strip every character up to U+0020 from both ends (plain SQL `trim` strips blanks only)."""
    return F.btrim(_col(c), F.lit(_CONTROL))


def is_blank(c: ColumnLike) -> Column:
    return F.length(trim_control(c)) == 0


def tokens(c: ColumnLike, pattern: str = r"\s+", trim: bool = True) -> Column:
    """Split text into words.

    Empty fields at the end never count. With `trim=False` a leading separator gives a leading empty word.
    """
    text = trim_control(c) if trim else F.regexp_replace(_col(c), f"(?:{pattern})$", "")
    return F.split(text, pattern)


def _without_empty_end(c: Column, sep: str) -> Column:
    return F.rtrim(c, F.lit(sep)) if len(sep) == 1 else F.regexp_replace(c, f"(?:{re.escape(sep)})+$", "")


def all_fields(c: ColumnLike, sep: str = ",") -> Column:
    """Fields of a delimited record, empty ones at the end included."""
    return F.split(_col(c), re.escape(sep))


def fields(c: ColumnLike, sep: str = ",") -> Column:
    """Fields of a delimited record; empty fields at the end are not fields."""
    stripped = _without_empty_end(_col(c), sep)
    only_separators = (F.length(stripped) == 0) & (F.length(_col(c)) > 0)
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(all_fields(stripped, sep))


def field_count(c: ColumnLike, sep: str = ",") -> Column:
    """Number of fields of the trimmed record."""
    return F.size(fields(trim_control(c), sep))


def has_fields(c: ColumnLike, n: int, sep: str = ",") -> Column:
    """Does the trimmed record have exactly `n` fields?"""
    stripped = _without_empty_end(trim_control(c), sep)
    right = F.size(all_fields(stripped, sep)) == n
    return right & (field_count(c, sep) == n) if n < 2 else right


def window_line(key: ColumnLike, value: ColumnLike, start: ColumnLike, end: ColumnLike) -> Column:
    """One printable line per window result."""
    pattern = "yyyy-MM-dd HH:mm:ss"
    return F.concat(
        F.lit("window: ["), F.date_format(_col(start), pattern), F.lit(" ~ "), F.date_format(_col(end), pattern),
        F.lit("], "), _col(key).cast("string"), F.lit(" = "), _col(value).cast("string"),
    )


def tuple_line(columns: Sequence[ColumnLike]) -> Column:
    """`(a,b)` line of a record."""
    return F.concat(F.lit("("), F.concat_ws(",", *[_col(c).cast("string") for c in columns]), F.lit(")"))


def tagged_text(tag: str, value: ColumnLike) -> Column:
    """`tag: value` text, doubles as Spark prints them (`main: 1.0`)."""
    return F.concat(F.lit(f"{tag}: "), _col(value).cast("string"))


def row_key(*columns: ColumnLike, sep: str = "_") -> Column:
    """Joined row key; NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(columns):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)
