"""Cutting ordered groups into chunks of bounded size.

An ordered computation over a group (running total, previous row, latest value so far) is a window frame, and a
window frame puts its whole group into one task. That is fine for many small groups; it is not for one group that
holds a third of the table, or for a computation without any key. `ordered_chunks` finds such groups and gives
their rows a chunk number that grows along the order, so that (group, chunk) can be the window partition and only
one summary row per chunk has to travel.

The cut points come from a row sample and are fixed on the driver as literals: they decide about balance only.
Whatever they are, the chunk of a row is a pure function of the row, so every branch of a plan and every retry of
a lost task agrees on it, and no row is left out.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "__chunk"
TREE = 64  # bounds that still make a decision tree of a size the compiler takes
MOST = 500_000  # sampled rows that should come to the driver


@dataclass(frozen=True)
class Split:
    """When and how far to cut groups."""

    rows: int = 2_000_000    # rows of one group a task should get at most
    max_chunks: int = 65_536  # upper end for the number of chunks; above `rows * max_chunks` rows chunks grow with the table
    samples: int = 24        # sampled rows per chunk


@dataclass(frozen=True)
class Chunked:
    """A frame with its chunk column. `keys_cut` holds the groups that have more than one chunk."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    rows: int
    chunks: int
    keys_cut: tuple[tuple, ...]

    @property
    def is_cut(self) -> bool:
        return self.chunks > 1

    def in_cut_group(self) -> Column:
        """Does the row belong to a group that was cut? Never NULL."""
        if not self.keys:
            return F.lit(self.is_cut)
        if len(self.keys) == 1:
            key = F.col(self.keys[0])
            values = [k[0] for k in self.keys_cut if k[0] is not None]
            found = F.coalesce(key.isin(values), F.lit(False)) if values else F.lit(False)
            return (found | key.isNull()) if len(values) < len(self.keys_cut) else found
        types = {f.name: f.dataType for f in self.df.schema.fields}
        wanted = [F.struct(*[F.lit(v).cast(types[k]).alias(k) for k, v in zip(self.keys, key, strict=True)])
                  for key in self.keys_cut]
        return F.struct(*[F.col(k) for k in self.keys]).isin(wanted) if wanted else F.lit(False)

    def cut_rows(self) -> DataFrame:
        return self.df.where(self.in_cut_group())

    def uncut_rows(self) -> DataFrame:
        return self.df.where(~self.in_cut_group())


def _reached(bound: Sequence, row: Sequence[Column], types: Sequence[T.DataType]) -> Column:
    """Is the bound <= the row, column by column, NULL before everything else?"""
    out = F.lit(True)
    for b, v, t in reversed(list(zip(bound, row, types, strict=True))):
        if b is None:
            out = v.isNotNull() | out
        else:
            b = F.lit(b).cast(t)
            out = F.coalesce((b < v) | ((b == v) & out), F.lit(False))
    return out


def _by_tree(row: Sequence[Column], types: Sequence[T.DataType], bounds: Sequence[tuple]) -> Column:
    def node(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(_reached(bounds[middle], row, types), node(middle + 1, high)).otherwise(node(low, middle))
    return node(0, len(bounds))


def _text(field: T.StructField) -> Column:
    """A value as text that gives back the same value; instants with their offset, as an hour may come twice in a zone."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSSXXXXX")
    return value.cast("string")


def _literal(schema: T.StructType, bounds: list, texts: list, depth: int) -> Column:
    """Bounds, nested `depth` arrays deep, as one array of structs that is folded to a single literal.

    Values go as text, as a literal per value takes seconds to build for thousands of bounds. Binary columns have no text
    that gives them back, so they go as literals.
    """
    if any(isinstance(f.dataType, T.BinaryType) for f in schema.fields):
        def built(value, level):
            if level:
                return F.array(*[built(v, level - 1) for v in value])
            return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(value, schema.fields, strict=True)])
        return built(bounds, depth)

    def named(value, level):
        return [named(v, level - 1) for v in value] if level else {f"c{i}": v for i, v in enumerate(value)}
    read = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))])
    wanted = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    for _ in range(depth):
        read, wanted = T.ArrayType(read), T.ArrayType(wanted)
    return F.from_json(F.lit(json.dumps(named(texts, depth))), read).cast(wanted)


def _counted(df: DataFrame, array: Column, size: int, out: str) -> DataFrame:
    """How many of the array's sorted values are <= `__row`: one projection per halving, which compile with the scan."""
    df = df.withColumn(out, F.lit(0))
    step = 1 << (size.bit_length() - 1)
    while step:
        at = F.col(out) + step
        reached = F.coalesce(F.try_element_at(array, at) <= F.col("__row"), F.lit(False))
        df = df.withColumn(out, F.when(reached, at).otherwise(F.col(out)))
        step //= 2
    return df


def _searched(df: DataFrame, schema: T.StructType, bounds: list, texts: list) -> DataFrame:
    """Search the first bound of every run of bounds, then the run, so that all bounds are in the plan just once."""
    width = 1 << (len(bounds).bit_length() // 2)
    heads = _literal(schema, bounds[::width], texts[::width], 1)
    runs = _literal(schema, *[[v[i:i + width] for i in range(0, len(v), width)] for v in (bounds, texts)], 2)
    out = _counted(df.withColumn("__row", F.struct(*schema.names)), heads, -(-len(bounds) // width), "__run")
    out = out.withColumn("__bounds", F.when(F.col("__run") > 0, F.try_element_at(runs, F.col("__run"))))
    out = _counted(out, F.col("__bounds"), width, "__in_run")
    chunk = F.greatest(F.col("__run") - 1, F.lit(0)) * width + F.col("__in_run")
    # Planning joins on the chunk puts projections into each other, and every halving uses the one before several times, so
    # that thousands of bounds would fill the driver. An explode of one value is as far as planning looks.
    return out.withColumn(CHUNK, F.explode(F.array(chunk))).drop("__row", "__run", "__bounds", "__in_run")


def _with_chunk(df: DataFrame, schema: T.StructType, bounds: Sequence[tuple], texts: Sequence[tuple]) -> DataFrame:
    """Number of bounds that are <= the row.

    Few bounds become one decision tree, which is compiled with the scan. A tree of many bounds would be too
    large to compile; they are searched in an array.
    """
    row = [F.col(c) for c in schema.names]
    if len(bounds) <= TREE:
        return df.withColumn(CHUNK, _by_tree(row, [f.dataType for f in schema.fields], bounds))
    return _searched(df, schema, bounds, texts)


def ordered_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Split = Split()) -> Chunked:
    """Number the chunks of every large group along `order`; small groups keep the single chunk 0.

    Runs a count, and a sample when the table is large enough to be cut: `samples` rows per chunk, fewer (but at least
    eight) above MOST rows in all.
    """
    keys, order = tuple(keys), tuple(order)
    columns = list(dict.fromkeys(keys + order))
    narrow = df.select(*columns)
    rows = narrow.count()
    wanted = -(-rows // split.rows)
    if not keys:
        # Without a key nothing else spreads the rows, so use the cores there are.
        wanted = max(wanted, min(df.sparkSession.sparkContext.defaultParallelism, rows // 1_000))
    wanted = min(wanted, split.max_chunks)
    whole = Chunked(df.withColumn(CHUNK, F.lit(0)), keys, order, rows, 1, ())
    if wanted < 2:
        return whole

    fraction = min(1.0, max(8, min(split.samples, MOST // wanted)) * wanted / rows)
    sample = narrow.sample(fraction, seed=42).orderBy(*columns)
    sample = sample.select("*", *[_text(f).alias(f"__t{i}") for i, f in enumerate(narrow.schema.fields)]).collect()
    every = max(1, len(sample) // wanted)
    picked = [tuple(row) for row in sample[every::every]]
    bounds = [row[:len(columns)] for row in picked]
    width = len(keys)
    if width:
        # A group is large when several bounds fall into it; bounds elsewhere would cut small groups for nothing.
        hits: dict[tuple, int] = {}
        for bound in bounds:
            hits[bound[:width]] = hits.get(bound[:width], 0) + 1
        bounds = [b for b in bounds if hits[b[:width]] > 1]
    bounds = list(dict.fromkeys(bounds))
    if not bounds:
        return whole

    texts = {row[:len(columns)]: row[len(columns):] for row in picked}
    chunked = _with_chunk(df, narrow.schema, bounds, [texts[b] for b in bounds])
    return Chunked(chunked, keys, order, rows, len(bounds) + 1, tuple(dict.fromkeys(b[:width] for b in bounds)))
