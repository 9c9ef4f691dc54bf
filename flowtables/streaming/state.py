"""Keyed state on streams: running values with a time to live.

State is held per key in the RocksDB store, which these functions choose for the session. Running values without a time to
live need no such store and no task per key: see `streaming.running`. With one, all rows of a key in a micro-batch are one
task's work, in frames if no order is asked for.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowtables.functions.times import micros
from flowtables.session import use_state_store

# Workers get the processors themselves, not their import path: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _RunningValue(StatefulProcessor):
    """One value per key; an output row per input row."""

    def __init__(self, kind: str, keys: list[str], order: list[str], value: str | None, out: str, names: list[str],
                 state_type: str, ttl_ms: int):
        self.kind, self.keys, self.order, self.value = kind, keys, order, value
        self.out, self.names, self.state_type, self.ttl_ms = out, names, state_type, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("value", f"v {self.state_type}", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        current = None if held is None else held[0]
        # Arrow hands a large key over in several frames; an order holds for all its rows of the micro-batch.
        frames = [pd.concat(rows).sort_values(self.order, kind="stable")] if self.order else rows
        for frame in frames:
            values = pd.Series(1, index=frame.index) if self.value is None else frame[self.value]
            start = pd.Series([current if current is not None else np.nan], dtype="float64" if values.dtype == float else "Int64")
            both = pd.concat([start, values.astype(start.dtype)], ignore_index=True)
            # A NULL adds nothing, and before the first value there is no result.
            result = (both.fillna(0).cumsum().where(both.notna().cummax()) if self.kind == "sum" else both.cummax().ffill())[1:]
            if len(result) and not pd.isna(result.iloc[-1]):
                current = result.iloc[-1].item()
            yield frame.assign(**{self.out: result.to_numpy(dtype=object, na_value=None)})[self.names]
        if current is not None:
            self.state.update((current,))

    def close(self) -> None:
        pass


def _running(stream: DataFrame, kind: str, keys: Sequence[str], value: str | None, out: str, order: Sequence[str],
             ttl: str) -> DataFrame:
    kind_of_value = T.LongType() if value is None else stream.schema[value].dataType
    if isinstance(kind_of_value, (T.LongType, T.IntegerType, T.ShortType)):
        state_type: T.DataType = T.LongType()
    elif isinstance(kind_of_value, T.DoubleType):
        state_type = kind_of_value
    else:
        raise TypeError("running values on streams are whole numbers or doubles")
    use_state_store(stream.sparkSession)
    schema = T.StructType([*stream.schema.fields, T.StructField(out, state_type)])
    processor = _RunningValue(kind, list(keys), list(order), value, out, schema.names, state_type.simpleString(),
                              micros(ttl) // 1_000)
    return stream.groupBy(*keys).transformWithStateInPandas(
        processor, schema, "append", "ProcessingTime")


def stream_running_sum(stream: DataFrame, keys: Sequence[str], value: str, ttl: str, out: str = "running_sum",
                       order: Sequence[str] = ()) -> DataFrame:
    """Sum so far per key, one row per input row; NULLs add nothing.

    A key that got no row for `ttl` starts from nothing again (processing time, renewed by every write). `order` sorts the
    rows of a key inside a micro-batch, for which they have to fit into one task's memory.
    """
    return _running(stream, "sum", keys, value, out, order, ttl)


def stream_running_count(stream: DataFrame, keys: Sequence[str], ttl: str, out: str = "running_count",
                         order: Sequence[str] = ()) -> DataFrame:
    return _running(stream, "sum", keys, None, out, order, ttl)


def stream_running_max(stream: DataFrame, keys: Sequence[str], value: str, ttl: str, out: str = "running_max",
                       order: Sequence[str] = ()) -> DataFrame:
    return _running(stream, "max", keys, value, out, order, ttl)
