"""Running values on streams, exact in any order inside a micro-batch and for keys of any size.

Each micro-batch goes through the same ordered computation as bounded input (`plans.scan`), which cuts large keys. What is
carried to the next batch is one row per key, kept in a folder per batch: a batch that is repeated starts from the same carry
and replaces what it wrote. Batches count in the order they come.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.operators.aggregates import rank_of_max, rank_of_min
from flowtables.operators.running import running_reduce
from flowtables.plans import scan as s
from flowtables.plans.chunks import Split

OnBatch = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Value:
    """One running value of a stream: made from a batch's columns, and what the end of a batch carries on."""

    running: Callable[[DataFrame], s.Running]
    carry: Callable[[DataFrame], Column]
    merge: Callable[[Column, Column], Column]  # carry, value inside the batch


def _plus(carry: Column, local: Column) -> Column:
    return F.coalesce(carry + local, local, carry)


def total(value: str) -> Value:
    """Sum so far; NULLs add nothing."""
    return Value(lambda df: s.total(value), lambda df: F.sum(value), _plus)


def count() -> Value:
    return Value(lambda df: s.row_number(), lambda df: F.count(F.lit(1)), _plus)


def highest(value: str) -> Value:
    return Value(lambda df: s.highest(value), lambda df: F.max(value), lambda c, v: F.greatest(c, v))


def lowest(value: str) -> Value:
    return Value(lambda df: s.lowest(value), lambda df: F.min(value), lambda c, v: F.least(c, v))


def record_with_highest(value: str, order: Sequence[str]) -> Value:
    """The whole record with the largest value so far, as a struct; among equals the earliest."""
    def best(df: DataFrame) -> Column:
        return F.struct(rank_of_max(df, value, order).alias("rank"), F.struct(*df.columns).alias("record"))
    return Value(lambda df: s.highest(best(df)), lambda df: F.max(best(df)), lambda c, v: F.greatest(c, v))


def record_with_lowest(value: str, order: Sequence[str]) -> Value:
    def best(df: DataFrame) -> Column:
        return F.struct(rank_of_min(value, order).alias("rank"), F.struct(*df.columns).alias("record"))
    return Value(lambda df: s.lowest(best(df)), lambda df: F.min(best(df)), lambda c, v: F.least(c, v))


def reduce_batches(keys: Sequence[str], order: Sequence[str], value: str, combine: Callable[[Column, Column], Column],
                   write: OnBatch, state: str, out: str = "running_reduce") -> OnBatch:
    """For `foreachBatch`: the running fold with an associative function of two columns (`operators.running.running_reduce`)."""
    keys = list(keys)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        inside = None
        try:
            inside = running_reduce(batch, keys, order, value, combine, out)
            kind = inside.schema[out].dataType
            if batch_id:
                before = spark.read.parquet(f"{state}/batch={batch_id - 1}").select(
                    *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct("__v").alias("__c"))
                same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)],
                              F.lit(True))
                merged = F.when(F.col("__c").isNull(), F.col(out)).otherwise(combine(F.col("__c.__v"), F.col(out))).cast(kind)
                # A left join: adaptive execution can split the rows of a large key, which in a full join it can't.
                inside = inside.join(before, same, "left").select(*batch.columns, merged.alias(out))
            inside = inside.persist()  # for the result and the carry
            write(inside, batch_id)
            ends = inside.groupBy(*keys).agg(F.max_by(F.struct(F.col(out).alias("__v")), F.struct(*order)).alias("__e"))
            if batch_id:
                # Keys without a row in this batch carry on what they had.
                ends = ends.join(before, same, "full").select(
                    *[F.coalesce(k, f"__k{i}").alias(k) for i, k in enumerate(keys)], F.coalesce("__e", "__c").alias("__e"))
            ends.select(*keys, "__e.__v").write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        finally:
            batch.unpersist()
            if inside is not None:
                inside.unpersist()
    return on_batch


def running_batches(keys: Sequence[str], order: Sequence[str], values: Mapping[str, Value], write: OnBatch, state: str,
                    split: Split = Split()) -> OnBatch:
    """For `foreachBatch`: hands each batch with its running values to `write`, one row per input row.

    `order` must be unique inside a key and batch. `state` is a folder of this query alone. A NULL key is a key.
    """
    keys = list(keys)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            inside = s.scan(batch, keys, order, {n: v.running(batch) for n, v in values.items()}, split)
            ends = batch.groupBy(*keys).agg(*[v.carry(batch).alias(n) for n, v in values.items()])
            if batch_id:
                # Join keys under other names, and null-safe: a NULL key goes on like any other.
                before = spark.read.schema(ends.schema).parquet(f"{state}/batch={batch_id - 1}").select(
                    *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(n).alias(f"__c_{n}") for n in values])
                same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)],
                              F.lit(True))
                kinds = {n: before.schema[f"__c_{n}"].dataType for n in values}
                merged = [v.merge(F.col(f"__c_{n}"), F.col(n).cast(kinds[n])).cast(kinds[n]).alias(n)
                          for n, v in values.items()]
                inside = inside.join(before, same, "left").select(*batch.columns, *merged)
                ends = ends.join(before, same, "full").select(
                    *[F.coalesce(k, f"__k{i}").alias(k) for i, k in enumerate(keys)], *merged)
            write(inside, batch_id)
            ends.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        finally:
            batch.unpersist()
    return on_batch
