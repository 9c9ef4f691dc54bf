"""Ordered computations on streams with a carry: what a micro-batch hands on to the next one, as small tables.

Every function here makes a `foreachBatch` function. A batch goes through the computation of bounded input together with
the carry, so the result does not depend on where the input was cut, as long as batches come in order. The carry of a batch
lies in a folder of its own: a batch that is repeated starts from the same carry and replaces what it wrote. Carries older
than the one a repeated batch needs are removed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.times import epoch_micros, micros
from flowtables.operators.aggregates import Measures
from flowtables.operators.changelog import latest_per_key
from flowtables.operators.count_windows import numbered_windows
from flowtables.operators.joins import asof_lookup
from flowtables.operators.late import LATE, REFIRE, Lateness, classify
from flowtables.operators.running import expiring_sum
from flowtables.operators.windows import session_agg
from flowtables.plans import scan as s
from flowtables.plans.chunks import CHUNK, Split, ordered_chunks

OnBatch = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Carry:
    """Tables that a batch leaves for the next one, in `folder`, which belongs to one query alone."""

    spark: SparkSession
    folder: str

    def path(self, name: str, batch_id: int) -> str:
        return f"{self.folder}/{name}/batch={batch_id}"

    def before(self, name: str, batch_id: int, schema: T.StructType) -> DataFrame:
        """What the batch before left; nothing for the first."""
        if not batch_id:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name, batch_id - 1))

    def leave(self, name: str, batch_id: int, table: DataFrame) -> DataFrame:
        """Write the carry, remove the one before the last."""
        table.write.mode("overwrite").parquet(self.path(name, batch_id))
        if batch_id > 1:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name, batch_id - 2))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return self.spark.read.schema(table.schema).parquet(self.path(name, batch_id))


def _same(keys: Sequence[str]) -> Column:
    """Null-safe equality with the keys under other names, as `_renamed` gives them."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], F.lit(True))


def _renamed(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    return table.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})


def count_window_batches(order: Sequence[str], size: int, measures: Measures, write: OnBatch, state: str,
                         slide: int | None = None, split: Split = Split()) -> OnBatch:
    """Windows of `size` rows after every `slide` rows of a stream (`operators.count_windows.count_window`).

    A window is written by the batch that brings its last row. Carried are the number of rows so far and those rows that a
    later window still holds, fewer than `size`. Rows of a batch count in the given order, batches as they come.
    """
    slide = slide or size

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        carry = Carry(batch.sparkSession, state)
        batch = batch.persist()
        try:
            seen = T.StructType.fromDDL("n long")
            before = carry.before("rows_so_far", batch_id, seen).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
            numbered = s.scan(batch, [], order, {"__n": s.row_number()}, split).withColumn("__n", F.col("__n") + before)
            rows = numbered.unionByName(carry.before("open_rows", batch_id, numbered.schema))
            now = before + batch.count()
            done, fires = before // slide, now // slide
            write(numbered_windows(rows, size, slide, measures, done + 1, fires), batch_id)
            carry.leave("open_rows", batch_id, rows.where(F.col("__n") > (fires + 1) * slide - size).coalesce(1))  # < size rows
            carry.leave("rows_so_far", batch_id, batch.sparkSession.createDataFrame([(now,)], seen))
        finally:
            batch.unpersist()
    return on_batch


def firing_batches(ts: str, value: str, arrival: Sequence[str], rule: Lateness, write: OnBatch, state: str,
                   keys: Sequence[str] = (), out: str = "total", split: Split = Split()) -> OnBatch:
    """Every firing of every window of a stream (`operators.late.window_firings`), written when it happens.

    `firing` 0 is written by the batch whose highest event time reaches window end + bound, and then one firing per row that
    still comes. Carried are the highest event time and the open windows with their totals; a window leaves when it can't
    fire again. `open_windows` lists what has not fired yet when the input ends.
    """
    by = [*keys, "window_start", "window_end"]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        carry, clock = Carry(batch.sparkSession, state), T.StructType.fromDDL("seen long")
        batch = batch.persist()
        rows = None
        try:
            seen = carry.before("clock", batch_id, clock).agg(F.max("seen")).first()[0]
            highest = batch.agg(F.greatest(F.max(epoch_micros(ts)), F.lit(seen).cast("long")).alias("seen")).first()[0]
            again = F.when(F.col("status") == REFIRE, 1).otherwise(0)
            rows = classify(batch, ts, arrival, rule, seen, split).where(F.col("status") != LATE).select(
                *by, *arrival, F.col(value).alias("__v"), again.cast("long").alias("__again")).persist()
            punctual = F.col("__again") == 0
            ends = rows.groupBy(*by).agg(
                F.sum(F.when(punctual, F.col("__v"))).alias("first_total"), F.sum("__v").alias(out),
                F.sum("__again").alias("firing"), F.count(F.when(punctual, 1)).alias("n_first"))
            kept = T.StructType([*ends.schema.fields, T.StructField("fired", T.BooleanType())])
            before = _renamed(carry.before("windows", batch_id, kept), by).withColumnsRenamed(
                {c: f"__c_{c}" for c in kept.names if c not in by})

            def plus(c: str) -> Column:
                return F.coalesce(F.col(f"__c_{c}") + F.col(c), F.col(c), F.col(f"__c_{c}")).cast(kept[c].dataType).alias(c)

            fires = epoch_micros("window_end") + micros(rule.bound)
            merged = ends.join(before, _same(by), "full").select(
                *[F.coalesce(k, f"__k{i}").alias(k) for i, k in enumerate(by)],
                *[plus(c) for c in ("first_total", out, "firing", "n_first")], F.coalesce("__c_fired", F.lit(False)).alias("was_fired"))
            merged = merged.withColumn("fired", F.coalesce(fires <= F.lit(highest).cast("long"), F.lit(False))).persist()
            first = merged.where(F.col("fired") & ~F.col("was_fired") & (F.col("n_first") > 0)).select(
                *by, F.lit(0).cast("long").alias("firing"), F.col("first_total").alias(out))
            running = s.scan(rows, by, arrival, {"__total": s.total("__v"), "__no": s.total("__again")}, split).where("__again = 1")
            later = running.join(before, _same(by), "left").select(
                *by, (F.col("__no") + F.coalesce(F.col("__c_firing"), F.lit(0))).cast("long").alias("firing"),
                F.coalesce(F.col(f"__c_{out}") + F.col("__total"), F.col("__total"), F.col(f"__c_{out}")).cast(kept[out].dataType).alias(out))
            write(first.unionByName(later), batch_id)
            open_ = F.coalesce(fires + micros(rule.allowed) > F.lit(highest).cast("long"), F.lit(True))
            carry.leave("windows", batch_id, merged.where(open_).select(*kept.names))
            carry.leave("clock", batch_id, batch.sparkSession.createDataFrame([(highest,)], clock))
            merged.unpersist()
        finally:
            batch.unpersist()
            if rows is not None:
                rows.unpersist()
    return on_batch


def open_windows(spark: SparkSession, state: str, keys: Sequence[str] = (), out: str = "total") -> DataFrame:
    """Windows that `firing_batches` holds and that have not fired, as the firing 0 they would have now."""
    waiting = _newest(spark, state, "windows").where(~F.col("fired") & (F.col("n_first") > 0))
    return waiting.select(*keys, "window_start", "window_end", F.lit(0).cast("long").alias("firing"), F.col("first_total").alias(out))


def asof_batches(is_version: Column, on: Sequence[str], order: Sequence[str], fields: Mapping[str, str | Column], write: OnBatch,
                 state: str, defaults: Mapping[str, object] | None = None, split: Split = Split()) -> OnBatch:
    """As-of join of two streams that come as one (`operators.joins.asof_lookup`): rows are versions or facts.

    Inside a batch facts and versions are merged in the given order, so a fact sees no later version of its own batch.
    Carried is the newest version per key; it is earlier than everything in the next batch.
    """
    on, order = list(on), list(order)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        carry = Carry(batch.sparkSession, state)
        batch = batch.persist()
        try:
            body = F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in fields.items()]).alias("__body")
            mine = batch.where(is_version).select(*on, *order, body).withColumn("__epoch", F.lit(1))
            known = carry.before("versions", batch_id, mine.schema).withColumn("__epoch", F.lit(0))
            versions = mine.unionByName(known)
            facts = batch.where(~F.coalesce(is_version, F.lit(False))).withColumn("__epoch", F.lit(1))
            names = {n: F.col("__body")[n] for n in fields}
            write(asof_lookup(facts, versions, on, ["__epoch", *order], names, defaults, split).drop("__epoch"), batch_id)
            carry.leave("versions", batch_id, latest_per_key(versions, on, ["__epoch", *order]).select(*mine.columns))
        finally:
            batch.unpersist()
    return on_batch


def expiring_batches(keys: Sequence[str], ts: str, ttl: str, write: OnBatch, state: str, value: str | None = None,
                     tie: Sequence[str] = (), out: str = "running_count", bound: str = "0 seconds", split: Split = Split()) -> OnBatch:
    """Running sum (by default a count) of a stream that starts again after `ttl` of silence (`operators.running.expiring_sum`).

    Time is event time. Carried are the last time and the running value per key; a key that is silent for `ttl` and `bound`
    longer than the highest event time allows is dropped from the carry, so this holds live keys only. Rows of a key must come
    in time order from batch to batch; rows of other keys may be behind the highest event time by up to `bound`.
    """
    keys = list(keys)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        carry, clock = Carry(batch.sparkSession, state), T.StructType.fromDDL("seen long")
        batch = batch.persist()
        results = None
        try:
            seen = carry.before("clock", batch_id, clock).agg(F.max("seen")).first()[0]
            amount = F.lit(1).cast("long") if value is None else F.col(value)
            kind = batch.select(F.sum(amount).alias("v")).schema["v"].dataType
            rows = batch.withColumns({"__amount": amount.cast(kind), "__held": F.lit(False)})
            last = carry.before("live", batch_id, rows.select(*keys, ts, "__amount", "__held").schema)
            both = rows.unionByName(last, allowMissingColumns=True)
            # A carried key is a row with its running value, the first of its key.
            both = both.withColumn("__first", ~F.col("__held"))
            results = expiring_sum(both, keys, ts, ttl, "__amount", ["__first", *tie], "__sum", split)
            results = results.withColumn("__sum", F.col("__sum").cast(kind)).persist()
            write(results.where(~F.col("__held")).select(*batch.columns, F.col("__sum").alias(out)), batch_id)
            highest = batch.agg(F.greatest(F.max(epoch_micros(ts)), F.lit(seen).cast("long")).alias("seen")).first()[0]
            ends = latest_per_key(results, keys, [ts, "__first", *tie])
            silent = F.coalesce(epoch_micros(ts) + micros(ttl) + micros(bound) <= F.lit(highest).cast("long"), F.lit(False))
            carry.leave("live", batch_id, ends.where(~silent).select(*keys, ts, F.col("__sum").alias("__amount"), F.lit(True).alias("__held")))
            carry.leave("clock", batch_id, batch.sparkSession.createDataFrame([(highest,)], clock))
        finally:
            batch.unpersist()
            if results is not None:
                results.unpersist()
    return on_batch


def session_batches(ts: str, gap: str, measures: Measures, write: OnBatch, state: str, keys: Sequence[str] = (),
                    bound: str = "0 seconds", late: OnBatch | None = None, split: Split = Split()) -> OnBatch:
    """Sessions of a stream (`operators.windows.session_agg`), with keys or without, written when they are over.

    A batch's sessions, cut into pieces as those of bounded input, are joined with the open ones that the carry holds; a row that
    comes out of order can extend one at either end or make one of two. A session is over when the highest event time is more
    than `gap` and `bound` past its last row. Rows that lie as far behind when their batch begins are late: they go to `late`,
    if given, and into no session. Rows without a time are left out. `open_sessions` lists what is not over when the input ends.
    """
    keys, width, reach = list(keys), micros(gap), micros(gap) + micros(bound)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        carry, clock = Carry(batch.sparkSession, state), T.StructType.fromDDL("seen long")
        batch = batch.persist()
        merged = None
        try:
            seen = carry.before("clock", batch_id, clock).agg(F.max("seen")).first()[0]
            too_late = F.coalesce(epoch_micros(ts) + reach < F.lit(seen).cast("long"), F.lit(False))
            if late:
                late(batch.where(too_late), batch_id)
            found = session_agg(batch.where(~too_late), ts, gap, measures, keys, split=split)
            mine = found.select(*keys, epoch_micros("window_start").alias("__first"),
                                (epoch_micros("window_end") - width).alias("__last"), *measures)
            both = mine.unionByName(carry.before("sessions", batch_id, mine.schema))

            def together(rows: DataFrame, *by: str) -> DataFrame:
                whole = [m.again(n).cast(mine.schema[n].dataType).alias(n) for n, m in measures.items()]
                return rows.groupBy(*keys, *by).agg(*[F.min("__first").alias("__first")] * ("__first" not in by),
                                                    F.max("__last").alias("__last"), *whole)

            # One session per start, so the order is unique; then those that reach the next are joined.
            chunked = s.scan_chunked(ordered_chunks(together(both, "__first"), keys, ["__first"], split),
                                     {"__reached": s.highest("__last", before=True)})
            starts = F.when(F.col("__first") - F.col("__reached") <= width, 0).otherwise(1)
            marked = replace(chunked, df=chunked.df.withColumn("__starts", starts))
            numbered = s.scan_chunked(marked, {"__sid": s.total("__starts")}).df.drop(CHUNK)
            merged = together(numbered, "__sid").select(*mine.columns).persist()
            highest = batch.agg(F.greatest(F.max(epoch_micros(ts)), F.lit(seen).cast("long")).alias("seen")).first()[0]
            over = F.coalesce(F.col("__last") + reach < F.lit(highest).cast("long"), F.lit(False))
            write(_windows(merged.where(over), keys, width, measures), batch_id)
            carry.leave("sessions", batch_id, merged.where(~over))
            carry.leave("clock", batch_id, batch.sparkSession.createDataFrame([(highest,)], clock))
        finally:
            batch.unpersist()
            if merged is not None:
                merged.unpersist()
    return on_batch


def _windows(sessions: DataFrame, keys: Sequence[str], width: int, measures: Measures) -> DataFrame:
    return sessions.select(*keys, F.timestamp_micros("__first").alias("window_start"),
                           F.timestamp_micros(F.col("__last") + width).alias("window_end"), *measures)


def open_sessions(spark: SparkSession, state: str, gap: str, measures: Measures, keys: Sequence[str] = ()) -> DataFrame:
    """Sessions that `session_batches` holds and that may still go on, as they are now."""
    return _windows(_newest(spark, state, "sessions"), keys, micros(gap), measures)


def _newest(spark: SparkSession, state: str, name: str) -> DataFrame:
    """The carry of the last batch, which the clock's newest row names; a carry without rows has no batch number."""
    newest = spark.read.parquet(f"{state}/clock").agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{state}/{name}/batch={newest}")
