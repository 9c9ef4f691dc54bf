"""Text files in hourly folders, closed when they have reached a size or when their hour has been silent for a while.

Lines wait in an open table, which a micro-batch hands on to the next one as a carry, until they fill a file. So an hour gets few
files of about the wanted size, however many batches bring its lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.text import tuple_line
from flowtables.functions.times import epoch_micros, hour_bucket, micros
from flowtables.plans import scan as s
from flowtables.plans.chunks import Split
from flowtables.streaming.carried import Carry, OnBatch, _newest

LINES = T.StructType([T.StructField("bucket", T.StringType()), T.StructField("at", T.LongType()),
                      T.StructField("value", T.StringType())])
CLOCK = T.StructType([T.StructField("seen", T.LongType())])


def _write(lines: DataFrame, path: str) -> None:
    """One file per (bucket, roll); a batch that is repeated replaces its own files and no others."""
    (lines.repartition("bucket", "roll").select("value", "bucket", "roll").write.partitionBy("bucket", "roll")
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").text(path))


def sized_file_batches(path: str, ts: str, text: Sequence[str], state: str, max_bytes: int = 128 << 20,
                       idle: str = "1 hour", split: Split = Split()) -> OnBatch:
    """Write the lines of a stream to `path/bucket=<hour>/roll=<batch>-<number>/`, for `foreachBatch`.

    A file has between half of `max_bytes` and `max_bytes`, unless a line is longer than a quarter of it; the last one of an hour may be
    smaller. That one is closed as soon as the stream's highest time is `idle` or more past the hour's last line; lines that come
    after that open the hour again. Rows without a time go to the bucket `none` and are closed by size, or by `close_open`.
    Lines of an hour are laid out by time. Carried are fewer than `max_bytes` per open hour.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        carry = Carry(batch.sparkSession, state)
        lines = batch.select(F.coalesce(hour_bucket(ts), F.lit("none")).alias("bucket"), epoch_micros(ts).cast("long").alias("at"),
                             tuple_line(text).alias("value"))
        rows = carry.before("open", batch_id, LINES).unionByName(lines).withColumn(
            "__size", F.octet_length("value").cast("long") + 1).persist()
        placed = None
        try:
            before = carry.before("clock", batch_id, CLOCK).agg(F.max("seen")).first()[0]
            seen = rows.agg(F.greatest(F.max("at"), F.lit(before).cast("long"))).first()[0]
            # What a file takes before the line that reaches its end, so that this line still fits.
            target = F.greatest(F.lit(max_bytes) - F.max("__size"), F.lit(-(-max_bytes // 2)))
            hours = rows.groupBy("bucket").agg(
                target.alias("__target"), F.sum("__size").alias("__bytes"),
                F.coalesce(F.lit(seen).cast("long") - F.max("at") >= micros(idle), F.lit(False)).alias("__idle"))
            ends = s.scan(rows, ["bucket"], ["at", "value"], {"__upto": s.total("__size")}, split)
            number = F.floor((F.col("__upto") - 1) / F.col("__target"))
            full = (number + 1) * F.col("__target") <= F.col("__bytes")
            # Rows are many for each hour, and hours a small table of their own: adaptive execution picks the join.
            placed = ends.join(hours, "bucket").withColumns(
                {"__closed": full | F.col("__idle"), "roll": F.concat_ws("-", F.lit(batch_id), number)}).persist()
            closed = placed.where("__closed")
            if not closed.isEmpty():
                _write(closed, path)
            carry.leave("open", batch_id, placed.where("NOT __closed").select(*LINES.names))
            carry.leave("clock", batch_id, batch.sparkSession.createDataFrame([(seen,)], CLOCK))
        finally:
            rows.unpersist()
            if placed is not None:
                placed.unpersist()
    return on_batch


def open_lines(spark: SparkSession, state: str) -> DataFrame:
    """Lines that wait for their file to be closed."""
    return _newest(spark, state, "open")


def close_open(spark: SparkSession, path: str, state: str) -> None:
    """Write what still waits, when the stream has ended for good. Doing it twice gives the same files."""
    _write(open_lines(spark, state).withColumn("roll", F.lit("end")), path)
