"""Running a stream to files and reading its result back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowtables.functions.times import unmarked
from flowtables.operators.changelog import latest_per_key
from flowtables.session import new_folder

OnBatch = Callable[[DataFrame, int], None]


def _finish(writer, timeout: int) -> None:
    query = writer.trigger(availableNow=True).start()
    try:
        if not query.awaitTermination(timeout):
            raise TimeoutError(f"stream did not end within {timeout} s")
    finally:
        query.stop()


def drain(stream: DataFrame, on_batch: OnBatch, checkpoint: str, mode: str = "append", timeout: int = 600) -> None:
    """Process all input that is there, batch by batch, then stop."""
    _finish(stream.writeStream.foreachBatch(on_batch).outputMode(mode).option("checkpointLocation", checkpoint),
            timeout)


def without_marks(df: DataFrame) -> DataFrame:
    """Time columns as plain data. A join of two streams has two event times, and a file sink takes one at most."""
    return df.select(*[unmarked(f.name).alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema.fields])


def drain_to_files(stream: DataFrame, path: str, checkpoint: str, timeout: int = 600) -> DataFrame:
    """Append all results to Parquet files, then read them."""
    _finish(without_marks(stream).writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint), timeout)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def keep_updates(path: str) -> OnBatch:
    """Write each micro-batch to its own folder; a batch that is repeated replaces itself."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return on_batch


def drain_updates(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str],
                  timeout: int = 600) -> DataFrame:
    """Results of an aggregation in update mode: the newest row per key."""
    drain(stream, keep_updates(path), checkpoint, "update", timeout)
    updates = stream.sparkSession.read.parquet(path)
    return latest_per_key(updates, keys, ["batch"]).drop("batch")


def early_firings(stream: DataFrame, on_batch: OnBatch, checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Hand on the changed results of an aggregation every so often, long before its windows are complete.

    A batch holds each changed group once with its value so far, so it can be written by key.
    """
    return (stream.writeStream.foreachBatch(on_batch).outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).start())


def result_table(stream: DataFrame, name: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Run a stream over the input that is there, with state and result below the shared folder."""
    base = new_folder(stream.sparkSession, name)
    if keys is None:
        return drain_to_files(stream, f"{base}/out", f"{base}/checkpoint")
    return drain_updates(stream, f"{base}/out", f"{base}/checkpoint", keys)

