"""Outputs to queues, databases and other services. Delivery is at least once: give records a key and write by key."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def json_messages(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Rows as queue messages: the JSON of all columns as `value`, and the joined key columns as `key` if given."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    if not key:
        return df.select(value)
    return df.select(F.concat_ws("_", *[F.col(c).cast("string") for c in key]).alias("key"), value)


def topic_sink(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Messages of a stream to a topic. Readers drop repeats by id with `dropDuplicatesWithinWatermark`."""
    return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def jdbc_append(url: str, table: str, driver: str | None = None, batch: int = 1_000, tasks: int | None = None,
                **properties: str) -> Callable[[DataFrame, int], None]:
    """Insert the rows of every micro-batch into a database table, for `foreachBatch`."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch), **properties}
    if driver:
        options["driver"] = driver
    if tasks:
        options["numPartitions"] = str(tasks)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        df.write.format("jdbc").options(**options).mode("append").save()
    return on_batch


def write_partitions(df: DataFrame, connect: Callable[[], Any], write: Callable[[Any, list[Row]], None],
                     close: Callable[[Any], None] = lambda c: c.close(), batch: int = 1_000, retries: int = 5,
                     wait: float = 0.2) -> None:
    """Write rows through a client that is set up once per task and closed at its end.

    `write` gets at most `batch` rows and is called again, up to `retries` times, when it fails; it must therefore
    replace by key (`REPLACE INTO`, `HSET`, ...), as must any write from a task that may run twice.
    """
    def send(client: Any, rows: list[Row]) -> None:
        for attempt in range(retries + 1):
            try:
                return write(client, rows)
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(wait * 2 ** attempt)

    def task(rows: Iterator[Row]) -> None:
        client, pending = None, []
        try:
            for row in rows:
                if client is None:
                    client = connect()
                pending.append(row)
                if len(pending) == batch:
                    send(client, pending)
                    pending = []
            if pending:
                send(client, pending)
        finally:
            if client is not None:
                close(client)

    df.foreachPartition(task)
