"""Topics of a message queue and tables of a database as inputs.

Both need a connector on the class path of the cluster (`spark-sql-kafka-0-10`, a JDBC driver).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def topic_options(servers: str, topics: str | None = None, pattern: str | None = None,
                  start: str | Mapping[str, Mapping[int, int]] | int = "latest",
                  per_batch: int | None = None) -> dict[str, str]:
    """Reader options. `start`: `earliest`, `latest`, a time in epoch milliseconds, or offsets per topic and partition.

    With `pattern` all matching topics are read and new ones are found while the query runs. On a restart the
    offsets of the query's checkpoint win over `start`.
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or pattern")
    options = {"kafka.bootstrap.servers": servers}
    options["subscribe" if topics else "subscribePattern"] = topics or pattern
    if isinstance(start, bool) or not isinstance(start, (str, int, Mapping)):
        raise TypeError("start must be a word, a time or offsets")
    if isinstance(start, int):
        options["startingTimestamp"] = str(start)
    elif isinstance(start, Mapping):
        options["startingOffsets"] = json.dumps({t: {str(p): o for p, o in ps.items()} for t, ps in start.items()})
    else:
        if start not in ("earliest", "latest"):
            raise ValueError("start must be earliest or latest")
        options["startingOffsets"] = start
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def topic_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Messages of topics as a stream; `value` is binary, see `records.message_csv`."""
    return spark.readStream.format("kafka").options(**topic_options(servers, **options)).load()


def topic_table(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Messages present now, as a bounded frame."""
    options.setdefault("start", "earliest")
    return spark.read.format("kafka").options(**topic_options(servers, **options)).load()


def jdbc_options(url: str, table: str, driver: str | None = None, column: str | None = None,
                 lower: object = None, upper: object = None, tasks: int = 1, fetch: int = 10_000,
                 **properties: str) -> dict[str, str]:
    """Reader options for a database table, read by `tasks` tasks that share the range of `column`."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch), **properties}
    if driver:
        options["driver"] = driver
    if tasks > 1:
        if column is None or lower is None or upper is None:
            raise ValueError("reading in parallel needs column, lower and upper")
        options |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(tasks)}
    return options


def jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Database table as it is now. To poll it, read it inside `foreachBatch`: every read gives all rows."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
