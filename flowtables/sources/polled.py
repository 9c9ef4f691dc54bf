"""A growing table read again and again, each poll only what is new since the last one.

Rows are known by a mark that new rows never undercut (a number that rises, a time of change) and by a key. What a poll reads
is appended to a folder as Parquet, one subfolder per poll, and that folder is all the state there is: the highest mark in it
says where the next poll starts, and its rows at that mark say which of the equal ones were read before. A poll's subfolder is
there as a whole or not at all, so a poll that fails is simply made again, and no row comes twice or gets lost between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POLL = "poll"


def polled_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows read so far with the number of their poll, from 0; none before the first poll."""
    schema = T.StructType([*schema.fields, T.StructField(POLL, T.IntegerType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def polled_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The polls as a stream: whatever new polls append is its next input."""
    schema = T.StructType([*schema.fields, T.StructField(POLL, T.IntegerType())])
    return spark.readStream.schema(schema).parquet(path)


def new_rows(table: DataFrame, known: DataFrame, mark: str, keys: Sequence[str]) -> DataFrame:
    """Rows of `table` that no poll in `known` has read.

    Rows above the highest known mark are new without a look at their key, and the comparison reaches the scan as a filter.
    Rows at that mark, and rows without a mark, are new if their key isn't known; those go through an anti join, in which keys
    may be NULL and which any number of equal marks can pass, as nothing of it is gathered in one place.
    """
    high = known.agg(F.max(mark)).first()[0]
    if high is None:
        above, open_ = F.col(mark).isNotNull(), F.col(mark).isNull()
    else:
        at = F.lit(high).cast(table.schema[mark].dataType)
        above, open_ = F.col(mark) > at, F.col(mark).isNull() | (F.col(mark) == at)
    seen = known.where(open_).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return table.where(above).unionByName(table.where(open_).join(seen, same, "left_anti"))


def poll(table: DataFrame, path: str, mark: str, keys: Sequence[str]) -> int | None:
    """Append what is new in `table` to `path`; the number of the poll, or None when there is nothing new.

    `table` is the table as it is now: a Parquet folder, a catalog table or a database table read anew for every poll. It may be
    read while it grows. Rows that appear below the highest mark, changes that leave the mark as it was, and deletes are not seen.
    Rows that agree in mark and key are one row to later polls, but those of one poll are all kept. One poller per path.
    """
    if POLL in table.columns or not keys:
        raise ValueError(f"a poll needs key columns and a table without a column {POLL!r}")
    spark = table.sparkSession
    known = polled_rows(spark, path, table.schema)
    last = known.agg(F.max(POLL)).first()[0]
    number = 0 if last is None else last + 1
    fresh = new_rows(table, known, mark, keys)
    folder = f"{path}/{POLL}={number}"
    fresh.write.mode("overwrite").parquet(folder)
    if not spark.read.schema(table.schema).parquet(folder).isEmpty():
        return number
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)
    return None
