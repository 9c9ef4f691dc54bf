"""Helpers that the operators share: the columns an operator reads, tables in the shared folder, code on executors."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.session import new_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BYTES = 64 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, unless PYTHONPATH already names it.

    They get texts in batches of bounded bytes, so that long texts need no more memory than many short ones.
    """
    limit = spark.conf.get(BATCH_BYTES).rstrip("bB")
    if limit.isdigit() and int(limit) > BYTES:  # with a unit it was set by someone
        spark.conf.set(BATCH_BYTES, str(BYTES))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, read by several branches, safe from lost executors."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")  # the table is what stays; its shuffle files can go with the job
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discarded(*tables: DataFrame) -> None:
    """Remove tables made by `written` that nothing reads any more."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def mapped(rows: DataFrame, run: Callable[[Iterator], Iterator], schema: str | T.StructType, unread: Sequence[str]) -> DataFrame:
    """`mapInPandas` for code that hands the columns `unread` on as they are.

    pandas turns whole numbers beside a NULL into floats, which hold 53 bits, so of these columns the long ones go as text.
    """
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    long = {c for c in unread if isinstance(rows.schema[c].dataType, T.LongType)}
    sent = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in long else F.col(f"`{c}`") for c in rows.columns])
    got = sent.mapInPandas(run, T.StructType([
        T.StructField(f.name, T.StringType() if f.name in long else f.dataType) for f in schema.fields]))
    return got.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in long else F.col(f"`{f.name}`")
                        for f in schema.fields])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """Is crc32 of the id's decimal digits `remainder` modulo `modulus`? A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == remainder, F.lit(False))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary file is on this machine and, as it comes with Python's packages, on every other."""
    import public_tokenizers
    return public_tokenizers.path(name)
