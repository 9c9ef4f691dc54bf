"""Session settings the library counts on, and the shared folder for cut lineage and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings an engine session should carry. All can be overridden by the caller's builder or spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Keyed state needs a store with several state variables per key; it also keeps large state out of the heap.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def build_session(app: str = "flowtables", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; `conf` entries (dots written as `__`) win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **dict([STATE_STORE]), **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_state_store(spark: SparkSession) -> None:
    """Choose the RocksDB store for streams started from now on; running streams keep the store they began with."""
    spark.conf.set(*STATE_STORE)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder: on a cluster a machine-local folder is lost with
    its machine, so a missing setting is an error there.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="flowtables-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, never used path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
