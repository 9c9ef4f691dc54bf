"""Tables with one row per key, kept by upserts: the newest row by an order wins, whenever it comes.

The table is Parquet in hash buckets of the key. A bucket is a base of unique keys and a few deltas; readers take the newest row
per key of both. An upsert writes a delta to each bucket its keys fall into, so it writes bytes in proportion to the batch, and
then one small file, the next list of parts, which makes them the table. Until that file is there readers see the old table
whole, and a job that fails half-way leaves nothing but folders that no list names. Running an upsert twice with the same rows
gives the same table. Keys are unique, so buckets are even however uneven the updates are. A table has one writer at a time.

A bucket whose deltas have grown to a share of its base gets a new base with its next update; one with many small deltas gets a
single delta instead. So a row is written again a bounded number of times for every row of updates, and a read merges at most
`Compaction.deltas` deltas of at most `Compaction.share` of the base.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.operators.changelog import latest_per_key

BUCKET = "bucket"
WRITTEN = "__written"  # number of the list a row came with; decides between rows that are equal in the order
LISTS = ("version string, bucket int, rows long, base boolean, buckets int, keys array<string>, order array<string>, "
         "mark string, list long")
KEPT_LISTS = 10        # lists that stay for readers who are still at an older one


@dataclass(frozen=True)
class Compaction:
    """When the deltas of a bucket are merged."""

    deltas: int = 8      # at most so many per bucket
    share: float = 0.25  # rows of a bucket's deltas against rows of its base


@dataclass(frozen=True)
class Part:
    """A bucket's folder in one version: its base or a delta."""

    version: str
    bucket: int
    rows: int
    base: bool

    def folder(self, path: str) -> str:
        return f"{path}/data/version={self.version}/{BUCKET}={self.bucket}"


@dataclass(frozen=True)
class State:
    """What the newest list says. At most `deltas + 1` parts a bucket, so bounded by the number of buckets."""

    number: int = -1
    buckets: int = 0
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    mark: str | None = None
    parts: dict[int, list[Part]] = field(default_factory=dict)


def _state(spark: SparkSession, path: str) -> State:
    try:
        lists = spark.read.schema(LISTS).option("ignoreMissingFiles", "true").parquet(f"{path}/lists")
        newest = lists.agg(F.max("list")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is None:
        return State()
    rows = lists.where(F.col("list") == newest).collect()
    parts = defaultdict(list)
    for r in rows:
        if r["version"]:
            parts[r["bucket"]].append(Part(r["version"], r["bucket"], r["rows"], r["base"]))
    return State(newest, rows[0]["buckets"], tuple(rows[0]["keys"]), tuple(rows[0]["order"]), rows[0]["mark"], dict(parts))


def _files(spark: SparkSession, path: str):
    """File system and path object of a folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _switch(spark: SparkSession, path: str, state: State) -> None:
    """Write a list as one file: it is there as a whole or not at all. Old lists go."""
    rows = [(p.version, p.bucket, p.rows, p.base, state.buckets, list(state.keys), list(state.order), state.mark)
            for parts in state.parts.values() for p in parts]
    rows = rows or [("", 0, 0, True, state.buckets, list(state.keys), list(state.order), state.mark)]
    schema = LISTS.removesuffix(", list long")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/lists/list={state.number}")
    fs, folder = _files(spark, f"{path}/lists")
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("list=") and int(name[5:]) <= state.number - KEPT_LISTS:
            fs.delete(entry.getPath(), True)


def _place(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, parts: Iterable[Part]) -> DataFrame:
    folders = sorted(p.folder(path) for p in parts)
    return spark.read.option("mergeSchema", "true").parquet(*folders)


def _current(spark: SparkSession, path: str, state: State) -> DataFrame:
    """Newest row per key. A bucket without deltas is read as it is."""
    merged = [p for parts in state.parts.values() if len(parts) > 1 for p in parts]
    plain = [p for parts in state.parts.values() if len(parts) == 1 for p in parts]
    found = [_read(spark, path, plain)] if plain else []
    if merged:
        found.append(latest_per_key(_read(spark, path, merged), state.keys, [*state.order, WRITTEN]))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)


def _write(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> tuple[str, dict[int, int]]:
    """A new version of the buckets that the rows fall into, one sorted file each, and its rows by bucket."""
    version = uuid.uuid4().hex
    folder = f"{path}/data/version={version}"
    (df.withColumn(BUCKET, _place(keys, buckets)).repartitionById(buckets, F.col(BUCKET))
     .sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET).parquet(folder))
    # Counting reads the footers. At most `buckets` numbers.
    rows = df.sparkSession.read.schema(f"{BUCKET} int").parquet(folder).groupBy(BUCKET).count().collect()
    return version, {r[BUCKET]: r["count"] for r in rows}


def read_table(spark: SparkSession, path: str, deleted: str | None = None) -> DataFrame:
    """Current rows. `deleted` names the boolean column that marks rows as taken out."""
    state = _state(spark, path)
    if not state.parts:
        raise ValueError(f"there is no row in a table at {path}")
    df = _current(spark, path, state).drop(WRITTEN)
    return df if deleted is None else df.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)


def upsert(path: str, updates: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int | None = None,
           compaction: Compaction = Compaction()) -> None:
    """Bring `updates` into the table at `path`.

    Per key the newest row by `order` counts, among the updates and against the stored row; of equal ones the update. So changes
    may come late and in any order. A delete is an upsert of a row that a boolean column marks as such (see `read_table`).
    `buckets` is for a new table (64 by default; about one per gigabyte); see `rebuild` for one that has outgrown it.
    Keys and order are those of the table's first rows. Updates without rows change nothing.
    """
    spark, keys, order = updates.sparkSession, tuple(keys), tuple(order)
    state = _state(spark, path)
    if state.buckets and buckets not in (None, state.buckets):
        raise ValueError(f"the table at {path} has {state.buckets} buckets")
    if state.buckets and (state.keys, state.order) != (keys, order):
        raise ValueError(f"the table at {path} has keys {state.keys} and order {state.order}")
    buckets, number = state.buckets or buckets or 64, state.number + 1
    # Used twice below, and the input may be a micro-batch.
    fresh = latest_per_key(updates, keys, order).withColumn(WRITTEN, F.lit(number).cast("long")).persist()
    try:
        counts = {r[0]: r[1] for r in fresh.groupBy(_place(keys, buckets)).count().collect()}  # at most `buckets` numbers
        if not counts:
            return
        kept, taken = {}, []  # parts of a touched bucket that stay, and those that go into its new part
        for bucket, rows in counts.items():
            parts = state.parts.get(bucket, [])
            deltas = [p for p in parts if not p.base]
            if sum(p.rows for p in deltas) + rows > compaction.share * sum(p.rows for p in parts if p.base):
                gone = parts
            else:
                gone = deltas if len(deltas) >= compaction.deltas else []
            kept[bucket] = [p for p in parts if p not in gone]
            taken += gone
        merged = fresh
        if taken:
            merged = latest_per_key(fresh.unionByName(_read(spark, path, taken), allowMissingColumns=True),
                                    keys, [*order, WRITTEN])
        version, written = _write(merged, path, keys, buckets)
    finally:
        fresh.unpersist()
    parts = state.parts | {b: [*kept[b], Part(version, b, n, not kept[b])] for b, n in written.items()}
    _switch(spark, path, State(number, buckets, keys, order, state.mark, parts))


def load(path: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int | None = None,
         mark: str | None = None) -> None:
    """Put `rows` in place of whatever the table holds, with a text that stays with it: both are there at once or not at all."""
    spark, keys, order = rows.sparkSession, tuple(keys), tuple(order)
    state = _state(spark, path)
    buckets, number = buckets or state.buckets or 64, state.number + 1
    fresh = latest_per_key(rows, keys, order).withColumn(WRITTEN, F.lit(number).cast("long"))
    version, written = _write(fresh, path, keys, buckets)
    _switch(spark, path, State(number, buckets, keys, order, mark, {b: [Part(version, b, n, True)] for b, n in written.items()}))


def table_mark(spark: SparkSession, path: str) -> str | None:
    """The text that came with the last `load`; None without one."""
    return _state(spark, path).mark


def rebuild(spark: SparkSession, path: str, keys: Sequence[str], buckets: int, deleted: str | None = None) -> None:
    """Write the whole table anew with another number of buckets; with `deleted`, without the rows marked as deleted.

    Forget deleted keys only when no change older than their delete can still come.
    """
    state = _state(spark, path)
    if not state.parts:
        raise ValueError(f"there is no row in a table at {path}")
    if tuple(keys) != state.keys:
        raise ValueError(f"the table at {path} has keys {state.keys}")
    rows = _current(spark, path, state)
    if deleted is not None:
        rows = rows.where(~F.coalesce(F.col(deleted), F.lit(False)))
    version, written = _write(rows, path, keys, buckets)
    _switch(spark, path, State(state.number + 1, buckets, state.keys, state.order, state.mark,
                               {b: [Part(version, b, n, True)] for b, n in written.items()}))


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove folders that the newest list doesn't name, when no reader of an older table is left. How many went."""
    state = _state(spark, path)
    if state.number < 0:
        return 0
    fs, data = _files(spark, f"{path}/data")
    named = defaultdict(set)
    for parts in state.parts.values():
        for p in parts:
            named[f"version={p.version}"].add(f"{BUCKET}={p.bucket}")
    old = []
    for version in fs.listStatus(data):
        buckets = named.get(version.getPath().getName())
        if buckets is None:
            old.append(version.getPath())
        else:
            old += [f.getPath() for f in fs.listStatus(version.getPath())
                    if f.isDirectory() and f.getPath().getName() not in buckets]
    for folder in old:
        fs.delete(folder, True)
    return len(old)


def upsert_batches(path: str, keys: Sequence[str], order: Sequence[str],
                   buckets: int | None = None) -> Callable[[DataFrame, int], None]:
    """The same for `writeStream.foreachBatch`."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        upsert(path, batch, keys, order, buckets)
    return on_batch


def changelog_batches(path: str, keys: Sequence[str], order: Sequence[str], op: str = "op",
                      deletes: Sequence[str] = ("d",), buckets: int | None = None) -> Callable[[DataFrame, int], None]:
    """Fold a stream of change records into a table; read it with `read_table(..., deleted="deleted")`."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        upsert(path, batch.withColumn("deleted", F.col(op).isin(*deletes)).drop(op), keys, order, buckets)
    return on_batch
