"""Keyed tables, external writers, reader options, partitioning and the driver contract."""

import json
import os

import pytest
from conftest import DATA, tuples
from pyspark.sql import functions as F

from flowtables import session
from flowtables.operators import partitioning as pt
from flowtables.sinks import external, files, keyed
from flowtables.sources import queues, tables


def test_upsert(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert(path, rows([(1, "a", 1), (2, "b", 1), (1, "c", 2)], "id int, v string, seq int"), ["id"], ["seq"], 4)
    assert tuples(keyed.read_table(spark, path), "id", "v") == [(1, "c"), (2, "b")]
    batch = rows([(2, "x", 1), (3, "y", 1)], "id int, v string, seq int")
    for _ in range(2):
        keyed.upsert(path, batch, ["id"], ["seq"], 4)
        assert tuples(keyed.read_table(spark, path), "id", "v") == [(1, "c"), (2, "x"), (3, "y")]
    with pytest.raises(ValueError):
        keyed.upsert(path, batch, ["id"], ["seq"], 5)
    keyed.upsert(path, batch.where("id > 9"), ["id"], ["seq"], 4)
    assert keyed.read_table(spark, path).count() == 3


def test_upsert_touches_only_its_buckets(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    many = rows([(i, "a", 1) for i in range(200)], "id int, v string, seq int")
    keyed.upsert(path, many, ["id"], ["seq"], 8)

    def written():
        return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}

    before = written()
    keyed.upsert(path, rows([(7, "b", 1)], "id int, v string, seq int"), ["id"], ["seq"])
    after = written()
    assert before < after and len(after - before) == 2  # a bucket and a list; nothing is overwritten
    assert keyed.read_table(spark, path).count() == 200
    assert keyed.vacuum(spark, path) == 0  # the first version still holds the other buckets
    keyed.rebuild(spark, path, ["id"], 3)
    assert keyed.vacuum(spark, path) == 2 and keyed.read_table(spark, path).count() == 200
    assert tuples(keyed.read_table(spark, path).where("v = 'b'"), "id") == [(7,)]


def test_older_changes_do_not_undo_newer_ones(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "id int, v string, ord int"
    for data in ([(1, "five", 5), (2, "one", 1)], [(1, "three", 3), (2, "two", 2)], [(1, "five again", 5), (3, None, None)]):
        keyed.upsert(path, rows(data, schema), ["id"], ["ord"])
    assert tuples(keyed.read_table(spark, path), "id", "v", "ord") == [(1, "five again", 5), (2, "two", 2), (3, None, None)]


def test_a_failure_before_the_switch_leaves_the_old_table(spark, rows, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "id int, v string, ord int"
    keyed.upsert(path, rows([(1, "a", 1), (2, "a", 1)], schema), ["id"], ["ord"], 2)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "_switch", lost)
        with pytest.raises(OSError):
            keyed.upsert(path, rows([(1, "b", 2), (3, "b", 2)], schema), ["id"], ["ord"])
    assert tuples(keyed.read_table(spark, path), "id", "v") == [(1, "a"), (2, "a")]
    keyed.upsert(path, rows([(1, "b", 2), (3, "b", 2)], schema), ["id"], ["ord"])
    assert tuples(keyed.read_table(spark, path), "id", "v") == [(1, "b"), (2, "a"), (3, "b")]


def test_deleted_rows(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    schema = "id int, v string, seq int, gone boolean"
    write = keyed.upsert_batches(path, ["id"], ["seq"], 2)
    write(rows([(1, "a", 1, False), (2, "b", 1, False)], schema), 0)
    write(rows([(1, "a", 2, True)], schema), 1)
    write(rows([(1, "late", 0, False)], schema), 2)
    assert tuples(keyed.read_table(spark, path, "gone"), "id", "v") == [(2, "b")]
    keyed.rebuild(spark, path, ["id"], 2, "gone")
    assert tuples(keyed.read_table(spark, path), "id") == [(2,)]


def test_write_partitions(spark, tmp_path):
    folder = str(tmp_path)

    class Client:
        """Stand-in for a database client: one file per connection, the first write of each fails."""

        def __init__(self):
            self.path = os.path.join(folder, f"{os.getpid()}-{id(self)}.jsonl")
            self.failed = False

        def write(self, rows):
            if not self.failed:
                self.failed = True
                raise OSError("try again")
            with open(self.path, "a") as f:
                f.write(json.dumps([r.id for r in rows]) + "\n")

        def close(self):
            with open(self.path, "a") as f:
                f.write('"closed"\n')

    external.write_partitions(spark.range(0, 25, numPartitions=2), Client, lambda c, rows: c.write(rows),
                              batch=10, wait=0.01)
    calls = [[json.loads(x) for x in (tmp_path / n).read_text().splitlines()] for n in os.listdir(folder)]
    assert len(calls) == 2 and all(c[-1] == "closed" for c in calls)
    batches = [b for c in calls for b in c[:-1]]
    assert sorted(i for b in batches for i in b) == list(range(25)) and max(map(len, batches)) == 10


def test_json_messages(rows):
    df = rows([(1, "a", None)], "id int, v string, w string")
    assert tuples(external.json_messages(df, ["id", "v"])) == [("1_a", '{"id":1,"v":"a"}')]


def test_write_lines(spark, rows, tmp_path):
    files.write_lines(rows([("west", 2)], "w string, n int"), f"{tmp_path}/o")
    assert tuples(spark.read.text(f"{tmp_path}/o")) == [("(west,2)",)]


def test_topic_options():
    options = queues.topic_options("h:1", "t", start={"t": {0: 5, 1: 7}}, per_batch=10)
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 5, "1": 7}}
    assert options["subscribe"] == "t" and options["maxOffsetsPerTrigger"] == "10"
    assert queues.topic_options("h:1", pattern="t-[0-9]")["subscribePattern"] == "t-[0-9]"
    assert queues.topic_options("h:1", "t", start=1656604800000)["startingTimestamp"] == "1656604800000"
    for bad in ({}, {"topics": "a", "pattern": "b"}, {"topics": "a", "start": "middle"}):
        with pytest.raises(ValueError):
            queues.topic_options("h:1", **bad)


def test_jdbc_options():
    options = queues.jdbc_options("jdbc:x", "t", column="id", lower=1, upper=9, tasks=3, user="u")
    assert (options["partitionColumn"], options["numPartitions"], options["user"]) == ("id", "3", "u")
    with pytest.raises(ValueError):
        queues.jdbc_options("jdbc:x", "t", tasks=3)


def test_catalog_tables(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    rows([(1, "a")], "id int, name string").write.mode("overwrite").saveAsTable("shop.users")
    assert ("shop",) in tuples(tables.databases(spark))
    for name in ("shop.users", "spark_catalog.shop.users"):
        assert tuples(tables.catalog_table(spark, name)) == [(1, "a")]


def test_wide_scan_reads_single_fields(spark, rows, tmp_path):
    df = rows([("k1", ("u", 1, "buy", "t")), ("k2", ("v", 2, "view", "t"))],
              "rowkey string, info struct<user_id:string,item_id:int,behavior:string,ts:string>")
    df.write.parquet(f"{tmp_path}/w")
    out = tables.wide_scan(spark.read.parquet(f"{tmp_path}/w"), ["info.item_id", "info.behavior"])
    assert tuples(out) == [("k1", 1, "buy"), ("k2", 2, "view")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "info:struct<item_id:int,behavior:string>" in plan
    assert tables.wide_scan(df, ["info.item_id"], limit=1).count() == 1


def test_partitioning(spark):
    df = spark.range(100)
    task = F.spark_partition_id().alias("task")
    by_number = pt.by_number(df, 2, F.col("id") % 2).select("id", task)
    assert by_number.where("task <> id % 2").count() == 0
    assert pt.by_number(df, 3, -F.col("id")).select("id", task).where("task <> pmod(-id, 3)").count() == 0
    sizes = [r["count"] for r in pt.evenly(df, 4).groupBy(task).count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 4
    assert pt.at_random(df, 3).rdd.getNumPartitions() == 3
    assert pt.fewer_tasks(pt.evenly(df, 4), 2).rdd.getNumPartitions() == 2
    placed = pt.by_key(df.withColumn("k", F.col("id") % 5), "k", n=3).select("k", task).distinct()
    assert placed.count() == 5


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


def test_driver_contract():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 60
    assert os.path.isdir(DATA)


def parquet_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_an_upsert_writes_in_proportion_to_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(100_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(0).alias("seq"))
    keyed.upsert(path, base, ["id"], ["seq"], 4)
    whole = parquet_bytes(f"{path}/data")
    for n in range(1, 4):
        before = parquet_bytes(f"{path}/data")
        keyed.upsert(path, base.where(f"id % 10000 = {n}").withColumn("seq", F.lit(n)), ["id"], ["seq"])
        assert parquet_bytes(f"{path}/data") - before < whole / 100
    got = keyed.read_table(spark, path)
    assert got.count() == got.select("id").distinct().count() == 100_000
    assert sorted(r.seq for r in got.where("seq > 0").collect()) == [1] * 10 + [2] * 10 + [3] * 10


def test_deltas_are_gathered_and_old_lists_go(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "id int, v string, seq int"
    small = keyed.Compaction(deltas=3, share=0.25)
    keyed.upsert(path, rows([(i, "a", 0) for i in range(40)], schema), ["id"], ["seq"], 1)
    want, shapes = {i: ("a", 0) for i in range(40)}, []
    for n in range(1, 15):
        batch = [(n % 5, f"b{n}", n), (100 + n, "new", n), (39, "older", -n)]
        keyed.upsert(path, rows(batch, schema), ["id"], ["seq"], compaction=small)
        want |= {n % 5: (f"b{n}", n), 100 + n: ("new", n)}
        parts = keyed._state(spark, path).parts[0]
        shapes.append((parts[0].rows, len(parts) - 1))
        assert parts[0].base and not any(p.base for p in parts[1:]) and len(parts) <= 4
    assert {r.id: (r.v, r.seq) for r in keyed.read_table(spark, path).collect()} == want
    assert len({b for b, _ in shapes}) > 1 and {d for _, d in shapes} >= {0, 1, 2, 3}  # bases and deltas were merged
    assert len([f for f in os.listdir(f"{path}/lists") if f.startswith("list=")]) == keyed.KEPT_LISTS
    assert keyed.vacuum(spark, path) > 0
    assert {r.id: (r.v, r.seq) for r in keyed.read_table(spark, path).collect()} == want
    with pytest.raises(ValueError):
        keyed.upsert(path, rows(batch, schema), ["id"], ["v"])
    with pytest.raises(ValueError):
        keyed.rebuild(spark, str(tmp_path / "none"), ["id"], 4)


def test_equal_rows_of_the_later_upsert_win_from_deltas_too(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "id int, v string, seq int"
    keyed.upsert(path, rows([(i, "a", 1) for i in range(40)], schema), ["id"], ["seq"], 1)
    for v in "bcd":
        keyed.upsert(path, rows([(1, v, 1)], schema), ["id"], ["seq"])
    keyed.upsert(path, rows([(2, "wide", 2, 0.5)], schema + ", extra double"), ["id"], ["seq"])
    got = {r.id: (r.v, r.extra) for r in keyed.read_table(spark, path).collect()}
    assert (got[1], got[2], got[3]) == (("d", None), ("wide", 0.5), ("a", None))
