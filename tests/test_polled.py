"""Polled tables, and tables from a snapshot and its change log."""

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from flowtables.sinks import keyed
from flowtables.sources import polled
from flowtables.streaming import handover, runs

SCHEMA = "id long, mark long, v string"


def test_equal_marks_are_read_once(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    first = [(1, 1, "a"), (2, 5, "b"), (3, 5, "c"), (None, 5, "no id"), (9, None, "no mark")]
    assert polled.poll(rows(first, SCHEMA), path, "mark", ["id"]) == 0
    assert polled.poll(rows(first, SCHEMA), path, "mark", ["id"]) is None
    second = [*first, (4, 5, "late, same mark"), (5, 7, "d"), (10, None, "no mark"), (6, 2, "below the mark")]
    assert polled.poll(rows(second, SCHEMA), path, "mark", ["id"]) == 1
    assert polled.poll(rows(second, SCHEMA), path, "mark", ["id"]) is None
    got = polled.polled_rows(spark, path, rows([], SCHEMA).schema)
    assert sorted((r.v, r.poll) for r in got.collect()) == sorted(
        [(v, 0) for *_, v in first] + [("late, same mark", 1), ("d", 1), ("no mark", 1)])


def test_a_table_without_rows_or_marks(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    assert polled.poll(rows([], SCHEMA), path, "mark", ["id"]) is None
    assert polled.poll(rows([(1, None, "a")], SCHEMA), path, "mark", ["id"]) == 0
    assert polled.poll(rows([(1, None, "a"), (2, None, "b")], SCHEMA), path, "mark", ["id"]) == 1
    assert polled.polled_rows(spark, path, rows([], SCHEMA).schema).count() == 2
    with pytest.raises(ValueError):
        polled.poll(rows([], SCHEMA), path, "mark", [])


def test_a_poll_that_fails_is_made_again(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    polled.poll(rows([(1, 1, "a")], SCHEMA), path, "mark", ["id"])
    more = rows([(1, 1, "a"), (2, 2, "b")], SCHEMA)
    broken = more.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        polled.poll(broken, path, "mark", ["id"])
    assert polled.polled_rows(spark, path, more.schema).count() == 1
    assert polled.poll(more, path, "mark", ["id"]) == 1
    assert polled.polled_rows(spark, path, more.schema).count() == 2


def test_filter_reaches_the_scan(spark, rows, tmp_path):
    table, path = str(tmp_path / "t"), str(tmp_path / "p")
    rows([(i, i // 3, "x") for i in range(30)], SCHEMA).write.parquet(table)
    polled.poll(spark.read.parquet(table).where("id < 20"), path, "mark", ["id"])
    new = polled.new_rows(spark.read.parquet(table), polled.polled_rows(spark, path, rows([], SCHEMA).schema), "mark", ["id"])
    assert "GreaterThan(mark,6)" in new._jdf.queryExecution().toString()
    assert tuples(new, "id") == [(i,) for i in range(20, 30)]


def test_polls_as_a_stream(spark, rows, tmp_path):
    path, got = str(tmp_path / "p"), []
    for upto in (10, 25):
        polled.poll(rows([(i, i // 4, "x") for i in range(upto)], SCHEMA), path, "mark", ["id"])
        stream = polled.polled_stream(spark, path, rows([], SCHEMA).schema)
        runs.drain(stream, lambda b, _: got.append(sorted(r.id for r in b.collect())), str(tmp_path / "c"))
    assert got == [list(range(10)), list(range(10, 25))]


LOG = [(1, "a", 1, "c"), (2, "a", 2, "c"), (1, None, 3, "d"), (3, "a", 4, "c"), (2, "b", 5, "u"), (4, "a", 6, "c"),
       (3, None, 7, "d"), (1, "again", 8, "c"), (2, "c", 9, "u")]
LOG_SCHEMA = "id long, v string, pos long, op string"


def state_at(position):
    held = {}
    for i, v, pos, op in LOG:
        if pos <= position:
            held.pop(i, None) if op == "d" else held.update({i: v})
    return held


def log_stream(spark, rows, folder, log):
    for at, record in enumerate(log):
        rows([record], LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/n={at}")
    return spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 2).parquet(folder)


@pytest.mark.parametrize("read_at", [4, 6])  # the snapshot is of the position itself, or already holds later changes
def test_snapshot_and_log_that_overlap(spark, rows, tmp_path, read_at):
    path, base = str(tmp_path / "t"), str(tmp_path)
    taken = []

    def snapshot():
        taken.append(1)
        return rows(list(state_at(read_at).items()), "id long, v string"), 4

    for upto in (6, 9):
        log = log_stream(spark, rows, f"{base}/log-{upto}", LOG[:upto][::-1])  # newest first
        handover.snapshot_then_changes(spark, path, snapshot, log, ["id"], "pos", f"{base}/c-{upto}", buckets=2)
        assert dict(tuples(keyed.read_table(spark, path, "deleted"), "id", "v")) == state_at(upto)
    assert len(taken) == 1


def test_a_snapshot_lost_half_way_leaves_nothing_behind(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "_switch", lost)
        with pytest.raises(OSError):
            handover.load_snapshot(spark, path, lambda: (rows([(7, "gone")], "id long, v string"), 3), ["id"], "pos", 2)
    assert handover.load_snapshot(spark, path, lambda: (rows([(8, "x")], "id long, v string"), 5), ["id"], "pos", 2) == 5
    assert handover.load_snapshot(spark, path, lost, ["id"], "pos") == 5
    assert tuples(keyed.read_table(spark, path, "deleted"), "id", "v") == [(8, "x")]
