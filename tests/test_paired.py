"""Joins and deadlines of streams with a carry give what the bounded forms give, wherever the input is cut."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from flowtables.operators import joins as jn
from flowtables.streaming import paired, runs

START = dt.datetime(2024, 1, 1)
LEFT, RIGHT = "id long, k string, lt timestamp", "rid long, k string, rt timestamp"
BOUND = 30


def sample(seed, n=90):
    """Rows in order of arrival, out of order by less than BOUND seconds."""
    r = random.Random(seed)
    return [(i, r.choice(["a", "b", "c", None]), START + dt.timedelta(seconds=max(0, i * 4 - r.randrange(BOUND)))) for i in range(n)]


def run(spark, tmp_path, parts, make):
    """All that a batch function writes over batches of `both`; the second comes twice, as after a failure."""
    out, state = [], f"{tmp_path}/state-{len(os.listdir(tmp_path))}"
    on_batch = make(lambda df, _: out.append([tuple(r) for r in df.collect()]), state)
    for i, frame in enumerate(parts):
        on_batch(frame, i)
        if i == 1:
            first = out.pop()
            on_batch(frame, i)
            assert sorted(out[-1], key=str) == sorted(first, key=str)
    return sorted((x for part in out for x in part), key=str), state


def cut(spark, left, right, batches):
    # The right side is cut elsewhere, and its clock runs apart from the left one's.
    a, b = [[len(rows) * i // batches for i in range(batches)] + [len(rows)] for rows in (left, right)]
    return [paired.both(spark.createDataFrame(left[a[i]:a[i + 1]], LEFT), spark.createDataFrame(right[b[i]:b[i + 1]], RIGHT))
            for i in range(batches)]


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_interval_joins_with_a_carry(spark, tmp_path, batches):
    left, right = sample(1), sample(2, 110)
    got, state = run(spark, tmp_path, cut(spark, left, right, batches), lambda write, state: paired.interval_batches(
        ["k"], "lt", "rt", "-7 seconds", "12 seconds", write, state, f"{BOUND} seconds", f"{BOUND} seconds"))
    want = jn.interval_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "lt", "rt",
                            "-7 seconds", "12 seconds").collect()
    assert len(want) > 50 and got == sorted(map(tuple, want), key=str)
    assert spark.read.parquet(f"{state}/left/batch={batches - 1}").count() < 30  # old rows have left


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("batches", [1, 2, 5])
def test_window_joins_with_a_carry(spark, tmp_path, batches, how):
    left, right = sample(3), sample(4, 110)
    defaults = {"rid": -1} if how == "left" else None
    got, state = run(spark, tmp_path, cut(spark, left, right, batches), lambda write, state: paired.window_batches(
        ["k"], "lt", "rt", "10 seconds", write, state, how, defaults, f"{BOUND} seconds", f"{BOUND} seconds"))
    whole = jn.window_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "lt", "rt", "10 seconds",
                           how, defaults).collect()
    until = min(max(x[2] for x in left), max(x[2] for x in right)) - dt.timedelta(seconds=BOUND)
    alone = [x for x in whole if x.rid == -1]
    want = [x for x in whole if x.rid != -1 or x.window_end <= until]
    assert len(want) > 30 and (how == "inner" or any(x.window_end > until for x in alone) and any(x.k is None for x in want))
    assert got == sorted(map(tuple, want), key=str)
    assert spark.read.parquet(f"{state}/right/batch={batches - 1}").count() < 30


@pytest.mark.parametrize("order", [[], ["id"]])
@pytest.mark.parametrize("batches", [1, 2, 5])
def test_deadlines_with_a_carry(spark, tmp_path, batches, order):
    r = random.Random(5)
    rows = [(i, k, at, r.choice([True, True, False, None])) for i, k, at in sample(6)]
    rows += [(len(rows), None, rows[-1][2] + dt.timedelta(seconds=60), False)]
    cuts = [len(rows) * i // batches for i in range(batches + 1)]
    parts = [spark.createDataFrame(rows[a:b], "id long, k string, at timestamp, open boolean") for a, b in zip(cuts, cuts[1:], strict=False)]
    got, state = run(spark, tmp_path, parts, lambda write, state: paired.overdue_batches(
        ["k"], "at", F.col("open"), "10 seconds", write, state, f"{BOUND} seconds", order))
    wait, seen = dt.timedelta(seconds=10), max(x[2] for x in rows) - dt.timedelta(seconds=BOUND)

    def follows(x, y):
        if y[2] == x[2]:
            return y[0] > x[0] if order else not y[3]
        return x[2] < y[2] <= x[2] + wait

    want = [x for x in rows if x[3] and x[2] + wait < seen and not (x[1] is not None and any(follows(x, y) for y in rows if y[1] == x[1]))]
    assert len(want) > 10 and got == sorted(want, key=str)
    assert spark.read.parquet(f"{state}/rows/batch={batches - 1}").count() < 30


def test_late_rows_of_closed_windows_are_left_out(spark, tmp_path):
    at = lambda s: START + dt.timedelta(seconds=s)
    parts = [paired.both(spark.createDataFrame(a, LEFT), spark.createDataFrame(b, RIGHT)) for a, b in (
        ([(1, "a", at(1)), (2, "a", at(50))], [(1, "a", at(50))]), ([(3, "a", at(2))], [(2, "a", at(3))]))]
    got, _ = run(spark, tmp_path, parts, lambda write, state: paired.window_batches(["k"], "lt", "rt", "10 seconds", write, state, "left"))
    assert [(x[1], x[3]) for x in got] == [(1, None), (2, 1)]


def test_both_is_one_stream_of_two(spark, tmp_path):
    for name, rows, kind in (("l", sample(1, 20), LEFT), ("r", sample(2, 30), RIGHT)):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}")
    a, b = (spark.readStream.schema(kind).parquet(f"{tmp_path}/{name}") for name, kind in (("l", LEFT), ("r", RIGHT)))
    on_batch = paired.interval_batches(["k"], "lt", "rt", "-9 seconds", "9 seconds", runs.keep_updates(f"{tmp_path}/out"), f"{tmp_path}/state")
    runs.drain(paired.both(a, b), on_batch, f"{tmp_path}/c")
    want = jn.interval_join(spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r"), ["k"], "lt", "rt", "-9 seconds", "9 seconds")
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    assert want.count() > 5 and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
