"""Streams with a carry give what the bounded form gives, wherever the input is cut, and hold no more than they need."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowtables.operators import count_windows as cw
from flowtables.operators import joins as jn
from flowtables.operators import late as lt
from flowtables.operators import running as rn
from flowtables.operators import windows as wn
from flowtables.operators.aggregates import Measure
from flowtables.streaming import carried as cr
from flowtables.streaming import running as sr

START = dt.datetime(2024, 1, 1)
KIND = "id long, k string, ts timestamp, v decimal(10,2)"


def sample(n=160, seed=1):
    r = random.Random(seed)
    rows, at = [], 0
    for i in range(n):
        at += r.choice([0, 1, 5, 40, 300])
        rows.append((i, r.choice(["a", "b", None]), START + dt.timedelta(seconds=max(0, at - r.choice([0, 0, 100, 900]))),
                     None if i % 9 == 0 else Decimal(r.randrange(1000))))
    return rows


def run(spark, tmp_path, rows, batches, make, kind=KIND):
    """All that the batch function writes, over uneven batches; the second is run twice, as after a failure."""
    out = []
    state = str(tmp_path / f"state-{batches}-{len(os.listdir(tmp_path))}")
    on_batch = make(lambda df, _: out.append(sorted(map(tuple, df.collect()), key=str)), state)
    cuts = [0, *sorted(random.Random(batches).sample(range(1, len(rows)), batches - 1)), len(rows)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        batch = spark.createDataFrame(random.Random(i).sample(rows[a:b], b - a), kind)
        on_batch(batch, i)
        if i == 1:
            first = out.pop()
            on_batch(batch, i)
            assert out[-1] == first
    return sorted((x for part in out for x in part), key=str), state


@pytest.mark.parametrize("batches", [1, 4])
@pytest.mark.parametrize("size, slide", [(5, 5), (6, 2), (5, 2), (3, 4), (1, 1), (70, 30)])
def test_count_windows(spark, tmp_path, size, slide, batches):
    rows, measures = sample(), {"total": Measure("sum", "v"), "n": Measure("count", "id")}
    got, state = run(spark, tmp_path, rows, batches, lambda write, state: cr.count_window_batches(["id"], size, measures, write, state, slide))
    want = cw.count_window(spark.createDataFrame(rows, KIND), ["id"], size, measures, slide)
    assert got == sorted((tuple(r) for r in want.select("window_no", "total", "n").collect()), key=str)
    assert spark.read.parquet(f"{state}/open_rows/batch={batches - 1}").count() < max(size, 1) + 1
    assert len(os.listdir(f"{state}/open_rows")) <= 2


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_window_firings(spark, tmp_path, batches):
    rows, rule = sample(), lt.Lateness("1 minute", "30 seconds", "2 minutes")
    got, state = run(spark, tmp_path, rows, batches, lambda write, state: cr.firing_batches("ts", "v", ["id"], rule, write, state, ["k"]))
    want = lt.window_firings(lt.classify(spark.createDataFrame(rows, KIND), "ts", ["id"], rule), "v", ["id"], ["k"])
    columns = ["k", "window_start", "window_end", "firing", "total"]
    waiting = [tuple(r) for r in cr.open_windows(spark, state, ["k"]).select(columns).collect()]
    assert sorted(got + waiting, key=str) == sorted((tuple(r) for r in want.select(columns).collect()), key=str)
    # Windows that can't fire any more have left.
    limit = max(r[2] for r in rows) - dt.timedelta(seconds=150)
    held = spark.read.parquet(f"{state}/windows/batch={batches - 1}").collect()
    assert held and all(r.window_end > limit for r in held)


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_asof(spark, tmp_path, batches):
    rows = sample()
    is_version = F.col("id") % 4 == 0
    got, state = run(spark, tmp_path, rows, batches, lambda write, state: cr.asof_batches(
        is_version, ["k"], ["id"], {"known": "v", "since": "id"}, write, state, {"since": -1}))
    df = spark.createDataFrame(rows, KIND)
    want = jn.asof_lookup(df.where(~is_version), df.where(is_version), ["k"], ["id"], {"known": "v", "since": "id"}, {"since": -1})
    assert got == sorted(map(tuple, want.collect()), key=str)
    assert spark.read.parquet(f"{state}/versions/batch={batches - 1}").count() == 3


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_expiring_sums(spark, tmp_path, batches):
    rows = sorted(sample(), key=lambda r: (r[2], r[0]))
    got, state = run(spark, tmp_path, rows, batches, lambda write, state: cr.expiring_batches(["k"], "ts", "2 minutes", write, state, "v", ["id"], "total"))
    want = rn.expiring_sum(spark.createDataFrame(rows, KIND), ["k"], "ts", "2 minutes", F.col("v"), ["id"], "total")
    assert got == sorted(map(tuple, want.collect()), key=str)
    last = {k: max(r[2] for r in rows if r[1] == k) for k in ("a", "b", None)}
    live = {k for k, t in last.items() if t + dt.timedelta(minutes=2) > max(last.values())}
    assert {r.k for r in spark.read.parquet(f"{state}/live/batch={batches - 1}").collect()} == live


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("batches", [1, 5])
def test_sessions(spark, tmp_path, batches, keys):
    rows, measures = sample(seed=2), {"total": Measure("sum", "v"), "n": Measure("count", "id")}
    got, state = run(spark, tmp_path, rows, batches, lambda write, state: cr.session_batches(
        "ts", "45 seconds", measures, write, state, keys, "15 minutes"))
    open_ = cr.open_sessions(spark, state, "45 seconds", measures, keys)
    want = wn.session_agg(spark.createDataFrame(rows, KIND), "ts", "45 seconds", measures, keys)
    assert sorted(got + [tuple(r) for r in open_.collect()], key=str) == sorted((tuple(r) for r in want.select(open_.columns).collect()), key=str)
    assert got and open_.count() < want.count()


def test_late_rows_of_sessions_join_or_go(spark, tmp_path):
    def at(second):
        return START + dt.timedelta(seconds=second)

    out, late = [], []
    on_batch = cr.session_batches("ts", "10 seconds", {"n": Measure("count", "id")}, lambda df, _: out.append(df.collect()),
                                  str(tmp_path / "s"), bound="20 seconds", late=lambda df, _: late.extend(r.id for r in df.collect()))
    for i, seconds in enumerate([[0, 15, 30], [8, 22], [100], [60, 71]]):
        on_batch(spark.createDataFrame([(s, "a", at(s), None) for s in seconds], KIND), i)
    assert [[(r.window_start, r.window_end, r.n) for r in part] for part in out] == [[], [], [(at(0), at(40), 5)], []]
    assert late == [60] and cr.open_sessions(spark, str(tmp_path / "s"), "10 seconds", {"n": Measure("count", "id")}).count() == 2


def test_running_folds_of_batches_split_large_keys_and_run_once(spark, tmp_path):
    got, plans = [], []

    def write(df, _):
        plans.append(df._jdf.queryExecution().toString())
        got.extend(map(tuple, df.collect()))

    on_batch = sr.reduce_batches(["k"], ["id"], "v", lambda a, b: (a + b) % 7, write, str(tmp_path / "state"), "out")
    rows = [(i, ["a", "b", None][i % 3 if i < 20 else 0], i) for i in range(40)]
    for i, part in enumerate((rows[:20], rows[20:30], rows[30:])):
        on_batch(spark.createDataFrame(part, "id long, k string, v long"), i)
    want = [(i, k, sum(v for j, q, v in rows if q == k and j <= i) % 7) for i, k, _ in rows]
    assert sorted(((i, k, o) for i, k, _, o in got), key=str) == sorted(want, key=str)
    # A full join can't be split, and without a cache the fold ran for the result and again for the carry.
    assert not any("FullOuter" in p for p in plans) and all(p.count("InMemoryRelation") for p in plans)
    ends = spark.read.parquet(str(tmp_path / "state" / "batch=2"))
    assert ends.count() == 3
