"""Streams of files: the result must be that of the bounded form."""

import datetime as dt
import os
import random
import time

import pytest
from conftest import tuples
from pyspark.sql import functions as F
from test_windows import DETAIL, MAIN, ORDERS, RULE

from flowtables import schemas as sc
from flowtables.functions import times as tm
from flowtables.operators import aggregates as ag
from flowtables.operators import joins as jn
from flowtables.operators import late as lt
from flowtables.operators import timeouts as to
from flowtables.operators import windows as wn
from flowtables.operators.aggregates import Measure
from flowtables.sinks import files as fs
from flowtables.sources import files, records
from flowtables.plans.chunks import Split
from flowtables.streaming import runs, running, state, timers
from flowtables.streaming import windows as sw


def at(df, source, target):
    return df.withColumn(target, tm.from_text(source))


def test_word_count_restarts_from_its_checkpoint(spark, text_files, tmp_path):
    folder = text_files("spark hive", "spark")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = ag.word_count(files.line_stream(spark, folder, 1), "value")
        return dict(tuples(runs.drain_updates(stream, out, checkpoint, ["word"])))

    assert run() == {"spark": 2, "hive": 1}
    text_files("hive hdfs", "")
    text_files("spark")
    assert run() == {"spark": 3, "hive": 2, "hdfs": 1}
    assert run() == {"spark": 3, "hive": 2, "hdfs": 1}


@pytest.mark.parametrize("kind", ["tumbling", "sliding", "session"])
def test_windows_equal_the_bounded_form(spark, text_files, tmp_path, kind):
    for part in (ORDERS[:4], ORDERS[4:8], ORDERS[8:]):
        folder = text_files(*part)
    measures = {"n": Measure("count"), "most": Measure("max", "order_money")}

    def result(df):
        df = at(records.parse_delimited(df, sc.ORDER_EVENT), "order_time", "ts")
        df = df.withWatermark("ts", "1 minute") if df.isStreaming else df
        if kind == "tumbling":
            return wn.tumbling_agg(df, "ts", "10 seconds", measures, ["user_id"])
        if kind == "sliding":
            return wn.sliding_agg(df, "ts", "10 seconds", "5 seconds", measures, ["user_id"])
        return wn.session_agg(df, "ts", "2 seconds", measures, ["user_id"])

    want = tuples(result(files.lines(spark, folder)))
    stream = result(files.line_stream(spark, folder, 1))
    if kind == "session":
        # Sessions have no update mode: push the watermark on and take what was closed.
        text_files("end,end,0,2023-09-12 11:00:00")
        text_files("end,end,0,2023-09-12 12:00:00")
        text_files("end,end,0,2023-09-12 13:00:00")
        got = runs.drain_to_files(stream, str(tmp_path / "o"), str(tmp_path / "c")).where("user_id <> 'end'")
    else:
        got = runs.drain_updates(stream, str(tmp_path / "o"), str(tmp_path / "c"), ["user_id", "window_start"])
    assert tuples(got) == want


def test_late_rows_do_not_depend_on_the_cut_into_batches(spark, text_files, tmp_path):
    numbered = [f"{i}|{line}" for i, line in enumerate(ORDERS)]
    for part in (numbered[:3], numbered[3:7], numbered[7:8], numbered[8:]):
        folder = text_files(*part)
    stream = files.line_stream(spark, folder, 1).select(
        F.split("value", r"\|")[0].cast("long").alias("arr"), F.split("value", r"\|")[1].alias("value"))
    stream = at(records.parse_delimited(stream, sc.ORDER_EVENT, keep=["arr"]), "order_time", "ts")
    base = str(tmp_path)
    on_batch = sw.split_late_batches("ts", ["arr"], RULE, runs.keep_updates(base + "/main"),
                                     runs.keep_updates(base + "/late"), base + "/seen")
    runs.drain(stream, on_batch, base + "/cp")
    assert tuples(spark.read.parquet(base + "/late"), "order_id") == [("p9",)]
    kept = spark.read.parquet(base + "/main")
    assert tuples(kept.where("status = 'refire'"), "order_id") == [("p7",)]
    total = lt.window_totals(kept, {"t": Measure("sum", "order_money", exact=True)})
    assert [float(r.t) for r in total.orderBy("window_start").collect()] == [20.5, 29.0, 11.0]


def test_stream_joins(spark, tmp_path, text_files):
    (tmp_path / "m").mkdir()
    (tmp_path / "d").mkdir()
    (tmp_path / "m" / "1.txt").write_text("\n".join(MAIN))
    (tmp_path / "d" / "1.txt").write_text("\n".join(DETAIL))

    def side(folder, schema, source, ts):
        lines = files.line_stream(spark, str(tmp_path / folder))
        return at(records.parse_delimited(lines, schema), source, ts).withWatermark(ts, "0 seconds")

    def main():
        return side("m", sc.MAIN_ORDER, "order_time", "mt")

    def detail():
        return side("d", sc.DETAIL_ORDER, "detail_time", "dt")

    want = ["m1"] * 2 + ["m2"] + ["m3"] * 2
    joined = jn.window_join(main(), detail(), ["order_id"], "mt", "dt", "5 seconds")
    got = runs.drain_to_files(joined, str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert [r[0] for r in tuples(got, "order_id")] == want
    joined = jn.interval_join(main(), detail(), ["order_id"], "mt", "dt", "-1 seconds", "2 seconds")
    got = runs.drain_to_files(joined, str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert [r[0] for r in tuples(got, "order_id")] == want
    # Left rows without a match come out once the watermarks of both sides have passed them.
    for i, s in ((2, "14:21:00"), (3, "14:22:00"), (4, "14:23:00")):
        (tmp_path / "m" / f"{i}.txt").write_text(f"2023-09-12 {s},end_{i},u,a,1")
        (tmp_path / "d" / f"{i}.txt").write_text(f"2023-09-12 {s},end_{i},d,g,1,1.0")
    main_lines = at(records.parse_delimited(files.line_stream(spark, str(tmp_path / "m"), 1), sc.MAIN_ORDER),
                    "order_time", "mt").withWatermark("mt", "0 seconds")
    detail_lines = at(records.parse_delimited(files.line_stream(spark, str(tmp_path / "d"), 1), sc.DETAIL_ORDER),
                      "detail_time", "dt").withWatermark("dt", "0 seconds")
    joined = jn.window_cogroup(main_lines, detail_lines, ["order_id"], "mt", "dt", "5 seconds", sc.DETAIL_DEFAULTS)
    got = runs.drain_to_files(joined, str(tmp_path / "o3"), str(tmp_path / "c3"))
    assert tuples(got.where("detail_id is null"), "order_id", "goods_number", "detail_money") == [
        ("m4", 0, 0.0)]


def test_enrich_reads_the_dimension_anew(spark, text_files, tmp_path):
    users = {"now": [("u1", "first", 1)]}
    folder = text_files("u1,1,t,view")
    text_files("u2,2,t,view")

    def dimension():
        return spark.createDataFrame(users["now"], "user_id string, user_name string, seq int")

    def write(df, batch_id):
        df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={batch_id}")
        users["now"] = [("u1", "first", 1), ("u1", "second", 2), ("u2", "other", 1)]

    on_batch = sw.enrich_batches(dimension, ["user_id"], ["seq"], write, {"user_name": "unknown"})
    logs = records.parse_delimited(files.line_stream(spark, folder, 1), sc.USER_LOG)
    runs.drain(logs, on_batch, str(tmp_path / "cp"))
    text_files("u1,3,t,view", "u3,4,t,view")
    runs.drain(logs, on_batch, str(tmp_path / "cp"))
    got = spark.read.parquet(f"{tmp_path}/out")
    assert tuples(got, "product_id", "user_name") == [(1, "first"), (2, "other"), (3, "second"), (4, "unknown")]


def test_keyed_state(spark, text_files, tmp_path):
    folder = text_files("1,a,5", "2,b,1", "3,a,7")
    text_files("4,a,6", "5,b,3")
    text_files("6,c,0", "7,a,9")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("k", T.StringType()),
                           T.StructField("v", T.LongType())])

    def stream():
        return records.parse_delimited(files.line_stream(spark, folder, 1), schema)

    def run(name, **values):
        on_batch = running.running_batches(["k"], ["seq"], values, runs.keep_updates(f"{tmp_path}/{name}"), f"{tmp_path}/s{name}")
        runs.drain(stream(), on_batch, f"{tmp_path}/c{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    out = run("a", top=running.highest("v"), low=running.lowest("v"), n=running.count())
    assert tuples(out, "seq", "top", "low", "n") == [
        (1, 5, 5, 1), (2, 1, 1, 1), (3, 7, 5, 2), (4, 7, 5, 3), (5, 3, 1, 2), (6, 0, 0, 1), (7, 9, 5, 4)]
    out = run("b", total=running.total("v"), best=running.record_with_lowest("v", ["seq"]))
    assert tuples(out, "seq", "total", "best.record.seq") == [
        (1, 5, 1), (2, 1, 2), (3, 12, 1), (4, 18, 1), (5, 4, 2), (6, 0, 6), (7, 27, 1)]


def batches_of(spark, tmp_path, schema, *batches):
    """A stream of one file per batch, in this order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.02)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


def test_running_values_with_nulls_and_a_large_unordered_key(spark, tmp_path):
    n = 12_000  # more than an Arrow frame holds
    first = [(i, "a", None if i % 5 == 0 else i % 11) for i in range(n)][::-1]
    second = [(n + i, "a", None if i % 3 == 0 else 1) for i in range(n)][::-1] + [(-1, None, 4), (-2, None, None)]
    third = [(3 * n, "a", None), (3 * n + 1, None, 3), (3 * n + 2, "b", None)]
    stream = batches_of(spark, tmp_path, "seq long, k string, v long", first, second, third)
    values = {"total": running.total("v"), "top": running.highest("v"), "n": running.count()}
    on_batch = running.running_batches(["k"], ["seq"], values, runs.keep_updates(f"{tmp_path}/o"), f"{tmp_path}/s", Split(rows=3_000))
    runs.drain(stream, on_batch, f"{tmp_path}/c")
    held, want = {}, []
    for batch in (first, second, third):
        for seq, k, v in sorted(batch):
            total, top, count = held.get(k, (None, None, 0))
            if v is not None:
                total, top = (total or 0) + v, v if top is None else max(top, v)
            held[k] = total, top, count + 1
            want.append((seq, *held[k]))
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/o").select("seq", *values).collect())) == sorted(want)


def test_running_values_go_on_after_a_failure(spark, tmp_path):
    stream = batches_of(spark, tmp_path, "seq long, k string, v long", [(1, "a", 1)], [(2, "a", 2)], [(3, "a", 3)])
    state_of = {"fail": True}

    def write(df, batch_id):
        df.write.mode("overwrite").parquet(f"{tmp_path}/o/batch={batch_id}")
        if batch_id == 1 and state_of["fail"]:
            raise OSError("lost")

    on_batch = running.running_batches(["k"], ["seq"], {"total": running.total("v")}, write, f"{tmp_path}/s")
    with pytest.raises(Exception, match="lost"):
        runs.drain(stream, on_batch, f"{tmp_path}/c")
    state_of["fail"] = False
    runs.drain(stream, on_batch, f"{tmp_path}/c")
    assert tuples(spark.read.parquet(f"{tmp_path}/o"), "seq", "total") == [(1, 1), (2, 3), (3, 6)]


def test_state_with_time_to_live_counts_on_while_it_lives(spark, text_files, tmp_path):
    folder = text_files("a", "b", "a")
    text_files("a")
    stream = files.line_stream(spark, folder, 1).withColumnRenamed("value", "word")
    counted = state.stream_running_count(stream, ["word"], ttl="1 day")
    query = (counted.writeStream.format("parquet").option("path", f"{tmp_path}/o")
             .option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="1 second").start())
    # With state in processing time a query never runs out of batches: wait for the rows, not for its end.
    end = time.time() + 60
    try:
        while time.time() < end and sum(p.numInputRows for p in query.recentProgress) < 4:
            time.sleep(0.5)
    finally:
        query.stop()
    assert tuples(spark.read.parquet(f"{tmp_path}/o")) == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]


def test_unpaid_orders_are_cancelled(spark, text_files, tmp_path):
    folder = text_files(f"o1,u,2022-08-06 15:07:14.828,{to.UNPAID},11.2", f"o2,u,2022-08-06 15:07:15.000,{to.UNPAID},2.0")
    text_files("o2,u,2022-08-06 15:07:20.000,已付款,2.0")
    text_files(f"o3,u,2022-08-06 15:08:00.000,{to.UNPAID},3.0")
    text_files("o4,u,2022-08-06 15:08:05.000,已付款,4.0")
    stream = records.parse_delimited(files.line_stream(spark, folder, 1), sc.PAY_ORDER)
    stream = stream.withColumn("order_time", F.to_timestamp("order_time"))
    out = runs.drain_to_files(timers.stream_cancel_unpaid(stream), f"{tmp_path}/o", f"{tmp_path}/c")
    assert tuples(out.where(F.col("order_status") == to.CANCELLED), "order_id", "order_amount") == [("o1", 11.2)]
    assert tuples(out.where(F.col("order_status") != to.CANCELLED), "order_id") == [
        ("o1",), ("o2",), ("o2",), ("o3",), ("o4",)]


def test_csv_stream_with_watermark_and_sql(spark, text_files, tmp_path):
    folder = text_files("2022-04-01 09:00:01,r1,3", "2022-04-01 09:00:04,r1,4")
    text_files("2022-04-01 09:00:07,r1,5")
    stream = files.csv_stream(spark, folder, sc.ROAD_RECORD, watermark=("record_time", "0 seconds"), files_per_batch=1)
    stream.createOrReplaceTempView("road")
    out = spark.sql("""SELECT window.start AS win_start, road_id, SUM(record_count) AS total FROM road
                       GROUP BY WINDOW(record_time, '5 seconds'), road_id""")
    got = runs.drain_updates(out, f"{tmp_path}/o", f"{tmp_path}/c", ["win_start", "road_id"])
    assert [r[1:] for r in tuples(got)] == [("r1", 7), ("r1", 5)]


def test_rolling_files(spark, text_files, tmp_path):
    folder = text_files("2022-04-01 09:00:01,r1,3", "2022-04-01 10:00:04,r1,4")
    stream = files.csv_stream(spark, folder, sc.ROAD_RECORD)
    query = fs.rolling_files(stream, f"{tmp_path}/o", f"{tmp_path}/c", "record_time", ["road_id", "record_count"],
                             available_now=True)
    query.awaitTermination(120)
    got = spark.read.text(f"{tmp_path}/o")
    assert tuples(got) == [("(r1,3)", "2022-04-01--09"), ("(r1,4)", "2022-04-01--10")]


def test_windows_fire_before_they_are_complete(spark, text_files, tmp_path):
    folder = text_files("2022-04-01 09:00:01,r1,3")
    stream = files.csv_stream(spark, folder, sc.ROAD_RECORD, watermark=("record_time", "0 seconds"), files_per_batch=1)
    day = wn.daily_agg(stream, "record_time", {"total": Measure("sum", "record_count")})
    query = runs.early_firings(day, runs.keep_updates(f"{tmp_path}/o"), f"{tmp_path}/c", "1 second")
    end = time.time() + 90

    def seen(n):
        while time.time() < end and sum(p.numInputRows for p in query.recentProgress) < n:
            time.sleep(0.3)

    try:
        seen(1)
        text_files("2022-04-01 09:30:00,r1,4")
        seen(2)
    finally:
        query.stop()
    totals = spark.read.parquet(f"{tmp_path}/o").where("total is not null")
    assert sorted(r.total for r in totals.collect()) == [3, 7]


START, RECORD = dt.datetime(2024, 1, 1), "id long, k string, at timestamp, open boolean"


def recorded(n=120, seed=3):
    r, at, rows = random.Random(seed), 0, []
    for i in range(n):
        at += r.choice([0, 1, 4, 9])
        rows.append((i, r.choice(["a", "b", "c", "d", None]), START + dt.timedelta(seconds=max(0, at - r.choice([0, 0, 5, 15]))),
                     r.choice([True, True, False, None])))
    return rows


def in_parts(spark, tmp_path, rows, parts, kind=RECORD):
    """The rows as a stream of `parts` batches."""
    folder = f"{tmp_path}/in-{parts}-{len(os.listdir(tmp_path))}"
    cuts = [len(rows) * i // parts for i in range(parts + 1)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        spark.createDataFrame(rows[a:b], kind).coalesce(1).write.mode("append").parquet(folder)
        for name in os.listdir(folder):
            if os.path.getmtime(f"{folder}/{name}") > START.timestamp() + 100_000:
                os.utime(f"{folder}/{name}", (START.timestamp() + i, START.timestamp() + i))
    return spark.readStream.schema(spark.createDataFrame([], kind).schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("order", [[], ["id"]])
@pytest.mark.parametrize("parts", [1, 3, 6])
def test_overdue_rows(spark, tmp_path, parts, order):
    rows, wait, bound = recorded(), dt.timedelta(seconds=10), dt.timedelta(seconds=15)
    # The last rows are not open and have no key; the clock goes by them all the same.
    rows += [(len(rows), None, rows[-1][2] + dt.timedelta(seconds=60), False)]
    out = timers.overdue(in_parts(spark, tmp_path, rows, parts), ["k"], "at", F.col("open"), "10 seconds", "15 seconds", order)
    got = tuples(runs.drain_to_files(out, f"{tmp_path}/o", f"{tmp_path}/c"), "id")
    seen = max(x[2] for x in rows) - bound

    def follows(x, y):
        if y[2] == x[2]:
            return y[0] > x[0] if order else not y[3]
        return x[2] < y[2] <= x[2] + wait

    want = [(x[0],) for x in rows if x[3] and x[2] + wait < seen
            and not (x[1] is not None and any(follows(x, y) for y in rows if y[1] == x[1]))]
    assert len(want) > 5
    # At the last watermark itself Spark may wait for one more batch.
    last = {(x[0],) for x in rows if x[2] + wait == seen}
    assert [x for x in got if x not in last] == want


def test_deadlines_run_no_python(spark, tmp_path, capsys):
    stream = in_parts(spark, tmp_path, recorded(), 2).withColumn("s", F.when(F.col("open"), to.UNPAID).otherwise("x"))
    timers.stream_cancel_unpaid(stream, "k", "at", "s").explain()
    plan = capsys.readouterr().out
    assert "StreamingSymmetricHashJoin" in plan and "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("parts", [1, 3, 6])
def test_left_cogroup_of_streams(spark, tmp_path, parts):
    rows = recorded()
    left = spark.createDataFrame([x for x in rows if x[3]], RECORD).select("id", "k", F.col("at").alias("lt"))
    right = spark.createDataFrame([x for x in rows if x[3] is False], RECORD).select(F.col("id").alias("rid"), "k", F.col("at").alias("rt"))
    want = jn.window_cogroup(left, right, ["k"], "lt", "rt", "10 seconds", {"rid": -1})
    a = in_parts(spark, tmp_path, [x for x in rows if x[3]], parts).select("id", "k", F.col("at").alias("lt"))
    b = in_parts(spark, tmp_path, [x for x in rows if x[3] is False], parts).select(F.col("id").alias("rid"), "k", F.col("at").alias("rt"))
    # Both inputs are out of order, and cut at different times.
    out = jn.window_cogroup(a.withWatermark("lt", "200 seconds"), b.withWatermark("rt", "200 seconds"), ["k"], "lt", "rt",
                            "10 seconds", {"rid": -1})
    done = runs.drain_to_files(out, f"{tmp_path}/o", f"{tmp_path}/c").select("id", "k", "rid", "window_start").collect()
    got = sorted(map(tuple, done), key=str)
    # Rows without a key can't have a partner, and Spark drops them before they move the watermark.
    ends = min(max(x[2] for x in rows if x[3]), max(x[2] for x in rows if x[3] is False and x[1])) - dt.timedelta(seconds=200)
    closed = [tuple(r) for r in want.select("id", "k", "rid", "window_start", "window_end").collect()]
    assert any(x[2] == -1 and x[4] <= ends for x in closed) and any(x[2] == -1 and x[4] > ends for x in closed)
    assert got == sorted((x[:4] for x in closed if x[2] != -1 or x[4] <= ends), key=str)


@pytest.mark.parametrize("parts", [1, 3, 6])
def test_repeated_deliveries(spark, tmp_path, parts):
    rows = [x for x in recorded() if x[0] % 7]
    r = random.Random(parts)
    delivered = sorted([(i, x) for i, x in enumerate(rows)] + [(i + r.randrange(40), x) for i, x in enumerate(rows) if x[0] % 2],
                       key=lambda p: p[0])
    stream = in_parts(spark, tmp_path, [x for _, x in delivered], parts)
    out = sw.without_repeats(stream, ["id", "k"], "at", "500 seconds")
    got = runs.drain_to_files(out, f"{tmp_path}/o", f"{tmp_path}/c")
    assert sorted(map(tuple, got.collect())) == sorted(rows)
