"""Windows, late data and joins on the sample inputs, and against brute force."""

import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from flowtables import schemas as sc
from flowtables.functions import times as tm
from flowtables.operators import count_windows as cw
from flowtables.operators import joins as jn
from flowtables.operators import late as lt
from flowtables.operators import timeouts as to
from flowtables.operators import windows as wn
from flowtables.operators.aggregates import Measure
from flowtables.plans.broadcasting import Limit, broadcast_if_small
from flowtables.plans.chunks import Split
from flowtables.sources import records

TINY = Split(rows=5)
FLOW = {"flow": Measure("sum", "flow")}

# Own records; the results the tests expect were worked out by hand.
MAIN = ["2023-09-12 14:20:03,m1,ann,oak street 1,12.00",
        "2023-09-12 14:20:09,m2,bob,elm street 2,30.00",
        "2023-09-12 14:20:16,m3,cem,ash street 3,7.50",
        "2023-09-12 14:20:28,m4,dia,fir street 4,0.00"]
DETAIL = ["2023-09-12 14:20:04,m1,d1,bread,2,6.00", "2023-09-12 14:20:04,m1,d2,salt,1,6.00",
          "2023-09-12 14:20:08,m2,d1,lamp,1,30.00",
          "2023-09-12 14:20:17,m3,d1,pen,5,5.00", "2023-09-12 14:20:18,m3,d2,ink,1,2.50",
          "2023-09-12 14:20:31,m4,d1,rope,1,0.00"]
ORDERS = ["p1,zoe,5.00,2023-09-12 10:30:01", "p2,zoe,7.50,2023-09-12 10:30:05", "p3,zoe,2.25,2023-09-12 10:30:09",
          "p4,zoe,20.00,2023-09-12 10:30:11", "p5,zoe,1.75,2023-09-12 10:30:08", "p6,zoe,3.00,2023-09-12 10:30:13",
          "p7,zoe,4.00,2023-09-12 10:30:07", "p8,zoe,6.00,2023-09-12 10:30:16", "p9,zoe,9.99,2023-09-12 10:30:02",
          "p10,zoe,11.00,2023-09-12 10:30:24"]


def lines(rows, data):
    return rows([(x,) for x in data], "value string")


def at(df, source, target):
    return df.withColumn(target, tm.from_text(source))


def clock(df, *columns):
    return [(*[r[c] for c in columns], r.window_start.strftime("%H:%M:%S"), r.window_end.strftime("%H:%M:%S"))
            for r in df.collect()]


@pytest.fixture
def main(rows):
    return at(records.parse_delimited(lines(rows, MAIN), sc.MAIN_ORDER), "order_time", "mt")


@pytest.fixture
def detail(rows):
    return at(records.parse_delimited(lines(rows, DETAIL), sc.DETAIL_ORDER), "detail_time", "dt")


def gate(rows, *data):
    df = rows([("2022-04-01 09:00:" + s, g, f) for s, g, f in data], sc.GATE_FLOW_EVENT)
    return at(df, "event_time", "ts")


def test_tumbling_event_time(rows):
    df = gate(rows, ("01", "a", 1), ("02", "a", 1), ("05", "a", 1), ("10", "a", 1), ("11", "a", 1), ("14", "b", 1),
              ("15", "b", 1))
    out = wn.tumbling_agg(df, "ts", "5 seconds", FLOW, ["gate"])
    assert sorted(clock(out, "gate", "flow")) == [
        ("a", 1, "09:00:05", "09:00:10"), ("a", 2, "09:00:00", "09:00:05"), ("a", 2, "09:00:10", "09:00:15"),
        ("b", 1, "09:00:10", "09:00:15"), ("b", 1, "09:00:15", "09:00:20")]


def test_sliding_panes_equal_spark_windows(rows):
    r = random.Random(5)
    df = gate(rows, *[(f"{r.randrange(60):02d}", r.choice("ab"), r.randrange(9)) for _ in range(80)])
    m = {"flow": Measure("sum", "flow"), "n": Measure("count"), "hi": Measure("max", "flow"), "lo": Measure("min", "flow")}
    for size, slide in (("10 seconds", "5 seconds"), ("7 seconds", "3 seconds")):
        plain = df.groupBy("gate", F.window("ts", size, slide)).agg(
            F.sum("flow"), F.count("flow"), F.max("flow"), F.min("flow"))
        want = sorted((x.gate, x.window.start, x.window.end, *x[2:]) for x in plain.collect())
        assert tuples(wn.sliding_agg(df, "ts", size, slide, m, ["gate"])) == want
    plain = df.groupBy(F.window("ts", "30 seconds", "5 seconds")).agg(
        F.sum("flow"), F.count("flow"), F.max("flow"), F.min("flow"))
    want = sorted((x.window.start, x.window.end, *x[1:]) for x in plain.collect())
    assert tuples(wn.sliding_agg(df, "ts", "30 seconds", "5 seconds", m)) == want


def test_daily_total_in_another_zone(rows):
    data = [("2022-08-04 15:59:59", 40.0), ("2022-08-04 16:00:00", 99.0), ("2022-08-05 15:59:59", 100.0)]
    df = at(rows(data, "t string, money double"), "t", "ts")
    out = wn.daily_agg(df, "ts", {"money": Measure("sum", "money")}, offset="-8 hours")
    local = out.select(F.date_format(F.from_utc_timestamp("window_start", "Asia/Shanghai"), "yyyy-MM-dd"), "money")
    assert tuples(local) == [("2022-08-04", 40.0), ("2022-08-05", 199.0)]


def test_session_gap_is_inclusive(rows):
    df = gate(rows, ("00", "a", 1), ("05", "a", 2), ("11", "a", 4))
    out = wn.session_agg(df, "ts", "5 seconds", FLOW)
    assert sorted(clock(out, "flow")) == [(3, "09:00:00", "09:00:10"), (4, "09:00:11", "09:00:16")]


@pytest.mark.parametrize("buckets", [1, 2, 5, 4096])
def test_sessions_against_brute_force(rows, buckets):
    r = random.Random(buckets)
    keys_of = ["a"] * 20 + list("bcdefghijkl")
    data = sorted((r.choice(keys_of), r.randrange(3000)) for _ in range(250))
    df = rows(data, "k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    for keys in (["k"], []):
        want, groups = [], {}
        for k, t in data:
            groups.setdefault(k if keys else "", []).append(t)
        for k, times in groups.items():
            run = []
            for t in [*sorted(times), None]:
                if run and (t is None or t - run[-1] > 10):
                    want.append((*([k] if keys else []), run[0], run[-1] + 10, len(run)))
                    run = []
                run.append(t)
        for split in (Split(), Split(rows=20)):
            out = wn.session_agg(df, "ts", "10 seconds", {"n": Measure("count")}, keys, buckets, split)
            got = out.select(*keys, F.unix_seconds("window_start"), F.unix_seconds("window_end"), "n")
            assert tuples(got) == sorted(want)


@pytest.mark.parametrize("size,slide", [(5, 5), (5, 2), (3, 4), (6, 2), (1, 1), (4, 9)])
def test_count_windows_against_brute_force(rows, size, slide):
    for n in (0, 3, 10, 47):
        values = [(i * 3) % 11 for i in range(n)]
        df = rows(random.Random(n).sample(list(enumerate(values)), n), "seq long, v long")
        want = [(k, sum(values[max(0, k * slide - size):k * slide])) for k in range(1, n // slide + 1)]
        for split in (Split(), TINY):
            out = cw.count_window(df, ["seq"], size, {"total": Measure("sum", "v")}, slide, split)
            assert tuples(out, "window_no", "total") == want


def test_count_window_samples(rows):
    df = rows(list(enumerate([1, 1, 1, 2, 3, 4, 5, 6, 4, 3])), "seq long, v long")
    for size, slide, want in ((5, 5, [8, 22]), (5, 2, [2, 5, 11, 20, 22]), (3, 4, [4, 15])):
        out = cw.count_window(df, ["seq"], size, {"t": Measure("sum", "v")}, slide)
        assert [r.t for r in out.orderBy("window_no").collect()] == want


def orders(rows):
    df = rows(list(enumerate(ORDERS)), "arr long, value string")
    return at(records.parse_delimited(df, sc.ORDER_EVENT, keep=["arr"]), "order_time", "ts")


RULE = lt.Lateness("10 seconds", "2 seconds", "3 seconds")


@pytest.mark.parametrize("split", [Split(), TINY])
def test_order_report_with_late_data(rows, split):
    df = orders(rows)
    seen = lt.classify(df, "ts", ["arr"], RULE, split=split)
    status = {r.order_id: r.status for r in seen.collect()}
    assert status["p7"] == lt.REFIRE and status["p9"] == lt.LATE
    assert sum(v == lt.ON_TIME for v in status.values()) == 8
    on_time, late = lt.split_late(df, "ts", ["arr"], RULE, split)
    assert tuples(late, "user_id", "order_money") == [("zoe", 9.99)]
    assert on_time.count() == 9
    exact = {"total_money": Measure("sum", "order_money", exact=True)}
    out = lt.window_totals(seen, exact, ["user_id"])
    assert sorted((s, float(v)) for v, s, _ in clock(out, "total_money")) == [
        ("10:30:00", 20.5), ("10:30:10", 29.0), ("10:30:20", 11.0)]
    money = seen.withColumn("order_money", F.col("order_money").cast("decimal(18,2)"))
    fired = lt.window_firings(money, "order_money", ["arr"], ["user_id"], split=split)
    assert sorted((s, n, float(v)) for n, v, s, _ in clock(fired, "firing", "total")) == [
        ("10:30:00", 0, 16.5), ("10:30:00", 1, 20.5), ("10:30:10", 0, 29.0), ("10:30:20", 0, 11.0)]


@pytest.mark.parametrize("bound,allowed", [(0, 0), (2, 0), (0, 5), (2, 5)])
def test_late_rules_against_brute_force(rows, bound, allowed):
    r = random.Random(bound * 10 + allowed)
    data = [(i, max(0, i // 2 + r.randrange(-12, 12)), r.randrange(5)) for i in range(120)]
    df = rows(data, "arr long, s long, v long").withColumn("ts", F.timestamp_seconds("s"))
    want, m = {}, None
    for i, t, _ in data:
        end = t // 5 * 5 + 5
        want[i] = (lt.ON_TIME if m is None or m < end + bound else
                   lt.REFIRE if m < end + bound + allowed else lt.LATE)
        m = t if m is None else max(m, t)
    rule = lt.Lateness("5 seconds", f"{bound} seconds", f"{allowed} seconds")
    for split in (Split(), TINY):
        assert dict(tuples(lt.classify(df, "ts", ["arr"], rule, split=split), "arr", "status")) == want


def test_window_without_rows_on_time_fires_for_later_ones(rows):
    df = rows([(0, 10, 1), (1, 3, 5), (2, 4, 6)], "arr long, s long, v long").withColumn("ts", F.timestamp_seconds("s"))
    seen = lt.classify(df, "ts", ["arr"], lt.Lateness("5 seconds", allowed="30 seconds"))
    out = lt.window_firings(seen, "v", ["arr"])
    assert tuples(out, "firing", "total") == [(0, 1), (1, 5), (2, 11)]


def test_window_join(main, detail):
    out = jn.window_join(main, detail, ["order_id"], "mt", "dt", "5 seconds")
    assert [r[0] for r in tuples(out, "order_id", "detail_id")] == (
        ["m1"] * 2 + ["m2"] + ["m3"] * 2)


def test_window_cogroup(main, detail):
    out = jn.window_cogroup(main, detail, ["order_id"], "mt", "dt", "5 seconds", sc.DETAIL_DEFAULTS)
    assert [r[0] for r in tuples(out, "order_id")] == (
        ["m1"] * 2 + ["m2"] + ["m3"] * 2 + ["m4"])
    alone = out.where("order_id = 'm4'").first()
    assert (alone.goods_number, alone.detail_money, alone.goods_name, alone.detail_id) == (0, 0.0, None, None)


def test_interval_join(main, detail):
    out = jn.interval_join(main, detail, ["order_id"], "mt", "dt", "-1 seconds", "2 seconds")
    assert sorted(r[0] for r in tuples(out, "order_id")) == (
        ["m1"] * 2 + ["m2"] + ["m3"] * 2)


def test_interval_bounds_are_inclusive(rows):
    m = rows([("k", 10)], "k string, s long").select("k", F.timestamp_seconds("s").alias("a"))
    d = rows([("k", s) for s in (8, 9, 12, 13)] + [("l", 10)], "k string, s long").select(
        "k", "s", F.timestamp_seconds("s").alias("b"))
    assert tuples(jn.interval_join(m, d, ["k"], "a", "b", "-1 seconds", "2 seconds"), "s") == [(9,), (12,)]
    assert tuples(jn.interval_join(m, d, ["k"], "a", "b", "-1 seconds", "-1 seconds"), "s") == [(9,)]


def test_interval_join_against_brute_force(rows):
    r = random.Random(9)
    a = [(i, r.choice("xxxyz"), r.randrange(-50, 50)) for i in range(60)]
    b = [(i, r.choice("xxxyz"), r.randrange(-50, 50)) for i in range(60)]
    m = rows(a, "i long, k string, s long").select("i", "k", F.timestamp_seconds("s").alias("a"))
    d = rows(b, "j long, k string, s long").select("j", "k", F.timestamp_seconds("s").alias("b"))
    want = sorted((i, j) for i, k, s in a for j, l, t in b if k == l and s - 3 <= t <= s + 7)
    assert tuples(jn.interval_join(m, d, ["k"], "a", "b", "-3 seconds", "7 seconds"), "i", "j") == want


def test_lookups(rows):
    scores = rows([(1, "语文", 50), (2, "语文", 60), (9, "数学", 1)], sc.SCORE).withColumnRenamed("stu_id", "id")
    students = rows([(1, "张三"), (2, "李四"), (3, "王五")], sc.STUDENT)
    out = jn.lookup_join(scores, students, ["id"], {"name": "未知"})
    assert tuples(out, "name", "course", "score") == [
        ("张三", "语文", 50), ("未知", "数学", 1), ("李四", "语文", 60)]
    versions = rows([("u1", "old", 1), ("u1", "new", 2)], "user_id string, user_name string, seq int")
    logs = rows([("u1", 7), ("u2", 8)], "user_id string, product_id int")
    newest = jn.newest_lookup_join(logs, versions, ["user_id"], ["seq"], {"user_name": "unknown"})
    assert tuples(newest) == [("u1", 7, "new"), ("u2", 8, "unknown")]


def test_broadcast_only_when_measured_small(rows):
    df = rows([(i, "x" * 10) for i in range(100)], "i int, t string")
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(df))
    assert not hinted(broadcast_if_small(df, Limit(rows=99)))
    assert not hinted(broadcast_if_small(df, Limit(bytes=500)))


@pytest.mark.parametrize("split", [Split(), TINY])
def test_asof_lookup(rows, split):
    logs = rows([("u", 1), ("u", 4), ("v", 5), ("u", 9), ("w", 9)] + [("u", i) for i in range(20, 40)],
                "user_id string, seq long")
    versions = rows([("u", 2, "A"), ("u", 9, "B"), ("v", 6, "C"), ("u", 30, None)],
                    "user_id string, seq long, name string")
    out = jn.asof_lookup(logs, versions, ["user_id"], ["seq"], {"name": "name"}, split=split)
    assert tuples(out.fillna("-"))[:1] == [("u", 1, "-")]
    got = {(u, q): n for u, q, n in tuples(out.fillna("-"))}
    assert got["u", 4] == "A" and got["v", 5] == "-" and got["u", 9] == "B" and got["w", 9] == "-"
    assert got["u", 29] == "B" and got["u", 30] == "-" and got["u", 39] == "-"


def test_cancel_unpaid(rows):
    data = [("o1", "u", "2022-08-06 15:07:14.828", to.UNPAID, 11.2), ("o2", "u", "2022-08-06 15:07:14.828", to.UNPAID, 1.0),
            ("o3", "u", "2022-08-06 15:07:20.000", to.UNPAID, 1.0), ("o4", "u", "2022-08-06 15:07:14.828", "已付款", 1.0)]
    df = rows(data, sc.PAY_ORDER).withColumn("order_time", F.to_timestamp("order_time"))
    paid = rows([("o2", 1, to.UNPAID), ("o2", 2, "已付款")], "order_id string, seq int, order_status string")
    assert df.select(to.deadline("order_time").cast("string")).first()[0] == "2022-08-06 15:07:29"
    for moment, want in (("15:07:28.999", []), ("15:07:29", [("o1", to.CANCELLED)])):
        as_of = F.lit(f"2022-08-06 {moment}").cast("timestamp")
        out = to.cancel_unpaid(df, as_of, statuses=paid, order=["seq"])
        assert tuples(out, "order_id", "order_status") == want


def test_firings_of_null_keys_and_null_values(rows):
    data = [(0, None, 1, 10), (1, None, 4, None), (2, None, 11, 1), (3, None, 3, 5), (4, "a", 12, None), (5, None, 2, None)]
    df = rows(data, "arr long, k string, s long, v long").withColumn("ts", F.timestamp_seconds("s"))
    seen = lt.classify(df, "ts", ["arr"], lt.Lateness("10 seconds", allowed="30 seconds"))
    out = lt.window_firings(seen, "v", ["arr"], ["k"]).select("k", F.unix_seconds("window_start"), "firing", "total")
    assert {tuple(r) for r in out.collect()} == {
        (None, 0, 0, 10), (None, 0, 1, 15), (None, 0, 2, 15), (None, 10, 0, 1), ("a", 10, 0, None)}


def test_types_of_sessions_do_not_depend_on_the_cut(rows):
    data = [(i % 3, i) for i in range(300)]
    df = rows(data, "k long, s long").withColumn("ts", F.timestamp_seconds("s")).withColumn("v", F.col("s") / 3)
    exact = {"total": Measure("sum", "v", exact=True), "mean": Measure("count")}
    whole, cut = (wn.session_agg(df, "ts", "1 second", exact, ["k"], split=s) for s in (Split(), Split(rows=50)))
    assert whole.dtypes == cut.dtypes and tuples(whole) == tuples(cut)
    assert [f.dataType for f in wn.session_agg(df, "ts", "1 second", exact).schema][-2:] == [f.dataType for f in whole.schema][-2:]


def test_defaults_are_for_rows_without_a_partner_only(rows):
    left = rows([(1, "2023-01-01 00:00:01"), (2, "2023-01-01 00:00:01"), (3, "2023-01-01 00:00:01")], "k int, a string")
    right = rows([(1, "2023-01-01 00:00:02", None), (2, "2023-01-01 00:00:02", 5)], "k int, b string, v int")
    left, right = at(left, "a", "lt"), at(right, "b", "rt")
    want = [(1, None), (2, 5), (3, -1)]
    out = jn.window_cogroup(left, right, ["k"], "lt", "rt", "5 seconds", {"v": -1})
    assert sorted(map(tuple, out.select("k", "v").collect())) == want and "__hit" not in out.columns
    for limit in (None, Limit(), Limit(rows=1)):
        out = jn.lookup_join(left, right, ["k"], {"v": -1}, limit)
        assert sorted(map(tuple, out.select("k", "v").collect())) == want and "__hit" not in out.columns
    versions = right.select("k", F.lit(0).alias("seq"), "v")
    out = jn.asof_lookup(left.withColumn("seq", F.lit(1)), versions, ["k"], ["seq"], {"v": "v"}, {"v": -1})
    assert sorted(map(tuple, out.select("k", "v").collect())) == want and "__hit" not in out.columns


def test_paid_orders_are_not_cancelled_by_default(rows):
    day = F.lit("2023-01-02").cast("timestamp")
    df = rows([("a", "2023-01-01 00:00:01", to.UNPAID), ("a", "2023-01-01 00:00:09", "paid"), ("b", "2023-01-01 00:00:02", to.UNPAID)],
              "order_id string, t string, order_status string").select(
        "order_id", F.to_timestamp("t").alias("order_time"), "order_status")
    assert tuples(to.cancel_unpaid(df, day), "order_id") == [("b",)]


def test_a_key_above_the_bound_is_always_cut(rows):
    from flowtables.plans.chunks import ordered_chunks
    df = rows([(0 if i < 8_000 else i % 400, i) for i in range(40_000)], "k long, seq long")
    chunked = ordered_chunks(df, ["k"], ["seq"], Split(rows=2_000))
    assert (0,) in chunked.keys_cut
    largest = chunked.df.where("k = 0").groupBy("__chunk").count().agg(F.max("count")).first()[0]
    assert largest <= 4_000
