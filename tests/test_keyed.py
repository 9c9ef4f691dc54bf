"""Keyed aggregates, running values and folds; the cut form must equal the plain one."""

import random
from itertools import accumulate

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from flowtables import queries
from flowtables.operators import aggregates as ag
from flowtables.operators import outputs as op
from flowtables.operators import running as rn
from flowtables.plans import scan as s
from flowtables.plans.chunks import CHUNK, Split, ordered_chunks

DISTRICT = [("上海", "浦东新区", 777), ("上海", "闵行区", 999), ("上海", "杨浦区", 666), ("北京", "东城区", 567),
            ("北京", "西城区", 987), ("上海", "静安区", 888), ("北京", "海淀区", 9999)]
TINY = Split(rows=7)


@pytest.fixture
def district(rows):
    return rows([(i, *r) for i, r in enumerate(DISTRICT)], "seq int, city string, district string, value int")


def test_running_field_max(district):
    out = rn.running_field_max(district, ["city"], ["seq"], "value")
    assert [(r.city, r.district, r.value) for r in out.orderBy("seq_seq").collect()] == [
        ("上海", "浦东新区", 777), ("上海", "浦东新区", 999), ("上海", "浦东新区", 999), ("北京", "东城区", 567),
        ("北京", "东城区", 987), ("上海", "浦东新区", 999), ("北京", "东城区", 9999)]


def test_running_record_max(district):
    out = rn.running_record_max(district, ["city"], ["seq"], "value")
    assert [(r.city, r.district, r.value) for r in out.orderBy("seq_seq").collect()] == [
        ("上海", "浦东新区", 777), ("上海", "闵行区", 999), ("上海", "闵行区", 999), ("北京", "东城区", 567),
        ("北京", "西城区", 987), ("上海", "闵行区", 999), ("北京", "海淀区", 9999)]


def test_final_forms(district):
    assert tuples(ag.field_max(district, ["city"], "value", ["seq"]), "city", "district", "value") == [
        ("上海", "浦东新区", 999), ("北京", "东城区", 9999)]
    assert tuples(ag.record_max(district, ["city"], "value", ["seq"]), "city", "district", "value") == [
        ("上海", "闵行区", 999), ("北京", "海淀区", 9999)]
    assert tuples(ag.record_min(district, ["city"], "value", ["seq"]), "city", "district", "value") == [
        ("上海", "杨浦区", 666), ("北京", "东城区", 567)]


def test_ties_keep_the_first_record(rows):
    df = rows([(1, "k", "a", 5), (2, "k", "b", 5), (3, "k", "c", 1), (4, "k", "d", 1)],
              "seq int, k string, name string, v int")
    assert ag.record_max(df, ["k"], "v", ["seq"]).first().name == "a"
    assert ag.record_min(df, ["k"], "v", ["seq"]).first().name == "c"
    names = [r.name for r in rn.running_record_max(df, ["k"], ["seq"], "v").orderBy("seq_seq").collect()]
    assert names == ["a", "a", "a", "a"]


def test_running_state_max(rows):
    values = [("上海", 488), ("上海", 100), ("北京", 823), ("北京", 234), ("上海", 888), ("上海", 666), ("北京", 323),
              ("上海", 344)]
    out = rn.running_max(rows([(i, *v) for i, v in enumerate(values)], "seq int, city string, v long"), ["city"],
                         ["seq"], "v")
    assert [r.running_max for r in out.orderBy("seq").collect()] == [488, 488, 823, 823, 888, 888, 823, 888]


def skewed(rows, n=400, seed=1):
    """A third of the rows have one key, keys and values may be NULL."""
    r = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if r.random() < 0.34 else r.choice([None, *[f"k{j}" for j in range(40)]])
        data.append((i, key, r.choice([None, *range(-5, 50)])))
    r.shuffle(data)
    return rows(data, "seq long, k string, v long"), sorted(data)


def by_key(data):
    groups = {}
    for seq, k, v in data:
        groups.setdefault(k, []).append((seq, v))
    return groups


@pytest.mark.parametrize("split", [TINY, Split(rows=2)])  # few bounds and many
def test_cut_scan_equals_plain_python(rows, split):
    df, data = skewed(rows)
    values = {"total": s.total("v"), "no": s.row_number(), "high": s.highest("v"), "low": s.lowest("v"),
              "prev_high": s.highest("v", before=True), "seen": s.latest("v", ["seq"]),
              "first": s.first("v", ["seq"]), "prev": s.latest("v", ["seq"], before=True)}
    chunked = ordered_chunks(df, ["k"], ["seq"], split)
    assert (chunked.chunks > 64) == (split.rows == 2)
    assert chunked.is_cut and ("hot",) in chunked.keys_cut
    assert chunked.df.groupBy("k", CHUNK).count().agg(F.max("count")).first()[0] < 40
    got = {r.seq: r for r in s.scan_chunked(chunked, values).df.collect()}
    assert len(got) == len(data)
    for items in by_key(data).values():
        seen, before = [], []
        for no, (seq, v) in enumerate(items, 1):
            if v is not None:
                seen.append(v)
            r = got[seq]
            assert r.no == no
            assert r.total == (sum(seen) if seen else None)
            assert (r.high, r.low) == ((max(seen), min(seen)) if seen else (None, None))
            assert r.prev_high == (max(before) if before else None)
            assert r.seen == (seen[-1] if seen else None)
            assert r.prev == (before[-1] if before else None)
            assert r.first == items[0][1]
            before = list(seen)


def test_cut_scan_without_key_and_with_ties_in_the_first_order_column(rows):
    data = [(i // 50, i, i % 7) for i in range(300)]
    df = rows(data, "t long, seq long, v long")
    chunked = ordered_chunks(df, [], ["t", "seq"], TINY)
    assert chunked.chunks > 20
    out = s.scan_chunked(chunked, {"x": s.total("v")}).df
    assert [r.x for r in out.orderBy("seq").collect()] == list(accumulate(v for *_, v in data))


def test_cut_and_plain_have_the_same_schema(rows):
    df, _ = skewed(rows)
    value = F.col("v").cast("decimal(18,2)")
    plain = rn.running_sum(df, ["k"], ["seq"], value)
    cut = rn.running_sum(df, ["k"], ["seq"], value, split=TINY)
    assert plain.schema == cut.schema
    assert tuples(plain.where("v is not null and k is not null")) == tuples(cut.where("v is not null and k is not null"))


def test_running_records_when_cut(rows):
    df, data = skewed(rows)
    df = df.where("v is not null and k is not null")
    for fn in (rn.running_record_max, rn.running_record_min, rn.running_field_max):
        assert tuples(fn(df, ["k"], ["seq"], "v")) == tuples(fn(df, ["k"], ["seq"], "v", split=TINY))


def test_expiring_sum(rows):
    df = rows([("a", 0), ("a", 3), ("a", 9), ("b", 1), ("a", 14), ("a", 18)], "k string, s long")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    for split in (Split(), Split(rows=2)):
        out = rn.expiring_sum(df, ["k"], "ts", "5 seconds", split=split)
        assert tuples(out, "k", "s", "running_count") == [
            ("a", 0, 1), ("a", 3, 2), ("a", 9, 1), ("a", 14, 1), ("a", 18, 2), ("b", 1, 1)]


def test_reduce_by_is_ordered(rows):
    data = [(i, "k" if i % 3 else "l", str(i)) for i in range(100)]
    df = rows(random.Random(3).sample(data, 100), "seq int, k string, v string")
    out = dict(tuples(ag.reduce_by(df, ["k"], "v", ["seq"], lambda a, b: F.concat(a, F.lit(","), b), fan_in=4,
                                   split=TINY)))
    for k in "kl":
        assert out[k] == ",".join(v for _, key, v in data if key == k)


def test_combine_in_pandas(spark):
    df = spark.range(0, 50_000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        F.col("id").alias("v"))
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("total", T.LongType())])
    out = ag.combine_in_pandas(
        df, ["k"], lambda p: p.groupby("k", as_index=False).agg(n=("v", "size"), total=("v", "sum")),
        lambda p: p.groupby("k", as_index=False).agg(n=("n", "sum"), total=("total", "sum")), schema)
    assert tuples(out) == tuples(df.groupBy("k").agg(F.count("v"), F.sum("v")))


def test_side_outputs(spark):
    df = spark.range(1, 11)
    even = F.col("id") % 2 == 0
    out = op.split_outputs(df, {"even": even, "odd": ~even})
    assert [r.id for r in out["odd"].orderBy("id").collect()] == [1, 3, 5, 7, 9]
    assert [r.id for r in out["even"].orderBy("id").collect()] == [2, 4, 6, 8, 10]
    both = op.tag_rows(df, {"even": even, "big": F.col("id") > 8})
    assert tuples(both.where("tag = 'big'"), "id") == [(9,), (10,)]


@pytest.mark.parametrize("ids", [
    [], [0, 1, 2, 3, None], [-5, 2**26, -2**26 - 1, 94_906_267],
    [2**31 - 1, 2**31 - 1], [2**31, 2**31],  # the squares' total just fits and just doesn't
    [3_000_000_001], [2**31, 1, 1],  # one fits, by its bound or only when added up
    [3_000_000_000, 3_000_000_000, 7], [-2**63], [2**63 - 1, 1]])
def test_totals_of_side_outputs_beyond_a_bigint(spark, tmp_path, ids):
    spark.createDataFrame([(i,) for i in ids], "event_id long").write.parquet(f"{tmp_path}/events.parquet")
    out = queries.side_outputs(spark, str(tmp_path))
    want = {"main": [i and i * i for i in ids]}
    for i in ids:
        if i is not None:
            want.setdefault("odd" if i % 2 else "even", []).append(i)
    totals = {tag: sum(i or 0 for i in numbers) for tag, numbers in want.items() if numbers}
    assert tuples(out, "tag", "n", "total") == sorted((tag, len(want[tag]), total) for tag, total in totals.items())
    fits = all(-2**63 <= total < 2**63 for total in totals.values())
    assert out.schema["total"].dataType.simpleString() == ("bigint" if fits else "decimal(38,0)")


def test_counted(spark):
    df, seen = ag.counted(spark.range(10), "c", even=F.col("id") % 2 == 0)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}


def test_top_rated_is_stable(rows):
    df = rows([("m1", 5.0)] * 3 + [("m2", 5.0)] * 3 + [("m3", 1.0)] * 2, "m string, r double")
    assert [r.m for r in ag.top_rated(df, "m", "r", 2).collect()] == ["m1", "m2"]


def test_empty_input(rows):
    df = rows([], "seq long, k string, v long")
    assert rn.running_sum(df, ["k"], ["seq"], "v").count() == 0
    assert rn.running_sum(df, [], ["seq"], "v").count() == 0
    assert ag.reduce_by(df, ["k"], "v", ["seq"], lambda a, b: a + b).count() == 0


def test_expiring_sum_with_nulls(rows):
    data = [(1, "a", 0, 5), (2, "a", 10, 6), (3, "a", 500, None), (4, "a", 510, 7), (5, "b", 1, None)]
    df = rows(data, "seq long, k string, s long, v long").withColumn("ts", F.timestamp_seconds("s"))
    for split in (Split(), Split(rows=2)):
        out = rn.expiring_sum(df, ["k"], "ts", "1 minute", "v", ["seq"], "total", split)
        assert tuples(out, "seq", "total") == [(1, 5), (2, 11), (3, 0), (4, 7), (5, 0)]
    with pytest.raises(TypeError):
        rn.expiring_sum(df.withColumn("v", F.lit(0.1)), ["k"], "ts", "1 minute", "v")


@pytest.mark.parametrize("split", [Split(rows=65_536), Split(rows=20)])
def test_running_reduce_in_order(rows, split):
    r = random.Random(4)
    data = [(i, r.choice(["a", "a", "a", "b", None]), r.choice([None, "x", "y", "z"])) for i in range(150)]
    df = rows(r.sample(data, len(data)), "seq long, k string, v string")
    join = lambda a, b: F.concat(F.coalesce(a, F.lit("-")), F.coalesce(b, F.lit("-")))
    out = rn.running_reduce(df, ["k"], ["seq"], F.coalesce("v", F.lit("-")), join, "so_far", split)
    held, want = {}, []
    for seq, k, v in data:
        held[k] = held.get(k, "") + (v or "-")
        want.append((seq, held[k]))
    assert tuples(out, "seq", "so_far") == want


def test_bounds_of_all_types_are_searched_as_they_are(spark):
    columns = {"long": "id", "timestamp": "timestamp_seconds(1729990000 + id * 1800)", "timestamp_ntz": "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)",
               "date": "date_add(date'1999-12-31', cast(id as int))", "decimal(20,4)": "cast(id as decimal(20,4)) / 7", "double": "id / 3.0D",
               "string": """concat('"\\'\\n', lpad(id, 5, '0'), 'ö')""", "binary": "cast(lpad(id, 5, '0') as binary)"}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # an hour comes twice in the data
        for kind, value in columns.items():
            df = spark.range(600).selectExpr("id", "IF(id % 3 = 0, NULL, 'k') AS k", f"cast({value} as {kind}) AS o")
            chunked = ordered_chunks(df, ["k"], ["o"], Split(rows=2))
            assert chunked.chunks > 64 and set(chunked.keys_cut) == {(None,), ("k",)}
            out = s.scan_chunked(chunked, {"n": s.row_number()}).df
            assert all(r.n == (r.id // 3 + 1 if r.k is None else r.id - r.id // 3) for r in out.collect()), kind
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_plans_of_thousands_of_bounds_stay_small(spark):
    # A join on the chunk used to put every halving of the search into the next: thousands of bounds filled any driver.
    df = spark.range(0, 12_000, 1, 4).selectExpr("id", "IF(id % 3 = 0, 'a', 'b') AS k", "id % 11 AS v")
    split = Split(rows=3)
    assert ordered_chunks(df, ["k"], ["id"], split).chunks > 3_000
    cut = rn.running_sum(df, ["k"], ["id"], "v", split=split)
    assert len(cut._jdf.queryExecution().optimizedPlan().treeString()) < 5_000_000
    plain = rn.running_sum(df, ["k"], ["id"], "v")
    assert cut.exceptAll(plain).isEmpty() and cut.count() == 12_000
