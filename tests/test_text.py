"""Text records: the traps of trimming, splitting and parsing."""

from conftest import tuples
from pyspark.sql import functions as F

from flowtables import schemas as sc
from flowtables.functions import text as tx
from flowtables.functions import times as tm
from flowtables.operators import aggregates as ag
from flowtables.sources import files, records

WORDS = ["north south north", "east", "south south west north", "west east north"]


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()[0]


def test_trim_strips_control_characters(spark):
    assert one(spark, tx.trim_control("v"), v="\t\x01 a b\r\n ") == "a b"


def test_fields_drop_empty_ones_at_the_end_only(spark):
    assert one(spark, tx.fields("v"), v="a,b,,") == ["a", "b"]
    assert one(spark, tx.fields("v"), v=",a,,b") == ["", "a", "", "b"]
    assert one(spark, tx.fields("v"), v=",,") == []
    assert one(spark, tx.fields("v"), v="") == [""]
    assert one(spark, tx.fields("v", "\x01"), v="a\x01b\x01") == ["a", "b"]
    assert one(spark, tx.fields("v", "|"), v="a|b|") == ["a", "b"]
    assert one(spark, tx.field_count("v"), v=" a,b,,\n") == 2


def test_tokens_with_and_without_trim(spark):
    assert one(spark, tx.tokens("v"), v="  a  b ") == ["a", "b"]
    assert one(spark, tx.tokens("v", trim=False), v="  a  b ") == ["", "a", "b"]


def test_word_count(spark, rows):
    out = ag.word_count(rows([(w,) for w in [*WORDS, "  ", ""]], "value string"), "value")
    assert dict(tuples(out)) == {"north": 4, "south": 3, "east": 2, "west": 2}


def test_lines(spark):
    assert one(spark, tx.tagged_text("main", F.col("v")), v=1.0) == "main: 1.0"
    assert one(spark, tx.tuple_line(["a", "b"]), a="west", b=2) == "(west,2)"
    line = tx.window_line("k", "v", F.timestamp_seconds("t"), F.timestamp_seconds(F.col("t") + 5))
    assert one(spark, line, k="a", v=3, t=0) == "window: [1970-01-01 00:00:00 ~ 1970-01-01 00:00:05], a = 3"


def test_row_key_is_null_with_a_null_part(spark):
    assert one(spark, tx.row_key("a", "b"), a="x", b=1) == "x_1"
    assert one(spark, tx.row_key("a", F.lit(None).cast("string")), a="x") is None


def test_click_log(spark, rows):
    line = ('{"browserType":"Firefox","categoryID":5,"channelID":1,"city":"Graz","country":"austria",'
            '"entryTime":1700000000000,"leaveTime":1700000060000,"network":"cable","produceID":7,"province":"Styria",'
            '"source":"search","userID":42}')
    out = records.click_log(rows([(line,), ("not json",)], "value string"))
    first = out.where(F.col("browser_type") == "Firefox").first()
    assert (first.category_id, first.user_id, first.entry_time) == (5, 42, 1700000000000)
    keys = out.where("user_id = 42").select(F.explode(tm.time_keys(tm.from_epoch_millis("entry_time"))).alias("k"))
    assert [r.k for r in keys.collect()] == ["2023-11-14-22", "2023-11-14", "2023-11"]
    local = out.where("user_id = 42").select(tm.time_keys(tm.from_epoch_millis("entry_time"), "Asia/Shanghai")[0])
    assert local.first()[0] == "2023-11-15-06"
    seconds = out.where("user_id = 42").select(tm.from_epoch_seconds(F.col("entry_time") / 1000) == tm.from_epoch_millis("entry_time"))
    assert seconds.first()[0]


def test_parse_delimited_and_rejected(spark, rows):
    df = rows([("o_1,u_1,11.50,2022-04-05 10:00:02",), ("o_2,u_2,x,2022-04-05 10:00:02",), ("o_3,u_3",),
               ("o_4,u_4, 5 ,2022-04-05 10:00:03,,",), (None,)], "value string")
    good = records.parse_delimited(df, sc.ORDER_EVENT)
    assert [(r.order_id, r.order_money) for r in good.orderBy("order_id").collect()] == [
        ("o_1", 11.5), ("o_2", None), ("o_4", 5.0)]
    assert tuples(records.rejected(df, sc.ORDER_EVENT), "reason") == [("field count",), ("field count",), ("field value",)]


def test_message_csv_lenient_and_comments(spark, rows):
    df = rows([("u1,7,view,2022",), ("#u2,1,x,y",), ("u3,seven,buy,2022",), ("u4",), (None,)], "value string")
    out = records.message_csv(df.select(F.col("value").cast("binary").alias("value")), sc.TRACK_LOG, comment="#")
    assert {(r.user_id, r.item_id, r.behavior) for r in out.collect()} == {
        ("u1", 7, "view"), ("u3", None, "buy"), ("u4", None, None), (None, None, None)}


def test_chat_message_has_twenty_fields(spark, rows):
    text = "\x01".join(f"f{i}" for i in range(20))
    out = records.message_csv(rows([(text,)], "value string"), sc.CHAT_MESSAGE, sep="\x01")
    assert out.first().asDict()["message"] == "f19"
    key = out.select(tx.row_key(*sc.CHAT_KEY)).first()[0]
    assert key == "f2_f0_f11"


def test_csv_table_tab_lenient(spark, tmp_path):
    (tmp_path / "r.data").write_text("1\t10\t3.5\t99\n2\t11\tbad\t99\n3\n")
    out = files.csv_table(spark, str(tmp_path / "r.data"), sc.RATING, sep="\t")
    assert [(r.user_id, r.rating, r.ts) for r in out.orderBy("user_id").collect()] == [
        ("1", 3.5, 99), ("2", None, 99), ("3", None, None)]


def test_compressed_lines_and_sequence(spark, tmp_path):
    import gzip
    with gzip.open(tmp_path / "w.txt.gz", "wt") as f:
        f.write("\n".join(WORDS))
    assert files.lines(spark, str(tmp_path / "w.txt.gz")).count() == 4
    assert [r.id for r in files.sequence(spark, 1, 10).collect()] == list(range(1, 11))


def test_durations():
    assert tm.micros("5 seconds") == 5_000_000
    assert tm.micros("-8 hours") == -8 * 3_600_000_000
    assert tm.micros("1 minute 30 seconds") == 90_000_000
    for bad in ("1 month", "soon"):
        try:
            tm.micros(bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_change_records(spark, rows):
    from flowtables.operators.changelog import apply_changelog, flatten_changes
    lines = ['{"op":"r","before":null,"after":{"id":1,"name":"a","age":1,"gender":"m"},"ts_ms":1}',
             '{"op":"r","before":null,"after":{"id":2,"name":"b","age":2,"gender":"f"},"ts_ms":1}',
             '{"op":"d","before":{"id":1,"name":"a","age":1,"gender":"m"},"after":null,"ts_ms":2}',
             '{"op":"u","before":{"id":2,"name":"b","age":2,"gender":"f"},'
             '"after":{"id":2,"name":"c","age":3,"gender":"f"},"ts_ms":3}']
    changes = flatten_changes(records.change_records(rows([(x,) for x in lines], "value string")), ["id"])
    assert tuples(apply_changelog(changes, ["id"], ["ts_ms"]), "id", "name", "age") == [(2, "c", 3)]
