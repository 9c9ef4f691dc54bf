"""The library's operators as queries over the standard tables, each with the same query in standard SQL.

Roles of the tables: `events` are a stream of records (in order of `event_id`), `orders` are main orders and
`lineitem` their details, `customer` is a dimension, `documents` is text. Times are written as text and money is
summed as decimal, so that results do not depend on zones or on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions import text as tx
from flowtables.functions import times as tm
from flowtables.operators import (aggregates as ag, changelog as cl, count_windows as cw, joins as jn, late as lt,
                                  outputs as op, partitioning as pt, running as rn, timeouts as to, windows as wn)
from flowtables.operators.aggregates import Measure
from flowtables.plans.chunks import Split
from flowtables.session import new_folder
from flowtables.sinks import external, files as file_sinks, keyed
from flowtables import schemas
from flowtables.sources import files, polled, records, tables
from flowtables.streaming import carried as cr, handover, paired, rolling, running as sr, runs, state, timers, windows as sw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return register


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # The tables hold zone-free times; with another session zone they would turn into other instants.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return tables.parquet_table(spark, folder, name)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events")


def money(c: str | Column) -> Column:
    return ag.exact_money(c)


SUM_VALUE = {"total": Measure("sum", "value", exact=True), "n": Measure("count")}


def plain(df: DataFrame, *numbers: str) -> DataFrame:
    """Window bounds as text and decimal totals as doubles."""
    bounds = {c: tm.to_text(c) for c in ("window_start", "window_end") if c in df.columns}
    return df.withColumns({**bounds, **{c: F.col(c).cast("double") for c in numbers}})


# Pieces of the SQL forms.
_MONEY = "CAST(value AS DECIMAL(18,2))"
_SUM = f"CAST(sum({_MONEY}) AS DOUBLE) AS total, count(*) AS n"
_US = "epoch_us(ts)"


def _at(us: str) -> str:
    return f"strftime(make_timestamp(CAST({us} AS BIGINT)), '%Y-%m-%d %H:%M:%S')"


def _pane(us: str, size: int, shift: int = 0) -> str:
    return f"(((({us}) - {shift}) // {size}) * {size} + {shift})"


MINUTE, HOUR, DAY = 60_000_000, 3_600_000_000, 86_400_000_000


# --- aggregates -------------------------------------------------------------------------------------------------

@query("""
SELECT l_partkey, count(l_partkey) AS ratings, round(avg(l_quantity), 2) AS rating FROM lineitem
GROUP BY l_partkey HAVING count(l_partkey) > 30 ORDER BY 3 DESC, 2 DESC, 1 LIMIT 10
""")
def top_rated(spark, folder):
    """Best rated items with more than 30 ratings."""
    return ag.top_rated(load(spark, folder, "lineitem"), "l_partkey", "l_quantity", 30)


@query("""
SELECT l_partkey, count(l_partkey) AS ratings, round(avg(l_quantity), 2) AS rating FROM lineitem
GROUP BY l_partkey HAVING count(l_partkey) > 20
""")
def rated_view(spark, folder):
    """The same through a view and SQL text, all items above the threshold."""
    op.as_view(load(spark, folder, "lineitem"), "parts_sold")
    return spark.sql("""
        SELECT l_partkey, count(l_partkey) AS ratings, round(avg(l_quantity), 2) AS rating
        FROM parts_sold GROUP BY l_partkey HAVING count(l_partkey) > 20""")


_WORDS = r"""
SELECT unnest(string_split_regex(regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'),
                                 '[ \t\n\x0B\f\r]+')) AS word
FROM documents WHERE length(regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')) > 0"""


@query(f"SELECT word, count(*) AS n FROM ({_WORDS}) GROUP BY word")
def word_count(spark, folder):
    return ag.word_count(load(spark, folder, "documents"), "text")


@query("SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n, "
       "min(value) AS low, max(value) AS high FROM events GROUP BY event_type")
def keyed_sum(spark, folder):
    out = ag.aggregate_by(events(spark, folder), ["event_type"], {
        **SUM_VALUE, "low": Measure("min", "value"), "high": Measure("max", "value")})
    return plain(out, "total")


@query("SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM orders")
def grand_total(spark, folder):
    out = ag.grand_total(load(spark, folder, "orders"), {
        "total": Measure("sum", "o_totalprice", exact=True), "n": Measure("count")})
    return plain(out, "total")


def _slim(spark, folder):
    return events(spark, folder).select("event_id", "user_id", "event_type", "value")


@query("""SELECT user_id, max(value) AS value, arg_min(event_type, event_id) AS event_type,
min(event_id) AS event_id FROM events GROUP BY user_id""")
def field_max(spark, folder):
    return ag.field_max(_slim(spark, folder), ["user_id"], "value", ["event_id"])


@query("""SELECT user_id, min(value) AS value, arg_min(event_type, event_id) AS event_type,
min(event_id) AS event_id FROM events GROUP BY user_id""")
def field_min(spark, folder):
    return ag.field_max(_slim(spark, folder), ["user_id"], "value", ["event_id"], lowest=True)


_BEST = """SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value {0}, event_id) AS rn FROM events) WHERE rn = 1"""


@query(_BEST.format("DESC"))
def record_max(spark, folder):
    return ag.record_max(_slim(spark, folder), ["user_id"], "value", ["event_id"])


@query(_BEST.format("ASC"))
def record_min(spark, folder):
    return ag.record_min(_slim(spark, folder), ["user_id"], "value", ["event_id"])


@query("SELECT user_id, CAST(sum(event_id) AS BIGINT) AS event_id FROM events GROUP BY user_id")
def keyed_reduce(spark, folder):
    """Fold of every user's values with a two-value function."""
    return ag.reduce_by(_slim(spark, folder), ["user_id"], "event_id", ["event_id"], lambda a, b: a + b, fan_in=32)


@query("SELECT event_type, string_agg(CAST(n AS VARCHAR), '>' ORDER BY hour) AS hours FROM ("
       f"SELECT event_type, {_at(_pane(_US, 6 * HOUR))} AS hour, count(*) AS n FROM events GROUP BY ALL) "
       "GROUP BY event_type")
def ordered_reduce(spark, folder):
    """Fold whose function is associative but depends on the order: six-hour counts chained per type."""
    counts = wn.tumbling_agg(events(spark, folder), "ts", "6 hours", {"n": Measure("count")}, ["event_type"])
    text = counts.select("event_type", "window_start", F.col("n").cast("string").alias("hours"))
    return ag.reduce_by(text, ["event_type"], "hours", ["window_start"], lambda a, b: F.concat(a, F.lit(">"), b),
                        fan_in=8)


@query("SELECT event_type, count(*) AS n, max(value) AS high FROM events GROUP BY event_type")
def pandas_combine(spark, folder):
    """User aggregate as a pair of frame functions."""
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("high", T.DoubleType())])

    def step(rows):
        return rows.groupby("event_type", as_index=False).agg(n=("value", "size"), high=("value", "max"))

    def merge(parts):
        return parts.groupby("event_type", as_index=False).agg(n=("n", "sum"), high=("high", "max"))

    return ag.combine_in_pandas(events(spark, folder).select("event_type", "value"), ["event_type"], step, merge,
                                schema)


# --- running values ---------------------------------------------------------------------------------------------

_UPTO = "(PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)"
# Small enough that the tables here are cut and the carry between chunks is part of the checked result.
CUT = Split(rows=1_000)


@query(f"SELECT event_id, user_id, CAST(sum({_MONEY}) OVER {_UPTO} AS DOUBLE) AS running_sum FROM events")
def running_sum(spark, folder):
    out = rn.running_sum(_slim(spark, folder), ["user_id"], ["event_id"], money("value"))
    return plain(out, "running_sum").select("event_id", "user_id", "running_sum")


@query(f"""SELECT event_id, event_type, CAST(sum({_MONEY}) OVER w AS DOUBLE) AS running_sum FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def running_sum_hot_keys(spark, folder):
    """Five keys hold everything: every key is cut into chunks."""
    out = rn.running_sum(_slim(spark, folder), ["event_type"], ["event_id"], money("value"), split=CUT)
    return plain(out, "running_sum").select("event_id", "event_type", "running_sum")


@query(f"SELECT event_id, CAST(sum({_MONEY}) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) "
       "AS running_sum FROM events")
def running_total(spark, folder):
    """Running sum over everything, without a key."""
    out = rn.running_sum(_slim(spark, folder), [], ["event_id"], money("value"))
    return plain(out, "running_sum").select("event_id", "running_sum")


@query(f"SELECT event_id, user_id, max(value) OVER {_UPTO} AS running_max, count(*) OVER {_UPTO} AS running_count "
       "FROM events")
def running_max(spark, folder):
    out = rn.running_max(_slim(spark, folder), ["user_id"], ["event_id"], "value")
    out = rn.running_count(out, ["user_id"], ["event_id"])
    return out.select("event_id", "user_id", "running_max", "running_count")


_FIELD = """SELECT event_id AS seq_event_id, user_id, {0}(value) OVER w AS value,
first_value(event_type) OVER w AS event_type, first_value(event_id) OVER w AS event_id
FROM events WINDOW w AS """ + _UPTO


@query(_FIELD.format("max"))
def running_field_max(spark, folder):
    return rn.running_field_max(_slim(spark, folder), ["user_id"], ["event_id"], "value")


@query(_FIELD.format("min"))
def running_field_min(spark, folder):
    return rn.running_field_max(_slim(spark, folder), ["user_id"], ["event_id"], "value", lowest=True)


_RECORD = """WITH r AS (SELECT event_id, {1}, {0}({{'v': {2}, 'o': -event_id}}) OVER (
  PARTITION BY {1} ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS b FROM events)
SELECT r.event_id AS seq_event_id, e.event_id, e.user_id, e.event_type, e.value
FROM r JOIN events e ON e.event_id = -(r.b).o"""


@query(_RECORD.format("max", "user_id", "value"))
def running_record_max(spark, folder):
    return rn.running_record_max(_slim(spark, folder), ["user_id"], ["event_id"], "value")


@query(_RECORD.format("max", "event_type", "-value"))
def running_record_min_hot_keys(spark, folder):
    return rn.running_record_min(_slim(spark, folder), ["event_type"], ["event_id"], "value", CUT)


_MODULUS = 1_000_003


def _mod_sum(a, b):
    return (a + b) % _MODULUS


@query(f"""SELECT event_id, event_type, CAST(sum(event_id * 7919) OVER (PARTITION BY event_type ORDER BY event_id
ROWS UNBOUNDED PRECEDING) % {_MODULUS} AS BIGINT) AS residue FROM events""")
def running_reduce(spark, folder):
    """A fold so far with a function of the user's."""
    e = events(spark, folder).select("event_id", "event_type")
    return rn.running_reduce(e, ["event_type"], ["event_id"], F.col("event_id") * 7919 % _MODULUS, _mod_sum, "residue",
                             Split(rows=500))


@query(f"""WITH g AS (
  SELECT event_id, user_id, CASE WHEN {_US} - lag({_US}) OVER w < {DAY} THEN 0 ELSE 1 END AS starts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id, run ORDER BY event_id ROWS UNBOUNDED PRECEDING)
  AS running_count FROM r""")
def ttl_count(spark, folder):
    """Count per user that starts again after a day without a row."""
    out = rn.expiring_sum(events(spark, folder), ["user_id"], "ts", "1 day", tie=["event_id"])
    return out.select("event_id", "user_id", "running_count")


@query(f"""WITH g AS (
  SELECT *, CASE WHEN {_US} - lag({_US}) OVER (PARTITION BY event_type ORDER BY ts, event_id) < {30 * MINUTE}
    THEN 0 ELSE 1 END AS starts FROM events),
r AS (SELECT *, sum(starts) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT event_id, event_type, CAST(sum({_MONEY}) OVER (PARTITION BY event_type, run ORDER BY event_id
  ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_sum FROM r""")
def ttl_sum_hot_keys(spark, folder):
    """Sum per type that starts again after half an hour without a row, with every key cut into chunks."""
    out = rn.expiring_sum(events(spark, folder), ["event_type"], "ts", "30 minutes", money("value"), ["event_id"],
                          "running_sum", CUT)
    return plain(out, "running_sum").select("event_id", "event_type", "running_sum")


# --- time, session and count windows ----------------------------------------------------------------------------

@query(f"""SELECT user_id, {_at(_pane(_US, HOUR))} AS window_start, {_at(_pane(_US, HOUR) + f' + {HOUR}')} AS window_end,
{_SUM} FROM events GROUP BY ALL""")
def tumbling_sum(spark, folder):
    return plain(wn.tumbling_agg(events(spark, folder), "ts", "1 hour", SUM_VALUE, ["user_id"]), "total")


@query(f"""SELECT {_at(_pane(_US, HOUR))} AS window_start, {_at(_pane(_US, HOUR) + f' + {HOUR}')} AS window_end,
{_SUM} FROM events GROUP BY ALL""")
def tumbling_all(spark, folder):
    """Fixed windows without a key."""
    return plain(wn.tumbling_agg(events(spark, folder), "ts", "1 hour", SUM_VALUE), "total")


@query(f"""WITH s AS (SELECT user_id, value, {_pane(_US, 5 * MINUTE)} - k * {5 * MINUTE} AS us
  FROM events, range(2) t(k))
SELECT user_id, {_at('us')} AS window_start, {_at(f'us + {10 * MINUTE}')} AS window_end, {_SUM} FROM s GROUP BY ALL""")
def sliding_sum(spark, folder):
    return plain(wn.sliding_agg(events(spark, folder), "ts", "10 minutes", "5 minutes", SUM_VALUE, ["user_id"]),
                 "total")


@query(f"""WITH s AS (SELECT ts, event_type, value, {_pane(_US, 20 * MINUTE)} - k * {20 * MINUTE} AS us
  FROM events, range(3) t(k))
SELECT event_type, {_at('us')} AS window_start, {_at(f'us + {50 * MINUTE}')} AS window_end, {_SUM} FROM s
WHERE {_US} < us + {50 * MINUTE} GROUP BY ALL""")
def sliding_uneven(spark, folder):
    """A window that is no multiple of its slide."""
    return plain(wn.sliding_agg(events(spark, folder), "ts", "50 minutes", "20 minutes", SUM_VALUE, ["event_type"]),
                 "total")


@query(f"""SELECT {_at(_pane(_US, DAY, -8 * HOUR))} AS window_start,
{_at(_pane(_US, DAY, -8 * HOUR) + f' + {DAY}')} AS window_end, {_SUM} FROM events GROUP BY ALL""")
def daily_offset_sum(spark, folder):
    """Days that start at midnight of a zone eight hours ahead."""
    return plain(wn.daily_agg(events(spark, folder), "ts", SUM_VALUE, offset="-8 hours"), "total")


def _sessions(part: str, key: str, gap: int) -> str:
    return f"""WITH g AS (
  SELECT *, CASE WHEN {_US} - lag({_US}) OVER ({part} ORDER BY ts, event_id) <= {gap} THEN 0 ELSE 1 END AS starts
  FROM events),
s AS (SELECT *, sum(starts) OVER ({part} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT {key} {_at('min(' + _US + ')')} AS window_start, {_at(f'max({_US}) + {gap}')} AS window_end, {_SUM}
FROM s GROUP BY {key} sid"""


@query(_sessions("PARTITION BY user_id", "user_id,", 60 * MINUTE))
def session_sum(spark, folder):
    out = wn.session_agg(events(spark, folder), "ts", "60 minutes", SUM_VALUE, ["user_id"])
    return plain(out, "total")


@query(_sessions("PARTITION BY event_type", "event_type,", 10 * MINUTE))
def session_sum_hot_keys(spark, folder):
    """Five keys hold everything: every key's sessions are put together from pieces."""
    out = wn.session_agg(events(spark, folder), "ts", "10 minutes", SUM_VALUE, ["event_type"], 64, CUT)
    return plain(out, "total")


@query(f"""WITH s AS (SELECT value, {_pane(_US, 10 * MINUTE)} - k * {10 * MINUTE} AS us FROM events, range(6) t(k))
SELECT {_at('us')} AS window_start, {_at(f'us + {HOUR}')} AS window_end, {_SUM} FROM s GROUP BY ALL""")
def sliding_all(spark, folder):
    """Overlapping windows without a key."""
    return plain(wn.sliding_agg(events(spark, folder), "ts", "1 hour", "10 minutes", SUM_VALUE), "total")


@query(_sessions("", "", 5 * MINUTE))
def session_all(spark, folder):
    """Sessions without a key."""
    return plain(wn.session_agg(events(spark, folder), "ts", "5 minutes", SUM_VALUE, buckets=64), "total")


def _counted(size: int, slide: int) -> str:
    return f"""WITH r AS (SELECT value, row_number() OVER (ORDER BY event_id) AS n, count(*) OVER () AS total_rows
  FROM events),
p AS (SELECT value, CAST(unnest(range((n + {slide - 1}) // {slide}, (n + {size - 1}) // {slide} + 1)) AS BIGINT)
  AS window_no, total_rows FROM r)
SELECT window_no, {_SUM} FROM p WHERE window_no * {slide} <= total_rows GROUP BY window_no"""


def _count_window(spark, folder, size, slide):
    return plain(cw.count_window(_slim(spark, folder), ["event_id"], size, SUM_VALUE, slide), "total")


@query(_counted(5, 5))
def count_tumbling(spark, folder):
    return _count_window(spark, folder, 5, 5)


@query(_counted(5, 2))
def count_sliding(spark, folder):
    return _count_window(spark, folder, 5, 2)


@query(_counted(3, 4))
def count_skipping(spark, folder):
    return _count_window(spark, folder, 3, 4)


# --- joins and lookups ------------------------------------------------------------------------------------------

def _orders(spark, folder):
    o = load(spark, folder, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderdate", "o_totalprice")


def _details(spark, folder):
    d = load(spark, folder, "lineitem")
    return d.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("string").alias("detail_id"),
                    F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("goods_name"), "l_shipdate",
                    F.col("l_quantity").alias("goods_number"), F.col("l_extendedprice").alias("detail_money"))


_ORDER_PARTS = """o AS (SELECT o_orderkey AS order_id, o_custkey, o_orderdate, o_totalprice FROM orders),
d AS (SELECT l_orderkey AS order_id, CAST(l_linenumber AS VARCHAR) AS detail_id,
      'part ' || l_partkey AS goods_name, l_shipdate, l_quantity AS goods_number,
      l_extendedprice AS detail_money FROM lineitem)"""
_W_ORDER = _pane("epoch_us(o_orderdate)", 90 * DAY)
_W_DETAIL = _pane("epoch_us(l_shipdate)", 90 * DAY)
_DATES = "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate"


def _dates(df):
    return df.withColumns({c: tm.to_text(c, "yyyy-MM-dd") for c in ("o_orderdate", "l_shipdate")})


@query(f"""WITH {_ORDER_PARTS}
SELECT o.order_id, o_custkey, o_totalprice, {_DATES}, detail_id, goods_name, goods_number, detail_money,
{_at(_W_ORDER)} AS window_start, {_at(_W_ORDER + f' + {90 * DAY}')} AS window_end
FROM o JOIN d ON o.order_id = d.order_id AND {_W_ORDER} = {_W_DETAIL}""")
def window_join(spark, folder):
    out = jn.window_join(_orders(spark, folder), _details(spark, folder), ["order_id"], "o_orderdate", "l_shipdate",
                         "90 days")
    return plain(_dates(out))


@query(f"""WITH {_ORDER_PARTS}
SELECT o.order_id, o_custkey, o_totalprice, {_DATES}, detail_id, goods_name,
coalesce(goods_number, 0) AS goods_number, coalesce(detail_money, 0) AS detail_money,
{_at(_W_ORDER)} AS window_start, {_at(_W_ORDER + f' + {90 * DAY}')} AS window_end
FROM o LEFT JOIN d ON o.order_id = d.order_id AND {_W_ORDER} = {_W_DETAIL}""")
def window_cogroup(spark, folder):
    out = jn.window_cogroup(_orders(spark, folder), _details(spark, folder), ["order_id"], "o_orderdate",
                            "l_shipdate", "90 days", {"goods_number": 0.0, "detail_money": 0.0})
    return plain(_dates(out))


@query(f"""WITH {_ORDER_PARTS}
SELECT o.order_id, o_custkey, o_totalprice, {_DATES}, detail_id, goods_name, goods_number, detail_money
FROM o JOIN d ON o.order_id = d.order_id
AND l_shipdate BETWEEN o_orderdate - INTERVAL 1 DAY AND o_orderdate + INTERVAL 120 DAY""")
def interval_join(spark, folder):
    out = jn.interval_join(_orders(spark, folder), _details(spark, folder), ["order_id"], "o_orderdate", "l_shipdate",
                           "-1 days", "120 days")
    return _dates(out)


_UNKNOWN = "unknown"


@query("""SELECT o_orderkey, o_custkey, o_totalprice, coalesce(c_name, 'unknown') AS c_name
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey""")
def dim_enrich(spark, folder):
    """Orders with the name of their customer, where the dimension lacks some customers."""
    o = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")
    c = c.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return jn.lookup_join(o, c, ["o_custkey"], {"c_name": _UNKNOWN}, limit=None)


@query("""SELECT c_custkey, c_name, c_nationkey, coalesce(n_name, '未知') AS n_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def broadcast_enrich(spark, folder):
    """Customers with their nation, a side table that is measured and then broadcast."""
    c = load(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = load(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return jn.lookup_join(c, n, ["c_nationkey"], {"n_name": "未知"})


@query("""WITH d AS (SELECT user_id, arg_max(value, event_id) AS signup_value FROM events
  WHERE event_type = 'signup' GROUP BY user_id)
SELECT event_id, e.user_id, event_type, coalesce(signup_value, -1) AS signup_value
FROM (SELECT * FROM events WHERE event_type <> 'signup') e LEFT JOIN d ON e.user_id = d.user_id""")
def newest_dim(spark, folder):
    """Log rows with the newest version of their user."""
    e = _slim(spark, folder)
    versions = e.where("event_type = 'signup'").select("user_id", "event_id", F.col("value").alias("signup_value"))
    logs = e.where("event_type <> 'signup'").select("event_id", "user_id", "event_type")
    newest = jn.newest_lookup_join(logs.withColumnRenamed("event_id", "log_id"), versions, ["user_id"], ["event_id"],
                                   {"signup_value": -1.0})
    return newest.withColumnRenamed("log_id", "event_id")


@query("""SELECT event_id, user_id, event_type, coalesce(seen, -1) AS signup_value FROM (
  SELECT *, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS seen FROM events)
WHERE event_type <> 'signup'""")
def asof_dim(spark, folder):
    """Log rows with the version of their user that was known when they came in."""
    e = _slim(spark, folder)
    logs = e.where("event_type <> 'signup'").select("event_id", "user_id", "event_type")
    return jn.asof_lookup(logs, e.where("event_type = 'signup'"), ["user_id"], ["event_id"],
                          {"signup_value": "value"}, {"signup_value": -1.0})


# --- late data --------------------------------------------------------------------------------------------------

RULE = lt.Lateness("5 minutes", bound="5 minutes", allowed="15 minutes")


def arrivals(df: DataFrame) -> DataFrame:
    """Events with an arrival time up to two hours off their own order."""
    return df.withColumn("arr", F.unix_seconds(F.col("ts").cast("timestamp")) + F.col("event_id") * 7919 % 7200)


_ARRIVED = f"""a AS (SELECT *, {_US} // 1000000 + (event_id * 7919) % 7200 AS arr FROM events),
m AS (SELECT *, max({_US}) OVER (ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen,
  {_pane(_US, 5 * MINUTE)} AS w FROM a),
c AS (SELECT *, CASE WHEN seen >= w + {(5 + 5 + 15) * MINUTE} THEN 'late' WHEN seen >= w + {(5 + 5) * MINUTE}
  THEN 'refire' ELSE 'on_time' END AS status FROM m)"""
_W5 = f"{_at('w')} AS window_start, {_at(f'w + {5 * MINUTE}')} AS window_end"


def _classified(spark, folder, rule=RULE):
    return lt.classify(arrivals(events(spark, folder)), "ts", ["arr", "event_id"], rule)


@query(f"WITH {_ARRIVED} SELECT event_id, status, {_W5} FROM c")
def late_status(spark, folder):
    return plain(_classified(spark, folder).select("event_id", "status", "window_start", "window_end"))


@query(f"WITH {_ARRIVED} SELECT event_id, user_id, {_W5} FROM c WHERE status = 'late'")
def late_rows(spark, folder):
    """Side output of rows that came after the allowed lateness."""
    _, late = lt.split_late(arrivals(events(spark, folder)), "ts", ["arr", "event_id"], RULE)
    return plain(late.select("event_id", "user_id", "window_start", "window_end"))


@query(f"WITH {_ARRIVED} SELECT {_W5}, {_SUM} FROM c WHERE status = 'on_time' GROUP BY w")
def on_time_totals(spark, folder):
    """First firing per window: what a query without allowed lateness sees."""
    rows = _classified(spark, folder).where(F.col("status") == lt.ON_TIME)
    return plain(lt.window_totals(rows, SUM_VALUE), "total")


@query(f"WITH {_ARRIVED} SELECT user_id, {_W5}, {_SUM} FROM c WHERE status <> 'late' GROUP BY user_id, w")
def refire_totals(spark, folder):
    """Last firing per user and window."""
    return plain(lt.window_totals(_classified(spark, folder), SUM_VALUE, ["user_id"]), "total")


@query(f"""WITH {_ARRIVED},
f AS (SELECT event_type, w, sum({_MONEY}) AS total FROM c WHERE status = 'on_time' GROUP BY ALL),
r AS (SELECT event_type, w, sum({_MONEY}) OVER p AS more, row_number() OVER p AS no FROM c WHERE status = 'refire'
  WINDOW p AS (PARTITION BY event_type, w ORDER BY arr, event_id ROWS UNBOUNDED PRECEDING)),
u AS (SELECT event_type, w, 0 AS firing, total FROM f UNION ALL
  SELECT r.event_type, r.w, no, coalesce(total, 0) + more FROM r
  LEFT JOIN f ON r.event_type = f.event_type AND r.w = f.w)
SELECT event_type, {_W5}, CAST(firing AS BIGINT) AS firing, CAST(total AS DOUBLE) AS total FROM u""")
def window_firings(spark, folder):
    """Every firing of every window."""
    rows = _classified(spark, folder).withColumn("value", money("value"))
    out = lt.window_firings(rows, "value", ["arr", "event_id"], ["event_type"])
    return plain(out, "total")


# --- records, scalar functions, outputs -------------------------------------------------------------------------

@query("""SELECT t.k AS time_key, count(*) AS n FROM (SELECT unnest([strftime(ts, '%Y-%m-%d-%H'),
strftime(ts, '%Y-%m-%d'), strftime(ts, '%Y-%m')]) AS k FROM events) t GROUP BY t.k""")
def time_keys(spark, folder):
    """Rows per hour, day and month."""
    keys = events(spark, folder).select(F.explode(tm.time_keys("ts")).alias("time_key"))
    return keys.groupBy("time_key").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time,
epoch_us(ts) // 1000 AS ms, event_id FROM events""")
def time_texts(spark, folder):
    """Time to epoch to time to text in another zone."""
    ms = events(spark, folder).select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    local = F.from_utc_timestamp(tm.from_epoch_millis("ms"), "Asia/Shanghai")
    return ms.select("event_id", "ms", tm.to_text(tm.from_text(tm.to_text(local))).alias("local_time"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, folder):
    e = events(spark, folder)
    return e.select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("""SELECT 'chrome' AS browser_type, user_id, epoch_us(ts) // 1000 AS entry_time, event_type AS source
FROM events WHERE event_type <> 'error'""")
def click_log(spark, folder):
    """Events as JSON click lines, read back with other column names and filtered by browser."""
    e = events(spark, folder)
    line = e.select(F.to_json(F.struct(
        F.when(F.col("event_type") == "error", "none").otherwise("chrome").alias("browserType"),
        F.col("user_id").alias("userID"), F.unix_millis(F.col("ts").cast("timestamp")).alias("entryTime"),
        F.col("event_type").alias("source"))).alias("value"))
    clicks = records.click_log(line).where(F.col("browser_type") == "chrome")
    return clicks.select("browser_type", "user_id", "entry_time", "source")


_ORDER_LINE = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("cust_id", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("money", T.DoubleType())])


def _order_lines(spark, folder):
    """Orders as text; finished ones get a field too many and pending ones a price that is no number."""
    o = load(spark, folder, "orders")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    tail = F.when(F.col("o_orderstatus") == "F", F.lit(",extra")).otherwise(F.lit(",,"))
    return o.select(F.concat(F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                                         "o_orderstatus", price), tail).alias("value"))


@query("""SELECT o_orderkey AS order_id, o_custkey AS cust_id, o_orderstatus AS status,
CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS money FROM orders WHERE o_orderstatus <> 'F'""")
def delimited_parse(spark, folder):
    return records.parse_delimited(_order_lines(spark, folder), _ORDER_LINE)


@query("""SELECT CASE WHEN o_orderstatus = 'F' THEN 'field count' ELSE 'field value' END AS reason, count(*) AS n
FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY ALL""")
def delimited_rejects(spark, folder):
    out = records.rejected(_order_lines(spark, folder), _ORDER_LINE)
    return out.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


_TRACK = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("item_id", T.IntegerType()),
                       T.StructField("behavior", T.StringType()), T.StructField("ts", T.StringType())])


@query("""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS INTEGER) AS item_id, event_type AS behavior,
strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events""")
def kafka_csv_roundtrip(spark, folder):
    """Queue messages with a CSV value."""
    e = events(spark, folder)
    parts = [F.col(c).cast("string") for c in ("user_id", "event_id", "event_type")]
    messages = e.select(F.concat_ws(",", *parts, tm.to_text("ts")).cast("binary").alias("value"))
    return records.message_csv(messages, _TRACK)


@query("""SELECT user_id || '_' || event_id AS key, '{"user_id":' || user_id || ',"event_id":' || event_id ||
',"event_type":"' || event_type || '"}' AS value FROM events""")
def kafka_json_out(spark, folder):
    e = events(spark, folder).select("user_id", "event_id", "event_type")
    return external.json_messages(e, ["user_id", "event_id"])


@query("""SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS tag, count(*) AS n,
CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY ALL
UNION ALL SELECT 'main', count(*), CAST(sum(CAST(event_id AS HUGEINT) * event_id) AS BIGINT) FROM events""")
def side_outputs(spark, folder):
    """Squares as the main output, odd and even numbers as side outputs. Totals beyond a BIGINT, where the SQL stops,
    make `total` a DECIMAL(38,0)."""
    e = events(spark, folder).select("event_id")
    even = F.col("event_id") % 2 == 0
    sides = op.tag_rows(e, {"even": even, "odd": ~even})
    exact = F.col("event_id").cast(T.DecimalType(19, 0))
    n, top = e.agg(F.count("event_id"), F.coalesce(F.max(F.abs(exact)), F.lit(0))).first()
    # `pow` counts in doubles, which hold the squares of longer numbers no more.
    square = F.pow("event_id", F.lit(2)).cast("long") if top <= 2**26 else exact * exact
    main = e.select(square.alias("event_id"), F.lit("main").alias("tag"))
    fits = n * int(top)**2 < 2**63
    out = op.union_all(main, sides).groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.col("event_id").cast(T.LongType() if fits else T.DecimalType(38, 0))).alias("total"))
    return out if fits else ag.bigint_if_fits(out, "total")


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS output FROM events""")
def split_outputs(spark, folder):
    """One frame per tag."""
    e = events(spark, folder).select("event_id")
    out = op.split_outputs(e, {"even": F.col("event_id") % 2 == 0, "odd": F.col("event_id") % 2 != 0})
    return op.union_all(*[df.withColumn("output", F.lit(tag)) for tag, df in out.items()])


@query("SELECT o_custkey AS cust_id FROM orders UNION ALL SELECT c_custkey FROM customer")
def union_all(spark, folder):
    o = load(spark, folder, "orders").select(F.col("o_custkey").alias("cust_id"))
    return op.union_all(o, load(spark, folder, "customer").select(F.col("c_custkey").alias("cust_id")))


@query("""SELECT 'order: ' || o_orderkey AS line FROM orders UNION ALL SELECT 'customer: ' || c_name FROM customer""")
def co_map(spark, folder):
    """Two types of records, each mapped by a function of its own."""
    return op.co_map(
        load(spark, folder, "orders"), load(spark, folder, "customer"),
        lambda o: o.select(tx.tagged_text("order", "o_orderkey").alias("line")),
        lambda c: c.select(tx.tagged_text("customer", "c_name").alias("line")))


@query("SELECT CAST(event_id % 2 AS INTEGER) AS task, count(*) AS n FROM events GROUP BY ALL")
def custom_partition(spark, folder):
    """Rows placed by number; the number of the task is what was asked for."""
    e = pt.by_number(events(spark, folder).select("event_id"), 2, F.col("event_id") % 2)
    return e.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'window: [' || s || ' ~ ' || e || '], ' || event_type || ' = ' || n AS line FROM (
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS s, event_type, count(*) AS n,
strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS e FROM events GROUP BY ALL)""")
def window_lines(spark, folder):
    out = wn.daily_agg(events(spark, folder), "ts", {"n": Measure("count")}, ["event_type"])
    return out.select(tx.window_line("event_type", "n", "window_start", "window_end").alias("line"))


@query("SELECT '(' || event_type || ',' || user_id || ')' AS value, count(*) AS n FROM events GROUP BY ALL")
def tuple_lines(spark, folder):
    line = tx.tuple_line(["event_type", "user_id"]).alias("value")
    return events(spark, folder).select(line).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, count(*) AS n FROM events GROUP BY ALL")
def hour_buckets(spark, folder):
    out = file_sinks.with_bucket(events(spark, folder), "ts")
    return out.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS rows, count(*) FILTER (event_type = 'error') AS errors FROM events")
def row_counters(spark, folder):
    """Counters filled beside another job, here the write of a table."""
    counted, seen = ag.counted(events(spark, folder), "rows_seen", errors=F.col("event_type") == "error")
    counted.write.parquet(new_folder(spark, "row_counters"))
    numbers = seen.get
    return spark.range(1).select(*[F.lit(numbers[n]).cast("long").alias(n) for n in ("rows", "errors")])


# --- files and the catalog: the given tables written in a format, then read by the library's readers -----------------

_LINES = """SELECT unnest(string_split(text, chr(10))) AS line FROM documents"""


def _text_folder(spark, folder, name, **options):
    """The documents' lines as text files."""
    path = new_folder(spark, name)
    docs = load(spark, folder, "documents")
    docs.select(F.explode(F.split("text", "\n")).alias("value")).write.options(**options).text(path)
    return path


def _line_counts(lines):
    return lines.groupBy(F.length("value").alias("chars")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT CAST(length(line) AS INTEGER) AS chars, count(*) AS n FROM ({_LINES}) GROUP BY ALL")
def text_files(spark, folder):
    return _line_counts(files.lines(spark, _text_folder(spark, folder, "text")))


@query(ORACLE["text_files"])
def gzip_text_files(spark, folder):
    return _line_counts(files.lines(spark, _text_folder(spark, folder, "gzip", compression="gzip")))


@query(ORACLE["text_files"])
def stream_text_files(spark, folder):
    """Lines of text files as a stream."""
    stream = files.line_stream(spark, _text_folder(spark, folder, "text_in"), 2)
    return _line_counts(runs.result_table(stream, "text_out"))


@query("""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS movie_id,
CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS rating, epoch_us(ts) // 1000000 AS ts FROM events""")
def csv_files(spark, folder):
    """Tab-separated files with some numbers that are none."""
    path = new_folder(spark, "csv")
    value = F.when(F.col("event_id") % 10 == 0, "none").otherwise(F.col("value").cast("string"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    events(spark, folder).select("user_id", "event_id", value, seconds).write.option("sep", "\t").csv(path)
    return files.csv_table(spark, path, schemas.RATING, sep="\t")


@query("""SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, CAST(user_id AS VARCHAR) AS road_id,
count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY ALL""")
def stream_csv_windows(spark, folder):
    """A stream of CSV files with a declared watermark, counted per minute in update mode."""
    path = new_folder(spark, "csv_in")
    e = events(spark, folder).select(tm.to_text("ts"), F.col("user_id").cast("string"), F.col("event_id").cast("int"))
    e.repartition(BATCHES).write.csv(path)
    stream = files.csv_stream(spark, path, schemas.ROAD_RECORD, watermark=("record_time", "36500 days"), files_per_batch=1)
    out = wn.tumbling_agg(stream, "record_time", "1 minute", {"n": Measure("count"), "total": Measure("sum", "record_count")},
                          ["road_id"])
    rows = runs.result_table(out, "csv_out", ["road_id", "window_start"])
    return rows.select(tm.to_text("window_start").alias("minute"), "road_id", "n", "total")


@query("""SELECT 'a' || event_id || '_' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '_r' || user_id AS rowkey, event_type AS message
FROM events WHERE event_id % 5 <> 0""")
def chat_records(spark, folder):
    """Messages of twenty fields between control characters, comment lines left out, with the row key of the wide table."""
    e = events(spark, folder)
    facts = {"msg_time": tm.to_text("ts"), "sender_account": F.concat(F.lit("a"), F.col("event_id").cast("string")),
             "receiver_account": F.concat(F.lit("r"), F.col("user_id").cast("string")), "message": F.col("event_type")}
    text = F.concat_ws("\x01", *[facts.get(c, F.lit("x")) for c in schemas.CHAT_COLUMNS])
    line = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("#"), text)).otherwise(text)
    chats = records.message_csv(e.select(line.alias("value")), schemas.CHAT_MESSAGE, sep="\x01", comment="#")
    return chats.select(tx.row_key(*schemas.CHAT_KEY).alias("rowkey"), "message")


@query("""SELECT user_id AS id, event_type AS name, CAST(event_id AS INTEGER) AS age FROM (SELECT *, row_number() OVER (
PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def change_records(spark, folder):
    """Change records as JSON with images before and after; an error deletes its user."""
    image = F.struct(F.col("user_id").cast("int").alias("id"), F.col("event_type").alias("name"),
                     F.col("event_id").cast("int").alias("age"))
    gone = F.col("event_type") == "error"
    e = events(spark, folder).select(F.to_json(F.struct(
        F.when(gone, "d").otherwise("u").alias("op"), F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"),
        F.col("event_id").alias("ts_ms"))).alias("value"))
    changes = cl.flatten_changes(records.change_records(e), ["id"])
    return cl.apply_changelog(changes, ["id"], ["ts_ms"]).select(F.col("id").cast("long").alias("id"), "name", "age")


@query("SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def catalog_join(spark, folder):
    """Tables found in the catalog by name."""
    for name in ("customer", "nation"):
        op.as_view(load(spark, folder, name), f"by_name_{name}")
    customer, nation = (tables.catalog_table(spark, f"by_name_{n}") for n in ("customer", "nation"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")


@query("SELECT event_id, user_id, value FROM events")
def stream_parquet_files(spark, folder):
    """A stream written to Parquet files."""
    base = new_folder(spark, "parquet_files")
    e = events(spark, folder).select("event_id", "user_id", "value")
    stream = in_batches(e, "parquet_in", thirds(e, "event_id"))
    file_sinks.parquet_files(stream, f"{base}/out", f"{base}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(e.schema).parquet(f"{base}/out")


@query("""SELECT 'even' AS how, 8 AS tasks, count(*) AS n FROM events UNION ALL SELECT 'fewer', 2, count(*) FROM events
UNION ALL SELECT 'key', 1, count(*) FROM events""")
def partitionings(spark, folder):
    """Rows dealt out evenly, put together into fewer tasks, and by key: how many tasks a key's rows are in at most."""
    e = events(spark, folder).select("event_id", "event_type")
    dealt = pt.evenly(e, 8)

    def tasks(df, how, *keys):
        each = df.groupBy(*keys, F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
        used = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("tasks"), F.sum("n").alias("n"))
        return used.agg(F.max("tasks").cast("int").alias("tasks"), F.sum("n").alias("n")).select(F.lit(how).alias("how"), "tasks", "n")

    return op.union_all(tasks(dealt, "even"), tasks(pt.fewer_tasks(dealt, 2), "fewer"), tasks(pt.by_key(e, "event_type"), "key", "event_type"))


# --- keyed tables -----------------------------------------------------------------------------------------------

@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_key(spark, folder):
    return cl.latest_per_key(_slim(spark, folder), ["user_id", "event_type"], ["event_id"])


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (
PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def changelog_state(spark, folder):
    """Current rows of a change log where `error` stands for a delete."""
    return cl.apply_changelog(_slim(spark, folder), ["user_id"], ["event_id"], "event_type", ["error"])


@query("""SELECT rowkey, user_id, event_type, event_id FROM (
SELECT user_id || '_' || event_type AS rowkey, user_id, event_type, event_id, row_number() OVER (
PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def wide_row_upsert(spark, folder):
    """Rows under a computed key with a struct of fields, newest per key, fields taken out again."""
    wide = cl.wide_rows(_slim(spark, folder), ["user_id", "event_type"], ["user_id", "event_type", "event_id"])
    newest = cl.latest_per_key(wide, ["rowkey"], ["info.event_id"])
    return tables.wide_scan(newest, ["info.user_id", "info.event_type", "info.event_id"])


@query("""SELECT o_orderkey, o_custkey, '取消' AS o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM orders WHERE o_orderstatus = 'O' AND o_orderdate + INTERVAL 30 DAY <= TIMESTAMP '1998-01-01 00:00:00'""")
def cancel_unpaid(spark, folder):
    """Orders still open thirty days after their date, as of a given day."""
    o = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    out = to.cancel_unpaid(o, F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"), "o_orderkey", "o_orderdate",
                           "o_orderstatus", "30 days", unpaid="O")
    return out.withColumn("o_orderdate", tm.to_text("o_orderdate", "yyyy-MM-dd"))


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN '取消' ELSE o_orderstatus END AS o_orderstatus
FROM orders""")
def upsert_table(spark, folder):
    """A table by key, with a second round that changes some of its rows."""
    path = new_folder(spark, "orders")
    o = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.lit(0).alias("seq"))
    keyed.upsert(path, o, ["o_orderkey"], ["seq"])
    keyed.upsert(path, o.where("o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("取消")), ["o_orderkey"], ["seq"])
    stale = o.withColumns({"o_orderstatus": F.lit("stale"), "seq": F.lit(-1)})  # older than what is stored
    keyed.upsert(path, stale, ["o_orderkey"], ["seq"])
    keyed.rebuild(spark, path, ["o_orderkey"], 16)
    return keyed.read_table(spark, path).drop("seq")


# --- streams: the same operators on a stream of files, run over all input that is there --------------------------

BATCHES = 3


def in_batches(df: DataFrame, name: str, part: Column, batches: int = BATCHES) -> DataFrame:
    """The rows as a stream that brings `part` 0, then 1, and so on, each as a micro-batch of several unordered files."""
    spark = df.sparkSession
    path, files = new_folder(spark, name), spark.sparkContext.defaultParallelism
    placed = df.withColumn("__part", F.least(F.greatest(part, F.lit(0)), F.lit(batches - 1)))
    for i in range(batches):
        placed.where(F.col("__part") == i).drop("__part").repartition(files).sortWithinPartitions(
            F.xxhash64(*df.columns)).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def thirds(df: DataFrame, column: str, batches: int = BATCHES) -> Column:
    """Number of the part of the column's range that a value lies in."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return F.floor((F.col(column) - low) * batches / max(1, high - low + 1)).cast("int")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events as they arrive, up to two hours out of order (see `arrivals`), in several micro-batches."""
    e = arrivals(tables.with_instants(events(spark, folder), "ts"))
    return in_batches(e, "events_in", thirds(e, "arr"))


@query(ORACLE["word_count"])
def stream_word_count(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text")
    stream = in_batches(docs, "documents_in", thirds(docs, "doc_id"))
    return runs.result_table(ag.word_count(stream, "text"), "word_count", ["word"])


@query(ORACLE["tumbling_sum"])
def stream_tumbling_sum(spark, folder):
    """Window totals in update mode, newest row per window."""
    out = sw.lateness_agg(event_stream(spark, folder), "ts", lt.Lateness("1 hour", "2 hours", "5 minutes"), SUM_VALUE,
                          ["user_id"])
    return plain(runs.result_table(out, "tumbling", ["user_id", "window_start"]), "total")


DISORDER = 100  # days by which the orders' rows come out of time order


def _order_streams(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders and details as streams of several micro-batches, out of order by up to DISORDER days."""
    o, d = load(spark, folder, "orders"), load(spark, folder, "lineitem")
    main = o.select(F.col("o_orderkey").alias("order_id"), "o_custkey", F.col("o_orderdate").cast("timestamp"), "o_totalprice")
    detail = d.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("string").alias("detail_id"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("goods_name"),
        F.col("l_shipdate").cast("timestamp"), F.col("l_quantity").alias("goods_number"),
        F.col("l_extendedprice").alias("detail_money"))
    out = []
    for df, name, ts in ((main, "orders_in", "o_orderdate"), (detail, "details_in", "l_shipdate")):
        # A row's place is its time plus some days that depend on its order.
        moved = F.unix_date(F.col(ts).cast("date")) + F.pmod(F.xxhash64("order_id"), F.lit(DISORDER)).cast("int")
        part = thirds(df.select(moved.alias("day")), "day")
        placed = df.withColumn("day", moved)
        stream = in_batches(placed, name, part).drop("day")
        out.append(stream)
    return out[0], out[1]


def _paired(spark: SparkSession, left: DataFrame, right: DataFrame, name: str, make: Callable) -> DataFrame:
    """What a function for batches of two streams (`streaming.paired`) writes until their input ends."""
    base = new_folder(spark, name)
    on_batch = make(runs.keep_updates(f"{base}/out"), f"{base}/state")
    runs.drain(paired.both(left, right), on_batch, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").drop("batch")


@query(ORACLE["interval_join"])
def stream_interval_join(spark, folder):
    """Join of two streams that come in several batches and out of order."""
    main, detail = _order_streams(spark, folder)
    return _dates(_paired(spark, main, detail, "interval_join", lambda write, state: paired.interval_batches(
        ["order_id"], "o_orderdate", "l_shipdate", "-1 days", "120 days", write, state, *[f"{DISORDER} days"] * 2)))


@query(ORACLE["late_rows"])
def stream_late_rows(spark, folder):
    """Late rows of a stream, found micro-batch by micro-batch."""
    base = new_folder(spark, "late_rows")
    stream = event_stream(spark, folder).select("event_id", "user_id", "ts", "arr")
    on_batch = sw.split_late_batches("ts", ["arr", "event_id"], RULE, runs.keep_updates(f"{base}/main"),
                                     runs.keep_updates(f"{base}/late"), f"{base}/seen")
    runs.drain(stream, on_batch, f"{base}/checkpoint")
    late = spark.read.parquet(f"{base}/late")
    return plain(late.select("event_id", "user_id", "window_start", "window_end"))


def _running_stream(spark, folder, name, df, keys, values):
    """Running values of a stream of several micro-batches, whose rows come in any order inside a batch."""
    base = new_folder(spark, name)
    stream = in_batches(df, f"{name}_in", thirds(df, "event_id"))
    on_batch = sr.running_batches(keys, ["event_id"], values, runs.keep_updates(f"{base}/out"), f"{base}/state")
    runs.drain(stream, on_batch, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").drop("batch")


_OFF = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id * 7919 % 7200 END"


def _offs(spark, folder):
    off = F.when(F.col("event_id") % 7 != 0, F.col("event_id") * 7919 % 7200)
    return events(spark, folder).select("event_id", "user_id", "event_type", off.alias("off"))


@query(f"SELECT event_id, user_id, max({_OFF}) OVER {_UPTO} AS running_max, min({_OFF}) OVER {_UPTO} AS running_min FROM events")
def stream_running_max(spark, folder):
    """Largest and smallest value so far, with NULLs among the values."""
    out = _running_stream(spark, folder, "running_max", _offs(spark, folder), ["user_id"], {
        "running_max": sr.highest("off"), "running_min": sr.lowest("off")})
    return out.select("event_id", "user_id", "running_max", "running_min")


@query(f"""SELECT event_id, event_type, CAST(sum({_OFF}) OVER w AS BIGINT) AS running_sum FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def stream_running_sum(spark, folder):
    out = _running_stream(spark, folder, "running_sum", _offs(spark, folder), ["event_type"], {"running_sum": sr.total("off")})
    return out.select("event_id", "event_type", "running_sum")


@query(ORACLE["running_record_max"])
def stream_record_max(spark, folder):
    """The whole record with the largest value so far."""
    df = _slim(spark, folder)
    out = _running_stream(spark, folder, "record_max", df, ["user_id"], {
        "best": sr.record_with_highest("value", ["event_id"])})
    return out.select(F.col("event_id").alias("seq_event_id"), "best.record.*")


@query(ORACLE["running_reduce"])
def stream_running_reduce(spark, folder):
    base = new_folder(spark, "running_reduce")
    e = events(spark, folder).select("event_id", "event_type", (F.col("event_id") * 7919 % _MODULUS).alias("v"))
    on_batch = sr.reduce_batches(["event_type"], ["event_id"], "v", _mod_sum, runs.keep_updates(f"{base}/out"),
                                 f"{base}/state", "residue")
    runs.drain(in_batches(e, "reduce_in", thirds(e, "event_id")), on_batch, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type", "residue")


@query(ORACLE["sliding_sum"])
def stream_sliding_sum(spark, folder):
    out = wn.sliding_agg(sw.watermarked(event_stream(spark, folder), "ts", "2 hours"), "ts", "10 minutes", "5 minutes",
                         SUM_VALUE, ["user_id"])
    return plain(runs.result_table(out, "sliding", ["user_id", "window_start"]), "total")


@query(ORACLE["window_join"])
def stream_window_join(spark, folder):
    main, detail = _order_streams(spark, folder)
    return plain(_dates(_paired(spark, main, detail, "window_join", lambda write, state: paired.window_batches(
        ["order_id"], "o_orderdate", "l_shipdate", "90 days", write, state, "inner", None, *[f"{DISORDER} days"] * 2))))


@query(f"SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY event_id "
       "ROWS UNBOUNDED PRECEDING) AS running_count FROM events")
def stream_running_count(spark, folder):
    out = _running_stream(spark, folder, "running_count", events(spark, folder).select("event_id", "event_type"),
                          ["event_type"], {"running_count": sr.count()})
    return out.select("event_id", "event_type", "running_count")


@query(ORACLE["changelog_state"])
def stream_changelog(spark, folder):
    """Stream of changes folded into a table; `error` stands for a delete. Changes come in any order over several batches."""
    base = new_folder(spark, "changelog")
    changes = _slim(spark, folder).select("event_id", "user_id", "event_type", "value")
    stream = in_batches(changes, "changes_in", F.pmod(F.xxhash64("event_id"), F.lit(BATCHES)).cast("int"))
    on_batch = keyed.changelog_batches(f"{base}/table", ["user_id"], ["event_id"], "event_type", ["error"])
    runs.drain(stream, on_batch, f"{base}/checkpoint")
    return keyed.read_table(spark, f"{base}/table", "deleted")


@query(ORACLE["changelog_state"])
def stream_cdc_initial(spark, folder):
    """The same table from a snapshot at half of the log and the whole log, which repeats what the snapshot holds. It is
    read in three batches, with a restart after the table was loaded and the first two batches were folded in."""
    base = new_folder(spark, "cdc_initial")
    changes = _slim(spark, folder)
    half = changes.agg(F.floor((F.min("event_id") + F.max("event_id")) / 2)).first()[0]

    def snapshot():
        return cl.apply_changelog(changes.where(F.col("event_id") <= half), ["user_id"], ["event_id"], "event_type",
                                  ["error"]), half

    for upto in (BATCHES - 1, BATCHES):
        log = in_batches(changes.where(thirds(changes, "event_id") < upto), "cdc_log", thirds(changes, "event_id"))
        handover.snapshot_then_changes(spark, f"{base}/table", snapshot, log, ["user_id"], "event_id",
                                       f"{base}/checkpoint-{upto}", "event_type", ["error"])
    return keyed.read_table(spark, f"{base}/table", "deleted")


@query("""SELECT event_id, event_type, event_id // 50 AS mark, CASE WHEN event_id <= high // 3 THEN 0
WHEN event_id <= high * 2 // 3 THEN 1 ELSE 2 END AS poll FROM events, (SELECT max(event_id) AS high FROM events)""")
def polled_table(spark, folder):
    """A table that grows, polled three times; fifty rows share a mark and the table is cut inside of one."""
    path = new_folder(spark, "polled")
    rows = events(spark, folder).select("event_id", "event_type", F.floor(F.col("event_id") / 50).alias("mark"))
    high = rows.agg(F.max("event_id")).first()[0]
    for upto in (high // 3, high * 2 // 3, high, high):
        polled.poll(rows.where(F.col("event_id") <= upto), path, "mark", ["event_id"])
    return polled.polled_rows(spark, path, rows.schema).withColumn("poll", F.col("poll").cast("int"))


@query(ORACLE["hour_buckets"])
def stream_hour_buckets(spark, folder):
    """Files in hourly folders."""
    base = new_folder(spark, "buckets")
    stream = event_stream(spark, folder).select("event_id", "ts")
    written = file_sinks.rolling_files(stream, f"{base}/out", f"{base}/checkpoint", "ts", available_now=True)
    written.awaitTermination()
    out = spark.read.parquet(f"{base}/out").withColumn("bucket", F.col("bucket").cast("string"))
    return out.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query(ORACLE["hour_buckets"])
def stream_sized_files(spark, folder):
    """Files in hourly folders, closed by size or after an idle day; what is open at the end is closed then."""
    base = new_folder(spark, "sized")
    rows = events(spark, folder).select("event_id", "event_type", "ts")
    on_batch = rolling.sized_file_batches(f"{base}/out", "ts", ["event_id", "event_type"], f"{base}/state", 64 << 10, "1 day")
    runs.drain(in_batches(rows, "sized_in", thirds(rows, "event_id")), on_batch, f"{base}/checkpoint")
    rolling.close_open(spark, f"{base}/out", f"{base}/state")
    out = spark.read.schema("value string, bucket string, roll string").text(f"{base}/out")
    return out.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT user_id, event_id, event_type, coalesce(signup_value, -1) AS signup_value FROM
(SELECT * FROM events WHERE event_type <> 'signup') e LEFT JOIN (SELECT user_id AS u, arg_max(value, event_id)
  AS signup_value FROM events WHERE event_type = 'signup' GROUP BY user_id) d ON e.user_id = d.u""")
def stream_newest_dim(spark, folder):
    """Stream of log rows with the newest version of their user at the time of each micro-batch."""
    base = new_folder(spark, "newest_dim")
    stream = event_stream(spark, folder).where("event_type <> 'signup'").select("user_id", "event_id", "event_type")

    def versions():
        return _slim(spark, folder).where("event_type = 'signup'").select(
            "user_id", F.col("event_id").alias("version"), F.col("value").alias("signup_value"))

    on_batch = sw.enrich_batches(versions, ["user_id"], ["version"], runs.keep_updates(f"{base}/out"),
                                 {"signup_value": -1.0})
    runs.drain(stream, on_batch, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").drop("batch")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN '未付款' ELSE o_orderstatus END AS o_orderstatus
FROM orders UNION ALL SELECT o_orderkey, '取消' FROM orders WHERE o_orderstatus = 'O'
AND o_orderdate + INTERVAL 15 SECOND <= (SELECT max(o_orderdate) FROM orders)""")
def stream_cancel_unpaid(spark, folder):
    """All orders, and a cancelled copy of those still unpaid at their deadline, by timers in event time."""
    o = load(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "O", to.UNPAID).otherwise(F.col("o_orderstatus"))
    stream = tables.parquet_stream(spark, folder, "orders", o.schema).select(
        "o_orderkey", status.alias("o_orderstatus"), F.col("o_orderdate").cast("timestamp"))
    out = timers.stream_cancel_unpaid(stream, "o_orderkey", "o_orderdate", "o_orderstatus")
    return runs.result_table(out, "cancel_unpaid").drop("o_orderdate")


# Payments: of every third open order ten days after its date, of every other third forty days after it.
_PAID = ((0, 10), (1, 40))


@query(f"""WITH r AS (SELECT o_orderkey, o_orderdate AS placed, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'done' END AS state
FROM orders {' '.join(f"UNION ALL SELECT o_orderkey, o_orderdate + INTERVAL {days} DAY, 'paid' FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 3 = {rest}"
                      for rest, days in _PAID)})
SELECT o_orderkey, strftime(placed, '%Y-%m-%d') AS placed FROM r WHERE state = 'open'
AND NOT EXISTS (SELECT 1 FROM r c WHERE c.o_orderkey = r.o_orderkey AND c.placed > r.placed AND c.placed <= r.placed + INTERVAL 708 HOUR)
AND r.placed + INTERVAL 708 HOUR <= (SELECT max(placed) FROM r) - INTERVAL {DISORDER} DAY""")
def stream_overdue(spark, folder):
    """Orders without a payment by noon of the thirtieth day; rows come in several batches and out of order."""
    o = load(spark, folder, "orders")
    rows = o.select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("placed"),
                    F.when(F.col("o_orderstatus") == "O", "open").otherwise("done").alias("state"))
    for rest, days in _PAID:
        paid = rows.where((F.col("state") == "open") & (F.col("o_orderkey") % 3 == rest))
        rows = rows.unionByName(paid.withColumns({"placed": tm.shift("placed", f"{days} days"), "state": F.lit("paid")}))
    dealt = rows.withColumn("day", F.unix_date(F.col("placed").cast("date")) + F.pmod(F.xxhash64("o_orderkey", "state"), F.lit(DISORDER)).cast("int"))
    stream = in_batches(dealt, "payments_in", thirds(dealt, "day")).drop("day")
    base = new_folder(spark, "overdue")
    runs.drain(stream, paired.overdue_batches(["o_orderkey"], "placed", F.col("state") == "open", "708 hours",
                                              runs.keep_updates(f"{base}/out"), f"{base}/state", f"{DISORDER} days"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("o_orderkey", tm.to_text("placed", "yyyy-MM-dd").alias("placed"))


@query(f"""WITH {_ORDER_PARTS}, closed AS (SELECT least((SELECT max(o_orderdate) FROM o), (SELECT max(l_shipdate) FROM d))
  - INTERVAL {DISORDER} DAY AS until)
SELECT o.order_id, o_custkey, o_totalprice, {_DATES}, detail_id, goods_name,
coalesce(goods_number, 0) AS goods_number, coalesce(detail_money, 0) AS detail_money,
{_at(_W_ORDER)} AS window_start, {_at(_W_ORDER + f' + {90 * DAY}')} AS window_end
FROM o LEFT JOIN d ON o.order_id = d.order_id AND {_W_ORDER} = {_W_DETAIL}
WHERE d.order_id IS NOT NULL OR make_timestamp({_W_ORDER + f' + {90 * DAY}'}) <= (SELECT until FROM closed)""")
def stream_window_cogroup(spark, folder):
    """Left co-group of two streams: pairs at once, orders without a detail when the watermark has closed their window."""
    main, detail = _order_streams(spark, folder)
    return plain(_dates(_paired(spark, main, detail, "window_cogroup", lambda write, state: paired.window_batches(
        ["order_id"], "o_orderdate", "l_shipdate", "90 days", write, state, "left", {"goods_number": 0.0, "detail_money": 0.0},
        *[f"{DISORDER} days"] * 2))))


REPEATED = 20 * 3600  # seconds within which a record is delivered again


@query("SELECT event_id, user_id, event_type FROM events")
def stream_deduplicated(spark, folder):
    """Events of which every second one is delivered twice, the repeat in any later batch within the bound."""
    e = arrivals(tables.with_instants(events(spark, folder), "ts")).select("event_id", "user_id", "event_type", "ts", "arr")
    again = e.where("event_id % 2 = 0").withColumn("arr", F.col("arr") + F.pmod(F.xxhash64("event_id"), F.lit(REPEATED)))
    both = e.unionByName(again)
    # A day covers the two hours of disorder and the repeats' delay.
    stream = in_batches(both, "delivered_in", thirds(both, "arr")).drop("arr")
    return runs.result_table(sw.without_repeats(stream, ["event_id"], "ts", "1 day"), "deduplicated").drop("ts")


# --- streams with a carry from batch to batch -----------------------------------------------------------------------

def uneven(df: DataFrame, column: str, batches: int = BATCHES) -> Column:
    """Number of the part of the column's range that a value lies in, where parts are of very different sizes."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    share = (F.col(column) - low) / max(1, high - low + 1)
    return F.floor(share * share * batches).cast("int")


def _carried(df: DataFrame, name: str, part: Column, make) -> tuple[DataFrame, str]:
    """The result of a stream through `make(write, state)`, and its state folder."""
    base = new_folder(df.sparkSession, name)
    on_batch = make(runs.keep_updates(f"{base}/out"), f"{base}/state")
    runs.drain(in_batches(df, f"{name}_in", part), on_batch, f"{base}/checkpoint")
    return df.sparkSession.read.parquet(f"{base}/out").drop("batch"), f"{base}/state"


def _count_window_stream(spark, folder, size, slide):
    e = _slim(spark, folder)
    out, _ = _carried(e, "count_windows", uneven(e, "event_id"), lambda write, state: cr.count_window_batches(
        ["event_id"], size, SUM_VALUE, write, state, slide))
    return plain(out, "total")


@query(_counted(5, 5))
def stream_count_tumbling(spark, folder):
    return _count_window_stream(spark, folder, 5, 5)


@query(_counted(5, 2))
def stream_count_sliding(spark, folder):
    return _count_window_stream(spark, folder, 5, 2)


@query(_counted(3, 4))
def stream_count_skipping(spark, folder):
    return _count_window_stream(spark, folder, 3, 4)


@query(ORACLE["window_firings"])
def stream_window_firings(spark, folder):
    """Every firing of every window, written when it happens; at the end the windows that still wait."""
    e = arrivals(events(spark, folder)).withColumn("value", money("value"))
    out, state = _carried(e, "window_firings", thirds(e, "arr"), lambda write, state: cr.firing_batches(
        "ts", "value", ["arr", "event_id"], RULE, write, state, ["event_type"]))
    return plain(out.unionByName(cr.open_windows(spark, state, ["event_type"])), "total")


@query(ORACLE["asof_dim"])
def stream_asof_dim(spark, folder):
    """Log rows with the version of their user known when they came in; rows and versions come mixed."""
    e = _slim(spark, folder)
    out, _ = _carried(e, "asof_dim", uneven(e, "event_id"), lambda write, state: cr.asof_batches(
        F.col("event_type") == "signup", ["user_id"], ["event_id"], {"signup_value": "value"}, write, state, {"signup_value": -1.0}))
    return out.select("event_id", "user_id", "event_type", "signup_value")


@query(ORACLE["ttl_count"])
def stream_ttl_count(spark, folder):
    """Count per user that starts again after a day without a row, in event time."""
    e = tables.with_instants(events(spark, folder), "ts").select("event_id", "user_id", "ts")
    part = thirds(e.withColumn("at", F.unix_seconds("ts")), "at")
    out, _ = _carried(e.withColumn("at", F.unix_seconds("ts")), "ttl_count", part, lambda write, state: cr.expiring_batches(
        ["user_id"], "ts", "1 day", write, state, tie=["event_id"]))
    return out.select("event_id", "user_id", "running_count")


def _session_stream(spark, folder, gap, keys):
    """Events that come up to two hours out of order."""
    e = arrivals(tables.with_instants(events(spark, folder), "ts")).select("event_id", "user_id", "ts", "value", "arr")
    out, state = _carried(e, "sessions", uneven(e, "arr"), lambda write, state: cr.session_batches(
        "ts", gap, SUM_VALUE, write, state, keys, "2 hours"))
    return plain(out.unionByName(cr.open_sessions(spark, state, gap, SUM_VALUE, keys)), "total")


@query(ORACLE["session_sum"])
def stream_session_sum(spark, folder):
    return _session_stream(spark, folder, "60 minutes", ["user_id"])


@query(ORACLE["session_all"])
def stream_session_all(spark, folder):
    """Sessions without a key: open ones meet the batch's at their edges, in pieces."""
    return _session_stream(spark, folder, "5 minutes", [])
