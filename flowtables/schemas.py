"""Record types of the inputs and results the library knows. Every reader is given one of these, none is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# CLICK_JSON has the names as they stand in the file, CLICK_NAMES those used in frames, in the same order.
CLICK_JSON = _schema(browserType=_S, categoryID=_L, channelID=_L, city=_S, country=_S, entryTime=_L, leaveTime=_L,
                     network=_S, produceID=_L, province=_S, source=_S, userID=_L)
CLICK_NAMES = ("browser_type", "category_id", "channel_id", "city", "country", "entry_time", "leave_time",
               "network", "produce_id", "province", "source", "user_id")
STUDENT = _schema(id=_I, name=_S)
SCORE = _schema(stu_id=_I, course=_S, score=_I)
RATING = _schema(user_id=_S, movie_id=_S, rating=_D, ts=_L)
TRACK_LOG = _schema(user_id=_S, item_id=_I, behavior=_S, ts=_S)
ROAD_RECORD = _schema(record_time=_TS, road_id=_S, record_count=_I)
GATE_FLOW_EVENT = _schema(event_time=_S, gate=_S, flow=_I)
ORDER_EVENT = _schema(order_id=_S, user_id=_S, order_money=_D, order_time=_S)
MAIN_ORDER = _schema(order_time=_S, order_id=_S, user_id=_S, address=_S, order_money=_D)
DETAIL_ORDER = _schema(detail_time=_S, order_id=_S, detail_id=_S, goods_name=_S, goods_number=_I, detail_money=_D)
DETAIL_DEFAULTS = {"goods_number": 0, "detail_money": 0.0}
PAY_ORDER = _schema(order_id=_S, user_id=_S, order_time=_S, order_status=_S, order_amount=_D)
USER_LOG = _schema(user_id=_S, product_id=_I, track_time=_S, event_type=_S)
USER_ROW = _schema(id=_I, name=_S, age=_I, gender=_S)
USER_CHANGE = T.StructType([
    T.StructField("op", _S), T.StructField("before", USER_ROW), T.StructField("after", USER_ROW),
    T.StructField("ts_ms", _L)])

# The column names of a chat record, in file order.
CHAT_COLUMNS = (
    "msg_time", "sender_nickyname", "sender_account", "sender_sex", "sender_ip", "sender_os", "sender_phone_type",
    "sender_network", "sender_gps", "receiver_nickyname", "receiver_ip", "receiver_account", "receiver_os",
    "receiver_phone_type", "receiver_network", "receiver_gps", "receiver_sex", "msg_type", "distance", "message")
CHAT_MESSAGE = T.StructType([T.StructField(c, _S) for c in CHAT_COLUMNS])
CHAT_KEY = ("sender_account", "msg_time", "receiver_account")
