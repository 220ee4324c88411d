"""Record schemas of the domain (start-up log, event log, order, order line,
user, sale detail, coupon alert, change event) as Spark types.

Time arrives as epoch milliseconds (``ts bigint``) or as a
``yyyy-MM-dd HH:mm:ss`` string, money as double; nothing else is typed.
"""

from pyspark.sql import types as T

S = T.StringType()

STARTUP_LOG = T.StructType([
    T.StructField("mid", S), T.StructField("uid", S), T.StructField("appid", S),
    T.StructField("area", S), T.StructField("os", S), T.StructField("ch", S),
    T.StructField("type", S), T.StructField("vs", S), T.StructField("ts", T.LongType()),
])

EVENT_LOG = T.StructType([
    T.StructField("mid", S), T.StructField("uid", S), T.StructField("appid", S),
    T.StructField("area", S), T.StructField("os", S), T.StructField("type", S),
    T.StructField("evid", S), T.StructField("pgid", S), T.StructField("npgid", S),
    T.StructField("itemid", S), T.StructField("ts", T.LongType()),
])

ORDER_INFO = T.StructType(
    [T.StructField(c, S) for c in (
        "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
        "payment_way", "user_id", "img_url")]
    + [T.StructField("total_amount", T.DoubleType())]
    + [T.StructField(c, S) for c in (
        "expire_time", "delivery_address", "create_time", "operate_time", "tracking_no",
        "parent_order_id", "out_trade_no", "trade_body")]
)

ORDER_DETAIL = T.StructType([T.StructField(c, S) for c in (
    "id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")])

USER_INFO = T.StructType([T.StructField(c, S) for c in (
    "id", "login_name", "user_level", "birthday", "gender")])

# Output record of the order x line x user join, in field order.
SALE_DETAIL_COLUMNS = (
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt",
)

# Row-change envelope: one row per changed database row (``key`` is the
# changed row's primary key as text).
CHANGE_EVENT = T.StructType([
    T.StructField("entry_type", S), T.StructField("table_name", S), T.StructField("op", S),
    T.StructField("key", S), T.StructField("after", T.MapType(S, S)),
])
