"""Adapters from the warehouse tables (``events``, ``orders``, ``lineitem``,
``customer``, ``part``, ``nation``) to the domain records.

Every adapter is a projection (plus, for order lines, one lookup join), so
Catalyst prunes columns and pushes filters straight to the parquet scan.
Timestamps in the tables are TIMESTAMP_NTZ and are read as UTC wall clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions.time import epoch_ms

# Stand-ins chosen for the event vocabulary of the tables.
# A purchase is a coupon take, a click is an item view.
EVID_MAP = {"purchase": "coupon", "click": "clickItem"}
# A signup is the app start-up record; every other event is an event log.
STARTUP_EVENT_TYPE = "signup"
# Devices for the alert stream: ten devices from the props key.
ALERT_DEVICES = 10
# Birthday and gender are fixed functions of the customer key.
BIRTHDAY_BASE = "1960-01-01"
BIRTHDAY_STEP = 7919
BIRTHDAY_SPAN_DAYS = 18262

PROPS_SCHEMA = "k INT"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def props_key(events: DataFrame) -> DataFrame:
    """Parse the JSON ``props`` into its typed ``k`` field."""
    return events.withColumn("k", F.from_json("props", PROPS_SCHEMA).getField("k"))


def startup_logs(events: DataFrame) -> DataFrame:
    """Start-up log per app activity row: the device is the user.

    Columns: mid, uid (bigint keys), type, ts (epoch ms), log_id. Keys keep
    their source type so joins and shuffles hash 8-byte longs, not strings.
    """
    uid = F.col("user_id")
    return events.select(
        uid.alias("mid"), uid.alias("uid"), F.lit("startup").alias("type"),
        epoch_ms("ts").alias("ts"), F.col("event_id").alias("log_id"),
    )


def evid_of(event_type: F.Column) -> F.Column:
    out = event_type
    for src, dst in EVID_MAP.items():
        out = F.when(event_type == src, F.lit(dst)).otherwise(out)
    return out


def event_logs(events: DataFrame) -> DataFrame:
    """Event log: device = props k mod 10, user = user_id, item = props k.

    Columns: mid (int), uid (bigint), evid, itemid (int), ts (epoch ms), log_id.
    The props JSON is parsed once, in its own projection.
    """
    parsed = events.select("event_id", "user_id", "event_type", "ts",
                           F.from_json("props", PROPS_SCHEMA).getField("k").alias("k"))
    return parsed.select(
        (F.col("k") % ALERT_DEVICES).alias("mid"),
        F.col("user_id").alias("uid"),
        evid_of(F.col("event_type")).alias("evid"),
        F.col("k").alias("itemid"),
        epoch_ms("ts").alias("ts"),
        F.col("event_id").alias("log_id"),
    )


def phone_of(custkey: F.Column) -> F.Column:
    return F.concat(F.lit("1"), F.lpad(custkey.cast("string"), 10, "0"))


def order_info(orders: DataFrame) -> DataFrame:
    """Order records."""
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        phone_of(F.col("o_custkey")).alias("consignee_tel"),
    )


def line_id() -> F.Column:
    """The line table has no primary key; a line is named by
    ``orderkey-linenumber-partkey-suppkey-shipdate(yyyyMMdd)``. Two lines equal
    in all of these are one line to the keyed upsert."""
    d = F.col("l_shipdate")
    yyyymmdd = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    return F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                       yyyymmdd.cast("string"))


def order_detail(lineitem: DataFrame, part: DataFrame | None = None) -> DataFrame:
    """Order lines, with the product name where ``part`` is given; order and
    sku ids stay bigint and the price is money (decimal(18,2)), not the text
    it travels as."""
    rows, name = lineitem, []
    if part is not None:
        names = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("sku_name"))
        rows, name = lineitem.join(names, "l_partkey", "left"), ["sku_name"]
    return rows.select(
        line_id().alias("id"),
        F.col("l_orderkey").alias("order_id"),
        *name,
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("order_price"),
        F.col("l_quantity").cast("int").cast("string").alias("sku_num"),
    )


def user_info(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    birthday = F.date_add(F.to_date(F.lit(BIRTHDAY_BASE)),
                          ((key * BIRTHDAY_STEP) % BIRTHDAY_SPAN_DAYS).cast("int"))
    return customer.select(
        key.alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_format(birthday, "yyyy-MM-dd").alias("birthday"),
        F.when(key % 2 == 1, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
    )
