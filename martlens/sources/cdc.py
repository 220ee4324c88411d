"""Row-change events.

An envelope row is ``(entry_type, table_name, op, after map<string,string>)``;
routing keeps ROWDATA entries and sends order inserts, order-line inserts and
user inserts/updates to their topics as a JSON object of the after-image.
Everything else is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.sources.logs import TOPIC_ORDER_DETAIL, TOPIC_ORDER_INFO, TOPIC_USER_INFO
from martlens.sources.tables import line_id

# Routing table (table, accepted operations, topic).
ROUTES = (
    ("order_info", ("INSERT",), TOPIC_ORDER_INFO),
    ("order_detail", ("INSERT",), TOPIC_ORDER_DETAIL),
    ("user_info", ("INSERT", "UPDATE"), TOPIC_USER_INFO),
)
ROWDATA = "ROWDATA"


def topic_for(table_name: F.Column, op: F.Column) -> F.Column:
    out = F.lit(None).cast("string")
    for table, ops, topic in reversed(ROUTES):
        out = F.when((table_name == table) & op.isin(*ops), F.lit(topic)).otherwise(out)
    return out


def route_changes(changes: DataFrame) -> DataFrame:
    """Keep routable ROWDATA entries; add ``topic`` and ``value`` (JSON)."""
    return (changes.filter(F.col("entry_type") == ROWDATA)
                   .withColumn("topic", topic_for(F.col("table_name"), F.col("op")))
                   .filter(F.col("topic").isNotNull())
                   .withColumn("value", F.to_json(F.col("after"))))


def _image(*pairs: tuple[str, F.Column]) -> F.Column:
    args = []
    for name, c in pairs:
        args += [F.lit(name), c.cast("string")]
    return F.create_map(*args)


def _money(c: str) -> F.Column:
    """Two-decimal money text (half up), via a codegen'd decimal cast."""
    return F.col(c).cast("decimal(18,2)").cast("string")


def change_log(orders: DataFrame, lineitem: DataFrame, customer: DataFrame, part: DataFrame) -> DataFrame:
    """A binlog over the warehouse tables, derived row by row.

    * every order is an ``order_info`` INSERT; a finished order (status F) is
      also an ``order_info`` UPDATE (not routed);
    * every line is an ``order_detail`` INSERT;
    * every customer is a ``user_info`` INSERT, and a ``user_info`` UPDATE
      when its account balance is negative;
    * every part is an INSERT into ``sku_info`` (a table nobody routes);
    * each order also opens a transaction: a TRANSACTIONBEGIN entry.
    Columns: entry_type, table_name, op, key, after.
    """
    def entries(df: DataFrame, *rows: F.Column) -> DataFrame:
        """The change entries of each row of a table, as data of one array."""
        return df.select(F.explode(F.array(*rows)).alias("e")).select("e.*").filter(F.col("table_name").isNotNull())

    def entry(table: str, op: str, key: F.Column, image: F.Column, when: F.Column | None = None,
              entry_type: str = ROWDATA) -> F.Column:
        named = F.lit(table) if when is None else F.when(when, F.lit(table))
        return F.struct(F.lit(entry_type).alias("entry_type"), named.alias("table_name"), F.lit(op).alias("op"),
                        key.alias("key"), image.alias("after"))

    oimg = _image(("id", F.col("o_orderkey")), ("user_id", F.col("o_custkey")),
                  ("order_status", F.col("o_orderstatus")), ("total_amount", _money("o_totalprice")),
                  ("create_time", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    okey = F.col("o_orderkey").cast("string")
    lkey = line_id()
    limg = _image(("id", lkey), ("order_id", F.col("l_orderkey")), ("sku_id", F.col("l_partkey")),
                  ("order_price", _money("l_extendedprice")), ("sku_num", F.col("l_quantity").cast("int")))
    ckey = F.col("c_custkey").cast("string")
    cimg = _image(("id", F.col("c_custkey")), ("login_name", F.col("c_name")), ("user_level", F.col("c_mktsegment")))
    nothing = F.create_map().cast("map<string,string>")
    return entries(orders,
                   entry("order_info", "INSERT", okey, oimg),
                   entry("order_info", "UPDATE", okey, oimg, F.col("o_orderstatus") == "F"),
                   entry("order_info", "INSERT", okey, nothing, entry_type="TRANSACTIONBEGIN")
                   ).unionByName(entries(lineitem, entry("order_detail", "INSERT", lkey, limg))
                   ).unionByName(entries(customer,
                                         entry("user_info", "INSERT", ckey, cimg),
                                         entry("user_info", "UPDATE", ckey, cimg, F.col("c_acctbal") < 0))
                   ).unionByName(entries(part, entry("sku_info", "INSERT", F.col("p_partkey").cast("string"),
                                                     _image(("id", F.col("p_partkey")), ("sku_name", F.col("p_name"))))))
