"""Order x order-line x user wide table.

In batch the late-arrival join of the stream is an inner equi-join on the
order id; the streaming form (``martlens.streaming.jobs``) adds watermarks
and an arrival-time range so state stays bounded. The user dimension is a
left join: an unknown user keeps null attributes and age 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.time import age_in_years, with_create_date_hour
from martlens.schemas import SALE_DETAIL_COLUMNS


def _order_side(order_info: DataFrame) -> DataFrame:
    o = order_info if "create_date" in order_info.columns else with_create_date_hour(order_info)
    return o.select(F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
                    F.col("create_date").alias("dt"))


def _line_side(order_detail: DataFrame) -> DataFrame:
    names = ["sku_name"] if "sku_name" in order_detail.columns else []
    return order_detail.select(F.col("id").alias("order_detail_id"), "order_id", "sku_id", *names,
                               F.col("order_price").cast("double").alias("sku_price"))


def join_orders_lines(order_info: DataFrame, order_detail: DataFrame, how: str = "inner") -> DataFrame:
    """J1/J2 (inner) or J3 (``full_outer``) on the order id."""
    o, d = _order_side(order_info), _line_side(order_detail)
    if how == "full_outer":
        return full_outer_skew_safe(o, d, "order_id").select(*o.columns, *[c for c in d.columns if c != "order_id"])
    return o.join(d, "order_id", how)


def full_outer_skew_safe(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """Full outer equi-join as ``many LEFT OUTER one`` plus ``one LEFT ANTI
    distinct(many keys)`` -- the same rows as ``join(..., 'full_outer')``.

    AQE cannot split a hot key of a full outer join (both sides are
    preserved); it can split the left side of a left outer join, where a key
    holding a third of the ``many`` rows lands. The anti join sees the
    ``many`` keys after a partially aggregated ``distinct``, so the hot key
    crosses the shuffle once per map task. Null keys never match and are kept
    by both parts, as in a full outer join.
    """
    with_match = many.join(one, key, "left_outer")
    unmatched = one.join(many.select(key).distinct(), key, "left_anti")
    return with_match.unionByName(unmatched, allowMissingColumns=True)


def enrich_users(sales: DataFrame, user_info: DataFrame, as_of: str | Column) -> DataFrame:
    """Left join the user dimension; age in whole 365-day years as of
    ``as_of``; unknown user -> null gender/level, age 0.

    No broadcast hint: the user table grows with the customer base, so the
    choice is left to the size estimate and AQE's runtime statistics.
    """
    users = user_info.select(F.col("id").alias("user_id"), F.col("gender").alias("user_gender"),
                             F.col("user_level"), F.col("birthday").alias("_birthday"))
    return (sales.join(users, "user_id", "left")
                 .withColumn("user_age", F.coalesce(age_in_years("_birthday", as_of), F.lit(0)))
                 .drop("_birthday"))


def sale_detail(order_info: DataFrame, order_detail: DataFrame, user_info: DataFrame,
                as_of: str | Column) -> DataFrame:
    """The full wide row plus ``doc_id`` = ``order_id_order_detail_id``.

    Users are joined to the orders before the lines: the user join then
    shuffles order rows rather than line rows, and the line side is
    shuffled once, by order id."""
    orders = enrich_users(_order_side(order_info), user_info, as_of)
    rows = orders.join(_line_side(order_detail), "order_id", "inner")
    return rows.select(F.concat_ws("_", F.col("order_id").cast("string"), "order_detail_id").alias("doc_id"),
                       *SALE_DETAIL_COLUMNS)


def interval_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                  lower: str, upper: str) -> DataFrame:
    """Equi-join on ``key`` with ``left_time + lower <= right_time <= left_time + upper``.

    Bounds are interval literals such as ``"-30 days"`` / ``"30 days"``. The
    equality key drives the shuffle; the range is a post-join filter inside
    the sort-merge join, the same shape Spark's stream-stream join needs.
    """
    cond = ((left[key] == right[key])
            & (right[right_time] >= left[left_time] + F.expr(f"INTERVAL {lower}"))
            & (right[right_time] <= left[left_time] + F.expr(f"INTERVAL {upper}")))
    return left.join(right, cond, "inner").drop(right[key])


def unmatched_lines(lines: DataFrame, orders: DataFrame, key: str, line_time: str, order_time: str,
                    bound: str) -> DataFrame:
    """Lines that no order of their key met within ``bound`` of their time, either
    way: what the stream drops from its join state, and sends to the reject topic.
    A line without a key or a time meets nobody."""
    o = orders.select(F.col(key).alias("_key"), F.col(order_time).alias("_time"))
    met = ((F.col(key) == F.col("_key")) & (F.col(line_time) >= F.col("_time") - F.expr(f"INTERVAL {bound}"))
           & (F.col(line_time) <= F.col("_time") + F.expr(f"INTERVAL {bound}")))
    return lines.join(o, met, "left_anti")
