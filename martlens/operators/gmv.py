"""Order amount (GMV) by day and hour (P3, P4, A3, A4) and by province.

Money is summed as decimal(18,2) and cast to double at the end, so the sum
does not depend on the order Spark adds partial sums in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.text import mask_phone
from martlens.functions.time import with_create_date_hour

MONEY = "decimal(18,2)"


def money_sum(c: str) -> F.Column:
    return F.sum(F.col(c).cast(MONEY)).cast("double")


def prepare_orders(order_info: DataFrame) -> DataFrame:
    """Add create_date/create_hour and mask the phone, as stored for serving."""
    out = with_create_date_hour(order_info)
    if "consignee_tel" in out.columns:
        out = out.withColumn("consignee_tel", mask_phone("consignee_tel"))
    return out


def gmv_total(orders: DataFrame, date: str | None = None) -> DataFrame:
    """A3: order amount per ``create_date`` (one date: null when no orders)."""
    if date is not None:
        return orders.filter(F.col("create_date") == date).agg(money_sum("total_amount").alias("sum_amount")) \
                     .select(F.lit(date).alias("create_date"), "sum_amount")
    return orders.groupBy("create_date").agg(money_sum("total_amount").alias("sum_amount"))


def gmv_hours(orders: DataFrame, date: str | None = None) -> DataFrame:
    """A4: order amount per ``create_date`` and ``create_hour``."""
    src = orders if date is None else orders.filter(F.col("create_date") == date)
    return src.groupBy("create_date", "create_hour").agg(money_sum("total_amount").alias("sum_amount"))


def sales_by_province(orders: DataFrame, provinces: DataFrame | None = None) -> DataFrame:
    """Order count and amount per ``province_id``.

    With ``provinces`` (user_id, province_id) the orders are first reduced to
    one row per user (count, exact decimal sum), so the join to the user's
    province sees one row per user instead of one per order; the second
    level sums the partial counts and amounts.
    """
    if provinces is None:
        return orders.groupBy("province_id").agg(F.count(F.lit(1)).alias("order_count"),
                                                 money_sum("total_amount").alias("sum_amount"))
    per_user = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"),
                                             F.sum(F.col("total_amount").cast(MONEY)).alias("amount"))
    return (per_user.join(provinces, "user_id", "left")
                    .groupBy("province_id").agg(F.sum("n").alias("order_count"),
                                                F.sum("amount").cast("double").alias("sum_amount")))
