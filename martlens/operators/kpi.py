"""KPI list (A16, U1): DAU, new devices and order amount per date.

Ids and names are the dashboard's. Per date the list has three entries;
a date with no orders has a null amount, one with no devices counts 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.operators.dau import daily_devices, dau_total
from martlens.operators.gmv import gmv_total

# KPI ids and names.
KPIS = (("dau", "新增日活"), ("new_mid", "新增设备"), ("order_amount", "新增交易额"))


def kpi_total(dau_daily: DataFrame, new_daily: DataFrame | None, gmv_daily: DataFrame) -> DataFrame:
    """Inputs: (logDate, dau), (logDate, new_devices), (create_date, sum_amount),
    each one row per date; without ``new_daily`` the first holds both counts
    (``dau.daily_devices``). Output: date, id, name, value (double).

    The three per-date aggregates are stacked (``unionByName``) and folded
    into one row per date by a single ``groupBy`` -- no joins -- then
    unpivoted with one ``explode``; every source is aggregated once.
    """
    ids = [kid for kid, _ in KPIS]

    def lane(df: DataFrame, date_col: str, **values: str) -> DataFrame:
        return df.select(F.col(date_col).alias("date"),
                         *[(F.col(values[k]) if k in values else F.lit(None)).cast("double").alias(k) for k in ids])

    if new_daily is None:
        stacked = lane(dau_daily, "logDate", dau="dau", new_mid="new_devices")
    else:
        stacked = lane(dau_daily, "logDate", dau="dau").unionByName(lane(new_daily, "logDate", new_mid="new_devices"))
    stacked = stacked.unionByName(lane(gmv_daily, "create_date", order_amount="sum_amount"))
    wide = stacked.groupBy("date").agg(*[F.max(k).alias(k) for k in ids])
    zero = {"dau": 0.0, "new_mid": 0.0, "order_amount": None}
    entries = F.array(*[
        F.struct(F.lit(kid).alias("id"), F.lit(name).alias("name"),
                 (F.col(kid) if zero[kid] is None else F.coalesce(F.col(kid), F.lit(zero[kid]))).alias("value"))
        for kid, name in KPIS])
    return wide.select("date", F.explode(entries).alias("e")).select("date", "e.id", "e.name", "e.value")


def kpi_for_dates(dau: DataFrame, orders: DataFrame, dates: Sequence[str], new_daily: DataFrame | None = None) -> DataFrame:
    """The dashboard's KPI list for some dates: always three rows a date (DAU and
    new devices 0, amount null when the date has no data). ``dau`` is the DAU
    table, ``orders`` the dated order table; all dates are one plan.

    With ``new_daily`` (logDate, new_devices), as a ``DeviceHistory`` keeps it, every
    input reads these dates only when it is stored partitioned. Without it the
    first day of every device is found from ``dau``, together with the counts."""
    dates = list(dates)
    spine = dau.sparkSession.range(1).select(F.explode(F.array(*[F.lit(d) for d in dates])).alias("logDate"), F.lit(0).cast("long").alias("n"))
    amounts = gmv_total(orders.filter(F.col("create_date").isin(dates)))
    if new_daily is None:
        both = daily_devices(dau).filter(F.col("logDate").isin(dates))
        zeros = spine.select("logDate", F.col("n").alias("dau"), F.col("n").alias("new_devices"))
        return kpi_total(both.unionByName(zeros), None, amounts)
    counts = dau_total(dau.filter(F.col("logDate").isin(dates))).unionByName(spine.select("logDate", F.col("n").alias("dau")))
    return kpi_total(counts, new_daily.filter(F.col("logDate").isin(dates)), amounts)


def kpi_for_date(dau: DataFrame, orders: DataFrame, date: str, new_daily: DataFrame | None = None) -> DataFrame:
    """``kpi_for_dates`` for one date."""
    return kpi_for_dates(dau, orders, [date], new_daily)
