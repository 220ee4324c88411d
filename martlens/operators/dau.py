"""Daily active devices (W1, L2, T4, J5, J6, U2, A1, A2, J7, new devices).

A device is active on a day from its first start-up log of that day; the
DAU table holds exactly that first row per ``(mid, logDate)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.time import with_log_date_hour
from martlens.operators.keyed import first_per_key

DEVICE_DAY = ("mid", "logDate")


def dau_first(startup: DataFrame, tz: str = "UTC") -> DataFrame:
    """Earliest start-up per device and day (ties on ts: smallest uid, then the
    remaining columns). Adds ``logDate``/``logHour`` when missing."""
    logs = startup if "logDate" in startup.columns else with_log_date_hour(startup, "ts", tz)
    return first_per_key(logs, DEVICE_DAY, ("ts", "uid"))


def dau_incremental(batch: DataFrame, seen: DataFrame, tz: str = "UTC") -> DataFrame:
    """New DAU rows of a micro-batch: first start-up per device-day of the
    batch, minus device-days already stored (``seen`` has mid, logDate).

    The anti-join key includes the log's own date, so a late log near midnight
    is compared with its own day. No broadcast hint: ``seen`` grows with the
    number of devices, AQE broadcasts it only when its measured size is small.
    """
    return not_seen(dau_first(batch, tz), seen)


def not_seen(firsts: DataFrame, seen: DataFrame) -> DataFrame:
    """Device-days that ``seen`` (mid, logDate) does not have."""
    # distinct: a partial aggregate on the join key (its exchange also serves
    # the join), so duplicated seen rows never pile up in one task
    keys = seen.select(*DEVICE_DAY).distinct()
    return firsts.join(keys, list(DEVICE_DAY), "left_anti")


def dau_total(dau: DataFrame, date: str | None = None) -> DataFrame:
    """A1: DAU count per ``logDate`` (one date: a single row, 0 when empty)."""
    if date is not None:
        return dau.filter(F.col("logDate") == date).agg(F.count(F.lit(1)).alias("dau")) \
                  .select(F.lit(date).alias("logDate"), "dau")
    return dau.groupBy("logDate").agg(F.count(F.lit(1)).alias("dau"))


def dau_hours(dau: DataFrame, date: str | None = None) -> DataFrame:
    """A2: DAU per ``logDate`` and ``logHour``."""
    src = dau if date is None else dau.filter(F.col("logDate") == date)
    return src.groupBy("logDate", "logHour").agg(F.count(F.lit(1)).alias("dau"))


def new_devices(dau: DataFrame, date: str | None = None) -> DataFrame:
    """Devices whose first-ever active day is ``logDate``. The minimum is
    taken over a DATE (fixed width, so a codegen'd hash aggregate; a string
    minimum would force a sort-based aggregate over all device history)."""
    first_day = dau.groupBy("mid").agg(F.date_format(F.min(F.to_date("logDate")), "yyyy-MM-dd").alias("logDate"))
    out = first_day.groupBy("logDate").agg(F.count(F.lit(1)).alias("new_devices"))
    return out if date is None else out.filter(F.col("logDate") == date)


def hour_map(hourly: DataFrame, value: str, date_col: str, hour_col: str) -> DataFrame:
    """Hourly values as one ``map<hour, value>`` per date -- the shape the
    hourly endpoints return. At most 24 entries per group."""
    return hourly.groupBy(date_col).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(hour_col), F.col(value))))).alias("hours"))


def daily_devices(dau: DataFrame) -> DataFrame:
    """Daily count and new devices per date from one shuffle of the device-days
    (date, dau, new_devices): the days of a device come together once, and the
    smallest of them is its first."""
    days = dau.select("mid", F.to_date("logDate").alias("day")).groupBy("mid").agg(F.collect_set("day").alias("days"))
    first = F.array_min("days")
    rows = days.select(F.explode(F.transform("days", lambda d: F.struct(d.alias("d"), (d == first).cast("long").alias("new")))).alias("e"))
    return rows.groupBy(F.date_format("e.d", "yyyy-MM-dd").alias("logDate")).agg(
        F.count(F.lit(1)).alias("dau"), F.sum("e.new").alias("new_devices"))


def _day_before(date: str) -> F.Column:
    return F.date_format(F.date_sub(F.to_date(F.lit(date)), 1), "yyyy-MM-dd")


def hours_compare(hourly: DataFrame, value: str, date_col: str, hour_col: str,
                  zero=0, date: str | None = None) -> DataFrame:
    """Today versus yesterday per hour on a 24-hour spine, missing = 0.
    Output: date, hour, today, yesterday.

    With ``date`` the spine is that date's 24 hours, whether or not it has any
    rows: just after midnight yesterday's curve stands against zeros. Without
    it, every date that has rows gets its spine (a date that only follows one
    with rows does not).

    One aggregation, no joins: rows, shifted rows and spine slots are stacked
    and summed per (date, hour), partially on the map side.
    """
    kind = dict(hourly.dtypes)[value]
    z = F.lit(zero).cast(kind)
    v = F.coalesce(F.col(value), z)
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda x: F.lpad(x.cast("string"), 2, "0"))
    d, h = F.col(date_col), F.col(hour_col)
    if date is not None:
        day = F.lit(date)
        spine = hourly.sparkSession.range(1).select(day.alias("d"), F.explode(hours).alias("hour"), z.alias("today"), z.alias("yesterday"))
        own = hourly.filter(d == date).select(day.alias("d"), h.alias("hour"), v.alias("today"), z.alias("yesterday"))
        before = hourly.filter(d == _day_before(date)).select(day.alias("d"), h.alias("hour"), z.alias("today"), v.alias("yesterday"))
        out = spine.unionByName(own).unionByName(before).groupBy("d", "hour").agg(
            F.sum("today").alias("today"), F.sum("yesterday").alias("yesterday"))
    else:
        def entry(day, hour, today, yesterday, own):
            return F.struct(day.alias("d"), hour.alias("hour"), today.alias("today"),
                            yesterday.alias("yesterday"), F.lit(own).alias("own"))

        nxt = F.date_format(F.date_add(F.to_date(d), 1), "yyyy-MM-dd")
        spine = F.transform(hours, lambda x: entry(d, x, z, z, 1))
        entries = F.concat(F.array(entry(d, h, v, z, 1), entry(nxt, h, z, v, 0)), spine)
        out = (hourly.select(F.explode(entries).alias("e")).select("e.*").groupBy("d", "hour")
               .agg(F.sum("today").alias("today"), F.sum("yesterday").alias("yesterday"), F.max("own").alias("own"))
               .filter(F.col("own") == 1))
    return out.select(F.col("d").alias(date_col), "hour", F.col("today").cast(kind).alias("today"),
                      F.col("yesterday").cast(kind).alias("yesterday"))
