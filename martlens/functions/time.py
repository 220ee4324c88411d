"""Time helpers.

Logs carry ``ts`` as epoch milliseconds; orders carry ``create_time`` as a
``yyyy-MM-dd HH:mm:ss`` string. Wall-clock values are produced as
TIMESTAMP_NTZ in an explicit zone so results never depend on the session or
JVM time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def epoch_ms(ntz: Column | str) -> Column:
    """TIMESTAMP_NTZ (read as UTC wall clock) -> epoch milliseconds."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), F.col(ntz) if isinstance(ntz, str) else ntz)


def from_epoch_ms(ms: Column | str, tz: str = "UTC") -> Column:
    """Epoch milliseconds -> wall-clock TIMESTAMP_NTZ in zone ``tz``."""
    c = F.col(ms) if isinstance(ms, str) else ms
    utc = F.timestamp_add("MILLISECOND", c, _epoch_ntz())
    if tz.upper() in ("UTC", "Z", "+00:00"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def with_log_date_hour(df: DataFrame, ts: str = "ts", tz: str = "UTC") -> DataFrame:
    """Add ``logDate`` (yyyy-MM-dd) and ``logHour`` (HH) from epoch-ms ``ts``."""
    wall = from_epoch_ms(ts, tz)
    return (df.withColumn("logDate", F.date_format(wall, "yyyy-MM-dd"))
              .withColumn("logHour", F.date_format(wall, "HH")))


def with_create_date_hour(df: DataFrame, create_time: str = "create_time") -> DataFrame:
    """Add ``create_date`` and ``create_hour`` by splitting ``yyyy-MM-dd HH:mm:ss``.
    A value without a time part gets a null hour (``get`` is null-safe under
    ANSI mode, where ``[1]`` would raise)."""
    parts = F.split(F.col(create_time), " ")
    return (df.withColumn("create_date", F.get(parts, 0))
              .withColumn("create_hour", F.get(F.split(F.get(parts, 1), ":"), 0)))


def age_in_years(birthday: Column | str, as_of: Column | str) -> Column:
    """Whole days between ``birthday`` and ``as_of`` divided by 365, truncated.

    Not calendar years: 365 days after a birthday is age 1, 364 days is 0.
    A null or unparsable birthday gives null (callers default it to 0).
    """
    b = F.try_to_date(F.col(birthday) if isinstance(birthday, str) else birthday)
    a = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return (F.datediff(a, b) / F.lit(365)).cast("int")


def epoch_minute(ms: Column | str) -> Column:
    """Epoch minute of an epoch-ms value (``ts / 1000 / 60``)."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.floor(c / F.lit(60000)).cast("long")
