"""Distinct devices of any date range from daily bitmap sets.

A device gets a dense number once (``number_devices``, ``extend_numbers``): its
hash picks one of ``parts``, its place among the devices of that part is the
low half.  The devices of a day are then one row per 32,768 numbers, a bitmap
of 4 KB.  Bitmaps of days, batches or parts merge by OR, exactly, so a range of
dates reads its daily rows and never the logs behind them.

Devices or days that are null are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PLACE_BITS = 40     # of a number, below the part
PARTS = 64


def _part(parts: int):
    return F.pmod(F.xxhash64("mid"), F.lit(parts)).cast("long")


def _numbered(mids: DataFrame, parts: int) -> DataFrame:
    rows = mids.select("mid").filter(F.col("mid").isNotNull()).distinct().withColumn("part", _part(parts))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("mid")).cast("long") - 1)


def number_devices(mids: DataFrame, parts: int = PARTS) -> DataFrame:
    """(mid, number) of the distinct devices in ``mids``."""
    return _numbered(mids, parts).select("mid", (F.shiftleft("part", PLACE_BITS) + F.col("place")).alias("number"))


def used_places(numbers: DataFrame) -> DataFrame:
    """(part, used): how many places of each part ``numbers`` takes."""
    return numbers.groupBy(F.shiftright("number", PLACE_BITS).alias("part")).agg(
        (F.max("number") % F.lit(1 << PLACE_BITS) + 1).alias("used"))


def extend_numbers(numbers: DataFrame, mids: DataFrame, parts: int = PARTS, used: DataFrame | None = None) -> DataFrame:
    """Numbers of the devices of ``mids`` that ``numbers`` does not know, behind
    the used places of their part.  ``parts`` must be what it was.  With ``used``
    (see ``used_places``), ``numbers`` need only hold the devices of ``mids``."""
    fresh = _numbered(mids.select("mid").join(numbers.select("mid"), "mid", "left_anti"), parts)
    return fresh.join(used_places(numbers) if used is None else used, "part", "left").select(
        "mid", (F.shiftleft("part", PLACE_BITS) + F.col("place") + F.coalesce("used", F.lit(0))).alias("number"))


def daily_sets(device_days: DataFrame, numbers: DataFrame) -> DataFrame:
    """(logDate, bucket, devices): bitmaps of the devices of each day.
    Repeated device-days are one bit."""
    rows = device_days.select("mid", "logDate").filter(F.col("logDate").isNotNull()).distinct().join(numbers, "mid")
    return rows.groupBy("logDate", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("devices"))


def merge_sets(sets: DataFrame) -> DataFrame:
    """One row per day and bucket of sets that several batches wrote."""
    return sets.groupBy("logDate", "bucket").agg(F.bitmap_or_agg("devices").alias("devices"))


def active_devices(sets: DataFrame, first: str, last: str) -> DataFrame:
    """One row: distinct devices from ``first`` to ``last``, both included (0
    when there are none).  On sets stored by date, only these days are read."""
    days = sets.filter(F.col("logDate").between(first, last))
    return days.groupBy("bucket").agg(F.bitmap_or_agg("devices").alias("devices")).agg(
        F.coalesce(F.sum(F.bitmap_count("devices")), F.lit(0)).alias("devices"))


def _trailing(rows: DataFrame, spans: Sequence[int]) -> list[tuple[int, DataFrame]]:
    """For each span (ascending), (bucket, day, devices) with the devices of the
    span's days up to ``day``.  A set of s days and the set of s days that ends
    ``step`` days before make one of s + step days, so a span takes log2 steps.
    Rows are dealt by bucket once; every step groups inside that partitioning."""
    out, span = [], 1
    rows = rows.repartition("bucket")
    for want in spans:
        while span < want:
            step = min(span, want - span)
            both = rows.select("bucket", F.explode(F.array(F.col("day"), F.date_add("day", step))).alias("day"), "devices")
            rows = both.groupBy("bucket", "day").agg(F.bitmap_or_agg("devices").alias("devices"))
            span += step
        out.append((want, rows))
    return out


def trailing_active_devices(sets: DataFrame, spans: Sequence[int] = (7, 30)) -> DataFrame:
    """Per calendar day from the first to the last day of ``sets`` (days without
    a device in any span left out): the distinct devices of the last n days, the
    day itself included, as columns ``devices_<n>``."""
    rows = sets.select("bucket", F.to_date("logDate").alias("day"), "devices")
    last = rows.agg(F.max("day")).scalar()
    spans = sorted(spans)
    lanes = [r.filter(F.col("day") <= last).select(
        "day", *[F.bitmap_count("devices").alias(f"devices_{n}") if n == span else F.lit(None).cast("long").alias(f"devices_{n}")
                 for n in spans]) for span, r in _trailing(rows, spans)]
    stacked = reduce(DataFrame.unionByName, lanes)
    return stacked.groupBy(F.date_format("day", "yyyy-MM-dd").alias("logDate")).agg(
        *[F.coalesce(F.sum(f"devices_{n}"), F.lit(0)).alias(f"devices_{n}") for n in spans])
