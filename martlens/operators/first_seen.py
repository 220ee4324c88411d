"""First-seen days of devices as monotone state, with an index by date.

The state holds the smallest day each device was seen on.  A batch of device
days lowers it or leaves it: ``first_seen_moves`` gives the signed rows of what
changed, (day, +1) for a new first day and (old day, -1) for the day a late log
takes the device away from.  Their sums by day are the new devices of each
day, so one date reads its own rows, not the history of all devices.

Devices or days that are null are left out.  The result does not depend on how
the logs fall into batches or in which order these arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_days(device_days: DataFrame) -> DataFrame:
    """(mid, first_day) of rows with mid and logDate (yyyy-MM-dd).  The minimum
    is taken over a DATE, which a codegen'd hash aggregate keeps in place."""
    return device_days.select("mid", F.to_date("logDate").alias("day")).filter(
        F.col("mid").isNotNull() & F.col("day").isNotNull()).groupBy("mid").agg(F.min("day").alias("first_day"))


def first_seen_moves(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    """(mid, first_day, old_day) of devices whose first day ``batch`` (mid,
    logDate) lowers; old_day is null for devices not seen before."""
    new = first_days(batch)
    if state is None:
        return new.withColumn("old_day", F.lit(None).cast("date"))
    known = state.select("mid", F.col("first_day").alias("old_day"))
    return new.join(known, "mid", "left").filter(F.col("old_day").isNull() | (F.col("first_day") < F.col("old_day")))


def merge_first_seen(state: DataFrame | None, moves: DataFrame) -> DataFrame:
    rows = moves.select("mid", "first_day")
    rows = rows if state is None else state.select("mid", "first_day").unionByName(rows)
    return rows.groupBy("mid").agg(F.min("first_day").alias("first_day"))


def by_date(moves: DataFrame) -> DataFrame:
    """(logDate, new_devices): signed counts of moves; sums of these over all
    batches are the new devices per date."""
    entries = F.array_compact(F.array(
        F.struct(F.col("first_day").alias("day"), F.lit(1).alias("n")),
        F.when(F.col("old_day").isNotNull(), F.struct(F.col("old_day").alias("day"), F.lit(-1).alias("n")))))
    return moves.select(F.inline(entries)).groupBy(F.date_format("day", "yyyy-MM-dd").alias("logDate")).agg(
        F.sum(F.col("n").cast("long")).alias("new_devices"))


def add_counts(counts: DataFrame) -> DataFrame:
    """Signed counts of several batches added up; dates with none left go."""
    return counts.groupBy("logDate").agg(F.sum("new_devices").alias("new_devices")).filter(F.col("new_devices") != 0)


def new_devices_of_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """New devices per date after all ``batches`` (mid, logDate)."""
    state, counts = None, None
    for batch in batches:
        moves = first_seen_moves(state, batch)
        rows = by_date(moves)
        counts = rows if counts is None else counts.unionByName(rows)
        state = merge_first_seen(state, moves)
    return add_counts(counts)
