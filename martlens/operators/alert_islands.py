"""Coupon alerts as episodes, without expanding events into windows
(T2, A11-A14, F3).

A window starts at every multiple of the slide.  An event lies in the windows
whose numbers form one interval, so with a 5 minute window that slides by 5
seconds an event is one interval, not sixty rows.

1. Islands: the intervals of one user's coupons on a device that touch are
   merged, so a user counts once per window however many coupons were taken;
   likewise the item views of a device.
2. Sweep line: an island is +1 where it begins and -1 behind its end.  The
   running sums per device are its coupon users and its views in every window
   between two such places.
3. An episode is a maximal stretch of windows with at least ``min_users`` users
   and no view.

The running sum has two levels: whole blocks of time are summed per device,
then each block is swept on its own, starting from the sum before it.  So no
task sweeps a device's whole history, and a device that holds a third of all
rows is first cut down to its distinct (user, pane) pairs by a partial
aggregate.

Rows without a device or a time are left out; a null user is nobody; a null
event id is neither a coupon nor a view.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.time import from_epoch_ms
from martlens.operators.alerts import COUPON, ITEM_VIEW, MIN_USERS, interval_ms

BLOCK = 4096        # windows swept together


def window_intervals(logs: DataFrame, window: str, slide: str) -> DataFrame:
    """(mid, user, viewed, lo, hi): distinct intervals of window numbers that
    coupons of a user (``viewed`` false) and item views (user null) cover."""
    length, step = interval_ms(window), interval_ms(slide)
    if not 0 < step <= length:
        raise ValueError("the slide must be positive and no longer than the window")
    pane = math.gcd(length, step)
    coupon = (F.col("evid") == COUPON) & F.col("uid").isNotNull()
    view = F.col("evid") == ITEM_VIEW
    panes = logs.filter(F.col("mid").isNotNull() & F.col("ts").isNotNull() & (coupon | view)).select(
        "mid", F.when(coupon, F.col("uid")).alias("user"), view.alias("viewed"),
        F.floor(F.col("ts") / F.lit(pane)).cast("long").alias("pane")).distinct()
    start = F.col("pane") * F.lit(pane)
    return panes.select("mid", "user", "viewed",
                        (F.floor((start - F.lit(length)) / F.lit(step)).cast("long") + 1).alias("lo"),
                        F.floor(start / F.lit(step)).cast("long").alias("hi")).filter("lo <= hi")


def islands(intervals: DataFrame) -> DataFrame:
    """Intervals of one (mid, user, viewed) that overlap or touch, merged.  They
    are equally long but for the rounding, so they end in the order they start."""
    line = Window.partitionBy("mid", "user", "viewed").orderBy("lo", "hi")
    opens = F.col("lo") > F.coalesce(F.lag("hi").over(line) + 1, F.col("lo") - 1)
    marked = intervals.withColumn("island", F.sum(opens.cast("long")).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("mid", "user", "viewed", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def sweep(merged: DataFrame) -> DataFrame:
    """(mid, lo, hi, users, views): stretches of windows with equal sums, by
    two-level prefix sums; stretches behind the last end are left out."""
    one = F.when(F.col("viewed"), F.lit(0)).otherwise(1).cast("long")
    ends = merged.select("mid", F.inline(F.array(
        F.struct(F.col("lo").alias("at"), one.alias("users"), (1 - one).alias("views")),
        F.struct((F.col("hi") + 1).alias("at"), (-one).alias("users"), (one - 1).alias("views")))))
    steps = ends.groupBy("mid", F.floor(F.col("at") / BLOCK).alias("block"), "at").agg(
        F.sum("users").alias("users"), F.sum("views").alias("views"))
    by_block = Window.partitionBy("mid").orderBy("block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    blocks = steps.groupBy("mid", "block").agg(F.sum("users").alias("u"), F.sum("views").alias("v"), F.min("at").alias("head")) \
        .select("mid", "block", F.coalesce(F.sum("u").over(earlier), F.lit(0)).alias("users_before"),
                F.coalesce(F.sum("v").over(earlier), F.lit(0)).alias("views_before"),
                F.lead("head").over(by_block).alias("next_block"))
    inside = Window.partitionBy("mid", "block").orderBy("at")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return steps.join(blocks, ["mid", "block"]).select(
        "mid", F.col("at").alias("lo"), (F.coalesce(F.lead("at").over(inside), "next_block") - 1).alias("hi"),
        (F.col("users_before") + F.sum("users").over(upto)).alias("users"),
        (F.col("views_before") + F.sum("views").over(upto)).alias("views")).filter(F.col("hi").isNotNull())


def alert_episodes(logs: DataFrame, window: str = "5 minutes", slide: str = "5 seconds",
                   min_users: int = MIN_USERS) -> DataFrame:
    """Per device, its maximal stretches of alerting windows: ``first_window``
    and ``last_window`` (starts, UTC wall clock), ``windows`` in between, both
    included, and ``most_users`` in one of them."""
    step = interval_ms(slide)
    alerting = sweep(islands(window_intervals(logs, window, slide))).filter(
        (F.col("users") >= min_users) & (F.col("views") == 0))
    line = Window.partitionBy("mid").orderBy("lo")
    opens = F.col("lo") > F.coalesce(F.lag("hi").over(line) + 1, F.col("lo") - 1)
    numbered = alerting.withColumn("episode", F.sum(opens.cast("long")).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    episodes = numbered.groupBy("mid", "episode").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                                      F.max("users").alias("most_users"))
    return episodes.select("mid", from_epoch_ms(F.col("lo") * F.lit(step)).alias("first_window"),
                           from_epoch_ms(F.col("hi") * F.lit(step)).alias("last_window"),
                           (F.col("hi") - F.col("lo") + 1).alias("windows"), "most_users")
