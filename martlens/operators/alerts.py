"""Coupon-abuse alerts.

A device raises an alert for a window when at least ``min_users`` distinct
users took coupons on it and nobody viewed an item in that window.

Batch plan (``coupon_alerts``), every group bounded:
0. panes: events are first aggregated per (mid, pane, evid, coupon user,
   coupon item) with a codegen'd hash aggregate, pane = gcd(window, slide).
   A hot device's events collapse here, before any window expansion, so the
   window/slide expansion factor (60 for 5 min / 5 s) multiplies pane rows,
   not raw events;
1. per (window, mid, evid): count, coupon users, coupon items;
2. per (window, mid): merge the few per-evid rows (at most one per type).
The window's event list is kept as (evid, count) pairs: the multiset of the
events, bounded by the number of event types, instead of one entry per event.

The streaming job stores step 0 of every micro-batch, and runs steps 1 and 2 over
the stored panes of the windows that have closed since (``closed_window_stage``),
so windows that cannot alert get no sets there either. An event without a device belongs to no device: every form
drops it first.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.time import epoch_minute, epoch_ms, from_epoch_ms
from martlens.operators.keyed import last_per_key

# Event ids and the user threshold.
COUPON = "coupon"
ITEM_VIEW = "clickItem"
MIN_USERS = 3


def window_stage(logs: DataFrame, window: str, slide: str, event_time: Column | None = None) -> DataFrame:
    """Step 1 in Spark's own sliding-window form: per (window, mid, evid)
    facts from raw events (each event expanded into every window containing
    it). The pane plans below must produce exactly this; tests compare them.

    Windows are aligned to the epoch, so they are computed on the instant
    ``timestamp_millis(ts)`` directly: the sliding-window expansion evaluates
    the time expression once per window, and this one is the cheapest."""
    t = event_time if event_time is not None else F.timestamp_millis(F.col("ts"))
    coupon = F.col("evid") == COUPON
    return (logs.filter(F.col("mid").isNotNull()).groupBy(F.window(t, window, slide).alias("window"), "mid", "evid")
                .agg(F.count(F.lit(1)).alias("n"),
                     F.collect_set(F.when(coupon, F.col("uid"))).alias("uids"),
                     F.collect_set(F.when(coupon, F.col("itemid"))).alias("items")))


_UNIT_MS = {"millisecond": 1, "second": 1000, "minute": 60000, "hour": 3600000, "day": 86400000,
            "week": 604800000}


def interval_ms(text: str) -> int:
    """``'5 seconds'`` -> 5000 (one number and one unit)."""
    m = re.fullmatch(r"\s*(\d+)\s*(millisecond|second|minute|hour|day|week)s?\s*", text.lower())
    if not m:
        raise ValueError(f"unsupported interval: {text!r}")
    return int(m.group(1)) * _UNIT_MS[m.group(2)]


def pane_ms(window: str, slide: str) -> tuple[int, int, int]:
    """Length and slide of the windows and length of the panes, in ms."""
    length, step = interval_ms(window), interval_ms(slide)
    if not 0 < step <= length:
        raise ValueError("the slide must be positive and no longer than the window")
    return length, step, math.gcd(length, step)


def _expand(panes: DataFrame, length: int, step: int) -> DataFrame:
    """Pane rows (mid, evid, u, i, n, start in ms), one per window start ``ws``."""
    start = F.col("start")
    hi = F.floor(start / F.lit(step)).cast("long") * F.lit(step)
    lo = F.floor((start - F.lit(length)) / F.lit(step)).cast("long") * F.lit(step) + F.lit(step)
    return panes.filter(lo <= hi).select(
        "mid", "evid", "u", "i", "n", F.explode(F.sequence(lo, hi, F.lit(step).cast("long"))).alias("ws"))


def pane_counts(logs: DataFrame, window: str, slide: str) -> DataFrame:
    """Step 0: (mid, evid, u, i, start, n), the events per device, pane, event
    type, coupon user and coupon item."""
    pane = pane_ms(window, slide)[2]
    coupon = F.col("evid") == COUPON
    start = F.floor(F.col("ts") / F.lit(pane)).cast("long") * F.lit(pane)
    return (logs.filter(F.col("mid").isNotNull() & F.col("ts").isNotNull())
                .groupBy("mid", "evid", F.when(coupon, F.col("uid")).alias("u"), F.when(coupon, F.col("itemid")).alias("i"),
                         start.alias("start"))
                .agg(F.count(F.lit(1)).alias("n")))


def _pane_rows(logs: DataFrame, window: str, slide: str) -> tuple[DataFrame, int]:
    """Step 0 plus the expansion: one row per (pane row, window start ``ws``)."""
    length, step, _ = pane_ms(window, slide)
    return _expand(pane_counts(logs, window, slide), length, step), length


def _window_facts(expanded: DataFrame, length: int) -> DataFrame:
    win = F.struct(from_epoch_ms(F.col("ws")).alias("start"),
                   from_epoch_ms(F.col("ws") + F.lit(length)).alias("end"))
    return (expanded.groupBy(win.alias("window"), "mid", "evid")
                    .agg(F.sum("n").alias("n"), F.collect_set("u").alias("uids"), F.collect_set("i").alias("items")))


def pane_window_stage(logs: DataFrame, window: str, slide: str) -> DataFrame:
    """Steps 0 and 1 of the batch plan for every window; same output as
    ``window_stage`` (window struct of UTC wall-clock bounds, mid, evid, n,
    uids, items)."""
    expanded, length = _pane_rows(logs, window, slide)
    return _window_facts(expanded, length)


def candidate_window_stage(logs: DataFrame, window: str, slide: str, min_users: int = MIN_USERS) -> DataFrame:
    """Step 1 only for windows that can alert. A window needs at least
    ``min_users`` coupon events and no item view; both are sums, found by a
    codegen'd hash aggregate over the expanded pane rows. The set-collecting
    aggregate then runs on the rows of the candidate windows only (a semi
    join), instead of on every window of every device."""
    expanded, length = _pane_rows(logs, window, slide)
    return _candidate_facts(expanded, length, min_users)


def _candidate_facts(expanded: DataFrame, length: int, min_users: int) -> DataFrame:
    cand = (expanded.groupBy("ws", "mid")
                    .agg(F.sum(F.when(F.col("evid") == COUPON, F.col("n"))).alias("c"),
                         F.sum(F.when(F.col("evid") == ITEM_VIEW, F.col("n"))).alias("v"))
                    .filter((F.coalesce("c", F.lit(0)) >= min_users) & (F.coalesce("v", F.lit(0)) == 0))
                    .select("ws", "mid"))
    return _window_facts(expanded.join(cand, ["ws", "mid"], "left_semi"), length)


def closed_window_stage(panes: DataFrame, window: str, slide: str, after: int, upto: int,
                        min_users: int = MIN_USERS) -> DataFrame:
    """Step 1 for the windows that end after ``after`` and not after ``upto`` (ms),
    from the pane rows of all their panes; only windows that can alert."""
    length, step, _ = pane_ms(window, slide)
    end = F.col("ws") + F.lit(length)
    near = panes.filter((F.col("start") > after - length) & (F.col("start") < upto))
    return _candidate_facts(_expand(near, length, step).filter((end > after) & (end <= upto)), length, min_users)


def alert_stage(facts: DataFrame, min_users: int = MIN_USERS) -> DataFrame:
    """Stage 2: merge per window and device; keep alerting windows."""
    merged = facts.groupBy("window", "mid").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("uids")))).alias("uids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"),
        F.array_sort(F.collect_list(F.struct("evid", "n"))).alias("events"),
        F.max((F.col("evid") == ITEM_VIEW).cast("int")).alias("_viewed"),
    )
    instant = dict(facts.dtypes)["window"].startswith("struct<start:timestamp,")

    def wall(bound: Column) -> Column:
        # instants become UTC wall clock (TIMESTAMP_NTZ); NTZ bounds already are
        return from_epoch_ms(F.unix_millis(bound)) if instant else bound

    return (merged.filter((F.size("uids") >= min_users) & (F.coalesce("_viewed", F.lit(0)) == 0))
                  .select("mid", wall(F.col("window.start")).alias("window_start"),
                          wall(F.col("window.end")).alias("window_end"), "uids", "item_ids", "events"))


def coupon_alerts(logs: DataFrame, window: str = "5 minutes", slide: str = "5 seconds",
                  min_users: int = MIN_USERS) -> DataFrame:
    """Alerts per device and sliding window on event time (batch form).
    Window bounds are returned as UTC wall clock."""
    return alert_stage(candidate_window_stage(logs, window, slide, min_users), min_users)


def alert_doc_id(alerts: DataFrame) -> DataFrame:
    """P9/W3 id: ``mid-<epoch minute of the window end>``."""
    minute = epoch_minute(epoch_ms("window_end"))
    return alerts.withColumn("doc_id", F.concat_ws("-", F.col("mid").cast("string"), minute.cast("string")))


def alerts_per_minute(alerts: DataFrame) -> DataFrame:
    """One alert per device and minute -- the one with the latest window."""
    return last_per_key(alert_doc_id(alerts), ["doc_id"], ["window_end"])


def flatten_alerts(alerts: DataFrame) -> DataFrame:
    """Alert arrays as comma-joined strings (events as ``evid:count``)."""
    ev = F.transform("events", lambda e: F.concat_ws(":", e.getField("evid"), e.getField("n").cast("string")))
    return (alerts.withColumn("uids", F.array_join(F.col("uids").cast("array<string>"), ","))
                  .withColumn("item_ids", F.array_join(F.col("item_ids").cast("array<string>"), ","))
                  .withColumn("events", F.array_join(ev, ",")))
