"""Life of cached user records: 24 hours from the last update or lookup.

An update writes the record with a day to live, and every lookup gives it a new
day.  A user is live in maximal stretches of touches (updates and lookups) that
are not more than the life apart, plus the life after the last one: sessions by gap.

``live_intervals`` is the batch form.  Touches are first folded per user and
pane, a fraction of the life, so touches of one pane are always in one session;
a user who has a third of all touches is then a few rows a day.  The stream
form is ``live_stream``: Spark's ``session_window`` under a watermark.
Rows without a user or a time are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.time import from_epoch_ms
from martlens.operators.alerts import interval_ms

LIFE = "24 hours"
PANES = 24      # of a life


def touches(updates: DataFrame, lookups: DataFrame) -> DataFrame:
    """(id, ts, kind) of updates and lookups, each with id and ts (epoch ms)."""
    return updates.select("id", "ts", F.lit("update").alias("kind")).unionByName(
        lookups.select("id", "ts", F.lit("lookup").alias("kind")))


def live_intervals(touched: DataFrame, life: str = LIFE) -> DataFrame:
    """(id, live_from, live_until, updates, lookups) per session; times are UTC
    wall clock, ``live_until`` is when the record expires."""
    gap = interval_ms(life)
    pane = max(1, gap // PANES)
    known = touched.filter(F.col("id").isNotNull() & F.col("ts").isNotNull())
    panes = known.groupBy("id", F.floor(F.col("ts") / F.lit(pane)).alias("pane")).agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"),
        F.count(F.when(F.col("kind") == "update", 1)).alias("updates"),
        F.count(F.when(F.col("kind") == "lookup", 1)).alias("lookups"))
    line = Window.partitionBy("id").orderBy("pane")
    opens = F.coalesce(F.col("lo") - F.lag("hi").over(line) > gap, F.lit(True))
    numbered = panes.withColumn("session", F.sum(opens.cast("long")).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("id", "session").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("updates").alias("updates"), F.sum("lookups").alias("lookups")) \
        .select("id", from_epoch_ms("lo").alias("live_from"), from_epoch_ms(F.col("hi") + F.lit(gap)).alias("live_until"),
                "updates", "lookups")


def live_stream(touched: DataFrame, life: str = LIFE, delay: str = "1 minute") -> DataFrame:
    """The same on a stream with ``ts``: a session is emitted once the watermark
    has passed its end."""
    timed = touched.filter(F.col("id").isNotNull() & F.col("ts").isNotNull()).withColumn("at", F.timestamp_millis("ts"))
    sessions = timed.withWatermark("at", delay).groupBy(F.session_window("at", life).alias("s"), "id").agg(
        F.count(F.when(F.col("kind") == "update", 1)).alias("updates"),
        F.count(F.when(F.col("kind") == "lookup", 1)).alias("lookups"))
    return sessions.select("id", from_epoch_ms(F.unix_millis("s.start")).alias("live_from"),
                           from_epoch_ms(F.unix_millis("s.end")).alias("live_until"), "updates", "lookups")


def live_at(records: DataFrame, touched: DataFrame, now: F.Column, life: str = LIFE) -> DataFrame:
    """The rows of ``records`` (id, updated_at) that are live at ``now``: updated
    or looked up (``touched``: id, read_at) not longer than ``life`` ago."""
    reads = touched.groupBy("id").agg(F.max("read_at").alias("_read_at"))
    last = F.greatest(F.col("updated_at"), F.coalesce("_read_at", F.col("updated_at")))
    return records.join(reads, "id", "left").filter(last >= now - F.expr(f"INTERVAL {life}")).drop("_read_at")
