"""The streaming jobs (T1-T10) as Structured Streaming queries: the
reference's five (DAU, GMV, alerts, sale detail, user dimension) plus log
ingest and change-event routing.

Each job takes a streaming DataFrame of JSON lines (``value``, ``ingest_time``),
output paths and a checkpoint folder, and returns the started query. Triggers
default to the reference's 5-second micro-batches; tests pass
``trigger={"availableNow": True}``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlens.functions.time import from_epoch_ms, with_log_date_hour
from martlens.operators import alerts as alert_ops
from martlens.operators import dau as dau_ops
from martlens.operators.gmv import prepare_orders
from martlens.operators.keyed import last_per_key
from martlens.operators.live_users import LIFE, live_at
from martlens.operators.sale_detail import enrich_users
from martlens.schemas import EVENT_LOG, ORDER_DETAIL, ORDER_INFO, STARTUP_LOG, USER_INFO
from martlens.sources.cdc import route_changes
from martlens.sources.logs import TOPIC_REJECT, ingest
from martlens.streaming.metrics import Steps, counted, observe_input
from martlens.streaming.sinks import BATCH_COL, KeyedStore, TopicSink, append_by_batch, folder_sink
from martlens.streaming.sources import parse_json
from martlens.streaming.state import COMPACT_EVERY, DeviceHistory, FoldingStore, OrderTotals, before

DEFAULT_TRIGGER = {"processingTime": "5 seconds"}


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


GMV_SCHEMA = f"{_ddl(ORDER_INFO)}, create_date string, create_hour string"
USER_SCHEMA = f"{_ddl(USER_INFO)}, updated_at timestamp"


def _start(writer, checkpoint: str, trigger: dict | None):
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER)).start()


def _once(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``write`` with its batch computed once, however many steps read it, so
    that rows observed on the way are also counted once."""
    def cached(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()

    return cached


# --- DAU -------------------------------------------------------------------

def dau_job(lines: DataFrame, store_root: str, checkpoint: str, trigger: dict | None = None, tz: str = "UTC",
            counts: Steps | None = None, history: DeviceHistory | None = None,
            compact_every: int = COMPACT_EVERY):
    """T3/T4 with the reference's rule: earliest log per device-day inside a
    batch, first batch overall. Each batch is anti-joined with the device-days
    stored by *earlier* batches (J5/J6, keyed on the log's own date), so a
    replayed batch recomputes the same rows and overwrites its own folder.

    Lines without a device or a time (malformed ones too) are rejected before
    any of that. ``counts`` gets, per batch, the rows read, left after the
    in-batch step and new (K10/A15). ``history`` takes in the new device-days:
    daily device sets, first days and new devices per day (K7, A16). The store
    is compacted every ``compact_every`` batches.
    """
    store = KeyedStore(store_root, list(dau_ops.DEVICE_DAY), partition_by=("logDate",), schema="mid string, logDate string")
    logs = with_log_date_hour(parse_json(lines, STARTUP_LOG).drop("ingest_time"), "ts", tz)
    logs = observe_input(logs, "dau", F.col("mid").isNull() | F.col("logDate").isNull())
    logs = logs.filter(F.col("mid").isNotNull() & F.col("logDate").isNotNull())

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Only the batch's own days can match: a range of logDate prunes the
        # store's partitions, so the cost per batch does not grow with history.
        days = batch.agg(F.min("logDate").alias("lo"), F.max("logDate").alias("hi"), F.count(F.lit(1)).alias("n")).first()
        seen = store.raw(spark).filter(F.col(BATCH_COL) < batch_id).filter(
            F.col("logDate").between(days["lo"], days["hi"]))
        rows, firsts = counted(dau_ops.dau_first(batch, tz))
        fresh, new = counted(dau_ops.not_seen(rows, seen))
        store.write_batch(fresh, batch_id)
        if history is not None:
            # the rows just written, so they are computed once
            history.write_batch(store.raw(spark).filter(F.col(BATCH_COL) == batch_id), batch_id)
        store.compact_by_turns(spark, batch_id, compact_every)
        if counts is not None:
            counts(batch_id, {"read": days["n"], "in_batch": firsts.get["rows"], "new": new.get["rows"]})

    return _start(logs.writeStream.foreachBatch(_once(write)), checkpoint, trigger)


def dau_dedup_job(lines: DataFrame, out: str, checkpoint: str, delay: str = "1 day",
                  trigger: dict | None = None, tz: str = "UTC"):
    """T3 in operator state: the first *arrival* per device-day is kept, state
    expires after the watermark ``delay``. Exactly-once via the checkpoint."""
    logs = (with_log_date_hour(parse_json(lines, STARTUP_LOG).drop("ingest_time"), "ts", tz)
            .withColumn("event_time", F.timestamp_millis("ts")))
    firsts = logs.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(dau_ops.DEVICE_DAY))
    w = firsts.writeStream.format("parquet").partitionBy("logDate").outputMode("append").option("path", out)
    return _start(w, checkpoint, trigger)


# --- log ingest and change routing ----------------------------------------

def _routed(lines: DataFrame, app: str) -> DataFrame:
    return observe_input(ingest(lines, server_ts=F.unix_millis(F.col("ingest_time"))), app, F.col("topic") == TOPIC_REJECT)


def log_ingest_job(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """S3/F2/K9: stamp, route and archive log lines whole, one folder per topic
    and day (``topic=.../dt=...``), as text; lines that are no JSON object land
    in the reject topic as they came. ``ingest_time`` is the server stamp."""
    routed = _routed(lines, "log")
    day = F.date_format(from_epoch_ms(F.unix_millis(F.col("ingest_time"))), "yyyy-MM-dd")
    w = routed.select("value", "topic", day.alias("dt")).writeStream.format("text").partitionBy("topic", "dt") \
        .outputMode("append").option("path", out)
    return _start(w, checkpoint, trigger)


def log_publish_job(lines: DataFrame, sink: TopicSink, checkpoint: str, trigger: dict | None = None):
    """S3/F2/K1: the stamped lines published to their topics."""
    routed = _routed(lines, "log_publish")
    return _start(sink(routed.select("topic", "value")), checkpoint, trigger)


def cdc_job(changes: DataFrame, sink: TopicSink | str, checkpoint: str, trigger: dict | None = None):
    """A stream of change envelopes routed to its topics; a path
    as ``sink`` means text folders per topic."""
    sink = folder_sink(sink) if isinstance(sink, str) else sink
    seen = observe_input(changes, "cdc", ~F.col("entry_type").eqNullSafe("ROWDATA"))
    return _start(sink(route_changes(seen).select("topic", "value")), checkpoint, trigger)


# --- GMV -------------------------------------------------------------------

def gmv_store(root: str) -> KeyedStore:
    """Orders by id (K2): a redelivered order replaces itself, so sums over
    ``read`` count it once."""
    return KeyedStore(root, "id", partition_by=("create_date",), schema=GMV_SCHEMA)


def gmv_job(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, totals: str | None = None,
            compact_every: int = COMPACT_EVERY, counts: Steps | None = None):
    """Orders parsed, dated (P3), phone masked (P4), upserted by id. Lines
    without an id or a date are rejected. With ``totals`` (a folder) the amounts
    per day and hour are kept there by deltas (``order_totals``): an order that
    comes again with another amount or time leaves its old day and hour, and
    its latest version counts in whatever order versions arrive. ``counts`` gets
    the images of a batch that are new."""
    orders = prepare_orders(parse_json(lines, ORDER_INFO).drop("ingest_time"))
    lost = F.col("id").isNull() | F.col("create_date").isNull()
    orders = observe_input(orders, "gmv", lost).filter(~lost)
    store = gmv_store(out)
    kept = order_totals(out, totals, compact_every) if totals else None

    def write(batch: DataFrame, batch_id: int) -> None:
        if kept is not None:
            new = kept.write_batch(batch, batch_id)
        else:
            rows, n = counted(last_per_key(batch, ["id"], ["create_time"]))
            store.write_batch(rows, batch_id)
            store.compact_by_turns(batch.sparkSession, batch_id, compact_every)
            new = n.get["rows"]
        if counts is not None:
            counts(batch_id, {"new": new})

    return _start(orders.writeStream.foreachBatch(_once(write)), checkpoint, trigger)


def order_totals(orders: str, totals: str, compact_every: int = COMPACT_EVERY) -> OrderTotals:
    """The totals that ``gmv_job`` keeps, to read or to write."""
    return OrderTotals(gmv_store(orders), totals, compact_every)


# --- coupon alerts ---------------------------------------------------------

def alert_job(lines: DataFrame, store_root: str, checkpoint: str, window: str = "5 minutes",
              slide: str = "5 seconds", delay: str = "1 minute", trigger: dict | None = None,
              compact_every: int = COMPACT_EVERY, counts: Steps | None = None):
    """T2 on event time, without operator state. Every batch folds its events
    into pane rows, stored by day beside the alerts (``<store_root>_panes``), and
    then evaluates the windows that have closed since the batch before, from the
    stored panes they cover: sums first, sets only for windows that can alert, as
    in batch. A window is closed when the watermark, the largest event time so
    far less ``delay``, has reached its end; events of panes that the watermark
    of the batch before had passed are late and dropped. Watermark and progress
    are stored per batch, so a replay does the same again. Alerts are upserted by
    their per-minute ``doc_id`` (T7, W3)."""
    logs = observe_input(parse_json(lines, EVENT_LOG), "alert", F.col("mid").isNull() | F.col("ts").isNull())
    length, _, pane = alert_ops.pane_ms(window, slide)
    late = alert_ops.interval_ms(delay)
    store = KeyedStore(store_root, "doc_id", version=("window_end",))
    root = store_root.rstrip("/")
    panes = FoldingStore(f"{root}_panes", ["mid", "evid", "u", "i", "start", "day"], {"n": F.sum}, ("day",),
                         "mid string, evid string, u string, i string, start long, n long, day string")
    done = FoldingStore(f"{root}_done", "of", {"latest": F.max, "until": F.max}, schema="of string, latest long, until long")

    def day(ms: Column) -> Column:
        return F.date_format(from_epoch_ms(ms), "yyyy-MM-dd")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        was = done.latest(before(done, spark, batch_id)).first()
        rows = alert_ops.pane_counts(batch, window, slide)
        if was is not None:
            rows = rows.filter(F.col("start") + pane > was["latest"] - late)
        panes.write_batch(rows.withColumn("day", day(F.col("start"))), batch_id)
        # a line without a device still tells the time
        span = batch.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
        n = 0
        if was is not None or span["hi"] is not None:
            latest = max(x for x in (was and was["latest"], span["hi"]) if x is not None)
            after = was["until"] if was is not None else span["lo"] - pane
            upto = max(was["until"], latest - late) if was is not None else latest - late
            done.write_batch(spark.createDataFrame([("windows", latest, upto)], "of string, latest long, until long"), batch_id)
            if upto > after:
                stored = panes.raw(spark).filter((F.col(BATCH_COL) <= batch_id) & (F.col("day") >= day(F.lit(after - length)))
                                                 & (F.col("day") <= day(F.lit(upto))))
                facts = alert_ops.closed_window_stage(panes.latest(stored), window, slide, after, upto)
                found, seen = counted(alert_ops.alerts_per_minute(alert_ops.alert_stage(facts)))
                store.write_batch(found, batch_id)
                n = seen.get["rows"]
        if counts is not None:
            counts(batch_id, {"alerts": n})
        for s in (store, panes, done):
            s.compact_by_turns(spark, batch_id, compact_every)

    return _start(logs.writeStream.foreachBatch(_once(write)), checkpoint, trigger)


# --- sale detail -----------------------------------------------------------

def sale_detail_job(order_lines: DataFrame, detail_lines: DataFrame,
                    users: DataFrame | UserLookup | Callable[[DataFrame], DataFrame], as_of: str | Callable[[], str],
                    store_root: str, checkpoint: str, bound: str = "100 seconds",
                    trigger: dict | None = None, compact_every: int = COMPACT_EVERY, rejects: str | None = None,
                    counts: Steps | None = None):
    """J1 as a stream-stream inner join on the order id with an arrival-time
    range of +-``bound`` on both watermarks (T5), so join state is dropped
    once a side can no longer match. The user dimension (J4) is joined per
    micro-batch inside ``foreachBatch``: a ``UserLookup``, or a callable that gets
    the batch's user ids (one column ``id``) and returns those users, so updates
    written after the query started are seen (T6) and nobody else is read; a
    plain DataFrame is used as given. A callable ``as_of`` is asked per batch, so ages move on.
    Output upserted by doc id (T7). Order lines carry no event time, so both
    sides use the ingest time.

    With ``rejects`` (a folder) the join is outer on the side of the lines: when
    the watermark drops a line that no order met, it is written there as a JSON
    line of the reject topic, one folder per batch."""
    lost = F.col("id").isNull()
    o = (observe_input(parse_json(order_lines, ORDER_INFO), "sale_order", lost)
         .select(F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
                 F.split("create_time", " ").getItem(0).alias("dt"), F.col("ingest_time").alias("o_time"))
         .withWatermark("o_time", bound))
    d = (observe_input(parse_json(detail_lines, ORDER_DETAIL), "sale_detail", lost)
         .select(F.col("id").alias("order_detail_id"), F.col("order_id").alias("d_order_id"), "sku_id", "sku_name",
                 F.col("order_price").try_cast("double").alias("sku_price"), F.col("ingest_time").alias("d_time"))
         .withWatermark("d_time", bound))
    cond = F.expr(f"""order_id = d_order_id AND
                      d_time >= o_time - INTERVAL {bound} AND d_time <= o_time + INTERVAL {bound}""")
    both = o.join(d, cond, "inner") if rejects is None else d.join(o, cond, "left_outer")
    joined = both.drop("o_time", "d_time")
    reject = append_by_batch(rejects, ["topic"]) if rejects is not None else None
    store = KeyedStore(store_root, "doc_id", partition_by=("dt",))

    def dimension(ids: DataFrame, batch_id: int) -> tuple[DataFrame, Callable[[], None]]:
        if isinstance(users, UserLookup):
            return users.users(ids, batch_id)
        return (users(ids) if callable(users) else users), lambda: None

    def write(batch: DataFrame, batch_id: int) -> None:
        met = batch.filter(F.col("order_id").isNotNull()).drop("d_order_id")
        if reject is not None:
            lone = batch.filter(F.col("order_id").isNull()).select(F.lit(TOPIC_REJECT).alias("topic"), F.to_json(F.struct(
                F.col("order_detail_id").alias("id"), F.col("d_order_id").alias("order_id"), "sku_id", "sku_name",
                F.col("sku_price").alias("order_price"))).alias("value"))
            reject(lone, batch_id)
        ids = met.select(F.col("user_id").alias("id")).filter(F.col("id").isNotNull()).distinct()
        mine, done = dimension(ids, batch_id)
        try:
            rows, n = counted(enrich_users(met, mine, as_of() if callable(as_of) else as_of).withColumn(
                "doc_id", F.concat_ws("_", F.col("order_id").cast("string"), "order_detail_id")))
            store.write_batch(rows, batch_id)
            if counts is not None:
                counts(batch_id, {"joined": n.get["rows"]})
            store.compact_by_turns(batch.sparkSession, batch_id, compact_every)
        finally:
            done()

    return _start(joined.writeStream.outputMode("append").foreachBatch(_once(write)), checkpoint, trigger)


# --- user dimension --------------------------------------------------------

def user_info_job(lines: DataFrame, store_root: str, checkpoint: str, trigger: dict | None = None,
                  compact_every: int = COMPACT_EVERY, counts: Steps | None = None):
    """User records upserted by id, last arrival wins; ``updated_at`` is
    kept, lookups apply the 24 h life to it (T6, ``UserLookup``)."""
    users = parse_json(lines, USER_INFO).withColumnRenamed("ingest_time", "updated_at")
    users = observe_input(users, "user", F.col("id").isNull()).filter(F.col("id").isNotNull())
    store = user_store(store_root)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows, n = counted(last_per_key(batch, ["id"], ["updated_at"]))
        store.write_batch(rows, batch_id)
        if counts is not None:
            counts(batch_id, {"in_batch": n.get["rows"]})
        store.compact_by_turns(batch.sparkSession, batch_id, compact_every)

    return _start(users.writeStream.foreachBatch(_once(write)), checkpoint, trigger)


def user_store(root: str) -> KeyedStore:
    return KeyedStore(root, "id", version=("updated_at",), schema=USER_SCHEMA)


class UserLookup:
    """J4/T6 for the user ids of a micro-batch.

    A user's record is the latest version that the user job stored or an earlier
    lookup found.  It lives for ``life`` from its last update or lookup.  Ids
    without a live record are asked of ``fallback`` (e.g. the relational table
    of record, read for these ids only); what it finds is written beside the
    store under the batch's id, so a replay replaces it, and so is the time of
    every lookup that found somebody.  Without ``fallback`` records do not
    expire.  Both side stores are compacted every ``compact_every`` batches.
    """

    COLUMNS = ("id", "user_level", "birthday", "gender")

    def __init__(self, spark: SparkSession, root: str, fallback: Callable[[DataFrame], DataFrame] | None = None,
                 life: str = LIFE, compact_every: int = COMPACT_EVERY,
                 now: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc)):
        root = root.rstrip("/")
        self.spark, self.fallback, self.life, self.every, self.now = spark, fallback, life, compact_every, now
        self.store = user_store(root)
        self.found = KeyedStore(f"{root}_fallback", "id", version=("updated_at",), schema=USER_SCHEMA)
        self.reads = FoldingStore(f"{root}_reads", "id", {"read_at": F.max}, schema="id string, read_at timestamp")

    def known(self, ids: DataFrame, batch_id: int) -> DataFrame:
        """Latest record per id, the version merge running over these ids only."""
        mine = self.store.raw(self.spark).join(ids, "id", "left_semi").drop(BATCH_COL)
        if self.fallback is not None:
            mine = mine.unionByName(before(self.found, self.spark, batch_id).join(ids, "id", "left_semi").drop(BATCH_COL))
        return last_per_key(mine, ["id"], ["updated_at"])

    def __call__(self, ids: DataFrame) -> DataFrame:
        """The same outside a micro-batch: the lookup is a batch of its own."""
        if self.fallback is None:
            return self.known(ids, 0).select(*self.COLUMNS)
        last = self.reads.raw(self.spark).agg(F.max(BATCH_COL)).first()[0]
        batch_id = 0 if last is None else int(last) + 1
        _, done = self.users(ids, batch_id)
        done()
        reads = before(self.reads, self.spark, batch_id + 1).join(ids, "id", "left_semi")
        return live_at(self.known(ids, batch_id + 1), reads, F.lit(self.now()), self.life).select(*self.COLUMNS)

    def users(self, ids: DataFrame, batch_id: int) -> tuple[DataFrame, Callable[[], None]]:
        """The users of ``ids`` (one row per id), and what to call once they have been used."""
        records = self.known(ids, batch_id)
        if self.fallback is None:
            return records.select(*self.COLUMNS), lambda: None
        at = F.lit(self.now())
        reads = before(self.reads, self.spark, batch_id).join(ids, "id", "left_semi")
        live = live_at(records, reads, at, self.life).select(*self.COLUMNS).persist()
        asked = self.fallback(ids.join(live.select("id"), "id", "left_anti")).select(*self.COLUMNS).persist()
        full = [F.col(f.name) if f.name in self.COLUMNS else F.lit(None).cast(f.dataType).alias(f.name) for f in USER_INFO]
        self.found.write_batch(asked.select(*full, at.cast("timestamp").alias("updated_at")), batch_id)
        both = live.unionByName(asked)
        self.reads.write_batch(both.select("id", at.cast("timestamp").alias("read_at")), batch_id)

        def done() -> None:
            live.unpersist()
            asked.unpersist()
            for store in (self.found, self.reads):
                store.compact_by_turns(self.spark, batch_id, self.every)

        return both, done


def user_lookup(spark: SparkSession, root: str, fallback: Callable[[DataFrame], DataFrame] | None = None,
                **options) -> UserLookup:
    return UserLookup(spark, root, fallback, **options)


def read_store(spark: SparkSession, root: str, key: str | list[str], version=(), partition_by=()) -> DataFrame:
    return KeyedStore(root, key, version, partition_by).read(spark)


__all__ = ["DeviceHistory", "UserLookup", "alert_job", "cdc_job", "dau_dedup_job", "dau_job", "gmv_job", "gmv_store", "log_ingest_job",
           "log_publish_job", "order_totals", "read_store", "sale_detail_job", "user_info_job", "user_lookup", "user_store"]
