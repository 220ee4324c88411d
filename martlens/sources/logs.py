"""Log ingest (S3, F2): parse a JSON log line, stamp the server ``ts`` and
route it to the start-up or the event topic.

The HTTP endpoint itself is not built; its input is any DataFrame or stream
with a ``value`` string column (a text file source, Kafka, ...).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from martlens.functions.json import is_one_object, object_fields, with_number
from martlens.functions.time import epoch_ms
from martlens.sources.tables import STARTUP_EVENT_TYPE, evid_of

# Topic names.
TOPIC_STARTUP = "TOPIC_START"
TOPIC_EVENT = "TOPIC_EVENT"
TOPIC_REJECT = "TOPIC_REJECT"       # ours: lines that are no JSON object
TOPIC_ORDER_INFO = "TOPIC_ORDER_INFO"
TOPIC_ORDER_DETAIL = "TOPIC_ORDER_DETAIL"
TOPIC_USER_INFO = "TOPIC_USER_INFO"

# Union of start-up and event log fields; a log line binds by field name.
LOG_FIELDS = ("type", "mid", "uid", "appid", "area", "os", "ch", "vs", "evid", "pgid", "npgid", "itemid")


def log_lines(events: DataFrame) -> DataFrame:
    """Render ``events`` rows as the JSON log lines a client would post.

    Columns: log_id, arrived_at, value. No ``ts`` in the line: the server
    stamps it on arrival (``arrived_at``).
    """
    is_startup = F.col("event_type") == STARTUP_EVENT_TYPE
    uid = F.col("user_id").cast("string")
    body = F.struct(
        F.when(is_startup, F.lit(None).cast("string")).otherwise(evid_of(F.col("event_type"))).alias("evid"),
        uid.alias("mid"), F.when(is_startup, F.lit("startup")).otherwise(F.lit("event")).alias("type"), uid.alias("uid"),
    )
    return events.select(F.col("event_id").alias("log_id"), F.col("ts").alias("arrived_at"),
                         F.to_json(body).alias("value"))


def rough_log_lines(events: DataFrame) -> DataFrame:
    """The same events as clients also post them: a key twice, numbers beyond
    any type, a time of the client's own, a nested object with a ``ts``.

    Columns: log_id, arrived_at, value."""
    key = F.col("user_id").cast("string")
    value = F.concat(
        F.lit('{"mid":"old", "type":"'), F.when(F.col("event_type") == STARTUP_EVENT_TYPE, "startup").otherwise("event"),
        F.lit('","ts":17, "n":1'), F.repeat(key, 12), F.lit(',"big":1e400,"in":{"ts":1,"k":[{"ts":2}]},"mid":"'), key,
        F.lit('","text":"a,\\"ts\\":3}" }'))
    return events.select(F.col("event_id").alias("log_id"), F.col("ts").alias("arrived_at"), value.alias("value"))


def route_topic(log_type: Column) -> Column:
    """``startup`` goes to the start-up topic; anything else, null included,
    is an event."""
    return F.when(log_type.eqNullSafe(F.lit("startup")), F.lit(TOPIC_STARTUP)).otherwise(F.lit(TOPIC_EVENT))


def ingest(lines: DataFrame, server_ts: Column | None = None) -> DataFrame:
    """Stamp every log line with the server time (epoch ms) and route it.

    ``server_ts`` defaults to the ingest time; pass a column to replay history.
    Adds: log (the known fields as text, the last one of a repeated key, and
    ts), topic, value (the line as it came, byte for byte, but for its member
    ``ts``, which is set to the stamp and stands last). A line that is not
    exactly one JSON object keeps its text and goes to TOPIC_REJECT.
    """
    ts = server_ts if server_ts is not None else F.unix_millis(F.current_timestamp())
    parsed = lines.withColumn("_raw", object_fields(F.col("value"), LOG_FIELDS)).withColumn("_ts", ts.cast("long")) \
        .withColumn("_good", is_one_object(F.col("value"), F.col("_raw")))
    good = F.col("_good")
    log = F.struct(*[F.col("_raw").getField(f).alias(f) for f in LOG_FIELDS], F.col("_ts").alias("ts"))
    return (parsed.withColumn("log", F.when(good, log))
                  .withColumn("topic", F.when(good, route_topic(F.col("_raw.type"))).otherwise(F.lit(TOPIC_REJECT)))
                  .withColumn("value", F.when(good, with_number(F.col("value"), "ts", F.col("_ts"))).otherwise(F.col("value")))
                  .drop("_raw", "_ts", "_good"))


def ingest_events_table(events: DataFrame, lines: Callable[[DataFrame], DataFrame] = log_lines) -> DataFrame:
    """Replay ``events`` through the ingest path with the row's own time as the
    server stamp. Columns: log_id, topic, type, mid, ts, value."""
    stamped = ingest(lines(events), server_ts=epoch_ms("arrived_at"))
    return stamped.select("log_id", "topic", F.col("log.type").alias("type"),
                          F.col("log.mid").alias("mid"), F.col("log.ts").alias("ts"), "value")
