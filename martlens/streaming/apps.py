"""The deployable streaming applications, one per job, wired to their topics.

Every app reads its topic(s) with ``kafka_stream`` (or any stream with
``value`` and ``ingest_time`` columns passed in ``sources``), writes under
``root`` and keeps its offsets and state in ``root/_checkpoints/<app>`` --
independent checkpoints, so no two apps share a consumer position.  The rows
read, rejected and left after each step of every micro-batch go to ``metrics``
(default: the log, see ``martlens.streaming.metrics``).

    python -m martlens.streaming.apps dau --servers host:9092 --root hdfs:///shared/martlens
"""

from __future__ import annotations

import argparse
import datetime as dt
import zoneinfo
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.sources import logs as topics
from martlens.sources.jdbc import user_lookup_jdbc
from martlens.streaming import jobs
from martlens.streaming.metrics import RunMetrics, Steps
from martlens.streaming.sinks import TopicSink, kafka_sink
from martlens.streaming.sources import kafka_stream
from martlens.streaming.state import COMPACT_EVERY

Source = Callable[[str], DataFrame]
_LISTENERS: dict[SparkSession, RunMetrics] = {}


def kafka_sources(spark: SparkSession, servers: str, starting_offsets: str = "latest") -> Source:
    return lambda topic: kafka_stream(spark, servers, topic, starting_offsets)


def _ck(root: str, app: str) -> str:
    return f"{root.rstrip('/')}/_checkpoints/{app}"


def _metrics(spark: SparkSession, metrics: RunMetrics | None, app: str) -> Steps:
    """Where an app reports its steps; its listener is added once per session."""
    if metrics is None:
        metrics = _LISTENERS.get(spark)
        if metrics is None:
            metrics = _LISTENERS[spark] = RunMetrics()
            spark.streams.addListener(metrics)
    return metrics.steps(app)


def dau_app(spark, source: Source, root: str, trigger=None, tz: str = "UTC", metrics: RunMetrics | None = None,
            compact_every: int = COMPACT_EVERY):
    """Device-days, and under ``devices`` what they say of devices (sets of
    active ones per day, first days, new ones per day)."""
    history = jobs.DeviceHistory(f"{root}/devices", compact_every=compact_every)
    return jobs.dau_job(source(topics.TOPIC_STARTUP), f"{root}/dau", _ck(root, "dau"), trigger, tz,
                        _metrics(spark, metrics, "dau"), history, compact_every)


def gmv_app(spark, source: Source, root: str, trigger=None, metrics: RunMetrics | None = None,
            compact_every: int = COMPACT_EVERY, **_):
    """Orders, and under ``gmv`` their totals per day and hour."""
    return jobs.gmv_job(source(topics.TOPIC_ORDER_INFO), f"{root}/order_info", _ck(root, "gmv"), trigger,
                        f"{root}/gmv", compact_every, _metrics(spark, metrics, "gmv"))


def alert_app(spark, source: Source, root: str, window="5 minutes", slide="5 seconds", delay="1 minute",
              trigger=None, metrics: RunMetrics | None = None, **_):
    return jobs.alert_job(source(topics.TOPIC_EVENT), f"{root}/coupon_alert", _ck(root, "alert"),
                          window, slide, delay, trigger, counts=_metrics(spark, metrics, "alert"))


def user_app(spark, source: Source, root: str, trigger=None, metrics: RunMetrics | None = None, **_):
    return jobs.user_info_job(source(topics.TOPIC_USER_INFO), f"{root}/user_info", _ck(root, "user"), trigger,
                              counts=_metrics(spark, metrics, "user"))


def today(tz: str = "UTC") -> Callable[[], str]:
    """The date in ``tz``, asked anew for every batch."""
    return lambda: dt.datetime.now(zoneinfo.ZoneInfo(tz)).date().isoformat()


def sale_detail_app(spark, source: Source, root: str, as_of: str | Callable[[], str] | None = None,
                    bound="100 seconds", trigger=None, tz: str = "UTC",
                    fallback: Callable[[DataFrame], DataFrame] | None = None, metrics: RunMetrics | None = None):
    """Users come from the user app's store, looked up per batch, then from
    ``fallback``. Lines that no order met in time go to ``sale_rejects``."""
    users = jobs.user_lookup(spark, f"{root}/user_info", fallback)
    return jobs.sale_detail_job(source(topics.TOPIC_ORDER_INFO), source(topics.TOPIC_ORDER_DETAIL), users,
                                as_of or today(tz), f"{root}/sale_detail", _ck(root, "sale_detail"), bound, trigger,
                                rejects=f"{root}/sale_rejects", counts=_metrics(spark, metrics, "sale_detail"))


def log_app(spark, source: Source, root: str, sink: TopicSink, trigger=None, raw_topic: str = "TOPIC_LOG_RAW",
            metrics: RunMetrics | None = None):
    """Raw lines archived whole by day, and published to their topics."""
    _metrics(spark, metrics, "log")
    return [jobs.log_ingest_job(source(raw_topic), f"{root}/logs", _ck(root, "logs"), trigger),
            jobs.log_publish_job(source(raw_topic), sink, _ck(root, "log_publish"), trigger)]


def cdc_app(spark, changes: DataFrame, root: str, sink: TopicSink, trigger=None, metrics: RunMetrics | None = None):
    """Change envelopes (see ``martlens.sources.cdc``) published to their topics."""
    _metrics(spark, metrics, "cdc")
    return jobs.cdc_job(changes, sink, _ck(root, "cdc"), trigger)


APPS = {"dau": dau_app, "gmv": gmv_app, "alert": alert_app, "user": user_app, "sale_detail": sale_detail_app}
CHANGE = "entry_type string, table_name string, op string, key string, after map<string,string>"


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("app", choices=[*sorted(APPS), "log", "cdc"])
    p.add_argument("--servers", required=True)
    p.add_argument("--root", required=True, help="shared storage root for tables and checkpoints")
    p.add_argument("--tz", default="UTC", help="zone in which days and hours are counted")
    p.add_argument("--as-of", default=None, help="fixed reference date for user ages (default: the current date)")
    p.add_argument("--users-jdbc", default=None, help="JDBC url of the user table of record (sale_detail)")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"martlens-{a.app}").getOrCreate()
    src, sink = kafka_sources(spark, a.servers), kafka_sink(a.servers)
    if a.app == "log":
        log_app(spark, src, a.root, sink)
    elif a.app == "cdc":
        rows = src("TOPIC_CHANGES").select(F.from_json("value", CHANGE).alias("c")).select("c.*")
        cdc_app(spark, rows, a.root, sink)
    elif a.app == "sale_detail":
        fallback = user_lookup_jdbc(spark, a.users_jdbc, {}) if a.users_jdbc else None
        sale_detail_app(spark, src, a.root, a.as_of, tz=a.tz, fallback=fallback)
    else:
        APPS[a.app](spark, src, a.root, tz=a.tz)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
