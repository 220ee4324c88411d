"""Streaming = batch: the same inputs fed as JSON-line files, out of order,
one file per trigger, through the streaming jobs with ``availableNow``."""

from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL, rows
from martlens.functions.time import epoch_ms
from martlens.operators import alerts, dau, gmv, sale_detail
from martlens.sources import tables
from martlens.streaming import jobs
from martlens.streaming.sinks import KeyedStore
from martlens.streaming.sources import text_stream

NOW = {"availableNow": True}


def _write_json_files(df, folder, order_col, n_files=3, reverse=True, by=None):
    """Split into ``n_files`` ranges of ``order_col`` (or by the int column
    ``by``) and write them so that, with ``reverse``, the latest range is
    read first."""
    from pyspark.sql.window import Window
    part = F.col(by) + 1 if by else F.ntile(n_files).over(Window.orderBy(order_col))
    ranked = df.withColumn("_part", part)
    parts = list(range(n_files, 0, -1)) if reverse else list(range(1, n_files + 1))
    drop = [c for c in ("_part", order_col, by) if c]
    for i, p in enumerate(parts):
        (ranked.filter(F.col("_part") == p).drop(*drop)
               .select(F.to_json(F.struct("*")).alias("value"))
               .coalesce(1).write.text(f"{folder}/src/f{i:02d}"))
    return [f"{folder}/src/f{i:02d}" for i in range(n_files)]


def _feed(spark, folders, watched):
    import glob
    import os
    import shutil
    os.makedirs(watched, exist_ok=True)
    for i, f in enumerate(folders):
        for j, part in enumerate(sorted(glob.glob(f"{f}/part-*"))):
            shutil.copy(part, f"{watched}/{i:02d}-{j:02d}.json")


def _run(q):
    q.awaitTermination(300)
    assert q.exception() is None, q.exception()


def _dau_stream(spark, startup, tmp_path, **split):
    files = _write_json_files(startup, str(tmp_path), **split)
    _feed(spark, files, str(tmp_path / "in"))
    q = jobs.dau_job(text_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1),
                     str(tmp_path / "dau"), str(tmp_path / "ck"), trigger=NOW)
    _run(q)
    observed = [p["observedMetrics"]["dau_input"]["rows"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(observed) == startup.count()   # per-batch input counts add up to the input
    return KeyedStore(str(tmp_path / "dau"), ["mid", "logDate"], partition_by=["logDate"]).read(spark)


def _startup(spark):
    ev = tables.read_table(spark, SF_SMALL, "events")
    return tables.startup_logs(ev).withColumn("mid", F.col("mid").cast("string")) \
                                  .withColumn("uid", F.col("uid").cast("string")).drop("log_id")


def test_dau_stream_equals_batch_when_days_do_not_span_batches(spark, tmp_path):
    startup = _startup(spark).withColumn("_d", ((F.col("ts") - 1704067200000) / 86400000 / 10).cast("int"))
    streamed = _dau_stream(spark, startup.withColumn("_o", F.col("ts")), tmp_path, order_col="_o", by="_d")
    cols = ["mid", "uid", "ts", "logDate", "logHour"]
    assert rows(streamed, *cols) == rows(dau.dau_first(startup.drop("_d")), *cols)


def test_dau_stream_keys_equal_batch_for_any_arrival_order(spark, tmp_path):
    startup = _startup(spark)
    streamed = _dau_stream(spark, startup.withColumn("_o", F.col("ts")), tmp_path, order_col="_o")
    assert rows(streamed, "mid", "logDate") == rows(dau.dau_first(startup), "mid", "logDate")


def test_gmv_stream_equals_batch(spark, tmp_path):
    orders = tables.order_info(tables.read_table(spark, SF_SMALL, "orders"))
    files = _write_json_files(orders.withColumn("_o", F.col("id")), str(tmp_path), "_o")
    _feed(spark, files, str(tmp_path / "in"))
    _run(jobs.gmv_job(text_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "out"), str(tmp_path / "ck"), NOW))
    streamed = gmv.gmv_total(jobs.gmv_store(str(tmp_path / "out")).read(spark))
    assert rows(streamed) == rows(gmv.gmv_total(gmv.prepare_orders(orders)))


def test_alert_stream_equals_batch_for_closed_windows(spark, tmp_path):
    logs = tables.event_logs(tables.read_table(spark, SF_ORACLE, "events"))
    files = _write_json_files(logs.withColumn("_o", F.col("ts")), str(tmp_path), "_o", reverse=False)
    _feed(spark, files, str(tmp_path / "in"))
    delay_ms = 3600 * 1000
    _run(jobs.alert_job(text_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "alerts"), str(tmp_path / "ck"),
                        window="6 hours", slide="1 hour", delay="1 hour", trigger=NOW))
    streamed = KeyedStore(str(tmp_path / "alerts"), "doc_id").read(spark)
    batch = alerts.alerts_per_minute(alerts.coupon_alerts(logs, "6 hours", "1 hour"))
    # windows closed by the watermark during the run (availableNow does not flush open ones)
    closed_before = logs.agg(F.max("ts")).first()[0] - delay_ms - 3600 * 1000
    keep = lambda df: df.filter(epoch_ms(F.col("window_end").cast("timestamp_ntz")) <= closed_before)
    norm = lambda df: keep(df).select("doc_id", *[F.array_sort(F.col(c).cast("array<long>")).alias(c)
                                                  for c in ("uids", "item_ids")])
    got, want = rows(norm(streamed)), rows(norm(batch))
    assert len(want) > 300 and got == want


def test_sale_detail_stream_stream_join_equals_batch(spark, tmp_path):
    o = tables.order_info(tables.read_table(spark, SF_SMALL, "orders"))
    d = tables.order_detail(tables.read_table(spark, SF_SMALL, "lineitem"), tables.read_table(spark, SF_SMALL, "part"))
    users = tables.user_info(tables.read_table(spark, SF_SMALL, "customer"))
    # lines first, orders later: the join must wait for the other side
    _feed(spark, _write_json_files(d.withColumn("_o", F.col("id")), str(tmp_path / "d"), "_o"), str(tmp_path / "din"))
    _feed(spark, _write_json_files(o.withColumn("_o", F.col("id")), str(tmp_path / "o"), "_o"), str(tmp_path / "oin"))
    q = jobs.sale_detail_job(text_stream(spark, str(tmp_path / "oin"), 1), text_stream(spark, str(tmp_path / "din"), 1),
                             users, "2024-02-01", str(tmp_path / "sd"), str(tmp_path / "ck"), trigger=NOW)
    _run(q)
    streamed = KeyedStore(str(tmp_path / "sd"), "doc_id", partition_by=["dt"]).read(spark)
    batch = sale_detail.sale_detail(o, d, users, "2024-02-01")
    cols = ["doc_id", "user_age", "user_gender", "sku_price", "dt"]
    assert rows(streamed, *cols) == rows(batch, *cols)


def test_user_info_stream_last_write_wins(spark, tmp_path):
    first = spark.createDataFrame([("1", "a", "1", "1990-01-01", "M"), ("2", "b", "1", "1991-01-01", "F")],
                                  "id string, login_name string, user_level string, birthday string, gender string")
    second = spark.createDataFrame([("1", "a2", "3", "1990-01-01", "M")], first.schema)
    _feed(spark, _write_json_files(first.withColumn("_o", F.col("id")), str(tmp_path / "a"), "_o", 1),
          str(tmp_path / "in"))
    _run(jobs.user_info_job(text_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "u"), str(tmp_path / "ck"), NOW))
    _feed(spark, _write_json_files(second.withColumn("_o", F.col("id")), str(tmp_path / "b"), "_o", 1),
          str(tmp_path / "in2"))
    import shutil
    for f in (tmp_path / "in2").iterdir():
        shutil.copy(f, tmp_path / "in" / ("z" + f.name))
    _run(jobs.user_info_job(text_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "u"), str(tmp_path / "ck"), NOW))
    got = rows(KeyedStore(str(tmp_path / "u"), "id").read(spark), "id", "login_name", "user_level")
    assert got == [("1", "a2", "3"), ("2", "b", "1")]


def test_log_ingest_stream_routes_and_archives_by_day(spark, tmp_path):
    ev = tables.read_table(spark, SF_SMALL, "events")
    from martlens.sources.logs import log_lines
    lines = log_lines(ev).select("value")
    lines.coalesce(1).write.text(str(tmp_path / "src"))
    _feed(spark, [str(tmp_path / "src")], str(tmp_path / "in"))
    _run(jobs.log_ingest_job(text_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"), NOW))
    out = spark.read.text(str(tmp_path / "out"))
    got = {r.topic: r["count"] for r in out.groupBy("topic").count().collect()}
    signups = ev.filter(F.col("event_type") == "signup").count()
    assert got == {"TOPIC_START": signups, "TOPIC_EVENT": ev.count() - signups}
    assert out.select(F.get_json_object("value", "$.ts").isNotNull().alias("stamped")).distinct().collect()[0].stamped


def test_cdc_stream_routes_like_batch(spark, tmp_path):
    from martlens.sources import cdc
    T = lambda n: tables.read_table(spark, SF_SMALL, n)
    changes = cdc.change_log(T("orders"), T("lineitem"), T("customer"), T("part"))
    from martlens.schemas import CHANGE_EVENT
    changes.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(CHANGE_EVENT).parquet(str(tmp_path / "in"))
    _run(jobs.cdc_job(stream, str(tmp_path / "out"), str(tmp_path / "ck"), NOW))
    out = spark.read.text(str(tmp_path / "out"))
    want = cdc.route_changes(changes)
    assert rows(out, "topic", "value") == rows(want, "topic", "value")


def test_dau_state_store_dedup_keeps_one_row_per_device_day(spark, tmp_path):
    startup = _startup(spark)
    _feed(spark, _write_json_files(startup.withColumn("_o", F.col("ts")), str(tmp_path), "_o", reverse=False),
          str(tmp_path / "in"))
    _run(jobs.dau_dedup_job(text_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "out"), str(tmp_path / "ck"),
                            delay="2 days", trigger=NOW))
    out = spark.read.parquet(str(tmp_path / "out")).withColumn("logDate", F.col("logDate").cast("string"))
    # in-order input: first arrival = earliest log, so rows equal the batch operator
    cols = ["mid", "uid", "ts", "logDate", "logHour"]
    assert rows(out, *cols) == rows(dau.dau_first(startup), *cols)


def test_apps_wire_topics_to_jobs(spark, tmp_path):
    """The DAU app reads the start-up topic (a file stream stands in for Kafka)."""
    from martlens.streaming import apps
    startup = _startup(spark)
    _feed(spark, _write_json_files(startup.withColumn("_o", F.col("ts")), str(tmp_path / "s"), "_o", reverse=False),
          str(tmp_path / "TOPIC_START"))
    seen = []

    def source(topic):
        seen.append(topic)
        return text_stream(spark, str(tmp_path / topic), 1)

    _run(apps.dau_app(spark, source, str(tmp_path / "root"), trigger=NOW))
    assert seen == ["TOPIC_START"]
    stored = KeyedStore(str(tmp_path / "root" / "dau"), ["mid", "logDate"], partition_by=["logDate"]).read(spark)
    assert rows(stored, "mid", "logDate") == rows(dau.dau_first(startup), "mid", "logDate")


def test_sale_detail_stream_drops_lines_beyond_the_arrival_bound(spark, tmp_path):
    import json
    import os
    users = spark.createDataFrame([(7, "a", "1", "2000-01-01", "F")],
                                  "id long, login_name string, user_level string, birthday string, gender string")
    t0 = 1_700_000_000
    (tmp_path / "o").mkdir()
    (tmp_path / "d").mkdir()
    order = {"id": "1", "user_id": "7", "order_status": "1", "create_time": "2024-01-01 10:00:00"}
    (tmp_path / "o" / "o.json").write_text(json.dumps(order) + "\n")
    os.utime(tmp_path / "o" / "o.json", (t0, t0))
    for name, delay in (("near", 60), ("far", 250)):       # bound is 100 s
        line = {"id": name, "order_id": "1", "sku_id": "3", "sku_name": "x", "order_price": "2.50"}
        f = tmp_path / "d" / f"{name}.json"
        f.write_text(json.dumps(line) + "\n")
        os.utime(f, (t0 + delay, t0 + delay))
    q = jobs.sale_detail_job(text_stream(spark, str(tmp_path / "o")), text_stream(spark, str(tmp_path / "d")),
                             users, "2024-02-01", str(tmp_path / "sd"), str(tmp_path / "ck"), trigger=NOW)
    _run(q)
    got = KeyedStore(str(tmp_path / "sd"), "doc_id", partition_by=["dt"]).read(spark)
    assert rows(got, "doc_id", "sku_price", "user_gender") == [("1_near", 2.5, "F")]


def test_archive_and_append_sinks(spark, tmp_path):
    from martlens.streaming.sinks import append_by_batch, archive_logs
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"dt":"2024-01-01","x":1}\n{"dt":"2024-01-02","x":2}\n')
    lines = text_stream(spark, str(src)).withColumn("dt", F.get_json_object("value", "$.dt"))
    archive = archive_logs(lines, str(tmp_path / "arch"), str(tmp_path / "ck1"))
    archive.processAllAvailable()
    archive.stop()
    got = spark.read.text(str(tmp_path / "arch"))
    assert sorted(str(r.dt) for r in got.select("dt").collect()) == ["2024-01-01", "2024-01-02"]
    write = append_by_batch(str(tmp_path / "app"), partition_by=["dt"])
    batch = spark.createDataFrame([("2024-01-01", 1)], "dt string, x long")
    write(batch, 3)
    write(batch, 3)  # a replay of batch 3 replaces its own folder
    assert spark.read.parquet(str(tmp_path / "app")).count() == 1


def test_sale_detail_stream_sees_user_updates_made_after_start(spark, tmp_path):
    import json
    calls = []
    versions = [spark.createDataFrame([(7, "1", "2000-01-01", "F")], "id long, user_level string, birthday string, gender string"),
                spark.createDataFrame([(7, "9", "2000-01-01", "M")], "id long, user_level string, birthday string, gender string")]

    def users(ids):   # the dimension as it is when each micro-batch runs
        calls.append(1)
        return versions[min(len(calls) - 1, 1)]

    (tmp_path / "o").mkdir()
    (tmp_path / "d").mkdir()
    for i in (1, 2):
        (tmp_path / "o" / f"o{i}.json").write_text(json.dumps(
            {"id": str(i), "user_id": "7", "order_status": "1", "create_time": "2024-01-01 10:00:00"}) + "\n")
        (tmp_path / "d" / f"d{i}.json").write_text(json.dumps(
            {"id": f"l{i}", "order_id": str(i), "sku_id": "3", "sku_name": "x", "order_price": "1.00"}) + "\n")
    q = jobs.sale_detail_job(text_stream(spark, str(tmp_path / "o"), 1), text_stream(spark, str(tmp_path / "d"), 1),
                             users, "2024-02-01", str(tmp_path / "sd"), str(tmp_path / "ck"), trigger=NOW)
    _run(q)
    got = rows(KeyedStore(str(tmp_path / "sd"), "doc_id", partition_by=["dt"]).read(spark), "doc_id", "user_gender")
    assert len(calls) >= 2 and got == [("1_l1", "F"), ("2_l2", "M")]


def test_dau_stream_replay_after_a_crash_is_idempotent(spark, tmp_path):
    """A batch whose output was written but whose commit was lost (driver died)
    is replayed on restart; the stored DAU must not change."""
    import os
    startup = _startup(spark)
    _feed(spark, _write_json_files(startup.withColumn("_o", F.col("ts")), str(tmp_path), "_o"), str(tmp_path / "in"))

    def run():
        q = jobs.dau_job(text_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "dau"),
                         str(tmp_path / "ck"), trigger=NOW)
        _run(q)
        processed = sum(p["numInputRows"] for p in q.recentProgress)
        return rows(KeyedStore(str(tmp_path / "dau"), ["mid", "logDate"], partition_by=["logDate"]).read(spark)), processed

    before, _ = run()
    commits = sorted(int(f) for f in os.listdir(tmp_path / "ck" / "commits") if f.isdigit())
    last = tmp_path / "ck" / "commits" / str(commits[-1])    # the last batch never committed
    os.remove(last)
    crc = tmp_path / "ck" / "commits" / f".{commits[-1]}.crc"
    if crc.exists():
        os.remove(crc)
    after, replayed = run()
    assert replayed > 0          # the uncommitted batch really ran again
    assert after == before
    assert len(after) == rows(dau.dau_first(startup), "mid", "logDate").__len__()
