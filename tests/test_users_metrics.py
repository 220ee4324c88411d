"""User life and lookup, lines unmatched at expiry, and the counts of all apps."""

import datetime as dt
import json
import os
import random

from conftest import rows
from pyspark.sql import functions as F
from test_streaming import NOW, _run

from martlens.operators import live_users, sale_detail
from martlens.sources import jdbc
from martlens.streaming import apps, jobs
from martlens.streaming.metrics import RunMetrics
from martlens.streaming.sinks import folder_sink
from martlens.streaming.sources import text_stream

DAY = 86_400_000
T0 = 1_704_067_200_000


def touched(spark, data):
    return spark.createDataFrame(data, "id string, ts long, kind string")


def sessions(data):
    out, by = [], {}
    for i, ts, kind in data:
        if i is not None and ts is not None:
            by.setdefault(i, []).append((ts, kind))
    for i, own in by.items():
        own.sort()
        start = 0
        for k in range(1, len(own) + 1):
            if k == len(own) or own[k][0] - own[k - 1][0] > DAY:
                part = own[start:k]
                at = [dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms) for ms in (part[0][0], part[-1][0] + DAY)]
                out.append((i, *at, sum(x[1] == "update" for x in part), sum(x[1] == "lookup" for x in part)))
                start = k
    return sorted(out, key=repr)


def random_touches(seed, n, users):
    rng = random.Random(seed)
    return [(rng.choice([f"u{k}" for k in range(users)]), T0 + rng.randrange(40 * DAY), rng.choice(["update", "lookup"])) for _ in range(n)]


EDGES = [("a", T0, "update"), ("a", T0 + DAY, "lookup"), ("b", T0, "update"), ("b", T0 + DAY + 1, "lookup"), ("b", T0 + 2 * DAY, "lookup"),
         ("c", T0, "lookup"), ("c", T0, "lookup"), (None, T0, "update"), ("d", None, "update")]


def test_lives_are_sessions_by_gap(spark):
    data = EDGES + random_touches(1, 300, 25) + [("hot", T0 + 1000 * i, "lookup") for i in range(400)]
    got = live_users.live_intervals(touched(spark, data).repartition(4))
    assert rows(got) == sessions(data)


def test_live_stream_equals_batch(spark, tmp_path):
    data = EDGES + random_touches(2, 200, 12)
    known = sorted((r for r in data if r[0] is not None and r[1] is not None), key=lambda r: r[1])
    # sessions that the last, far touch closes are emitted
    parts = [known[:70], known[70:140], known[140:], [("end", T0 + 90 * DAY, "update")]]
    _files(tmp_path / "in", [(f"f{k}", k, [dict(zip(("id", "ts", "kind"), r, strict=True)) for r in part]) for k, part in enumerate(parts)])
    lines = text_stream(spark, str(tmp_path / "in"), 1).select(F.from_json("value", "id string, ts long, kind string").alias("r")).select("r.*")
    q = live_users.live_stream(lines, delay="1 minute").writeStream.format("parquet").option("path", str(tmp_path / "out")) \
        .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(**NOW).start()
    _run(q)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sessions(known)


def test_predicates_name_every_id_once(spark):
    table = spark.range(1000).selectExpr("concat('u', id) AS id", "id % 7 AS user_level").cache()
    ids = spark.createDataFrame([(f"u{i}",) for i in range(0, 1000, 3)] + [("u3",), (None,), ("o'brien",), ("gone",)], "id string")
    asked = []

    def read(predicates):
        asked.append(predicates)
        return table.filter(" OR ".join(predicates))

    found = jdbc.rows_by_id(ids, read, per_query=50, at_once=120)
    assert rows(found, "id") == sorted((f"u{i}",) for i in range(0, 1000, 3))
    flat = [i for p in asked for q in p for i in q.removeprefix("id IN (").removesuffix(")").split(", ")]
    assert len(flat) == len(set(flat)) == 336 and "'o''brien'" in flat and max(q.count(",") for p in asked for q in p) < 50
    assert len(asked) == 3
    assert jdbc.rows_by_id(ids.filter("id IS NULL"), read) is None and jdbc.in_lists([]) == []


def _user_rows(spark, data):
    return spark.createDataFrame(data, "id string, login_name string, user_level string, birthday string, gender string, updated_at timestamp")


def test_lookups_refresh_the_life_and_expired_users_are_read_again(spark, tmp_path):
    clock = [dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)]
    asked, level = [], ["db"]

    def fallback(ids):
        asked.append(sorted(r.id for r in ids.collect()))
        return spark.createDataFrame([(i, level[0], "2000-01-01", "M") for i in asked[-1] if i != "nobody"],
                                     "id string, user_level string, birthday string, gender string")

    lookup = jobs.user_lookup(spark, str(tmp_path / "u"), fallback, compact_every=2, now=lambda: clock[0])
    jobs.user_store(str(tmp_path / "u")).write_batch(_user_rows(spark, [("1", "a", "store", "1990-01-01", "F", clock[0])]), 0)
    ids = spark.createDataFrame([("1",), ("2",), ("nobody",)], "id string")

    def ask(batch, hours):
        clock[0] += dt.timedelta(hours=hours)
        users, done = lookup.users(ids, batch)
        got = rows(users, "id", "user_level")
        done()
        return got

    assert ask(0, 1) == [("1", "store"), ("2", "db")] and asked[-1] == ["2", "nobody"]
    assert ask(0, 0) == [("1", "store"), ("2", "db")] and asked[-1] == ["2", "nobody"]     # a replay asks the same again
    level[0] = "new"
    for batch in (1, 2):                                                                   # kept alive by lookups
        assert ask(batch, 20) == [("1", "store"), ("2", "db")] and asked[-1] == ["nobody"]
    assert ask(3, 25) == [("1", "new"), ("2", "new")] and asked[-1] == ["1", "2", "nobody"]
    assert ask(4, 1) == [("1", "new"), ("2", "new")] and asked[-1] == ["nobody"]
    jobs.user_store(str(tmp_path / "u")).write_batch(_user_rows(spark, [("2", "b", "update", "1990-01-01", "F", clock[0])]), 1)
    assert ask(5, 1) == [("1", "new"), ("2", "update")]
    assert rows(jobs.user_lookup(spark, str(tmp_path / "u"))(ids), "id") == [("1",), ("2",)]
    assert not spark._jsparkSession.sharedState().cacheManager().lookupCachedData(lookup.known(ids, 6)._jdf).isDefined()


def _files(folder, files):
    """[(name, seconds after T0, records)] as JSON lines with these arrival times."""
    folder.mkdir(parents=True)
    for name, at, records in files:
        f = folder / f"{name}.json"
        f.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
        os.utime(f, (T0 / 1000 + at, T0 / 1000 + at))
    return str(folder)


def _line(i, order):
    return {"id": i, "order_id": order, "sku_id": "3", "sku_name": "x", "order_price": "2.50"}


def _order(i):
    return {"id": i, "user_id": "7", "order_status": "1", "create_time": "2024-01-01 10:00:00"}


LINES = [("a", 0, [_line("near", "1"), _line("lost", "9"), _line("late", "2")]), ("b", 50, [_line("second", "1")]),
         ("z", 2000, [_line("open", "8")])]
ORDERS = [("a", 30, [_order("1")]), ("b", 400, [_order("2")]), ("z", 2000, [_order("77")])]


def test_lines_that_no_order_met_are_rejected_when_they_expire(spark, tmp_path):
    users = spark.createDataFrame([("7", "1", "2000-01-01", "F")], "id string, user_level string, birthday string, gender string")
    q = jobs.sale_detail_job(text_stream(spark, _files(tmp_path / "o", ORDERS), 1), text_stream(spark, _files(tmp_path / "d", LINES), 1),
                             users, "2024-02-01", str(tmp_path / "sd"), str(tmp_path / "ck"), trigger=NOW, rejects=str(tmp_path / "rej"))
    _run(q)
    got = jobs.read_store(spark, str(tmp_path / "sd"), "doc_id", partition_by=("dt",))
    assert rows(got, "doc_id", "user_gender") == [("1_near", "F"), ("1_second", "F")]
    rejected = [json.loads(r.value) for r in spark.read.parquet(str(tmp_path / "rej")).collect()]
    table = [(n, i["id"], i["order_id"], at) for n, at, ls in LINES for i in ls]
    batch = sale_detail.unmatched_lines(
        spark.createDataFrame(table, "f string, id string, order_id string, at int").withColumn("at", F.timestamp_seconds("at")),
        spark.createDataFrame([(o["id"], at) for _, at, os_ in ORDERS for o in os_], "order_id string, o_at int")
        .withColumn("o_at", F.timestamp_seconds("o_at")), "order_id", "at", "o_at", "100 seconds")
    closed = sorted(r.id for r in batch.collect() if r.id != "open")        # still waiting when the stream stops
    assert sorted(r["id"] for r in rejected) == closed == ["late", "lost"] and rejected[0]["order_price"] == 2.5


def test_unmatched_lines_edges(spark):
    line = spark.createDataFrame([(1, 10), (1, 200), (None, 10), (2, None), (3, 5)], "k int, t int").withColumn("t", F.timestamp_seconds("t"))
    order = spark.createDataFrame([(1, 50), (1, 60), (2, 5), (None, 10), (3, None)], "k int, s int").withColumn("s", F.timestamp_seconds("s"))
    got = sale_detail.unmatched_lines(line, order, "k", "t", "s", "100 seconds").select("k", F.unix_seconds("t"))
    assert rows(got) == sorted([(1, 200), (None, 10), (2, None), (3, 5)], key=repr)


def test_every_app_reports_its_counts(spark, tmp_path):
    seen = {}
    metrics = RunMetrics(lambda r: seen.setdefault(r["app"], []).append(r))
    spark.streams.addListener(metrics)
    try:
        start = {"mid": "m1", "uid": "u", "type": "startup", "ts": T0}
        data = {"TOPIC_START": [start, start, {"mid": "m2"}, "junk"], "TOPIC_ORDER_INFO": [_order("1") | {"total_amount": 2.0}, {"id": None}],
                "TOPIC_ORDER_DETAIL": [_line("l", "1")], "TOPIC_USER_INFO": [{"id": "7"}, {"id": "7"}, {}],
                "TOPIC_EVENT": [{"mid": "d", "uid": f"u{k}", "evid": "coupon", "ts": T0} for k in range(3)] + ["junk"],
                "TOPIC_LOG_RAW": [start, "junk"]}
        for topic, records in data.items():
            _files(tmp_path / topic, [("a", 0, records)])

        def source(topic):
            return text_stream(spark, str(tmp_path / topic))

        root = str(tmp_path / "root")
        for app in (apps.dau_app, apps.gmv_app, apps.alert_app, apps.user_app, apps.sale_detail_app):
            _run(app(spark, source, root, trigger=NOW, metrics=metrics))
        for q in apps.log_app(spark, source, root, folder_sink(str(tmp_path / "topics")), NOW, metrics=metrics):
            _run(q)
        changes = spark.createDataFrame([("ROWDATA", "order_info", "INSERT", "1", {"id": "1"}), ("TRANSACTIONEND", None, None, None, None)],
                                        apps.CHANGE)
        changes.write.parquet(str(tmp_path / "changes"))
        _run(apps.cdc_app(spark, spark.readStream.schema(apps.CHANGE).parquet(str(tmp_path / "changes")), root,
                          folder_sink(str(tmp_path / "cdc")), NOW, metrics=metrics))
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        first = {app: r[0] for app, r in seen.items()}
        counts = {app: (r["read"], r["rejected"]) for app, r in first.items()}
        assert counts == {"dau": (4, 2), "gmv": (2, 1), "alert": (4, 1), "user": (3, 1), "sale_order": (2, 1), "sale_detail": (1, 0),
                          "log": (2, 1), "log_publish": (2, 1), "cdc": (2, 1)}
        assert (first["dau"]["in_batch"], first["dau"]["new"]) == (1, 1) and first["gmv"]["new"] == 1
        assert first["user"]["in_batch"] == 1 and first["sale_detail"]["joined"] == 1
        assert all(r["seconds"] >= 0 for r in first.values()) and first["sale_detail"]["state_rows"] > 0
    finally:
        spark.streams.removeListener(metrics)


def test_alert_stream_without_state_survives_a_replay(spark, tmp_path):
    """Late and early events, a view that silences a device, and the last batch run twice."""
    minute = 60_000
    def ev(mid, uid, at, evid="coupon"):
        return {"mid": mid, "uid": uid, "evid": evid, "itemid": "1", "ts": T0 + at * minute}

    files = [[ev("a", "u1", 1), ev("b", "u1", 1), ev("a", "u2", 2)], [ev("a", "u3", 4), ev("b", "u2", 4), ev("b", "u3", 5)],
             [ev("b", "u9", 3, "clickItem"), ev("a", "u1", 30)], [ev("a", "late", 3, "clickItem")] + [ev("c", f"u{k}", 40 + k) for k in range(4)], [ev("z", "u", 90)]]
    source = _files(tmp_path / "in", [(f"f{k}", k, f) for k, f in enumerate(files)])
    seen = []

    def run():
        q = jobs.alert_job(text_stream(spark, source, 1), str(tmp_path / "al"), str(tmp_path / "ck"), "10 minutes", "1 minute",
                           "3 minutes", NOW, compact_every=2)
        _run(q)
        seen.extend(p["stateOperators"] for p in q.recentProgress)
        return rows(jobs.read_store(spark, str(tmp_path / "al"), "doc_id"), "doc_id", "uids")

    from martlens.operators import alerts
    logs = spark.createDataFrame([tuple(e[c] for c in ("mid", "uid", "evid", "itemid", "ts")) for f in files for e in f if e["uid"] != "late"],
                                 "mid string, uid string, evid string, itemid string, ts long")
    want = rows(alerts.alerts_per_minute(alerts.coupon_alerts(logs, "10 minutes", "1 minute")), "doc_id", "uids")
    got = run()
    assert want and got == want                     # the last event closes all windows before it
    assert not any(seen)                            # no operator state
    last = max(int(f) for f in os.listdir(tmp_path / "ck" / "commits") if f.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if (tmp_path / "ck" / "commits" / name).exists():
            os.remove(tmp_path / "ck" / "commits" / name)
    assert run() == want
