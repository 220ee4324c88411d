"""Alert episodes by islands and a sweep against plain window expansion."""

import random

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from martlens.functions.time import epoch_ms
from martlens.operators import alert_islands as I
from martlens.operators import alerts
from martlens.sources import tables

SCHEMA = "mid string, uid string, evid string, itemid long, ts long"


def table(spark, events):
    return spark.createDataFrame(events, SCHEMA)


def expanded(events, window, slide, min_users=3):
    length, step = alerts.interval_ms(window), alerts.interval_ms(slide)
    users, views = {}, set()
    for mid, uid, evid, _, ts in events:
        if mid is None or ts is None:
            continue
        for k in range((ts - length) // step + 1, ts // step + 1):
            if evid == "coupon" and uid is not None:
                users.setdefault((mid, k), set()).add(uid)
            if evid == "clickItem":
                views.add((mid, k))
    hit = sorted(key for key, u in users.items() if len(u) >= min_users and key not in views)
    out = []
    for mid, k in hit:
        if out and out[-1][0] == mid and out[-1][2] == k - 1:
            out[-1][2], out[-1][3] = k, max(out[-1][3], len(users[mid, k]))
        else:
            out.append([mid, k, k, len(users[mid, k])])
    return sorted((m, a * step, b * step, b - a + 1, n) for m, a, b, n in out)


def got(df):
    return rows(df.select("mid", epoch_ms("first_window"), epoch_ms("last_window"), "windows", "most_users"))


def random_events(seed, n, devices, users, span):
    rng = random.Random(seed)
    t0 = 1_704_067_200_000
    return [(rng.choice([None, *[f"d{k}" for k in range(devices)]]), rng.choice([None, *[f"u{k}" for k in range(users)]]),
             rng.choices(["coupon", "clickItem", "other", None], [12, 1, 3, 1])[0], 1,
             rng.choice([None] + [t0 + rng.randrange(span)] * 30)) for _ in range(n)]


@pytest.mark.parametrize("window, slide", [("5 minutes", "5 seconds"), ("20 seconds", "7 seconds"), ("1 minute", "1 minute")])
def test_episodes_equal_window_expansion(spark, window, slide):
    for seed, span in ((1, 4_000_000), (2, 300_000)):
        events = random_events(seed, 400, 3, 9, span)
        want = expanded(events, window, slide)
        assert got(I.alert_episodes(table(spark, events).repartition(4), window, slide)) == want
        assert want or window != "5 minutes"


def test_episodes_across_sweep_blocks(spark, monkeypatch):
    monkeypatch.setattr(I, "BLOCK", 3)
    events = random_events(3, 500, 2, 8, 3_000_000)
    assert got(I.alert_episodes(table(spark, events), "5 minutes", "5 seconds")) == expanded(events, "5 minutes", "5 seconds")


def test_a_hot_device_and_a_hot_user(spark):
    events = random_events(4, 1500, 2, 30, 30_000_000)
    events += [("hot", "u1", "coupon", 1, 1_704_067_200_000 + 1000 * i) for i in range(1500)]
    events += [("hot", f"v{i % 40}", "coupon", 1, 1_704_067_200_000 + 5000 * i) for i in range(300)]
    assert got(I.alert_episodes(table(spark, events).repartition(5))) == expanded(events, "5 minutes", "5 seconds")


def test_nothing_and_nobody(spark):
    assert I.alert_episodes(table(spark, [])).count() == 0
    alone = [("d", None, "coupon", 1, 5000), ("d", "a", "coupon", 1, 5000), ("d", "b", "coupon", 1, 5000), (None, "c", "coupon", 1, 5000)]
    assert I.alert_episodes(table(spark, alone)).count() == 0
    with pytest.raises(ValueError, match="slide"):
        I.alert_episodes(table(spark, []), "5 seconds", "1 minute")


def test_windows_are_those_of_the_alert_operator(spark):
    logs = tables.event_logs(tables.read_table(spark, SF_SMALL, "events"))
    episodes = I.alert_episodes(logs, "12 hours", "1 hour")
    step = 3_600_000
    windows = episodes.select("mid", F.explode(F.sequence(epoch_ms("first_window"), epoch_ms("last_window"), F.lit(step).cast("long"))))
    want = alerts.coupon_alerts(logs, "12 hours", "1 hour").select("mid", epoch_ms("window_start"))
    assert rows(windows) == rows(want) and want.count() > 0


def test_only_native_columns_and_no_expansion(spark):
    plan = I.alert_episodes(table(spark, [("d", "a", "coupon", 1, 5000)]))._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "CartesianProduct", "NestedLoop", "sequence(") if x in plan]
