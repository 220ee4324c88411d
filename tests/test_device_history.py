"""Device sets, first-seen days and their stores against plain Python."""

import datetime as dt
import itertools
import json
import random

import pytest
from conftest import rows
from test_streaming import NOW, _run

from martlens.operators import device_sets as S
from martlens.operators import first_seen as FS
from martlens.streaming import apps, jobs
from martlens.streaming.sources import text_stream
from martlens.streaming.state import DeviceHistory

DAYS = [f"2024-01-{d:02d}" for d in range(1, 32)]


def table(spark, days):
    return spark.createDataFrame(days, "mid string, logDate string")


def random_days(seed, n, devices):
    rng = random.Random(seed)
    return [(f"m{min(rng.randrange(devices), rng.randrange(devices))}", rng.choice(DAYS)) for _ in range(n)]


def trailing(days, spans):
    known = [(m, dt.date.fromisoformat(d)) for m, d in days if m is not None and d is not None]
    first, last = min(d for _, d in known), max(d for _, d in known)
    out = []
    for k in range((last - first).days + 1):
        day = first + dt.timedelta(k)
        counts = [len({m for m, d in known if day - dt.timedelta(n) < d <= day}) for n in spans]
        if any(counts):
            out.append((str(day), *counts))
    return out


def first_days(days):
    seen = {}
    for m, d in days:
        if m is not None and d is not None:
            seen[m] = min(seen.get(m, d), d)
    out = {}
    for d in seen.values():
        out[d] = out.get(d, 0) + 1
    return seen, sorted(out.items())


@pytest.mark.parametrize("parts", [1, 7])
def test_trailing_ranges(spark, parts):
    days = random_days(1, 900, 150) + [(None, DAYS[0]), ("x", None), ("gap", "2024-03-20")]
    t = table(spark, days)
    sets = S.daily_sets(t, S.number_devices(t, parts))
    for spans in ((7, 30), (1, 2, 3), (5,)):
        assert rows(S.trailing_active_devices(sets, spans)) == trailing(days, sorted(spans))
    want = len({m for m, d in days if m and d and "2024-01-05" <= d <= "2024-01-11"})
    assert S.active_devices(sets, "2024-01-05", "2024-01-11").first()[0] == want
    assert S.active_devices(sets, "2025-01-05", "2025-01-11").first()[0] == 0


def test_numbers_are_dense_and_stay(spark):
    mids = [f"m{i}" for i in range(2000)]
    t = spark.createDataFrame([(m,) for m in mids[:1200]] + [("m1",), (None,)], "mid string")
    numbers = S.number_devices(t, 4).cache()
    more = S.extend_numbers(numbers, spark.createDataFrame([(m,) for m in mids[1000:]] + [("m5",)], "mid string"), 4).cache()
    by = {r.mid: r.number for r in numbers.unionByName(more).collect()}
    assert sorted(by) == sorted(mids) and len(set(by.values())) == 2000 and more.count() == 800
    for part in range(4):
        places = sorted(n & ((1 << S.PLACE_BITS) - 1) for n in by.values() if n >> S.PLACE_BITS == part)
        assert places == list(range(len(places)))
    # more than one bitmap per part
    assert numbers.count() == 1200


def test_bitmaps_of_many_devices(spark):
    days = spark.range(100_000).selectExpr("id AS mid", "if(id % 3 = 0, '2024-01-01', '2024-01-02') AS logDate")
    sets = S.daily_sets(days, S.number_devices(days, 2))
    assert sets.count() > 4
    assert rows(S.trailing_active_devices(sets, (2,))) == [("2024-01-01", 33334), ("2024-01-02", 100_000)]


def test_first_days_in_any_batch_order(spark):
    days = random_days(2, 300, 60) + [(None, DAYS[3]), ("x", None)]
    batches = [days[:100], days[100:200], days[200:]]
    for order in itertools.islice(itertools.permutations(batches), 0, None, 2):
        got = FS.new_devices_of_batches([table(spark, b) for b in order])
        assert rows(got) == first_days(days)[1]


def test_a_late_log_moves_a_first_day_back(spark):
    state = FS.first_days(table(spark, [("a", "2024-01-05"), ("b", "2024-01-02")]))
    moves = FS.first_seen_moves(state, table(spark, [("a", "2024-01-03"), ("a", "2024-01-04"), ("b", "2024-01-09"), ("c", "2024-01-03")]))
    assert rows(FS.by_date(moves)) == [("2024-01-03", 2), ("2024-01-05", -1)]
    assert [(m, str(d)) for m, d in rows(FS.merge_first_seen(state, moves))] == [("a", "2024-01-03"), ("b", "2024-01-02"), ("c", "2024-01-03")]


def test_a_device_that_holds_a_third_of_the_rows(spark):
    days = random_days(3, 4000, 80) + [("hot", DAYS[i % 31]) for i in range(2000)]
    t = table(spark, days).repartition(6)
    assert rows(FS.new_devices_of_batches([t])) == first_days(days)[1]
    assert rows(S.trailing_active_devices(S.daily_sets(t, S.number_devices(t)), (7,))) == trailing(days, (7,))


def test_history_of_batches_with_replays_and_compaction(spark, tmp_path):
    days = random_days(4, 240, 50)
    history = DeviceHistory(str(tmp_path / "h"), parts=3, compact_every=2)
    for b in range(4):
        part = days[b * 60:(b + 1) * 60] + [(None, DAYS[0])]
        for _ in range(2 if b == 2 else 1):         # a batch written twice, as after a lost commit
            history.write_batch(table(spark, part), b)
        so_far = days[:(b + 1) * 60]
        assert rows(history.new_devices(spark)) == first_days(so_far)[1]
    assert rows(history.trailing(spark)) == trailing(so_far, (7, 30))
    assert {r.mid: str(r.first_day) for r in history.first.read(spark).collect()} == first_days(days)[0]
    date, n = first_days(days)[1][0]
    one = history.new_devices(spark, date)
    assert rows(one) == [(date, n)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "logDate" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sum(p.name.startswith("base-") for p in (tmp_path / "h" / "sets").iterdir()) <= 2


def test_the_dau_app_keeps_the_history(spark, tmp_path):
    (tmp_path / "in").mkdir()
    days = random_days(5, 120, 30)
    for b in range(3):
        lines = [json.dumps({"mid": m, "uid": "u", "type": "startup", "ts": int(dt.datetime.fromisoformat(d + "T09:00:00+00:00").timestamp()) * 1000})
                 for m, d in days[b::3]]
        (tmp_path / "in" / f"f{b}.json").write_text("\n".join([*lines, "junk"]) + "\n")
    _run(apps.dau_app(spark, lambda _: text_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "root"), NOW, compact_every=2))
    history = jobs.DeviceHistory(f"{tmp_path}/root/devices")
    assert rows(history.new_devices(spark)) == first_days(days)[1]
    assert rows(history.trailing(spark, (7,))) == trailing(days, (7,))
