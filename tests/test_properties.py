"""Property tests: operator results do not depend on how input is batched
or ordered."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from martlens.operators import dau, upsert

DAY = 86400000
T0 = 1704067200000

log_rows = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3 * DAY - 1)), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs=log_rows, cuts=st.lists(st.integers(0, 40), max_size=3), seed=st.randoms())
def test_incremental_dau_keys_independent_of_batching(spark, logs, cuts, seed):
    data = [(f"m{m}", f"u{m}", "startup", T0 + t, i) for i, (m, t) in enumerate(logs)]
    seed.shuffle(data)
    bounds = sorted({min(c, len(data)) for c in cuts} | {0, len(data)})
    schema = "mid string, uid string, type string, ts long, log_id long"
    stored = spark.createDataFrame([], "mid string, logDate string")
    keys = []
    for a, b in zip(bounds, bounds[1:]):
        batch = spark.createDataFrame(data[a:b], schema)
        new = dau.dau_incremental(batch, stored).select("mid", "logDate").collect()
        keys += [tuple(r) for r in new]
        stored = stored.unionByName(spark.createDataFrame(new, "mid string, logDate string"))
    want = rows(dau.dau_first(spark.createDataFrame(data, schema)), "mid", "logDate")
    assert sorted(keys) == sorted(want)   # every device-day exactly once


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 9)), min_size=1, max_size=30),
       split=st.integers(0, 30))
def test_upsert_equals_latest_of_everything(spark, docs, split):
    data = [(k, v, i) for i, (k, v) in enumerate(docs)]
    schema = "doc_id string, v long, seq long"
    split = min(split, len(data))
    merged = upsert.upsert_latest(spark.createDataFrame(data[:split], schema),
                                  spark.createDataFrame(data[split:], schema), "doc_id", ["seq"])
    latest = {}
    for k, v, i in data:
        latest[k] = (k, v, i)
    assert rows(merged) == sorted(latest.values(), key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(slide=st.integers(1, 12), extra=st.integers(0, 24),
       events=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.sampled_from(["coupon", "view", "clickItem"]),
                                 st.integers(0, 3 * 3600 - 1)), min_size=1, max_size=60))
def test_pane_alert_plan_equals_spark_windows(spark, slide, extra, events):
    from martlens.operators import alerts
    window = slide + extra
    data = [(m, u, e, u % 3, T0 + s * 1000 * 60, i) for i, (m, u, e, s) in enumerate(events)]
    logs = spark.createDataFrame(data, "mid long, uid long, evid string, itemid long, ts long, log_id long")
    w, sl = f"{window * 5} minutes", f"{slide * 5} minutes"
    want = rows(alerts.alert_stage(alerts.window_stage(logs, w, sl), 2))
    assert rows(alerts.alert_stage(alerts.pane_window_stage(logs, w, sl), 2)) == want
    assert rows(alerts.coupon_alerts(logs, w, sl, min_users=2)) == want   # candidate-filtered plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(0, 40), size=st.integers(1, 7))
def test_pages_concatenate_to_the_ordered_hits(spark, n, size):
    from martlens.operators import search
    df = spark.createDataFrame([(f"d{i % 5}", f"id{i:03d}") for i in range(n)], "dt string, doc_id string")
    pages, p = [], 1
    while True:
        got = [(r.dt, r.doc_id) for r in search.page(df, p, size, ["dt", "doc_id"]).collect()]
        if not got:
            break
        pages += got
        p += 1
    assert pages == sorted((r.dt, r.doc_id) for r in df.collect())
