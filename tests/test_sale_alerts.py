from pyspark.sql import functions as F

from conftest import rows
from martlens.operators import alerts, sale_detail

ORD = "id long, user_id long, order_status string, create_time string"
LINE = "id string, order_id long, sku_id long, sku_name string, order_price string"
USR = "id long, birthday string, gender string, user_level string"


def _data(spark):
    orders = spark.createDataFrame([(1, 10, "1001", "2024-01-01 08:00:00"), (2, 99, "1002", "2024-01-02 09:00:00")], ORD)
    lines = spark.createDataFrame([
        ("1-1", 1, 7, "small ring", "10.50"), ("1-2", 1, 8, "red gear", "3.00"),
        ("2-1", 2, 7, "small ring", "10.50"), ("9-1", 9, 7, "small ring", "1.00"),  # 9: no order
    ], LINE)
    users = spark.createDataFrame([(10, "2000-01-31", "M", "2")], USR)
    return orders, lines, users


def test_wide_row_inner_join_and_user_enrichment(spark):
    o, l, u = _data(spark)
    out = sale_detail.sale_detail(o, l, u, "2024-01-31")
    got = rows(out, "doc_id", "user_age", "user_gender", "sku_price", "dt")
    assert got == [("1_1-1", 24, "M", 10.5, "2024-01-01"), ("1_1-2", 24, "M", 3.0, "2024-01-01"),
                   ("2_2-1", 0, None, 10.5, "2024-01-02")]  # unknown user 99: age 0, null gender


def test_full_outer_keeps_unmatched_lines(spark):
    o, l, _ = _data(spark)
    got = rows(sale_detail.join_orders_lines(o, l, "full_outer"), "order_id", "order_detail_id")
    assert (9, "9-1") in got and len(got) == 4


def test_interval_join_bounds_are_inclusive(spark):
    left = spark.createDataFrame([(1, "2024-01-10")], "k long, t string").withColumn("t", F.to_timestamp_ntz("t"))
    right = spark.createDataFrame([(1, "2024-01-07"), (1, "2024-01-13"), (1, "2024-01-14"), (2, "2024-01-10")],
                                  "k long, u string").withColumn("u", F.to_timestamp_ntz("u"))
    got = rows(sale_detail.interval_join(left, right, "k", "t", "u", "-3 days", "3 days"), "u")
    assert sorted(str(r[0])[:10] for r in got) == ["2024-01-07", "2024-01-13"]


EV = "mid long, uid long, evid string, itemid long, ts long, log_id long"
T0 = 1704067200000
M = 60000


def _alerts(spark, data, **kw):
    logs = spark.createDataFrame(data, EV)
    return alerts.coupon_alerts(logs, window="5 minutes", slide="5 minutes", **kw)


def test_alert_needs_three_users_and_no_item_view(spark):
    base = [(1, u, "coupon", 100 + u, T0 + u * M // 2, u) for u in (1, 2, 3)]
    assert _alerts(spark, base).count() == 1
    a = _alerts(spark, base).first()
    assert a.uids == [1, 2, 3] and a.item_ids == [101, 102, 103]
    assert [tuple(e) for e in a.events] == [("coupon", 3)]
    assert _alerts(spark, base + [(1, 4, "clickItem", 5, T0 + 4 * M, 9)]).count() == 0   # viewed an item
    assert _alerts(spark, base[:2]).count() == 0                                         # two users
    assert _alerts(spark, [(1, 1, "coupon", 1, T0 + i * M, i) for i in range(3)]).count() == 0  # one user 3x
    assert _alerts(spark, base[:2] + [(1, None, "coupon", 1, T0, 7)]).count() == 0      # null uid is no user
    assert _alerts(spark, base + [(1, 1, "view", 1, T0, 8)]).first().events[-1].evid == "view"


def test_window_edge_is_half_open(spark):
    data = [(1, 1, "coupon", 1, T0, 1), (1, 2, "coupon", 1, T0 + 4 * M, 2), (1, 3, "coupon", 1, T0 + 5 * M, 3)]
    assert _alerts(spark, data).count() == 0     # third coupon is in the next window


def test_one_alert_per_device_minute(spark):
    data = [(1, u, "coupon", 1, T0 + 30000, u) for u in (1, 2, 3)]
    logs = spark.createDataFrame(data, EV)
    many = alerts.coupon_alerts(logs, window="1 minute", slide="10 seconds")
    per_minute = alerts.alerts_per_minute(many)
    assert many.count() == 6   # six 1-minute windows contain 00:00:30; they end in two minutes
    docs = [(d, str(e)) for d, e in rows(per_minute, "doc_id", "window_end")]
    assert docs == [("1-28401120", "2024-01-01 00:00:50"), ("1-28401121", "2024-01-01 00:01:30")]


def test_duplicate_order_collapses_under_the_doc_id_upsert(spark):
    from martlens.operators import upsert
    o, l, u = _data(spark)
    dup = o.unionByName(o.filter(F.col("id") == 1))        # the same order delivered twice
    rows_ = sale_detail.sale_detail(dup, l, u, "2024-01-31")
    assert rows_.count() == 5                                # the join repeats order 1's lines
    stored = upsert.upsert_latest(None, rows_, "doc_id", ["create_time"])
    assert rows(stored, "doc_id") == [("1_1-1",), ("1_1-2",), ("2_2-1",)]


def test_age_bucket_edges(spark):
    from martlens.operators import search
    hits = spark.createDataFrame([(19, "M"), (20, "M"), (29, "F"), (30, "F"), (0, None)], "user_age int, user_gender string")
    # <20: 19 and 0 (unknown user) -> 40%; >=30: 30 -> 20%; 20-30: rest -> 40%
    assert rows(search.age_ratio(hits)) == [(40.0, 40.0, 20.0)]
    assert rows(search.gender_ratio(hits)) == [(40.0, 60.0)]
