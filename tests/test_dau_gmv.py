from pyspark.sql import functions as F

from conftest import rows
from martlens.operators import dau, gmv, kpi

LOG = "mid string, uid string, type string, ts long, log_id long"
D1 = 1704067200000  # 2024-01-01 00:00:00 UTC
H = 3600 * 1000


def test_first_log_per_device_day_keeps_earliest_and_breaks_ties(spark):
    logs = spark.createDataFrame([
        ("m1", "u2", "startup", D1 + 5 * H, 1),
        ("m1", "u1", "startup", D1 + 2 * H, 2),
        ("m1", "u9", "startup", D1 + 2 * H, 3),       # tie on ts: smaller uid wins
        ("m1", "u1", "startup", D1 + 24 * H - 1, 4),  # 23:59:59.999 same day
        ("m1", "u1", "startup", D1 + 24 * H, 5),      # 00:00:00 next day
        ("m2", "u3", "startup", D1 + 1 * H, 6),
    ], LOG)
    got = rows(dau.dau_first(logs), "mid", "logDate", "logHour", "log_id")
    assert got == [("m1", "2024-01-01", "02", 2), ("m1", "2024-01-02", "00", 5), ("m2", "2024-01-01", "01", 6)]


def test_incremental_compares_with_the_logs_own_day(spark):
    seen = spark.createDataFrame([("m1", "2024-01-02")], "mid string, logDate string")
    batch = spark.createDataFrame([
        ("m1", "u1", "startup", D1 + 23 * H, 1),   # yesterday's log arriving today: new for 01-01
        ("m1", "u1", "startup", D1 + 30 * H, 2),   # already seen on 01-02
        ("m3", "u1", "startup", D1 + 30 * H, 3),
    ], LOG)
    got = rows(dau.dau_incremental(batch, seen), "mid", "logDate")
    assert got == [("m1", "2024-01-01"), ("m3", "2024-01-02")]


def test_replayed_batch_gives_the_same_rows(spark):
    batch = spark.createDataFrame([("m1", "u1", "startup", D1, 1), ("m1", "u1", "startup", D1 + H, 2)], LOG)
    empty = spark.createDataFrame([], "mid string, logDate string")
    assert rows(dau.dau_incremental(batch, empty)) == rows(dau.dau_incremental(batch, empty))


def test_dau_total_single_date_is_zero_when_empty(spark):
    d = dau.dau_first(spark.createDataFrame([("m1", "u1", "startup", D1, 1)], LOG))
    assert rows(dau.dau_total(d, "2024-01-01")) == [("2024-01-01", 1)]
    assert rows(dau.dau_total(d, "2030-01-01")) == [("2030-01-01", 0)]


def test_hours_compare_fills_the_24_hour_spine(spark):
    hourly = spark.createDataFrame([("2024-01-02", "05", 3), ("2024-01-01", "05", 7), ("2024-01-01", "23", 1)],
                                   "logDate string, logHour string, dau long")
    out = dau.hours_compare(hourly, "dau", "logDate", "logHour", zero=0, date="2024-01-02")
    got = {r.hour: (r.today, r.yesterday) for r in out.collect()}
    assert len(got) == 24
    assert got["05"] == (3, 7) and got["23"] == (0, 1) and got["00"] == (0, 0)


def test_hours_compare_of_a_date_without_rows(spark):
    hourly = spark.createDataFrame([("2024-01-01", "05", 7), ("2024-01-01", "23", 1)],
                                   "logDate string, logHour string, dau long")
    after = {r.hour: (r.logDate, r.today, r.yesterday) for r in
             dau.hours_compare(hourly, "dau", "logDate", "logHour", zero=0, date="2024-01-02").collect()}
    assert len(after) == 24 and after["05"] == ("2024-01-02", 0, 7) and after["00"] == ("2024-01-02", 0, 0)
    empty = dau.hours_compare(hourly, "dau", "logDate", "logHour", zero=0, date="2031-01-01").collect()
    assert len(empty) == 24 and all((r.today, r.yesterday) == (0, 0) for r in empty)


def test_daily_devices_agree_with_the_separate_counts(spark):
    logs = spark.createDataFrame([("m1", "u", "s", D1, 1), ("m1", "u", "s", D1 + 24 * H, 2), ("m1", "u", "s", D1 + H, 2),
                                  ("m2", "u", "s", D1 + 24 * H, 3)], LOG)
    first = dau.dau_first(logs)
    assert rows(dau.daily_devices(first)) == [("2024-01-01", 1, 1), ("2024-01-02", 2, 1)]


def test_new_devices_counts_first_ever_day(spark):
    logs = spark.createDataFrame([("m1", "u", "s", D1, 1), ("m1", "u", "s", D1 + 24 * H, 2),
                                  ("m2", "u", "s", D1 + 24 * H, 3)], LOG)
    assert rows(dau.new_devices(dau.dau_first(logs))) == [("2024-01-01", 1), ("2024-01-02", 1)]


ORD = "id long, user_id long, total_amount double, create_time string, consignee_tel string"


def test_gmv_sums_exact_cents_ignores_null_and_is_null_for_a_date_without_orders(spark):
    o = gmv.prepare_orders(spark.createDataFrame([
        (1, 1, 0.1, "2024-01-01 00:10:00", "13800000000"),
        (2, 1, 0.2, "2024-01-01 00:20:00", None),
        (3, 2, None, "2024-01-01 13:00:00", "1"),
    ], ORD))
    assert rows(gmv.gmv_total(o)) == [("2024-01-01", 0.3)]
    assert rows(gmv.gmv_total(o, "2024-01-05")) == [("2024-01-05", None)]
    assert rows(gmv.gmv_hours(o)) == [("2024-01-01", "00", 0.3), ("2024-01-01", "13", None)]
    assert sorted(rows(o, "consignee_tel"), key=str) == sorted([(None,), ("1*******",), ("1380*******",)], key=str)


def test_kpi_list_has_three_entries_per_date(spark):
    d = spark.createDataFrame([("2024-01-01", 5)], "logDate string, dau long")
    n = spark.createDataFrame([("2024-01-01", 2)], "logDate string, new_devices long")
    g = spark.createDataFrame([("2024-01-02", 9.5)], "create_date string, sum_amount double")
    got = rows(kpi.kpi_total(d, n, g), "date", "id", "value")
    assert got == [("2024-01-01", "dau", 5.0), ("2024-01-01", "new_mid", 2.0), ("2024-01-01", "order_amount", None),
                   ("2024-01-02", "dau", 0.0), ("2024-01-02", "new_mid", 0.0), ("2024-01-02", "order_amount", 9.5)]


def test_hour_map_per_date(spark):
    hourly = spark.createDataFrame([("2024-01-01", "05", 3), ("2024-01-01", "00", 7), ("2024-01-02", "23", 1)],
                                   "logDate string, logHour string, dau long")
    got = {r.logDate: r.hours for r in dau.hour_map(hourly, "dau", "logDate", "logHour").collect()}
    assert got == {"2024-01-01": {"00": 7, "05": 3}, "2024-01-02": {"23": 1}}


def test_upper_case_columns(spark):
    from martlens.streaming.sinks import upper_case_columns
    assert upper_case_columns(spark.createDataFrame([(1, 2)], "mid long, logDate long")).columns == ["MID", "LOGDATE"]
