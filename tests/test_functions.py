import datetime as dt

from pyspark.sql import functions as F

from martlens.functions import (age_in_years, half_up_share, mask_phone, match_all, match_any,
                                remainder_share, search_tokens, with_create_date_hour, with_log_date_hour)
from martlens.functions.time import epoch_ms, from_epoch_ms


def test_mask_phone_null_short_and_normal(spark):
    df = spark.createDataFrame([("13812345678",), ("12",), (None,)], "tel string")
    got = [r[0] for r in df.select(mask_phone("tel")).collect()]
    assert got == ["1381*******", "12*******", None]


def test_create_date_hour_splits_string(spark):
    df = spark.createDataFrame([("2020-08-18 00:05:01",), ("2020-08-18 23:59:59",), ("2020-08-18",), (None,)],
                               "create_time string")
    got = with_create_date_hour(df).select("create_date", "create_hour").collect()
    assert [tuple(r) for r in got] == [("2020-08-18", "00"), ("2020-08-18", "23"), ("2020-08-18", None), (None, None)]


def test_log_date_hour_midnight_edges_and_zone(spark):
    # 2024-01-01 23:59:59.999 UTC and 2024-01-02 00:00:00 UTC
    df = spark.createDataFrame([(1704153599999,), (1704153600000,)], "ts long")
    got = [tuple(r) for r in with_log_date_hour(df).select("logDate", "logHour").collect()]
    assert got == [("2024-01-01", "23"), ("2024-01-02", "00")]
    shanghai = [tuple(r) for r in with_log_date_hour(df, tz="Asia/Shanghai").select("logDate", "logHour").collect()]
    assert shanghai == [("2024-01-02", "07"), ("2024-01-02", "08")]


def test_epoch_ms_round_trip(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12, 0, 0, 123456),)], "t timestamp_ntz")
    r = df.select(epoch_ms("t").alias("ms")).select("ms", from_epoch_ms("ms").alias("back")).first()
    assert r.ms == 1719835200123
    assert r.back == dt.datetime(2024, 7, 1, 12, 0, 0, 123000)


def test_age_is_whole_365_day_periods(spark):
    df = spark.createDataFrame([("2023-02-01",), ("2023-02-02",), (None,), ("2004-02-01",), ("not a date",)], "b string")
    got = [r[0] for r in df.select(age_in_years("b", "2024-02-01")).collect()]
    # 365 days -> 1, 364 days -> 0, null -> null, 20 years incl. 5 leap days -> 20, garbage -> null
    assert got == [1, 0, None, 20, None]


def test_shares_round_half_up_and_zero_total(spark):
    df = spark.createDataFrame([(1, 3), (1, 8), (0, 0), (2, 3)], "p long, n long")
    out = df.select(half_up_share(F.col("p"), F.col("n")).alias("s")).select("s", remainder_share(F.col("s")).alias("r"))
    assert [tuple(r) for r in out.collect()] == [(33.3, 66.7), (12.5, 87.5), (0.0, 100.0), (66.7, 33.3)]


def test_tokens_cjk_and_words(spark):
    df = spark.createDataFrame([("Small RING 手机壳",)], "s string")
    assert df.select(search_tokens("s")).first()[0] == ["small", "ring", "手", "机", "壳"]


def test_match_all_vs_any_and_empty_keyword(spark):
    df = spark.createDataFrame([("small ring",), ("small bolt",), ("red gear",), ("小米手机",)], "s string")

    def hits(pred):
        return sorted(r[0] for r in df.filter(pred).collect())

    assert hits(match_all("s", "small ring")) == ["small ring"]
    assert hits(match_any("s", "small ring")) == ["small bolt", "small ring"]
    assert hits(match_all("s", "手机")) == ["小米手机"]
    assert hits(match_all("s", "")) == sorted(["small ring", "small bolt", "red gear", "小米手机"])
    assert hits(match_all("s", "blue")) == []
