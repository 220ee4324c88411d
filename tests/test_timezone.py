"""Results must not depend on the session time zone (the tables are NTZ)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL, rows

NAMES = ["log_date_hour", "dau_first", "gmv_hours", "coupon_alert", "log_route", "interval_join", "cdc_route"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_in_another_session_zone(spark, name):
    q = entry.queries()[name]
    utc = rows(q(spark, SF_SMALL))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = rows(q(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert other == utc


def test_checkpoint_dir_is_set_once_and_reused(spark):
    from martlens.session import checkpoint_dir
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    first = checkpoint_dir(spark)
    assert first == (configured or spark.sparkContext.getCheckpointDir())
    assert checkpoint_dir(spark) == first
