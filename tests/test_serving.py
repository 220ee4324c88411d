"""Date-filtered serving queries on stored tables prune partitions and agree
with the queries over the raw tables."""

from conftest import SF_SMALL, rows
from martlens.operators import dau, search
from martlens.plans import queries as q
from martlens.plans import serving


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_search_on_index_prunes_by_date(spark, tmp_path):
    path = str(tmp_path / "sale_index")
    serving.build_sale_index(spark, SF_SMALL, path)
    index = serving.open_table(spark, path, ["dt"])
    day = index.groupBy("dt").count().orderBy("count", ascending=False).first().dt
    hits = search.search(index, "small", day, operator="or")
    assert "PartitionFilters: [isnotnull(dt" in _plan(hits)
    raw = search.search(q.sale_detail_q(spark, SF_SMALL), "small", day, operator="or")
    assert rows(hits, "doc_id") == rows(raw, "doc_id")
    assert rows(search.gender_ratio(hits)) == rows(search.gender_ratio(raw))


def test_dau_on_stored_table_prunes_by_date(spark, tmp_path):
    path = str(tmp_path / "dau")
    serving.build_dau_table(spark, SF_SMALL, path)
    stored = serving.open_table(spark, path, ["logDate"])
    one_day = dau.dau_hours(stored, "2024-01-05")
    assert "PartitionFilters: [isnotnull(logDate" in _plan(one_day)
    want = [r for r in rows(q.dau_hours(spark, SF_SMALL)) if r[0] == "2024-01-05"]
    assert rows(one_day) == want


def test_bucketed_tables_join_without_exchange(spark):
    from pyspark.sql import functions as F
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_custkey")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(F.col("l_orderkey").alias("k"), "l_partkey")
    serving.write_bucketed(orders, "orders_b", "k", 8)
    serving.write_bucketed(lines, "lines_b", "k", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("orders_b").join(spark.table("lines_b"), "k")
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == orders.join(lines, "k").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
