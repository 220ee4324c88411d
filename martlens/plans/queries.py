"""One query per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole tables; parameters (keyword, page, window length,
reference date) are the serving request's, not row caps. Column names match
``martlens.plans.oracle.ORACLE_SQL``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions.text import mask_phone
from martlens.functions.time import epoch_ms, with_create_date_hour, with_log_date_hour
from martlens.operators import (
    alert_islands,
    alerts,
    dau,
    deltas,
    device_sets,
    first_seen,
    gmv,
    kpi,
    live_users,
    sale_detail,
    search,
    term_index,
    upsert,
    users,
)
from martlens.operators.keyed import last_per_key
from martlens.plans import pages
from martlens.session import scratch_folder
from martlens.sources import cdc, logs, tables

# Request parameters of the registered queries.
AS_OF = "2024-02-01"          # reference date for user ages
KEYWORD_ALL = "small ring"    # AND search
KEYWORD_ANY = "blue gear"     # OR search
PAGE_NO, PAGE_SIZE = 2, 20
SEARCH_DATE = "1996-03-13"    # date term of the one-date search
TOP_TERMS = 5                 # buckets of the top-N terms request
DATE, EMPTY_DATE = "2024-01-15", "2031-05-05"   # one-date requests: a day with data and one without
ORDER_DATE = "1996-03-13"
ALERT_WINDOW, ALERT_SLIDE = "6 hours", "1 hour"
MATCH_BOUND = "365 days"      # unmatched_lines
INTERVAL_LOWER, INTERVAL_UPPER = "-30 days", "30 days"
BATCH_SPLIT_HOUR = "12"       # dau_incremental: morning batch is stored, afternoon batch arrives
DELTA_SPLIT = "1995-01-01"    # gmv_delta: orders from before arrive first, amendments of later ones with them
RANGE_DAYS = (7, 30)          # active_devices_range
ISLAND_WINDOW, ISLAND_SLIDE = "3 hours", "5 seconds"
UPSERT_SPLIT = "1998-01-01"   # upsert_latest: lines shipped before are stored, later ones arrive

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tables.read_table(spark, sf, name)


def _startup(spark, sf):
    return with_log_date_hour(tables.startup_logs(_t(spark, sf, "events")))


def _dau(spark, sf):
    return dau.dau_first(_startup(spark, sf))


def _orders(spark, sf):
    return gmv.prepare_orders(tables.order_info(_t(spark, sf, "orders")))


def _purchase_orders(spark, sf):
    """Purchases of the event table as timed orders (the order table has dates only)."""
    ev = _t(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return with_create_date_hour(ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("user_id"),
        F.col("value").alias("total_amount"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("create_time")))


def _sale_detail(spark, sf):
    return sale_detail.sale_detail(
        tables.order_info(_t(spark, sf, "orders")),
        tables.order_detail(_t(spark, sf, "lineitem"), _t(spark, sf, "part")),
        tables.user_info(_t(spark, sf, "customer")), AS_OF)


def parse_props(spark, sf):
    return tables.props_key(_t(spark, sf, "events")).select("event_id", "k")


def log_date_hour(spark, sf):
    return _startup(spark, sf).select("log_id", "ts", "logDate", "logHour")


def order_date_hour(spark, sf):
    return with_create_date_hour(tables.order_info(_t(spark, sf, "orders"))) \
        .select("id", "create_time", "create_date", "create_hour")


def mask_phone_q(spark, sf):
    return tables.order_info(_t(spark, sf, "orders")).select("id", mask_phone("consignee_tel").alias("consignee_tel"))


def cdc_route(spark, sf):
    changes = cdc.change_log(_t(spark, sf, "orders"), _t(spark, sf, "lineitem"),
                             _t(spark, sf, "customer"), _t(spark, sf, "part"))
    return cdc.route_changes(changes).select("table_name", "op", "key", "topic", "value")


def log_route(spark, sf):
    return logs.ingest_events_table(_t(spark, sf, "events")).drop("value")


def dau_first(spark, sf):
    return _dau(spark, sf)


def dau_total(spark, sf):
    return dau.dau_total(_dau(spark, sf))


def dau_hours(spark, sf):
    return dau.dau_hours(_dau(spark, sf))


def dau_incremental(spark, sf):
    s = _startup(spark, sf)
    stored = dau.dau_first(s.filter(F.col("logHour") < BATCH_SPLIT_HOUR))
    arriving = s.filter(F.col("logHour") >= BATCH_SPLIT_HOUR)
    return dau.dau_incremental(arriving, stored)


def dau_hours_compare(spark, sf):
    return dau.hours_compare(dau.dau_hours(_dau(spark, sf)), "dau", "logDate", "logHour", zero=0)


def new_devices(spark, sf):
    return dau.new_devices(_dau(spark, sf))


def gmv_total(spark, sf):
    return gmv.gmv_total(_orders(spark, sf))


def gmv_hours(spark, sf):
    return gmv.gmv_hours(_purchase_orders(spark, sf))


def gmv_hours_compare(spark, sf):
    hourly = gmv.gmv_hours(_purchase_orders(spark, sf))
    return dau.hours_compare(hourly, "sum_amount", "create_date", "create_hour", zero=0.0)


def sales_by_province(spark, sf):
    provinces = _t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"),
                                                F.col("c_nationkey").cast("string").alias("province_id"))
    return gmv.sales_by_province(_orders(spark, sf), provinces)


def sale_detail_q(spark, sf):
    return _sale_detail(spark, sf)


def full_outer(spark, sf):
    rows = sale_detail.join_orders_lines(
        tables.order_info(_t(spark, sf, "orders")),
        tables.order_detail(_t(spark, sf, "lineitem")), "full_outer")
    return rows.select("order_id", "order_detail_id", "dt", "sku_id")


def interval_join(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    l = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                                         "l_partkey", "l_suppkey", "l_shipdate")
    return sale_detail.interval_join(o, l, "o_orderkey", "o_orderdate", "l_shipdate",
                                     INTERVAL_LOWER, INTERVAL_UPPER)


def user_latest(spark, sf):
    ev = _t(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return users.latest_version(ev, "user_id", ("ts", "event_id"))


def user_enrich(spark, sf):
    o = tables.order_info(_t(spark, sf, "orders")).select(F.col("id").alias("order_id"), "user_id")
    return sale_detail.enrich_users(o, tables.user_info(_t(spark, sf, "customer")), AS_OF)


def scalar_lookup(spark, sf):
    return users.scalar_per_key(_t(spark, sf, "customer"), "c_custkey",
                                _t(spark, sf, "orders"), "o_custkey", "o_orderkey")


def exists_semi(spark, sf):
    return users.exists_in(_t(spark, sf, "customer").select("c_custkey"), "c_custkey",
                           _t(spark, sf, "orders"), "o_custkey")


def upsert_latest(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("doc_id"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    split = F.to_timestamp_ntz(F.lit(UPSERT_SPLIT))
    stored = li.filter(F.col("l_shipdate") < split).withColumn("batch", F.lit(1))
    arriving = li.filter(F.col("l_shipdate") >= split).withColumn("batch", F.lit(2))
    return upsert.upsert_latest(stored, arriving, "doc_id",
                                ("batch", "l_shipdate", "l_partkey", "l_suppkey"))


def _hits(spark, sf, keyword=KEYWORD_ALL, operator="and", date=None, with_users=True):
    return search.sale_hits(
        tables.order_info(_t(spark, sf, "orders")),
        tables.order_detail(_t(spark, sf, "lineitem"), _t(spark, sf, "part")),
        tables.user_info(_t(spark, sf, "customer")) if with_users else None, AS_OF, keyword, operator, date)


def sale_search_total(spark, sf):
    return search.total(_hits(spark, sf, with_users=False))


def sale_search_hits(spark, sf):
    return _hits(spark, sf)


def sale_search_date(spark, sf):
    return _hits(spark, sf, KEYWORD_ANY, "or", SEARCH_DATE)


def sale_search_page(spark, sf):
    return search.page(_hits(spark, sf), PAGE_NO, PAGE_SIZE, ["dt", "doc_id"])


def sale_search_response(spark, sf):
    """The endpoint's answer for one date as one row: total, page and pies."""
    parts = search.sale_detail_response(
        _hits(spark, sf, KEYWORD_ANY, "or", SEARCH_DATE), None, 1, PAGE_SIZE, None)
    detail = parts["detail"].agg(F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("detail"))
    return parts["stat"].withColumn("detail", detail.scalar())


def match_any(spark, sf):
    return _hits(spark, sf, KEYWORD_ANY, "or", with_users=False).select("doc_id", "sku_name")


def sale_by_age(spark, sf):
    return search.terms(_hits(spark, sf), "user_age")


def sale_by_gender(spark, sf):
    return search.terms(_hits(spark, sf), "user_gender")


def sale_top_ages(spark, sf):
    return search.top_terms(_hits(spark, sf), "user_age", TOP_TERMS)


def gender_ratio(spark, sf):
    return search.gender_ratio(_hits(spark, sf))


def age_ratio(spark, sf):
    return search.age_ratio(_hits(spark, sf))


def max_metric(spark, sf):
    return search.max_metric(_hits(spark, sf, KEYWORD_ANY, "or"), "user_age", "max_age")


def sale_stat_json(spark, sf):
    return search.stat_json(_hits(spark, sf))


def kpi_total(spark, sf):
    return kpi.kpi_total(dau.daily_devices(_startup(spark, sf)), None, gmv.gmv_total(_orders(spark, sf)))


def kpi_for_date(spark, sf):
    return kpi.kpi_for_dates(_startup(spark, sf), _orders(spark, sf), [DATE, EMPTY_DATE, ORDER_DATE])


def dau_total_date(spark, sf):
    d = _dau(spark, sf)
    return dau.dau_total(d, DATE).unionByName(dau.dau_total(d, EMPTY_DATE))


def gmv_total_date(spark, sf):
    o = _orders(spark, sf)
    return gmv.gmv_total(o, ORDER_DATE).unionByName(gmv.gmv_total(o, EMPTY_DATE))


def dau_hour_map(spark, sf):
    """The hourly endpoint's map for one date, as its JSON."""
    hours = dau.dau_hours(_dau(spark, sf), DATE)
    return dau.hour_map(hours, "dau", "logDate", "logHour").select("logDate", F.to_json("hours").alias("hours"))


def _day_after(hourly, date_col):
    """The day after the last one with data (one row to the driver)."""
    last = hourly.agg(F.date_format(F.date_add(F.max(F.to_date(date_col)), 1), "yyyy-MM-dd").alias("d")).first()["d"]
    return last or EMPTY_DATE


def dau_hours_compare_date(spark, sf):
    hourly = dau.dau_hours(_dau(spark, sf))
    return dau.hours_compare(hourly, "dau", "logDate", "logHour", zero=0, date=_day_after(hourly, "logDate"))


def gmv_hours_compare_date(spark, sf):
    hourly = gmv.gmv_hours(_purchase_orders(spark, sf))
    return dau.hours_compare(hourly, "sum_amount", "create_date", "create_hour", zero=0.0,
                             date=_day_after(hourly, "create_date"))


def log_route_full(spark, sf):
    return logs.ingest_events_table(_t(spark, sf, "events")).select("log_id", "topic", "value")


def log_route_rough(spark, sf):
    """Lines with repeated keys, long numbers and times of their own."""
    rows = logs.ingest_events_table(_t(spark, sf, "events"), logs.rough_log_lines)
    return rows.select("log_id", "topic", "mid", "value")


def gmv_upsert_total(spark, sf):
    """Orders of which the finished ones were delivered twice."""
    o = _orders(spark, sf)
    delivered = o.unionByName(o.filter(F.col("order_status") == "F"))
    return gmv.gmv_total(last_per_key(delivered, ["id"], ["create_time"]))


def _order_versions(spark, sf):
    """First and amended versions of orders: when a finished order is settled,
    its amount becomes that of its lines and its time that of its first shipment."""
    columns = ["id", "version", "total_amount", "create_time"]
    o = tables.order_info(_t(spark, sf, "orders"))
    shipped = _t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total_amount"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    first = o.withColumn("version", F.lit(1))
    finished = first.filter(F.col("order_status") == "F")
    amended = finished.select("id").join(shipped, "id").withColumn("version", F.lit(2))
    return first.select(*columns), finished.select(*columns), amended.select(*columns)


def gmv_delta(spark, sf):
    """Totals kept by deltas over three batches: half of the amendments come
    before the orders they amend, and finished orders are redelivered late."""
    first, finished, amended = _order_versions(spark, sf)
    early, late = F.col("create_time") < DELTA_SPLIT, F.col("create_time") >= DELTA_SPLIT
    batches = [first.filter(early).unionByName(amended.filter(late)),
               first.filter(late).unionByName(amended.filter(early)), finished]
    return deltas.totals_of_batches([with_create_date_hour(b) for b in batches], "id", ["version"], ["create_date"])


def active_devices_range(spark, sf):
    days = _startup(spark, sf).select("mid", "logDate").distinct()
    sets = device_sets.daily_sets(days, device_sets.number_devices(days))
    return device_sets.trailing_active_devices(sets, RANGE_DAYS)


def new_devices_incremental(spark, sf):
    """Three batches in which later hours arrive first, so that first days move back."""
    s = _startup(spark, sf).select("mid", "logDate", "logHour")
    hour = F.col("logHour")
    return first_seen.new_devices_of_batches(
        [s.filter(hour >= "16"), s.filter((hour >= "08") & (hour < "16")), s.filter(hour < "08")])


def coupon_alert_islands(spark, sf):
    return alert_islands.alert_episodes(tables.event_logs(_t(spark, sf, "events")), ISLAND_WINDOW, ISLAND_SLIDE)


def user_live_intervals(spark, sf):
    """Sign-ups and purchases update a user's record, views look it up."""
    ev = _t(spark, sf, "events").select(F.col("user_id").alias("id"), epoch_ms("ts").alias("ts"), "event_type")
    update = F.col("event_type").isin("signup", "purchase")
    return live_users.live_intervals(live_users.touches(ev.filter(update), ev.filter(F.col("event_type") == "view")))


def search_by_terms(spark, sf):
    """The AND and the OR request, from the term rows of all documents."""
    docs = _hits(spark, sf, None, with_users=False).select("doc_id", "sku_name")
    terms = term_index.term_rows(docs)
    both = term_index.having_all(terms, KEYWORD_ALL).withColumn("operator", F.lit("and"))
    return both.unionByName(term_index.having_any(terms, KEYWORD_ANY).withColumn("operator", F.lit("or")))


def sale_page_deep(spark, sf):
    """The last page of all documents, from a stored result and its directory."""
    order = ["dt", "doc_id"]
    path = scratch_folder(spark, "pages")
    docs = _hits(spark, sf, None, with_users=False).select("doc_id", "dt", "order_detail_id", "sku_id")
    pages.write_pages(docs.distinct(), path, order, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stored = pages.Pages(spark, path, order)
    return stored.page(stored.last_page(PAGE_SIZE), PAGE_SIZE)


def sale_facets(spark, sf):
    return search.facets(_hits(spark, sf))


def unmatched_lines(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    l = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey",
                                         "l_suppkey", "l_shipdate")
    return sale_detail.unmatched_lines(l, o, "o_orderkey", "l_shipdate", "o_orderdate", MATCH_BOUND)


def _alerts(spark, sf):
    return alerts.coupon_alerts(tables.event_logs(_t(spark, sf, "events")), ALERT_WINDOW, ALERT_SLIDE)


def coupon_alert(spark, sf):
    return alerts.flatten_alerts(_alerts(spark, sf))


def coupon_alert_minute(spark, sf):
    return alerts.flatten_alerts(alerts.alerts_per_minute(_alerts(spark, sf)))


QUERIES: dict[str, Query] = {
    "parse_props": parse_props,
    "log_date_hour": log_date_hour,
    "order_date_hour": order_date_hour,
    "mask_phone": mask_phone_q,
    "cdc_route": cdc_route,
    "log_route": log_route,
    "dau_first": dau_first,
    "dau_total": dau_total,
    "dau_hours": dau_hours,
    "dau_incremental": dau_incremental,
    "dau_hours_compare": dau_hours_compare,
    "new_devices": new_devices,
    "gmv_total": gmv_total,
    "gmv_hours": gmv_hours,
    "gmv_hours_compare": gmv_hours_compare,
    "sales_by_province": sales_by_province,
    "sale_detail": sale_detail_q,
    "full_outer": full_outer,
    "interval_join": interval_join,
    "user_latest": user_latest,
    "user_enrich": user_enrich,
    "scalar_lookup": scalar_lookup,
    "exists_semi": exists_semi,
    "upsert_latest": upsert_latest,
    "sale_search_total": sale_search_total,
    "sale_search_hits": sale_search_hits,
    "sale_search_page": sale_search_page,
    "match_any": match_any,
    "sale_by_age": sale_by_age,
    "sale_by_gender": sale_by_gender,
    "gender_ratio": gender_ratio,
    "age_ratio": age_ratio,
    "max_metric": max_metric,
    "kpi_total": kpi_total,
    "coupon_alert": coupon_alert,
    "coupon_alert_minute": coupon_alert_minute,
    "sale_stat_json": sale_stat_json,
    "sale_search_date": sale_search_date,
    "sale_search_response": sale_search_response,
    "sale_top_ages": sale_top_ages,
    "kpi_for_date": kpi_for_date,
    "dau_total_date": dau_total_date,
    "gmv_total_date": gmv_total_date,
    "dau_hour_map": dau_hour_map,
    "dau_hours_compare_date": dau_hours_compare_date,
    "gmv_hours_compare_date": gmv_hours_compare_date,
    "log_route_full": log_route_full,
    "gmv_upsert_total": gmv_upsert_total,
    "log_route_rough": log_route_rough,
    "gmv_delta": gmv_delta,
    "active_devices_range": active_devices_range,
    "new_devices_incremental": new_devices_incremental,
    "coupon_alert_islands": coupon_alert_islands,
    "user_live_intervals": user_live_intervals,
    "search_by_terms": search_by_terms,
    "sale_page_deep": sale_page_deep,
    "sale_facets": sale_facets,
    "unmatched_lines": unmatched_lines,
}
