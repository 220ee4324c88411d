"""DuckDB SQL oracles, one per registered query (same column names).

Written from the table definitions and the operator rules, independently of
the Spark code: the views ``events orders lineitem customer part ...`` are
the raw tables.
"""

from __future__ import annotations

from martlens.plans import queries as q

_AS_OF = q.AS_OF
_SPLIT_HOUR = q.BATCH_SPLIT_HOUR

STARTUP = """startup AS (
  SELECT user_id AS mid, user_id AS uid, 'startup' AS type,
         (epoch_us(ts) // 1000) AS ts, event_id AS log_id,
         strftime(ts, '%Y-%m-%d') AS logDate, strftime(ts, '%H') AS logHour
  FROM events)"""

DAU = """dau AS (
  SELECT mid, uid, type, ts, log_id, logDate, logHour FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, logDate
                                 ORDER BY ts, uid, type, log_id, logHour) AS rn
    FROM startup) WHERE rn = 1)"""

ORDER_INFO = """oi AS (
  SELECT o_orderkey AS id, o_custkey AS user_id,
         o_orderstatus AS order_status, o_totalprice AS total_amount,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         '1' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS consignee_tel,
         o_custkey
  FROM orders)"""

LINES = """lines AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d')) AS id,
         l_orderkey AS order_id, p_name AS sku_name,
         l_partkey AS sku_id, printf('%.2f', l_extendedprice) AS order_price
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)"""

USERS = """users AS (
  SELECT c_custkey AS id, c_mktsegment AS user_level,
         strftime(DATE '1960-01-01' + CAST((c_custkey * 7919) % 18262 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 1 THEN 'M' ELSE 'F' END AS gender
  FROM customer)"""

AGE = f"CAST(trunc(date_diff('day', CAST(u.birthday AS DATE), DATE '{_AS_OF}') / 365.0) AS INTEGER)"

SALE = f"""sale AS (
  SELECT CAST(o.id AS VARCHAR) || '_' || l.id AS doc_id, l.id AS order_detail_id, o.id AS order_id, o.order_status,
         o.create_time, o.user_id, l.sku_id, u.gender AS user_gender,
         COALESCE({AGE}, 0) AS user_age, u.user_level,
         CAST(l.order_price AS DOUBLE) AS sku_price, l.sku_name,
         split_part(o.create_time, ' ', 1) AS dt
  FROM oi o JOIN lines l ON l.order_id = o.id LEFT JOIN users u ON u.id = o.user_id)"""


def _words(kw: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in kw.lower().split()) + "]"


HITS_ALL = f"""hits AS (SELECT * FROM sale
  WHERE list_has_all(string_split(lower(sku_name), ' '), {_words(q.KEYWORD_ALL)}))"""
HITS_ANY = f"""hits AS (SELECT * FROM sale
  WHERE list_has_any(string_split(lower(sku_name), ' '), {_words(q.KEYWORD_ANY)}))"""

SALE_CTES = ",\n".join([ORDER_INFO, LINES, USERS, SALE])


def _share(part: str, total: str) -> str:
    return (f"CASE WHEN {total} = 0 THEN 0.0::DOUBLE ELSE "
            f"floor(CAST({part} AS DOUBLE) * 1000.0::DOUBLE / CAST({total} AS DOUBLE) + 0.5::DOUBLE) / 10.0::DOUBLE END")


def _rest(*shares: str) -> str:
    return f"floor((100.0::DOUBLE - {' - '.join(shares)}) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE"


SHARES = f"""c AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE user_gender = 'M') AS m,
         count(*) FILTER (WHERE user_age < 20) AS lo, count(*) FILTER (WHERE user_age >= 30) AS hi
  FROM hits),
s1 AS (SELECT n, {_share('m', 'n')} AS male_ratio, {_share('lo', 'n')} AS lt20_ratio,
              {_share('hi', 'n')} AS ge30_ratio FROM c),
s AS (SELECT *, {_rest('male_ratio')} AS female_ratio,
             {_rest('lt20_ratio', 'ge30_ratio')} AS "20to30_ratio" FROM s1)"""

_STAT = """'[{"title":"用户年龄占比","options":[{"name":"20岁以下","value":' || CAST(lt20_ratio AS VARCHAR)
  || '},{"name":"20岁到30岁","value":' || CAST("20to30_ratio" AS VARCHAR)
  || '},{"name":"30岁及30岁以上","value":' || CAST(ge30_ratio AS VARCHAR)
  || '}]},{"title":"用户性别占比","options":[{"name":"男","value":' || CAST(male_ratio AS VARCHAR)
  || '},{"name":"女","value":' || CAST(female_ratio AS VARCHAR) || '}]}]'"""

_MONEY = "CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"

PURCHASES = """p AS (
  SELECT event_id AS id, value AS total_amount,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time FROM events WHERE event_type = 'purchase'),
ph AS (
  SELECT split_part(create_time, ' ', 1) AS create_date,
         split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour,
         CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount
  FROM p GROUP BY 1, 2)"""


def _compare(h: str, date_col: str, zero: str) -> str:
    return f"""dates AS (SELECT DISTINCT d FROM {h}),
spine AS (SELECT d, lpad(CAST(x AS VARCHAR), 2, '0') AS hour FROM (SELECT d, unnest(range(0, 24)) AS x FROM dates))
SELECT s.d AS {date_col}, s.hour, COALESCE(t.v, {zero}) AS today, COALESCE(y.v, {zero}) AS yesterday
FROM spine s
LEFT JOIN {h} t ON t.d = s.d AND t.hour = s.hour
LEFT JOIN {h} y ON y.d = strftime(CAST(s.d AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AND y.hour = s.hour"""


def _compare_after(h: str, date_col: str, zero: str) -> str:
    """The day after the last one with data."""
    return f"""day AS (SELECT strftime(CAST(max(d) AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS d, max(d) AS before FROM {h}),
spine AS (SELECT d, before, lpad(CAST(x AS VARCHAR), 2, '0') AS hour FROM (SELECT d, before, unnest(range(0, 24)) AS x FROM day))
SELECT s.d AS {date_col}, s.hour, {zero} AS today, COALESCE(y.v, {zero}) AS yesterday
FROM spine s LEFT JOIN {h} y ON y.d = s.before AND y.hour = s.hour"""


_W_MS = 6 * 3600 * 1000
_S_MS = 3600 * 1000
_K = _W_MS // _S_MS

ALERTS = f"""ev AS (
  SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS mid,
         user_id AS uid,
         CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem' ELSE event_type END AS evid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS itemid,
         (epoch_us(ts) // 1000) AS ms
  FROM events),
win AS (SELECT mid, uid, evid, itemid, (ms // {_S_MS} - j) * {_S_MS} AS ws
        FROM (SELECT *, unnest(range(0, {_K})) AS j FROM ev)),
agg AS (SELECT mid, ws,
               list_sort(list(DISTINCT uid) FILTER (WHERE evid = 'coupon')) AS uids,
               list_sort(list(DISTINCT itemid) FILTER (WHERE evid = 'coupon')) AS items,
               count(*) FILTER (WHERE evid = 'clickItem') AS clicks
        FROM win GROUP BY mid, ws),
evc AS (SELECT mid, ws, string_agg(evid || ':' || CAST(n AS VARCHAR), ',' ORDER BY evid, n) AS events
        FROM (SELECT mid, ws, evid, count(*) AS n FROM win GROUP BY mid, ws, evid) GROUP BY mid, ws),
alerts AS (
  SELECT a.mid, make_timestamp(a.ws * 1000) AS window_start, make_timestamp((a.ws + {_W_MS}) * 1000) AS window_end,
         array_to_string(a.uids, ',') AS uids, array_to_string(a.items, ',') AS item_ids, e.events
  FROM agg a JOIN evc e ON e.mid = a.mid AND e.ws = a.ws
  WHERE len(a.uids) >= 3 AND a.clicks = 0)"""

_CDC_LINE_KEY = ("concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
                 "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d'))")

ORACLE_SQL: dict[str, str] = {
    "parse_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",

    "log_date_hour": f"WITH {STARTUP} SELECT log_id, ts, logDate, logHour FROM startup",

    "order_date_hour": f"""WITH {ORDER_INFO}
SELECT id, create_time, split_part(create_time, ' ', 1) AS create_date,
       split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour FROM oi""",

    "mask_phone": f"WITH {ORDER_INFO} SELECT id, substring(consignee_tel, 1, 4) || '*******' AS consignee_tel FROM oi",

    "cdc_route": f"""
SELECT 'order_info' AS table_name, 'INSERT' AS op, CAST(o_orderkey AS VARCHAR) AS key, 'TOPIC_ORDER_INFO' AS topic,
       CAST(json_object('id', CAST(o_orderkey AS VARCHAR), 'user_id', CAST(o_custkey AS VARCHAR),
                        'order_status', o_orderstatus, 'total_amount', printf('%.2f', o_totalprice),
                        'create_time', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS VARCHAR) AS value
FROM orders
UNION ALL
SELECT 'order_detail', 'INSERT', {_CDC_LINE_KEY}, 'TOPIC_ORDER_DETAIL',
       CAST(json_object('id', {_CDC_LINE_KEY}, 'order_id', CAST(l_orderkey AS VARCHAR),
                        'sku_id', CAST(l_partkey AS VARCHAR), 'order_price', printf('%.2f', l_extendedprice),
                        'sku_num', CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR)) AS VARCHAR)
FROM lineitem
UNION ALL
SELECT 'user_info', op, CAST(c_custkey AS VARCHAR), 'TOPIC_USER_INFO',
       CAST(json_object('id', CAST(c_custkey AS VARCHAR), 'login_name', c_name, 'user_level', c_mktsegment) AS VARCHAR)
FROM (SELECT *, 'INSERT' AS op FROM customer
      UNION ALL SELECT *, 'UPDATE' AS op FROM customer WHERE c_acctbal < 0)""",

    "log_route": """
SELECT event_id AS log_id,
       CASE WHEN event_type = 'signup' THEN 'TOPIC_START' ELSE 'TOPIC_EVENT' END AS topic,
       CASE WHEN event_type = 'signup' THEN 'startup' ELSE 'event' END AS type,
       CAST(user_id AS VARCHAR) AS mid, (epoch_us(ts) // 1000) AS ts
FROM events""",

    "dau_first": f"WITH {STARTUP}, {DAU} SELECT * FROM dau",

    "dau_total": f"WITH {STARTUP}, {DAU} SELECT logDate, count(*) AS dau FROM dau GROUP BY logDate",

    "dau_hours": f"WITH {STARTUP}, {DAU} SELECT logDate, logHour, count(*) AS dau FROM dau GROUP BY logDate, logHour",

    "dau_incremental": f"""WITH {STARTUP},
arriving AS (SELECT * FROM startup WHERE logHour >= '{_SPLIT_HOUR}'),
firsts AS (SELECT mid, uid, type, ts, log_id, logDate, logHour FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, logDate ORDER BY ts, uid, type, log_id, logHour) AS rn
    FROM arriving) WHERE rn = 1)
SELECT * FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM startup s
                  WHERE s.logHour < '{_SPLIT_HOUR}' AND s.mid = f.mid AND s.logDate = f.logDate)""",

    "dau_hours_compare": f"""WITH {STARTUP}, {DAU},
h AS (SELECT logDate AS d, logHour AS hour, count(*) AS v FROM dau GROUP BY 1, 2),
{_compare('h', 'logDate', '0')}""",

    "new_devices": f"""WITH {STARTUP}, {DAU}
SELECT logDate, count(*) AS new_devices FROM (SELECT mid, min(logDate) AS logDate FROM dau GROUP BY mid)
GROUP BY logDate""",

    "gmv_total": f"""WITH {ORDER_INFO}
SELECT split_part(create_time, ' ', 1) AS create_date, {_MONEY.format(c='total_amount')} AS sum_amount
FROM oi GROUP BY 1""",

    "gmv_hours": f"WITH {PURCHASES} SELECT create_date, create_hour, sum_amount FROM ph",

    "gmv_hours_compare": f"""WITH {PURCHASES},
h AS (SELECT create_date AS d, create_hour AS hour, sum_amount AS v FROM ph),
{_compare('h', 'create_date', '0.0::DOUBLE')}""",

    "sales_by_province": f"""WITH {ORDER_INFO}
SELECT CAST(c_nationkey AS VARCHAR) AS province_id, count(*) AS order_count,
       {_MONEY.format(c='total_amount')} AS sum_amount
FROM oi LEFT JOIN customer ON c_custkey = oi.o_custkey GROUP BY 1""",

    "sale_detail": f"WITH {SALE_CTES} SELECT * FROM sale",

    "full_outer": f"""WITH {ORDER_INFO}, {LINES}
SELECT COALESCE(o.id, l.order_id) AS order_id, l.id AS order_detail_id,
       split_part(o.create_time, ' ', 1) AS dt, l.sku_id
FROM oi o FULL OUTER JOIN lines l ON l.order_id = o.id""",

    "interval_join": """
SELECT o_orderkey, o_orderdate, o_custkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
 AND l_shipdate >= o_orderdate - INTERVAL 30 DAY AND l_shipdate <= o_orderdate + INTERVAL 30 DAY""",

    "user_latest": """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC) AS rn
  FROM events) WHERE rn = 1""",

    "user_enrich": f"""WITH {ORDER_INFO}, {USERS}
SELECT o.user_id, o.id AS order_id, u.gender AS user_gender, u.user_level, COALESCE({AGE}, 0) AS user_age
FROM oi o LEFT JOIN users u ON u.id = o.user_id""",

    "scalar_lookup": """
SELECT c_custkey, COALESCE(CAST(m AS BIGINT), 0) AS value
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS m FROM orders GROUP BY 1) ON o_custkey = c_custkey""",

    "exists_semi": "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",

    "upsert_latest": f"""WITH li AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS doc_id,
         l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         CASE WHEN l_shipdate < TIMESTAMP '{q.UPSERT_SPLIT}' THEN 1 ELSE 2 END AS batch
  FROM lineitem)
SELECT doc_id, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, batch FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY batch DESC, l_shipdate DESC, l_partkey DESC,
                                l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
  FROM li) WHERE rn = 1""",

    "sale_search_total": f"WITH {SALE_CTES}, {HITS_ALL} SELECT count(*) AS total FROM hits",

    "sale_search_hits": f"WITH {SALE_CTES}, {HITS_ALL} SELECT * FROM hits",

    "sale_search_page": f"""WITH {SALE_CTES}, {HITS_ALL}
SELECT * FROM hits ORDER BY dt, doc_id LIMIT {q.PAGE_SIZE} OFFSET {(q.PAGE_NO - 1) * q.PAGE_SIZE}""",

    "match_any": f"WITH {SALE_CTES}, {HITS_ANY} SELECT doc_id, sku_name FROM hits",

    "sale_by_age": f"""WITH {SALE_CTES}, {HITS_ALL}
SELECT user_age, count(*) AS doc_count FROM hits WHERE user_age IS NOT NULL GROUP BY 1""",

    "sale_by_gender": f"""WITH {SALE_CTES}, {HITS_ALL}
SELECT user_gender, count(*) AS doc_count FROM hits WHERE user_gender IS NOT NULL GROUP BY 1""",

    "gender_ratio": f"WITH {SALE_CTES}, {HITS_ALL}, {SHARES} SELECT male_ratio, female_ratio FROM s",

    "age_ratio": f'WITH {SALE_CTES}, {HITS_ALL}, {SHARES} SELECT lt20_ratio, "20to30_ratio", ge30_ratio FROM s',

    "max_metric": f"WITH {SALE_CTES}, {HITS_ANY} SELECT max(user_age) AS max_age FROM hits",

    "sale_stat_json": f"""WITH {SALE_CTES}, {HITS_ALL}, {SHARES}
SELECT n AS total,
  {_STAT} AS stat
FROM s""",

    "kpi_total": f"""WITH {STARTUP}, {DAU}, {ORDER_INFO},
dd AS (SELECT logDate AS date, count(*) AS v FROM dau GROUP BY 1),
nd AS (SELECT logDate AS date, count(*) AS v FROM (SELECT mid, min(logDate) AS logDate FROM dau GROUP BY mid) GROUP BY 1),
gd AS (SELECT split_part(create_time, ' ', 1) AS date, {_MONEY.format(c='total_amount')} AS v FROM oi GROUP BY 1),
dates AS (SELECT date FROM dd UNION SELECT date FROM nd UNION SELECT date FROM gd)
SELECT date, 'dau' AS id, '新增日活' AS name, CAST(COALESCE(v, 0) AS DOUBLE) AS value FROM dates LEFT JOIN dd USING (date)
UNION ALL SELECT date, 'new_mid', '新增设备', CAST(COALESCE(v, 0) AS DOUBLE) FROM dates LEFT JOIN nd USING (date)
UNION ALL SELECT date, 'order_amount', '新增交易额', CAST(v AS DOUBLE) FROM dates LEFT JOIN gd USING (date)""",

    "coupon_alert": f"WITH {ALERTS} SELECT * FROM alerts",

    "coupon_alert_minute": f"""WITH {ALERTS}
SELECT mid, window_start, window_end, uids, item_ids, events, doc_id FROM (
  SELECT *, CAST(mid AS VARCHAR) || '-' || CAST(epoch_ms(window_end) // 60000 AS VARCHAR) AS doc_id FROM alerts)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY window_end DESC, mid DESC, window_start DESC) = 1""",

    "sale_search_date": f"""WITH {SALE_CTES}, {HITS_ANY} SELECT * FROM hits WHERE dt = '{q.SEARCH_DATE}'""",

    "sale_search_response": f"""WITH {SALE_CTES}, {HITS_ANY},
all_hits AS (SELECT * FROM hits WHERE dt = '{q.SEARCH_DATE}'), {SHARES.replace('FROM hits)', 'FROM all_hits)')},
shown AS (SELECT doc_id FROM all_hits ORDER BY dt, doc_id LIMIT {q.PAGE_SIZE})
SELECT n AS total, {_STAT} AS stat,
       (SELECT coalesce(string_agg(doc_id, ',' ORDER BY doc_id), '') FROM shown) AS detail
FROM s""",

    "sale_top_ages": f"""WITH {SALE_CTES}, {HITS_ALL},
t AS (SELECT user_age, count(*) AS doc_count FROM hits WHERE user_age IS NOT NULL GROUP BY 1),
top AS (SELECT * FROM t ORDER BY doc_count DESC, user_age LIMIT {q.TOP_TERMS})
SELECT user_age, doc_count,
       CAST((SELECT sum(doc_count) FROM t) - (SELECT sum(doc_count) FROM top) AS BIGINT) AS other_docs FROM top""",

    "kpi_for_date": f"""WITH {STARTUP}, {DAU}, {ORDER_INFO},
dates(date) AS (VALUES ('{q.DATE}'), ('{q.EMPTY_DATE}'), ('{q.ORDER_DATE}'))
SELECT date, 'dau' AS id, '新增日活' AS name,
       CAST((SELECT count(*) FROM dau WHERE logDate = date) AS DOUBLE) AS value FROM dates
UNION ALL SELECT date, 'new_mid', '新增设备',
       CAST((SELECT count(*) FROM (SELECT mid, min(logDate) AS d FROM dau GROUP BY mid) WHERE d = date) AS DOUBLE) FROM dates
UNION ALL SELECT date, 'order_amount', '新增交易额',
       (SELECT {_MONEY.format(c='total_amount')} FROM oi WHERE split_part(create_time, ' ', 1) = date) FROM dates""",

    "dau_total_date": f"""WITH {STARTUP}, {DAU}, dates(d) AS (VALUES ('{q.DATE}'), ('{q.EMPTY_DATE}'))
SELECT d AS logDate, (SELECT count(*) FROM dau WHERE logDate = d) AS dau FROM dates""",

    "gmv_total_date": f"""WITH {ORDER_INFO}, dates(d) AS (VALUES ('{q.ORDER_DATE}'), ('{q.EMPTY_DATE}'))
SELECT d AS create_date, (SELECT {_MONEY.format(c='total_amount')} FROM oi WHERE split_part(create_time, ' ', 1) = d)
       AS sum_amount FROM dates""",

    "dau_hour_map": f"""WITH {STARTUP}, {DAU},
h AS (SELECT logDate, logHour, count(*) AS n FROM dau WHERE logDate = '{q.DATE}' GROUP BY 1, 2)
SELECT logDate, '{{' || string_agg('"' || logHour || '":' || CAST(n AS VARCHAR), ',' ORDER BY logHour) || '}}' AS hours
FROM h GROUP BY 1""",

    "dau_hours_compare_date": f"""WITH {STARTUP}, {DAU},
h AS (SELECT logDate AS d, logHour AS hour, count(*) AS v FROM dau GROUP BY 1, 2),
{_compare_after('h', 'logDate', '0')}""",

    "gmv_hours_compare_date": f"""WITH {PURCHASES},
h AS (SELECT create_date AS d, create_hour AS hour, sum_amount AS v FROM ph),
{_compare_after('h', 'create_date', '0.0::DOUBLE')}""",

    "log_route_full": """
SELECT event_id AS log_id, CASE WHEN event_type = 'signup' THEN 'TOPIC_START' ELSE 'TOPIC_EVENT' END AS topic,
       '{' || CASE event_type WHEN 'signup' THEN ''
              ELSE '"evid":"' || CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem'
                                 ELSE event_type END || '",' END
       || '"mid":"' || user_id || '","type":"' || CASE WHEN event_type = 'signup' THEN 'startup' ELSE 'event' END
       || '","uid":"' || user_id || '","ts":' || (epoch_us(ts) // 1000) || '}' AS value
FROM events""",

    "gmv_upsert_total": f"""WITH {ORDER_INFO}
SELECT split_part(create_time, ' ', 1) AS create_date, {_MONEY.format(c='total_amount')} AS sum_amount
FROM oi GROUP BY 1""",

    "log_route_rough": r"""
SELECT event_id AS log_id, CASE WHEN event_type = 'signup' THEN 'TOPIC_START' ELSE 'TOPIC_EVENT' END AS topic,
       CAST(user_id AS VARCHAR) AS mid,
       '{"mid":"old", "type":"' || CASE WHEN event_type = 'signup' THEN 'startup' ELSE 'event' END
       || '", "n":1' || repeat(CAST(user_id AS VARCHAR), 12) || ',"big":1e400,"in":{"ts":1,"k":[{"ts":2}]},"mid":"'
       || user_id || '","text":"a,\"ts\":3}" ,"ts":' || (epoch_us(ts) // 1000) || '}' AS value
FROM events""",

    "gmv_delta": f"""WITH {ORDER_INFO},
shipped AS (SELECT l_orderkey AS id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount, min(l_shipdate) AS t
            FROM lineitem GROUP BY 1),
last AS (SELECT CASE WHEN order_status = 'F' AND s.id IS NOT NULL THEN strftime(t, '%Y-%m-%d')
                     ELSE split_part(create_time, ' ', 1) END AS create_date,
                CASE WHEN order_status = 'F' AND s.id IS NOT NULL THEN amount
                     ELSE CAST(total_amount AS DECIMAL(18,2)) END AS amount
         FROM oi LEFT JOIN shipped s USING (id))
SELECT create_date, CAST(sum(amount) AS DOUBLE) AS sum_amount, count(*) AS order_count FROM last GROUP BY 1""",

    "active_devices_range": """WITH days AS (SELECT DISTINCT user_id AS mid, CAST(ts AS DATE) AS d FROM events WHERE user_id IS NOT NULL),
dates AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM days)
SELECT strftime(dates.d, '%Y-%m-%d') AS logDate,
       count(DISTINCT CASE WHEN days.d > dates.d - 7 THEN mid END) AS devices_7, count(DISTINCT mid) AS devices_30
FROM dates JOIN days ON days.d <= dates.d AND days.d > dates.d - 30 GROUP BY 1""",

    "new_devices_incremental": f"""WITH {STARTUP}, {DAU}
SELECT logDate, count(*) AS new_devices FROM (SELECT mid, min(logDate) AS logDate FROM dau GROUP BY mid) GROUP BY 1""",

    # every event expanded into every window that contains it
    "coupon_alert_islands": """WITH ev AS (
  SELECT CAST(json_extract(props, '$.k') AS INTEGER) % 10 AS mid, user_id AS uid, event_type, epoch_ms(ts) AS ts
  FROM events WHERE event_type IN ('purchase', 'click')),
windows AS (SELECT mid, uid, event_type,
                   unnest(generate_series((ts - 10800000) // 5000 + 1, ts // 5000)) AS k FROM ev),
alerting AS (SELECT mid, k, count(DISTINCT uid) AS users FROM windows GROUP BY 1, 2
             HAVING count(DISTINCT uid) FILTER (event_type = 'purchase') >= 3 AND count(*) FILTER (event_type = 'click') = 0),
numbered AS (SELECT mid, k, users, k - row_number() OVER (PARTITION BY mid ORDER BY k) AS episode FROM alerting)
SELECT mid, make_timestamp(min(k) * 5000000) AS first_window, make_timestamp(max(k) * 5000000) AS last_window,
       count(*) AS windows, max(users) AS most_users FROM numbered GROUP BY mid, episode""",

    # a session ends where the next touch is more than a day away
    "user_live_intervals": """WITH t AS (SELECT user_id AS id, epoch_us(ts) // 1000 AS ms, event_type FROM events
              WHERE event_type IN ('signup', 'purchase', 'view') AND user_id IS NOT NULL),
o AS (SELECT *, coalesce(ms - lag(ms) OVER (PARTITION BY id ORDER BY ms) > 86400000, true) AS opens FROM t),
n AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS session FROM o)
SELECT id, make_timestamp(min(ms) * 1000) AS live_from, make_timestamp((max(ms) + 86400000) * 1000) AS live_until,
       count(*) FILTER (event_type <> 'view') AS updates, count(*) FILTER (event_type = 'view') AS lookups
FROM n GROUP BY id, session""",

    "search_by_terms": f"""WITH {SALE_CTES},
a AS (SELECT DISTINCT doc_id FROM sale WHERE list_has_all(string_split(lower(sku_name), ' '), {_words(q.KEYWORD_ALL)})),
b AS (SELECT DISTINCT doc_id FROM sale WHERE list_has_any(string_split(lower(sku_name), ' '), {_words(q.KEYWORD_ANY)}))
SELECT doc_id, 'and' AS operator FROM a UNION ALL SELECT doc_id, 'or' FROM b""",

    "sale_page_deep": f"""WITH {SALE_CTES},
d AS (SELECT DISTINCT doc_id, dt, order_detail_id, sku_id FROM sale),
r AS (SELECT *, row_number() OVER (ORDER BY dt, doc_id) - 1 AS place, count(*) OVER () AS n FROM d)
SELECT doc_id, dt, order_detail_id, sku_id FROM r WHERE place >= ((n - 1) // {q.PAGE_SIZE}) * {q.PAGE_SIZE}""",

    "sale_facets": f"""WITH {SALE_CTES}, {HITS_ALL}, {SHARES}
SELECT 'total' AS facet, CAST(NULL AS VARCHAR) AS bucket, n AS doc_count, CAST(NULL AS DOUBLE) AS value FROM s
UNION ALL SELECT 'max_age', NULL, NULL, (SELECT CAST(max(user_age) AS DOUBLE) FROM hits)
UNION ALL SELECT 'user_age', CAST(user_age AS VARCHAR), count(*), NULL FROM hits WHERE user_age IS NOT NULL GROUP BY user_age
UNION ALL SELECT 'user_gender', user_gender, count(*), NULL FROM hits WHERE user_gender IS NOT NULL GROUP BY user_gender
UNION ALL SELECT 'gender_ratio', 'male', NULL, male_ratio FROM s
UNION ALL SELECT 'gender_ratio', 'female', NULL, female_ratio FROM s
UNION ALL SELECT 'age_ratio', 'lt20', NULL, lt20_ratio FROM s
UNION ALL SELECT 'age_ratio', '20to30', NULL, "20to30_ratio" FROM s
UNION ALL SELECT 'age_ratio', 'ge30', NULL, ge30_ratio FROM s""",

    "unmatched_lines": """SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey
                  AND l.l_shipdate BETWEEN o.o_orderdate - INTERVAL 365 DAY AND o.o_orderdate + INTERVAL 365 DAY)""",
}
