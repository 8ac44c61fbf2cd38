"""SQL that derives every registered query's result from the test tables on its own, for comparison.

Written in the DuckDB dialect. It never goes through JSON or a join state: each
statement restates what the pipeline should find.
"""

from __future__ import annotations

from ..sources.samples import AS_OF, EPOCH, ITEM, ITEM_ONE_TERM, LAST_DAY, MISSING_DAY, ORDER_DAY, TD

# One row per event, with the fields its log carries.
_EVENT = """
e0 AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, epoch_us(ts) // 1000 AS ms FROM events
),
logs AS (
  SELECT event_id, event_type, k, ms AS ts,
    'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS user_id, CAST(user_id % 25 AS VARCHAR) AS province_id,
    'ch_' || (user_id % 5) AS channel, CASE WHEN event_id % 4 = 0 THEN '1' ELSE '0' END AS is_new,
    'md_' || (user_id % 7) AS model, CASE WHEN user_id % 2 = 0 THEN 'Android' ELSE 'iOS' END AS operate_system,
    'v2.1.' || (user_id % 10) AS version_code, 'ba_' || (user_id % 3) AS brand,
    CASE event_type WHEN 'view' THEN 'good_detail' WHEN 'click' THEN 'good_list' WHEN 'purchase' THEN 'payment' END AS page_id,
    CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 AND event_id % 11 = 0 THEN '' ELSE 'home' END AS last_page_id,
    CAST(k AS VARCHAR) AS page_item, 'sku_id' AS page_item_type, 'query' AS "sourceType", k * 100 AS during_time
  FROM e0
),
page AS (SELECT * FROM logs WHERE event_type IN ('view', 'click', 'purchase')),
dated AS (
  SELECT *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt, strftime(make_timestamp(ts * 1000), '%H') AS hr FROM page
),
entry AS (SELECT * FROM dated WHERE last_page_id IS NULL),
first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, dt ORDER BY ts, page_id, page_item, user_id) AS rn FROM entry
  ) WHERE rn = 1
)
"""
_BASE = "mid, user_id, province_id, channel, is_new, model, operate_system, version_code, brand"
_PAGE = f'{_BASE}, page_id, last_page_id, page_item, page_item_type, "sourceType", during_time'

_DISPLAYED = f"""
displayed AS (
  SELECT {_PAGE}, 'query' AS display_type, CAST(k + i AS VARCHAR) AS display_item, 'sku_id' AS display_item_type,
    CAST(i AS VARCHAR) AS display_order, CAST(i AS VARCHAR) AS display_pos_id, ts
  FROM page, unnest(range(1, k % 4 + 1)) AS u(i) WHERE event_type = 'view'
)"""
_ACTED = f"""
acted AS (
  SELECT {_PAGE}, 'act_' || i AS "actionId", CAST(k AS VARCHAR) AS "actionItem", 'sku_id' AS "actionItemType",
    ts + i * 1000 AS "actionTs", ts
  FROM page, unnest(range(1, k % 3 + 1)) AS u(i) WHERE event_type = 'click'
)"""

_AGE = """
  CAST(trunc((CASE WHEN m > 0 AND d < 0 THEN m - 1 WHEN m < 0 AND d > 0 THEN m + 1 ELSE m END) / 12.0) AS INTEGER)"""
_DIMS = f"""
born AS (
  SELECT c_custkey AS id,
    CASE WHEN c_custkey % 10 = 9 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    DATE '1960-01-01' + CAST((c_custkey * 97) % 20000 AS INTEGER) AS birth
  FROM customer
),
spans AS (
  SELECT *, (year(DATE '{AS_OF}') - year(birth)) * 12 + month(DATE '{AS_OF}') - month(birth) AS m,
    day(DATE '{AS_OF}') - day(birth) AS d
  FROM born
),
users AS (SELECT id, gender, strftime(birth, '%Y-%m-%d') AS birthday, {_AGE} AS age FROM spans),
provinces AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(100000 + n_nationkey AS VARCHAR) AS area_code,
    'CN-' || n_nationkey AS iso_code, 'CN-P' || n_nationkey AS iso_3166_2
  FROM nation
)
"""

_CDC = f"""
raw_change AS (
  SELECT 'order_info' AS table_name, o_orderkey AS key, 0 AS n, NULL AS name FROM orders
  UNION ALL
  SELECT 'user_info', c_custkey, v, 'u' || c_custkey || '_v' || v
  FROM customer, unnest(range(0, CASE WHEN c_custkey % 10 = 0 THEN 3 ELSE 1 END)) AS u(v)
  UNION ALL SELECT 'base_province', n_nationkey, 0, n_name FROM nation
  UNION ALL SELECT 'comment_info', r_regionkey, 0, r_name FROM region
  UNION ALL SELECT 'sku_info', p_partkey, 0, p_name FROM part
),
named_change AS (
  SELECT *, CAST(key AS VARCHAR) AS id, CAST({EPOCH} + n AS BIGINT) AS ts,
    CASE (key + n) % 6 WHEN 0 THEN 'bootstrap-insert' WHEN 1 THEN 'insert' WHEN 2 THEN 'update' WHEN 3 THEN 'delete'
      WHEN 4 THEN 'bootstrap-start' ELSE 'ddl' END AS type
  FROM raw_change
),
change AS (
  SELECT *, CASE WHEN type IN ('bootstrap-insert', 'insert') THEN 'I' WHEN type = 'update' THEN 'U' ELSE 'D' END AS op
  FROM named_change WHERE type IN ('bootstrap-insert', 'insert', 'update', 'delete')
),
dim_change AS (SELECT * FROM change WHERE table_name IN ('user_info', 'base_province', 'sku_info'))
"""
_LATEST_DIM = f"""
WITH {_CDC}
SELECT table_name, id, op, ts, name FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, id ORDER BY ts DESC) AS rn FROM dim_change
) WHERE rn = 1
"""

_ORDERS = f"""
info AS (
  SELECT o_orderkey AS id, o_orderkey % 25 AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
    o_totalprice AS total_amount, CAST(0 AS DOUBLE) AS activity_reduce_amount, CAST(0 AS DOUBLE) AS coupon_reduce_amount,
    o_totalprice AS original_total_amount, CAST(10 AS DOUBLE) AS feight_fee, CAST(0 AS DOUBLE) AS feight_fee_reduce,
    CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS refundable_time,
    strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS create_time, CAST(NULL AS VARCHAR) AS operate_time, s
  FROM (SELECT *, {EPOCH} + (o_orderkey % 10) * 86400 + (o_orderkey * 7919) % 86400 AS s FROM orders)
),
detail AS (
  SELECT DISTINCT
    CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      epoch_us(l_shipdate) // 86400000000, CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_quantity * 100) AS BIGINT)
    )), 1, 15) AS BIGINT) AS id,
    l_orderkey AS order_id, l_partkey AS sku_id, p_retailprice AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
    p_name AS sku_name, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS create_time,
    l_extendedprice AS split_total_amount, CAST(0 AS DOUBLE) AS split_activity_amount,
    CAST(0 AS DOUBLE) AS split_coupon_amount, s
  FROM (
    SELECT *, {EPOCH} + (l_orderkey % 10) * 86400 + (l_orderkey * 7919) % 86400 + l_linenumber * 18000 AS s FROM lineitem
  ) AS l LEFT JOIN part ON l_partkey = p_partkey
)
"""
_WIDE = f"""
{_DIMS},
{_ORDERS},
wide AS (
  SELECT d.id AS detail_id, i.id AS order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
    d.split_total_amount, d.split_activity_amount, d.split_coupon_amount,
    i.province_id, i.order_status, i.user_id, i.total_amount, i.activity_reduce_amount, i.coupon_reduce_amount,
    i.original_total_amount, i.feight_fee, i.feight_fee_reduce, i.expire_time, i.refundable_time,
    d.create_time, i.operate_time, substr(i.create_time, 1, 10) AS create_date, substr(i.create_time, 12, 2) AS create_hour,
    p.name AS province_name, p.area_code AS province_area_code, p.iso_3166_2 AS province_3166_2_code,
    p.iso_code AS province_iso_code, u.age AS user_age, u.gender AS user_gender
  FROM info AS i JOIN detail AS d ON d.order_id = i.id AND abs(d.s - i.s) <= 86400
  LEFT JOIN users AS u ON u.id = i.user_id LEFT JOIN provinces AS p ON p.id = i.province_id
)
"""


def _words(text: str) -> str:
    return f"regexp_split_to_array(lower({text}), '[^a-z0-9]+')"


def _found(item: str) -> str:
    terms = " AND ".join(f"list_contains({_words('sku_name')}, '{t}')" for t in item.split())
    return f"{_WIDE}, day AS (SELECT * FROM wide WHERE create_date = '{ORDER_DAY}'), found AS (SELECT * FROM day WHERE {terms})"


def _scored(item: str) -> str:
    terms = item.split()
    df = ", ".join(f"count(*) FILTER (WHERE list_contains(w, '{t}')) AS df{i}" for i, t in enumerate(terms))

    def one(i: int, t: str) -> str:
        tf = f"len(list_filter({_words('sku_name')}, lambda x: x = '{t}'))"
        length = f"len({_words('sku_name')})"
        idf = f"ln(1 + (docs - df{i} + 0.5) / (df{i} + 0.5))"
        return f"{idf} * {tf} * 2.2 / ({tf} + 1.2 * (0.25 + 0.75 * {length} / avg_len))"

    score = " + ".join(one(i, t) for i, t in enumerate(terms))
    return f"""{_found(item)},
stats AS (SELECT count(*) AS docs, avg(len(w)) AS avg_len, {df} FROM (SELECT {_words('sku_name')} AS w FROM day WHERE sku_name IS NOT NULL)),
scored AS (SELECT found.*, {score} AS score FROM found, stats)"""


def _marked(item: str) -> str:
    return f"regexp_replace(sku_name, '\\b({'|'.join(item.split())})\\b', '<em>\\1</em>', 'gi')"


def _sum(amount: str) -> str:
    return f"CAST(sum(CAST({amount} AS DECIMAL(18,2))) AS DOUBLE)"


def _buckets(field: str, item: str = ITEM_ONE_TERM) -> str:
    return f"""WITH {_found(item)}
SELECT {field}, {_sum('split_total_amount')} AS total_amount, count(*) AS n FROM found WHERE {field} IS NOT NULL GROUP BY {field}"""


def _page(item: str, offset: int) -> str:
    return f"""WITH {_scored(item)}
SELECT create_time, order_price, province_name, {_marked(item)} AS sku_name, sku_num, total_amount, user_age, user_gender
FROM scored ORDER BY score DESC, detail_id LIMIT 20 OFFSET {offset}"""


_HOUR_OF_DAY = f"""WITH {_EVENT}, by_hour AS (SELECT hr, count(*) AS n FROM first WHERE dt = '{TD}' GROUP BY hr)"""
_WIDE_COLUMNS = f"WITH {_WIDE} SELECT * FROM wide"

ORACLE: dict[str, str] = {
    "raw_log_source": f"""WITH {_EVENT}
SELECT 'ODS_BASE_LOG_0522' AS topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset", mid AS key, ts FROM logs""",
    "log_parse": f"""WITH {_EVENT}
SELECT mid, ts, CAST(event_type = 'error' AS INTEGER) AS has_err,
  CAST(event_type IN ('view', 'click', 'purchase', 'error') AS INTEGER) AS has_page,
  CAST(event_type = 'signup' AS INTEGER) AS has_start,
  CAST(CASE WHEN event_type = 'view' THEN k % 4 ELSE 0 END AS INTEGER) AS n_displays,
  CAST(CASE WHEN event_type = 'click' THEN k % 3 ELSE 0 END AS INTEGER) AS n_actions
FROM logs""",
    "log_split_counts": f"""WITH {_EVENT},
c AS (
  SELECT count(*) AS parsed, count(*) FILTER (WHERE event_type = 'error') AS error,
    count(*) FILTER (WHERE event_type IN ('view', 'click', 'purchase')) AS page,
    count(*) FILTER (WHERE event_type = 'signup') AS start,
    CAST(coalesce(sum(k % 4) FILTER (WHERE event_type = 'view'), 0) AS BIGINT) AS display,
    CAST(coalesce(sum(k % 3) FILTER (WHERE event_type = 'click'), 0) AS BIGINT) AS action
  FROM logs
)
SELECT 'parsed' AS branch, parsed AS n FROM c UNION ALL SELECT 'corrupt', 0 UNION ALL SELECT 'error', error FROM c
UNION ALL SELECT 'clean', parsed - error FROM c UNION ALL SELECT 'no_common', 0 UNION ALL SELECT 'page', page FROM c
UNION ALL SELECT 'display', display FROM c UNION ALL SELECT 'action', action FROM c UNION ALL SELECT 'start', start FROM c""",
    "log_json_roundtrip": f"""WITH {_EVENT}
SELECT mid, page_id, last_page_id, during_time, ts, CAST(CASE WHEN last_page_id IS NULL THEN 15 ELSE 16 END AS INTEGER) AS n_fields
FROM page""",
    "log_topics_sink": f"""WITH {_EVENT}, {_DISPLAYED}, {_ACTED},
m AS (
  SELECT 'DWD_PAGE_LOG_TOPIC_0522' AS topic, mid FROM page
  UNION ALL SELECT 'DWD_PAGE_DISPLAY_TOPIC_0522', mid FROM displayed
  UNION ALL SELECT 'DWD_PAGE_ACTION_TOPIC_0522', mid FROM acted
  UNION ALL SELECT 'DWD_START_LOG_TOPIC_0522', mid FROM logs WHERE event_type = 'signup'
  UNION ALL SELECT 'DWD_ERROR_LOG_TOPIC_0522', mid FROM logs WHERE event_type = 'error'
)
SELECT topic, mid AS key, count(*) AS n FROM m GROUP BY topic, mid""",
    "page_log": f"WITH {_EVENT} SELECT {_PAGE}, ts FROM page",
    "page_display_log": f"WITH {_EVENT}, {_DISPLAYED} SELECT * FROM displayed",
    "page_action_log": f"WITH {_EVENT}, {_ACTED} SELECT * FROM acted",
    "start_log": f"""WITH {_EVENT}
SELECT {_BASE.removesuffix(', brand')}, 'icon' AS entry, CAST(k AS VARCHAR) AS open_ad_id, k * 10 AS loading_time,
  k * 7 AS open_ad_ms, k AS open_ad_skip_ms, ts
FROM logs WHERE event_type = 'signup'""",
    "error_log": f"""WITH {_EVENT}
SELECT mid, k AS error_code, 'm' AS msg, 'home' AS page_id, ts FROM logs WHERE event_type = 'error'""",
    "page_log_parse": f"WITH {_EVENT} SELECT {_PAGE}, ts FROM page",
    "page_log_dt_hr": f"WITH {_EVENT} SELECT mid, page_id, ts, dt, hr FROM dated",
    "session_entry_pages": f"WITH {_EVENT} SELECT {_PAGE}, ts FROM page WHERE last_page_id IS NULL",
    "cdc_op_map": f"WITH {_CDC} SELECT table_name, id, type, op, ts FROM change",
    "cdc_fact_route": f"""WITH {_CDC}
SELECT 'DWD_' || upper(table_name) || '_' || op || '_0522' AS topic, id AS key, key AS id
FROM change WHERE table_name IN ('order_info', 'order_detail', 'sku_info')""",
    "cdc_dim_route": f"WITH {_CDC} SELECT table_name, id, op, ts, name FROM dim_change",
    "dim_upsert_latest": _LATEST_DIM,
    "cdc_stream": _LATEST_DIM,
    "cdc_stream_batches": f"""WITH {_CDC},
routed AS (SELECT * FROM dim_change WHERE table_name <> 'sku_info' OR (key * 3 + n) % 2 = 1)
SELECT 'dimension' AS kind, table_name AS name, id, op FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, id ORDER BY ts DESC) AS rn FROM routed
) WHERE rn = 1
UNION ALL SELECT 'fact', 'DWD_' || upper(table_name) || '_' || op || '_0522', id, NULL FROM change WHERE table_name IN ('order_info', 'order_detail', 'sku_info')""",
    "user_age": f"""WITH {_DIMS}
SELECT id, birthday, age, strftime(DATE '{AS_OF}' - 1, '%Y-%m-%d') AS day_before FROM users""",
    "enrich_user": f"""WITH {_DIMS}
SELECT o_orderkey AS id, o_custkey AS user_id, gender AS user_gender, age AS user_age, CAST(u.id IS NOT NULL AS INTEGER) AS user_found
FROM orders LEFT JOIN users AS u ON u.id = o_custkey""",
    "enrich_province": f"""WITH {_DIMS}
SELECT o_orderkey AS id, o_orderkey % 25 AS province_id, name AS province_name, area_code AS province_area_code,
  iso_code AS province_iso_code, iso_3166_2 AS province_3166_2
FROM orders LEFT JOIN provinces AS p ON p.id = o_orderkey % 25""",
    "dau_first_seen": f"WITH {_EVENT} SELECT mid, dt, hr, user_id, page_id, page_item, ts FROM first",
    "dau_wide": f"""WITH {_EVENT}, {_DIMS}
SELECT {_BASE}, page_id, page_item, page_item_type, "sourceType", during_time, u.gender AS user_gender,
  CAST(u.age AS VARCHAR) AS user_age, p.name AS province_name, p.iso_code AS province_iso_code,
  p.iso_3166_2 AS province_3166_2, p.area_code AS province_area_code, dt, hr, ts
FROM first LEFT JOIN users AS u ON CAST(u.id AS VARCHAR) = user_id
LEFT JOIN provinces AS p ON CAST(p.id AS VARCHAR) = province_id""",
    "dau_first_seen_stream": f"""WITH {_EVENT}, {_DIMS}
SELECT dt, mid, user_id, p.name AS province_name FROM first LEFT JOIN provinces AS p ON CAST(p.id AS VARCHAR) = province_id""",
    "pipeline_chain": f"""WITH {_EVENT}, {_CDC},
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_name, id ORDER BY ts DESC) AS rn FROM dim_change) WHERE rn = 1
)
SELECT dt, mid, user_id, p.name AS province_name,
  CASE WHEN u.key % 10 = 9 THEN NULL WHEN u.key % 2 = 0 THEN 'F' WHEN u.key % 2 = 1 THEN 'M' END AS user_gender
FROM first LEFT JOIN latest AS u ON u.table_name = 'user_info' AND u.id = user_id
LEFT JOIN latest AS p ON p.table_name = 'base_province' AND p.id = province_id""",
    "record_balance": f"""WITH {_EVENT}, {_CDC},
read AS (
  SELECT *, make_timestamp(ts * 1000) >= '2024-01-16' AND event_id % 89 = 0 AS broken FROM logs
),
raw AS (
  SELECT 'raw log' AS source, CASE WHEN broken THEN 'corrupt' WHEN event_type = 'error' THEN 'error'
    WHEN event_type IN ('view', 'click', 'purchase') THEN 'page' WHEN event_type = 'signup' THEN 'start' ELSE 'other' END AS fate
  FROM read
),
changed AS (
  SELECT 'change' AS source, CASE WHEN (key * 3 + n) % 89 = 0 THEN 'corrupt'
    WHEN type NOT IN ('bootstrap-insert', 'insert', 'update', 'delete') THEN 'no_change'
    WHEN table_name = 'comment_info' THEN 'unlisted' ELSE 'routed' END AS fate
  FROM named_change
),
paged AS (
  SELECT 'page' AS source, CASE WHEN last_page_id IS NOT NULL THEN 'later_page'
    WHEN row_number() OVER (PARTITION BY mid, dt, last_page_id IS NULL) = 1 THEN 'first' ELSE 'repeated' END AS fate
  FROM dated WHERE NOT (make_timestamp(ts * 1000) >= '2024-01-16' AND event_id % 89 = 0)
),
fates AS (
  SELECT * FROM (VALUES ('raw log', ['read', 'corrupt', 'error', 'page', 'start', 'other']),
    ('change', ['read', 'corrupt', 'no_change', 'unlisted', 'routed']),
    ('page', ['read', 'corrupt', 'no_key', 'later_page', 'first', 'late', 'repeated']),
    ('order header', ['read', 'corrupt', 'no_key', 'kept']), ('order line', ['read', 'corrupt', 'no_key', 'kept'])) AS t(source, names)
),
went AS (SELECT * FROM raw UNION ALL SELECT * FROM changed UNION ALL SELECT * FROM paged)
SELECT f.source, f.fate, CAST(count(w.source) AS BIGINT) AS n
FROM (SELECT source, unnest(names) AS fate FROM fates) AS f
LEFT JOIN went AS w ON w.source = f.source AND (w.fate = f.fate OR f.fate = 'read') GROUP BY f.source, f.fate""",
    "dau_by_hour_stream": f"""WITH {_EVENT},
in_time AS (
  SELECT * FROM entry WHERE NOT (make_timestamp(ts * 1000) BETWEEN '2024-01-05' AND '2024-01-11' AND ts % 97 = 0)
),
first_hour AS (SELECT mid, dt, arg_min(hr, ts) AS hr FROM in_time GROUP BY mid, dt)
SELECT dt, hr, count(*) AS n FROM first_hour
WHERE CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT make_timestamp(max(ts) * 1000) - INTERVAL 2 HOUR FROM entry)
GROUP BY dt, hr""",
    "dau_state_seed": f"WITH {_EVENT} SELECT mid, dt, hr, ts FROM first WHERE dt = '{TD}' AND hr >= '12'",
    "dau_total": f"WITH {_EVENT} SELECT count(*) AS dau_total FROM first WHERE dt = '{TD}'",
    "dau_total_missing_day": f"WITH {_EVENT} SELECT count(*) AS dau_total FROM first WHERE dt = '{MISSING_DAY}'",
    "dau_by_hour": f"{_HOUR_OF_DAY} SELECT hr, n FROM by_hour",
    "dau_by_hour_filled": f"""{_HOUR_OF_DAY}
SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hr, coalesce(n, 0) AS n
FROM unnest(range(0, 24)) AS u(h) LEFT JOIN by_hour ON hr = lpad(CAST(h AS VARCHAR), 2, '0')""",
    "dau_realtime": f"""WITH {_EVENT}
SELECT 'dauTotal' AS metric, CAST(NULL AS VARCHAR) AS hr, count(*) AS n FROM first WHERE dt = '{TD}'
UNION ALL SELECT 'dauTd', hr, count(*) FROM first WHERE dt = '{TD}' GROUP BY hr
UNION ALL SELECT 'dauYd', hr, count(*) FROM first WHERE dt = strftime(DATE '{TD}' - 1, '%Y-%m-%d') GROUP BY hr""",
    "stream_resume": f"WITH {_EVENT} SELECT mid, page_id, page_item, ts FROM page",
    "order_parse": f"WITH {_ORDERS} SELECT * EXCLUDE (s) FROM info",
    "order_detail_parse": f"WITH {_ORDERS} SELECT * EXCLUDE (s) FROM detail",
    "order_date_parts": f"""WITH {_ORDERS}
SELECT id, create_time, substr(create_time, 1, 10) AS create_date, substr(create_time, 12, 2) AS create_hour FROM info""",
    "order_full_outer": f"""WITH {_ORDERS}
SELECT coalesce(i.id, d.order_id) AS order_id, i.id AS info_id, d.id AS detail_id, i.total_amount, d.split_total_amount
FROM info AS i FULL OUTER JOIN detail AS d ON d.order_id = i.id""",
    "order_wide": _WIDE_COLUMNS,
    "order_wide_stream": _WIDE_COLUMNS,
    "order_late_expired": f"""WITH {_ORDERS}
SELECT d.id AS detail_id, i.id AS order_id, CAST(abs(d.s - i.s) AS BIGINT) AS seconds_apart
FROM info AS i JOIN detail AS d ON d.order_id = i.id WHERE abs(d.s - i.s) > 86400""",
    "sink_upsert_idempotent": f"""WITH {_WIDE}
SELECT CAST(detail_id AS VARCHAR) AS doc_id, create_date AS dt, order_id,
  CASE WHEN order_id % 2 = 0 THEN 'Z' ELSE order_status END AS order_status, split_total_amount
FROM wide""",
    "item_search": f"WITH {_found(ITEM)} SELECT detail_id, order_id, sku_name, create_time FROM found",
    "item_search_ranked": f"""WITH {_scored(ITEM)}
SELECT detail_id, sku_name, round(score, 6) AS score FROM scored ORDER BY score DESC, detail_id""",
    "item_search_postings": f"WITH {_scored(ITEM)} SELECT detail_id, round(score, 6) AS score FROM scored",
    "detail_after": _page(ITEM_ONE_TERM, 20),
    "item_highlight": f"WITH {_found(ITEM_ONE_TERM)} SELECT detail_id, {_marked(ITEM_ONE_TERM)} AS sku_name FROM found",
    "item_sum_by_age": _buckets("user_age"),
    "item_sum_by_gender": _buckets("user_gender"),
    "item_top_ages": f"{_buckets('user_age')} ORDER BY n DESC, user_age LIMIT 10",
    "stats_by_item_age": f"""WITH {_found(ITEM)},
b AS (
  SELECT count(*) AS n, {_sum("CASE WHEN user_age < 20 THEN split_total_amount ELSE 0 END")} AS b0,
    {_sum("CASE WHEN user_age BETWEEN 20 AND 29 THEN split_total_amount ELSE 0 END")} AS b1,
    {_sum("CASE WHEN user_age >= 30 THEN split_total_amount ELSE 0 END")} AS b2
  FROM found WHERE user_age IS NOT NULL
)
SELECT '20岁以下' AS name, b0 AS value FROM b WHERE n > 0 UNION ALL SELECT '20到29岁', b1 FROM b WHERE n > 0
UNION ALL SELECT '30岁以上', b2 FROM b WHERE n > 0""",
    "stats_by_item_gender": f"""WITH {_found(ITEM)}
SELECT CASE user_gender WHEN 'F' THEN '女' WHEN 'M' THEN '男' ELSE user_gender END AS name, {_sum('split_total_amount')} AS value
FROM found WHERE user_gender IS NOT NULL GROUP BY user_gender""",
    "detail_total": f"WITH {_found(ITEM)} SELECT count(*) AS total FROM found",
    "detail_by_item": _page(ITEM, 0),
    "detail_page_2": _page(ITEM_ONE_TERM, 20),
}


# ---- dashboard -----------------------------------------------------------------------

_WEEK = f"""WITH {_EVENT},
week AS (SELECT * FROM dated WHERE dt BETWEEN strftime(DATE '{TD}' - 6, '%Y-%m-%d') AND '{TD}'),
numbered AS (
  SELECT *, sum(CAST(last_page_id IS NULL AS INTEGER)) OVER (
    PARTITION BY mid ORDER BY ts, last_page_id IS NOT NULL, page_id, page_item, last_page_id ROWS UNBOUNDED PRECEDING
  ) AS visit, row_number() OVER (PARTITION BY mid ORDER BY ts, last_page_id IS NOT NULL, page_id, page_item, last_page_id) AS rn
  FROM week
),
visit AS (
  SELECT mid, CAST(visit AS BIGINT) AS visit, min(dt) AS dt, arg_min(page_id, rn) AS entry_page, arg_min(channel, rn) AS channel,
    max(CAST(is_new = '1' AS INTEGER)) AS is_new, count(*) AS pages, CAST(sum(during_time) AS BIGINT) AS millis
  FROM numbered GROUP BY mid, visit
)"""


def _lines(days: int) -> str:
    return f"""{_WIDE},
lines AS (SELECT * FROM wide WHERE create_date BETWEEN strftime(DATE '{ORDER_DAY}' - {days - 1}, '%Y-%m-%d') AND '{ORDER_DAY}'),
ordered AS (SELECT DISTINCT order_id, user_id, province_name, total_amount FROM lines)"""


def _versus(metric: str, figure: str) -> str:
    return f"""SELECT '{metric}' AS metric, round(CAST({figure.replace('KIND', '0')} AS DOUBLE), 6) AS old,
  round(CAST({figure.replace('KIND', '1')} AS DOUBLE), 6) AS new FROM visit"""


def _top(name: str, num: int, joined: bool) -> str:
    source = "lines JOIN part ON p_partkey = sku_id" if joined else "lines"
    return f"""WITH {_lines(7)}
SELECT {name} AS name, {_sum('split_total_amount')} AS value FROM {source} GROUP BY {name} ORDER BY value DESC, name LIMIT {num}"""


_STAGES = ["首页|home", "商品详情|good_detail", "加购物车|cart", "订单|trade", "支付|payment"]

ORACLE |= {
    "pv_count": f"{_WEEK} SELECT dt, count(*) AS pv FROM week GROUP BY dt",
    "uv_count": f"{_WEEK} SELECT dt, count(DISTINCT mid) AS uv FROM week GROUP BY dt",
    "visit_total": f"""{_WEEK}
SELECT count(*) AS pv_count, count(DISTINCT mid) AS uv_count, count(DISTINCT mid) FILTER (WHERE is_new = '1') AS new_count FROM week""",
    "uv_period": f"""WITH {_EVENT}
SELECT count(DISTINCT mid) AS uv_count, count(DISTINCT mid) FILTER (WHERE is_new = '1') AS new_count
FROM dated WHERE dt BETWEEN strftime(DATE '{LAST_DAY}' - 29, '%Y-%m-%d') AND '{LAST_DAY}'""",
    "visit_sessions": f"{_WEEK} SELECT * FROM visit",
    "new_visit_stats": _WEEK
    + " UNION ALL ".join(
        [
            _versus("浏览量", "sum(pages) FILTER (WHERE is_new = KIND)"),
            _versus("访客数", "count(DISTINCT mid) FILTER (WHERE is_new = KIND)"),
            _versus("跳出率", "avg(CAST(pages = 1 AS INTEGER)) FILTER (WHERE is_new = KIND)"),
            _versus("平均访问时长", "avg(millis / 1000.0) FILTER (WHERE is_new = KIND)"),
            _versus("平均访问页面数", "avg(pages) FILTER (WHERE is_new = KIND)"),
        ]
    ),
    "channel_pv": f"{_WEEK} SELECT channel AS name, CAST(count(*) AS DOUBLE) AS value FROM week GROUP BY channel",
    "channel_bounce": f"""{_WEEK}
SELECT channel AS name, round(avg(CAST(pages = 1 AS INTEGER)), 6) AS value FROM visit GROUP BY channel""",
    "page_path": f"""{_WEEK}
SELECT last_page_id AS source, page_id AS target, count(*) AS value FROM week WHERE last_page_id <> '' GROUP BY last_page_id, page_id""",
    "user_action_convert": _WEEK
    + " UNION ALL ".join(
        f"SELECT '{s.split('|')[0]}' AS stage, count(DISTINCT mid) AS n FROM week WHERE page_id = '{s.split('|')[1]}'"
        for s in _STAGES
    ),
    "user_paid": f"""WITH {_lines(3)},
paid AS (SELECT count(*) AS n FROM customer WHERE c_custkey IN (SELECT user_id FROM lines))
SELECT 'paid' AS name, n AS value FROM paid UNION ALL SELECT 'unpaid', (SELECT count(*) FROM customer) - n FROM paid""",
    "user_total": f"""WITH {_EVENT}, {_lines(7)}
SELECT (SELECT count(*) FROM customer) AS user_count,
  (SELECT count(DISTINCT user_id) FROM dated
   WHERE is_new = '1' AND dt BETWEEN strftime(DATE '{ORDER_DAY}' - 6, '%Y-%m-%d') AND '{ORDER_DAY}') AS new_count,
  round({_sum('total_amount')} / count(DISTINCT user_id), 4) AS pct
FROM ordered""",
    "order_total": f"""WITH {_lines(3)}
SELECT count(*) AS order_count, {_sum('total_amount')} AS order_amount, count(DISTINCT user_id) AS order_user FROM ordered""",
    "area_orders": f"WITH {_lines(3)} SELECT province_name AS name, count(*) AS value FROM ordered GROUP BY province_name",
    "top_spu": _top("sku_name", 7, False),
    "top_tm": _top("p_brand", 7, True),
    "top_category": _top("p_type", 3, True),
}
