"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from .functions.vocabulary import EVENT_TYPES

_TYPES = "[" + ", ".join(f"'{t}'" for t in EVENT_TYPES) + "]"

# Every tenth event has a second version with ten units more; the version that came in last counts, events without an id don't.
_EVENTS = f"""
    sent AS (
        SELECT event_id AS n, 1 + event_id % 14 AS no, ts, user_id AS u, event_type AS src, value,
            unnest(CASE WHEN event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS late FROM events
    ),
    named AS (
        SELECT n, no, src, late, value, CASE WHEN n % 97 <> 0 THEN 'ev-' || n END AS event_uuid, no::INT AS event_id, {_TYPES}[no] AS event_type,
            ts, epoch_us(ts) // 1000000 AS event_ts, ts::DATE AS log_date, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created_at,
            'u' || u || '-' || strftime(ts, '%Y%m%d') AS session_id, 'u' || u AS user_id, CASE WHEN u % 2 = 0 THEN 'iOS' ELSE 'Android' END AS device_os,
            '1.' || (u % 3) AS app_version, u, 'p' || (n % 50) AS product,
            CASE WHEN no = 14 THEN CASE WHEN n % 6 = 0 THEN 0 ELSE 1 END END::INT AS is_success, CASE WHEN no = 11 THEN CASE WHEN n % 5 = 0 THEN 0 ELSE 1 END END::INT AS is_valid
        FROM sent
    ),
    ev AS (
        SELECT *, strftime(ts, '%Y%m%d') || '_' || user_id || '_' || no AS trans_event_id, date_trunc('second', ts) AS event_time,
            coalesce(is_success = 0, false) OR coalesce(is_valid = 0, false) AS failed
        FROM named WHERE event_uuid IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_uuid ORDER BY ts + to_hours(late) DESC, u % 10 DESC, 2 * n + late DESC) = 1
    )"""
_COMMON = "event_uuid, trans_event_id, event_id, event_type, event_time, log_date, session_id, user_id, device_os, app_version"


def _of(number: str, value: str) -> str:
    return f"CASE WHEN no IN ({number}) THEN {value} END"


_DISCOVERY = f"""
    discovery AS (
        SELECT {_COMMON}, NULL::VARCHAR AS meta_app_version, src AS source_screen, NULL::VARCHAR AS source_element, {_of("3", "n % 10")}::INT AS position,
            {_of("2", "'blue shirt ' || (n % 7)")} AS search_keyword, {_of("2", "n % 30")}::INT AS result_count, {_of("3, 4", "product")} AS product_id,
            NULL::VARCHAR AS product_name, NULL::BIGINT AS base_price, {_of("4", "'size'")} AS variant_type, {_of("4", "'M'")} AS variant_value
        FROM ev WHERE no BETWEEN 1 AND 4
    )"""
_CART = f"""
    cart AS (
        SELECT {_COMMON}, src AS source_screen, NULL::VARCHAR AS source_element, {_of("5, 7, 8", "product")} AS product_id, NULL::VARCHAR AS variant_color, NULL::VARCHAR AS variant_size,
            {_of("5", "1 + n % 3 + 10 * late")}::INT AS quantity, {_of("7", "1 + n % 2")}::INT AS removed_quantity, NULL::VARCHAR AS action_type,
            {_of("8", "n % 4")}::INT AS old_quantity, {_of("8", "n % 5")}::INT AS new_quantity, {_of("6", "n % 9")}::INT AS total_items, {_of("6", "n % 9 * 1000")} AS cart_total_value
        FROM ev WHERE no BETWEEN 5 AND 8
    )"""
_CHECKOUT = f"""
    checkout AS (
        SELECT {_COMMON}, {_of("9", "product || ',q' || (n % 3)")} AS items_list, {_of("10", "CASE WHEN n % 2 = 0 THEN 'post' ELSE 'courier' END")} AS shipping_method, NULL::BIGINT AS shipping_fee,
            {_of("10", "'City ' || (n % 6)")} AS city_province, {_of("11", "'promo' || (n % 4)")} AS promotion_id, NULL::VARCHAR AS promotion_type, NULL::BIGINT AS discount_amount,
            is_valid, CASE WHEN is_valid = 0 THEN 'expired' END AS error_message, {_of("12", "['card', 'cod', 'wallet'][1 + n % 3]")} AS payment_method,
            {_of("13", "floor(value * 100)")}::BIGINT AS final_amount, {_of("13", "'o' || n")} AS order_id, NULL::VARCHAR AS transaction_id, is_success,
            CASE WHEN is_success = 0 THEN 'E' || (n % 3) END AS error_code
        FROM ev WHERE no BETWEEN 9 AND 14
    )"""

_FUNNEL = """
    funnel AS (
        SELECT date_trunc('hour', event_time) AS hour, app_version, device_os, event_type, count(*) AS event_count,
            count(*) FILTER (NOT failed) AS success_count, count(DISTINCT user_id) AS unique_users
        FROM ev GROUP BY ALL
    )"""
_HEALTH = "app_health AS (SELECT date_trunc('hour', event_time) AS hour, app_version, event_type, count(*) AS total_count, count(*) FILTER (failed) AS error_count FROM ev GROUP BY ALL)"
_REVENUE = """
    revenue AS (
        SELECT date_trunc('hour', ts) AS hour, 'item ' || (event_id % 50) AS item, sum(1 + event_id % 3)::BIGINT AS units_sold,
            sum((1 + event_id % 3) * 150000)::BIGINT AS total_revenue, count(DISTINCT user_id) AS unique_buyers
        FROM events WHERE event_type = 'purchase' GROUP BY ALL
    )"""
_YESTERDAY = "date_trunc('day', hour) = DATE '2024-01-20' - INTERVAL 1 DAY"
_WEEK, _MONTH = "hour >= DATE '2024-01-20' - INTERVAL 7 DAY", "hour >= DATE '2024-01-20' - INTERVAL 30 DAY"


def _rate(part: str, whole: str, digits: int = 4, times: str = "") -> str:
    return f"round({times}sum({part})::DOUBLE / sum({whole})::DOUBLE, {digits})"


# Every seventh order has an older snapshot; the newest one by change, then by load, counts.
_TX = """
    versions AS (
        SELECT o_orderkey AS k, o_orderkey::VARCHAR AS transaction_id, 'b' || (o_custkey % 5) AS branch_id, o_orderdate + to_seconds(o_orderkey % 86400) AS transaction_datetime,
            o_orderpriority AS payment_type, o_totalprice::DECIMAL(15, 2) AS trans_total_amount, CASE WHEN o_orderkey % 53 <> 0 THEN 'c' || o_custkey END AS customer_id,
            CASE WHEN old = 1 THEN 'W' ELSE substr('WRODICBPF', (1 + o_orderkey % 9)::INT, 1) END AS order_status, CASE WHEN o_orderkey % 2 = 0 THEN 'offline' ELSE 'online' END AS channel,
            o_orderdate AS ordered, CASE WHEN old = 1 THEN o_orderdate ELSE o_orderdate + to_days((o_orderkey % 40)::INT) END AS updated_at, old
        FROM (SELECT *, unnest(CASE WHEN o_orderkey % 7 = 0 THEN [0, 1] ELSE [0] END) AS old FROM orders)
    ),
    tx AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY transaction_id, branch_id ORDER BY updated_at DESC NULLS LAST, old, order_status) = 1),
    timed AS (SELECT *, strftime(transaction_datetime, '%Y%m') AS ym, strftime(transaction_datetime, '%Y%m%d') AS ymd FROM tx),
    nou AS (SELECT customer_id, min(ymd) AS nou_ymd FROM timed WHERE customer_id IS NOT NULL GROUP BY customer_id),
    months AS (SELECT DISTINCT customer_id, ym FROM timed WHERE customer_id IS NOT NULL),
    silver AS (
        SELECT t.ym AS trans_month, transaction_datetime::DATE AS trans_date, strftime(transaction_datetime, '%H:%M:%S') AS trans_time,
            (epoch_us(transaction_datetime) // 1000000)::BIGINT AS "timestamp", concat_ws('_', t.ymd, t.customer_id, transaction_id) AS trans_id, t.customer_id,
            CASE WHEN t.customer_id IS NULL THEN NULL WHEN nou.nou_ymd[1:6] = t.ym THEN 1 WHEN m.customer_id IS NOT NULL THEN 2 ELSE 3 END::INT AS user_type,
            CASE WHEN t.customer_id IS NOT NULL AND row_number() OVER (PARTITION BY t.customer_id ORDER BY transaction_datetime, transaction_id, branch_id) = 1 THEN 1 ELSE 0 END::INT AS NOU,
            nou.nou_ymd, branch_id, channel, order_status, payment_type, trans_total_amount AS order_total_amount, transaction_datetime AS created_at, updated_at, t.ym, t.ymd
        FROM timed t LEFT JOIN nou ON nou.customer_id = t.customer_id
        LEFT JOIN months m ON m.customer_id = t.customer_id AND m.ym = strftime(strptime(t.ym || '01', '%Y%m%d') - INTERVAL 1 MONTH, '%Y%m')
    )"""
_SNAPSHOT = """
    snap AS (
        SELECT *, date_diff('day', trans_date, CASE WHEN order_status IN ('W', 'O', 'D', 'P') THEN DATE '1998-06-15' ELSE updated_at::DATE END) AS age FROM silver
        WHERE (order_status IN ('W', 'O', 'D', 'P') AND trans_date <= DATE '1998-06-15') OR (order_status IN ('I', 'B', 'C', 'R') AND updated_at::DATE = DATE '1998-06-15')
    )"""


def _group(name: str, codes: str) -> str:
    return f"""sum(CASE WHEN order_status IN ({codes}) THEN order_total_amount ELSE 0 END)::DECIMAL(38, 2) AS {name}_rev,
            count(DISTINCT CASE WHEN order_status IN ({codes}) THEN trans_id END)::INT AS {name}_orders"""


_STATES = """
    states AS (SELECT k, transaction_id, branch_id, order_status, transaction_datetime AS created_at, updated_at FROM tx),
    old AS (SELECT transaction_id, branch_id, order_status, created_at, updated_at FROM states WHERE created_at < TIMESTAMP '1998-01-01'),
    new AS (SELECT transaction_id, branch_id, 'I' AS order_status, created_at + INTERVAL 1 DAY AS created_at, updated_at + INTERVAL 50 DAY AS updated_at FROM states WHERE created_at >= TIMESTAMP '1997-06-01')"""

_CUSTOMERS = """
    people AS (
        SELECT c_custkey AS k, n_name, 'c' || c_custkey AS customer_id, c_mktsegment || CASE WHEN old = 1 THEN ' before' ELSE '' END AS segment,
            TIMESTAMP '2024-01-01' + to_days((c_custkey % 10)::INT) AS created_at, TIMESTAMP '2024-01-01' + to_days((c_custkey % 10 + c_custkey % 5 - old)::INT) AS updated_at
        FROM (SELECT *, unnest(CASE WHEN c_custkey % 4 = 0 THEN [0, 1] ELSE [0] END) AS old FROM customer) JOIN nation ON c_nationkey = n_nationkey
    ),
    latest AS (
        SELECT customer_id, k,
            trim(regexp_replace(concat_ws(' ', CASE WHEN k % 20 > 1 THEN ' Customer  ' || (k % 100) END, CASE WHEN k % 20 <> 0 THEN segment END), '\\s+', ' ', 'g')) AS full_name,
            CASE WHEN k % 11 <> 0 THEN CASE WHEN k % 13 = 0 THEN '12' ELSE 'xxxxxxx' || right(lpad(k::VARCHAR, 8, '0'), 3) END END AS phone,
            DATE '1980-01-01' + (k % 9000)::INT AS dob, (k % 80)::INT AS age, ['O', 'M', 'F'][1 + k % 3] AS gender,
            CASE WHEN k % 17 = 0 THEN 'unknown' WHEN k % 19 = 0 THEN '' ELSE n_name END AS city,
            CASE WHEN k % 23 = 0 THEN 2 WHEN k % 10 = 4 THEN 0 ELSE 1 END::INT AS _cdc_operation, created_at AS registered_datetime, updated_at,
            CASE WHEN k % 2 = 0 THEN 'pos' ELSE 'web' END AS source
        FROM people QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1
    )"""
_CREATED = "TIMESTAMP '2024-01-01' + to_days(({0} % 10)::INT) AS created_at, TIMESTAMP '2024-01-01' + to_days(({0} % 15)::INT) AS updated_at"
_KIND = "CASE WHEN {0} % {1} = 0 THEN 2 WHEN {0} % 10 = 4 THEN 0 ELSE 1 END::INT AS _cdc_operation"
_CATEGORIES = """
    cat AS (
        SELECT DISTINCT p_type AS category_id, length(p_type) AS n,
            array_to_string(list_transform(string_split(lower(p_type), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS category_name
        FROM part WHERE length(p_type) % 5 <> 0
    )"""

_SALES = """
    sale AS (
        SELECT event_id AS n, event_type AS kind, 'u' || user_id AS user_id, CASE WHEN event_id % 11 <> 0 THEN 'item ' || (event_id % 50) ELSE 'Unknown' END AS item,
            event_id % 4 <> 0 AS ok, CASE WHEN event_id % 7 <> 0 THEN 1 + event_id % 3 ELSE 0 END AS units
        FROM events
    )"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


ORACLES: dict[str, str] = {
    "bronze_events": _with(_EVENTS) + """SELECT event_uuid, event_id, event_type, event_ts, log_date, created_at, session_id, user_id, device_os, app_version,
        'behavior_events' AS _kafka_topic, (u % 10)::INT AS _kafka_partition, 2 * n + late AS _kafka_offset FROM named""",
    "bronze_transactions": _with(_TX) + """SELECT strftime(updated_at, '%Y%m%d') AS report_date, strftime(updated_at, '%Y%m') AS report_month, channel, branch_id, transaction_id, transaction_datetime, payment_type, trans_total_amount,
            CASE WHEN k % 2 = 0 THEN k % 8 END::INT AS trans_total_line, CASE WHEN k % 2 = 0 THEN k % 6 END::INT AS trans_total_sell_sku, customer_id, order_status,
            ordered::DATE AS delivery_date, transaction_datetime AS created_at, updated_at FROM versions""",
    "bronze_transaction_details": """
        WITH l AS (
            SELECT l_orderkey || '-' || l_linenumber AS id, l_orderkey::VARCHAR AS transaction_id, CASE WHEN l_orderkey % 2 = 0 THEN 'offline' ELSE 'online' END AS channel,
                CASE WHEN l_orderkey % 2 = 0 THEN 'b' || (l_suppkey % 5) END AS branch_id, 'p' || l_partkey AS product_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS promo,
                l_quantity::INT AS qty, l_shipdate AS created_at, CASE WHEN l_linestatus = 'O' THEN 'pc' END AS uom, l_extendedprice::DECIMAL(15, 2) AS amount, CASE WHEN l_linenumber % 2 = 0 THEN 'M' ELSE '' END AS size FROM lineitem
        )
        SELECT transaction_id, channel, branch_id, count(DISTINCT CASE WHEN promo = 0 THEN id END) AS order_total_line, sum(CASE WHEN promo = 0 THEN qty ELSE 0 END)::BIGINT AS order_total_sku,
            count(DISTINCT CASE WHEN promo = 1 THEN id END) AS promo_total_line, sum(CASE WHEN promo = 1 THEN qty ELSE 0 END)::BIGINT AS promo_total_sku, max(promo)::INT AS is_promo,
            min(created_at) AS created_at, string_agg(concat_ws(':', id, product_id, promo, coalesce(uom, '-'), qty, amount, size, ''), ',' ORDER BY id, product_id, promo, uom NULLS FIRST, qty, amount) AS trans_metadata, strftime(min(created_at), '%Y%m%d') AS report_date
        FROM l GROUP BY transaction_id, channel, branch_id""",
    "silver_events_discovery": _with(_EVENTS, _DISCOVERY) + "SELECT * FROM discovery",
    "silver_events_cart": _with(_EVENTS, _CART) + "SELECT * FROM cart",
    "silver_events_checkout": _with(_EVENTS, _CHECKOUT) + "SELECT * FROM checkout",
    "silver_customers": _with(_CUSTOMERS) + "SELECT * EXCLUDE (k) FROM latest",
    "silver_products": _with(_CATEGORIES) + f"""SELECT 'p' || p_partkey AS product_id, p_name AS product_name, upper(p_name) AS product_display_name, p_type AS category_id, category_name,
        ['pc', 'box', 'set'][1 + p_size % 3] AS sales_unit, p_brand AS color, p_size::VARCHAR AS size, p_retailprice::DECIMAL(15, 2) AS unit_price, {_KIND.format("p_partkey", 9)}, {_CREATED.format("p_partkey")}
        FROM part LEFT JOIN cat ON p_type = category_id""",
    "silver_branches": f"""SELECT 'b' || s_suppkey AS branch_id, s_name AS branch_name, CASE WHEN s_suppkey % 2 = 0 THEN 'store' ELSE 'outlet' END AS branch_type, r_name AS region, n_name AS city_province,
        'Ward ' || (s_suppkey % 12) AS ward, CASE WHEN s_suppkey % 6 = 0 THEN 'closed' ELSE 'open' END AS status, DATE '2010-01-01' + (s_suppkey % 3000)::INT AS open_date, {_KIND.format("s_suppkey", 9)}, {_CREATED.format("s_suppkey")}
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "silver_category": _with(_CATEGORIES) + f"SELECT category_id, category_name, {_KIND.format('n', 3)}, {_CREATED.format('n')} FROM cat",
    "silver_nou": _with(_TX) + "SELECT customer_id, nou_ymd, nou_ymd[1:6] AS ym FROM nou",
    "silver_nou_daily": _with(_TX) + """SELECT customer_id, nou_ymd, nou_ymd[1:6] AS ym FROM nou
        WHERE nou_ymd = '19960301' AND customer_id IN (SELECT customer_id FROM timed WHERE ymd = '19960301')""",
    "silver_nou_updated": _with(_TX) + "SELECT customer_id, nou_ymd, nou_ymd[1:6] AS ym FROM nou",
    "silver_transactions_latest": _with(_TX) + "SELECT transaction_id, branch_id, channel, order_status, updated_at FROM tx",
    "silver_transactions": _with(_TX) + "SELECT * FROM silver",
    "user_type_distribution": _with(_TX) + "SELECT user_type, count(*) AS n_orders FROM silver GROUP BY user_type",
    "gold_events_discovery": _with(_EVENTS, _DISCOVERY) + "SELECT event_type, log_date, session_id, user_id, source_screen, source_element, position, search_keyword, product_id, count(*) AS event_count FROM discovery GROUP BY ALL",
    "gold_events_cart": _with(_EVENTS, _CART) + """SELECT event_type, log_date, session_id, user_id, source_screen, source_element, product_id, count(*) AS event_count,
        sum(CASE WHEN event_type = 'add_to_cart' THEN quantity ELSE 0 END)::BIGINT AS qty_added, sum(CASE WHEN event_type = 'remove_from_cart' THEN removed_quantity ELSE 0 END)::BIGINT AS qty_removed
        FROM cart GROUP BY ALL""",
    "gold_events_checkout": _with(_EVENTS, _CHECKOUT) + "SELECT event_type, log_date, session_id, user_id, payment_method, shipping_method, promotion_id, is_success, error_code, error_message, count(*) AS event_count FROM checkout GROUP BY ALL",
    "gold_daily_customer_sales": _with(_TX, _SNAPSHOT) + f"""SELECT DATE '1998-06-15' AS snapshot_date, customer_id, branch_id, user_type, channel, payment_type, '199806' AS ym, '19980615' AS ymd,
        {_group("processing", "'W', 'O', 'D', 'P'")}, {_group("recognized", "'I'")}, {_group("returned", "'B'")}, {_group("cancelled", "'C', 'R'")}
        FROM snap GROUP BY customer_id, branch_id, user_type, channel, payment_type""",
    "gold_daily_logistics_aging": _with(_TX, _SNAPSHOT) + """SELECT DATE '1998-06-15' AS snapshot_date,
        CASE WHEN age < 1 THEN '<1' WHEN age <= 3 THEN '<=3' WHEN age <= 7 THEN '<=7' WHEN age <= 14 THEN '<=14' WHEN age <= 28 THEN '<=28' ELSE '>28' END AS aging_category,
        branch_id, order_status, channel, payment_type, '199806' AS ym, '19980615' AS ymd, sum(order_total_amount)::DECIMAL(25, 2) AS total_rev, count(DISTINCT trans_id)::INT AS total_orders
        FROM snap GROUP BY ALL""",
    "gold_funnel_hourly": _with(_EVENTS, _FUNNEL) + "SELECT * FROM funnel",
    "gold_app_health_hourly": _with(_EVENTS, _HEALTH) + "SELECT * FROM app_health",
    "gold_user_activity_daily": _with(_EVENTS) + "SELECT log_date, user_id, count(*) AS event_count, count(DISTINCT session_id) AS session_count, min(event_time) AS first_event_at, max(event_time) AS last_event_at FROM ev GROUP BY ALL",
    "gold_item_revenue_hourly": _with(_REVENUE) + "SELECT * FROM revenue",
    "exact_users_by_day": _with(_EVENTS) + "SELECT log_date, event_type, count(DISTINCT user_id) AS unique_users FROM ev GROUP BY ALL",
    "report_error_rate_by_version": _with(_EVENTS, _HEALTH) + f"SELECT app_version, sum(total_count)::BIGINT AS total_events, sum(error_count)::BIGINT AS errors, {_rate('error_count', 'total_count')} AS error_rate FROM app_health WHERE {_YESTERDAY} GROUP BY app_version",
    "report_payment_failures_by_version": _with(_EVENTS, _HEALTH) + f"""SELECT app_version, sum(total_count)::BIGINT AS payment_attempts, sum(error_count)::BIGINT AS failures, {_rate("error_count", "total_count")} AS failure_rate
        FROM app_health WHERE event_type = 'payment_callback' AND {_WEEK} GROUP BY app_version""",
    "report_error_spikes": _with(_EVENTS, _HEALTH) + f"""SELECT *, round(error_count::DOUBLE / total_count, 4) AS error_rate FROM app_health WHERE {_YESTERDAY} AND error_count > 0
        ORDER BY error_rate DESC, hour, app_version, event_type LIMIT 20""",
    "report_funnel_overview": _with(_EVENTS, _FUNNEL) + f"""SELECT event_type, sum(event_count)::BIGINT AS total_events, sum(success_count)::BIGINT AS successful, {_rate("success_count", "event_count")} AS success_rate,
        sum(unique_users)::BIGINT AS unique_users FROM funnel WHERE {_YESTERDAY} GROUP BY event_type""",
    "report_funnel_by_version": _with(_EVENTS, _FUNNEL) + f"SELECT app_version, event_type, sum(event_count)::BIGINT AS total_events, sum(unique_users)::BIGINT AS unique_users FROM funnel WHERE {_YESTERDAY} GROUP BY ALL",
    "report_funnel_by_system": _with(_EVENTS, _FUNNEL) + f"SELECT device_os, event_type, sum(event_count)::BIGINT AS total_events, sum(unique_users)::BIGINT AS unique_users FROM funnel WHERE {_WEEK} GROUP BY ALL",
    "report_revenue_ranking": _with(_REVENUE) + f"SELECT item, sum(units_sold)::BIGINT AS total_units, sum(total_revenue)::BIGINT AS revenue, sum(unique_buyers)::BIGINT AS unique_buyers FROM revenue WHERE {_WEEK} GROUP BY item",
    "report_revenue_by_hour_of_day": _with(_REVENUE) + f"SELECT hour(hour)::INT AS hour_of_day, sum(units_sold)::BIGINT AS total_units, sum(total_revenue)::BIGINT AS revenue FROM revenue WHERE {_YESTERDAY} GROUP BY ALL",
    "report_revenue_trend": _with(_REVENUE) + f"SELECT hour::DATE AS day, sum(total_revenue)::BIGINT AS daily_revenue, sum(units_sold)::BIGINT AS daily_units FROM revenue WHERE {_MONTH} GROUP BY ALL",
    "report_funnel_success": _with(_EVENTS, _FUNNEL) + f"SELECT event_type, sum(event_count)::BIGINT AS total, {_rate('success_count', 'event_count', 1, '100 * ')} AS success_pct FROM funnel GROUP BY event_type",
    "report_top_items": _with(_REVENUE) + "SELECT item, sum(units_sold)::BIGINT AS units, sum(total_revenue)::BIGINT AS revenue FROM revenue GROUP BY item ORDER BY revenue DESC, item LIMIT 5",
    "upsert_insert_only": _with(_TX, _STATES) + "SELECT * FROM old UNION ALL SELECT * FROM new WHERE (transaction_id, branch_id) NOT IN (SELECT (transaction_id, branch_id) FROM old)",
    "upsert_update": _with(_TX, _STATES) + "SELECT * FROM new UNION ALL SELECT * FROM old WHERE (transaction_id, branch_id) NOT IN (SELECT (transaction_id, branch_id) FROM new)",
    "upsert_keep_created": _with(_TX, _STATES) + """SELECT n.transaction_id, n.branch_id, n.order_status, coalesce(o.created_at, n.created_at) AS created_at, n.updated_at
        FROM new n LEFT JOIN old o ON n.transaction_id = o.transaction_id AND n.branch_id = o.branch_id
        UNION ALL SELECT * FROM old WHERE (transaction_id, branch_id) NOT IN (SELECT (transaction_id, branch_id) FROM new)""",
    "change_feed": _with(_TX, _STATES) + """, a AS (SELECT * FROM old WHERE (transaction_id, branch_id) IN (SELECT (transaction_id, branch_id) FROM new)), b AS (SELECT * FROM new WHERE (transaction_id, branch_id) IN (SELECT (transaction_id, branch_id) FROM old))
        SELECT *, 'update_preimage' AS _change FROM a UNION ALL SELECT *, 'update_postimage' FROM b
        UNION ALL SELECT *, 'delete' FROM old WHERE (transaction_id, branch_id) NOT IN (SELECT (transaction_id, branch_id) FROM new)
        UNION ALL SELECT *, 'insert' FROM new WHERE (transaction_id, branch_id) NOT IN (SELECT (transaction_id, branch_id) FROM old)""",
    "scd2_customers": _with(_CUSTOMERS) + """SELECT customer_id, upper(full_name) AS full_name, CASE WHEN k % 2 = 0 THEN updated_at - INTERVAL 9 DAY ELSE updated_at END AS updated_at, k % 2 <> 0 AS is_current,
            CASE WHEN k % 2 = 0 THEN updated_at - INTERVAL 9 DAY ELSE updated_at END AS valid_from, CASE WHEN k % 2 = 0 THEN updated_at END AS valid_to FROM latest WHERE registered_datetime < TIMESTAMP '2024-01-07'
        UNION ALL SELECT customer_id, full_name, updated_at, true, updated_at, NULL FROM latest WHERE registered_datetime >= TIMESTAMP '2024-01-07' OR k % 2 = 0""",
    "constraint_violations": _with(_TX) + """SELECT unnest(['valid_order_status', 'valid_channel', 'valid_user_type', 'paid', 'small', 'has_customer']) AS rule,
        unnest([count(*) FILTER (NOT regexp_matches(order_status, '^[WRODICBPF]$')), count(*) FILTER (channel NOT IN ('offline', 'online')), count(*) FILTER (user_type NOT IN (1, 2, 3)), count(*) FILTER (order_status = 'F'), count(*) FILTER (order_total_amount >= 200000), count(*) FILTER (customer_id IS NULL)]) AS n_violations FROM silver""",
    "quarantined_transactions": _with(_TX) + """SELECT trans_id, branch_id, concat_ws(',', CASE WHEN order_status = 'F' THEN 'paid' END, CASE WHEN order_total_amount >= 200000 THEN 'small' END, CASE WHEN customer_id IS NULL THEN 'has_customer' END) AS broken
        FROM silver WHERE order_status = 'F' OR order_total_amount >= 200000 OR customer_id IS NULL""",
    "compacted_orders": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "zordered_orders": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "job_bronze_customers": _with(_CUSTOMERS) + """SELECT customer_id, CASE WHEN k % 20 <> 0 THEN segment END AS first_name, CASE WHEN k % 20 > 1 THEN ' Customer  ' || (k % 100) END AS last_name,
        CASE WHEN k % 11 <> 0 THEN CASE WHEN k % 13 = 0 THEN '12' ELSE '09' || lpad(k::VARCHAR, 8, '0') END END AS phone, DATE '1980-01-01' + (k % 9000)::INT AS dob, (k % 80)::INT AS age, (k % 3)::INT AS gender,
        CASE WHEN k % 17 <> 0 THEN CASE WHEN k % 19 = 0 THEN '' ELSE 'Street ' || k || ', ' || n_name END END AS address_line, CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END::INT AS is_deleted,
        created_at AS registered_datetime, created_at, updated_at, CASE WHEN k % 2 = 0 THEN 'pos' ELSE 'web' END AS source, strftime(updated_at, '%Y%m') AS report_month, strftime(updated_at, '%Y%m%d') AS report_date FROM people""",
    "job_silver_events_cart": _with(_EVENTS, _CART) + "SELECT * FROM cart",
    "job_silver_transactions": _with(_TX) + """, loads AS (SELECT *, strftime(transaction_datetime, '%Y%m') AS ym, strftime(transaction_datetime, '%Y%m%d') AS ymd, CASE WHEN updated_at < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS batch FROM versions),
        batches AS (SELECT unnest([1, 2]) AS batch),
        registry AS (SELECT b.batch, customer_id, min(ymd) AS nou_ymd FROM batches b JOIN loads l ON l.batch <= b.batch WHERE customer_id IS NOT NULL GROUP BY ALL),
        ordered_in AS (SELECT DISTINCT b.batch, customer_id, ym FROM batches b JOIN loads l ON l.batch <= b.batch WHERE customer_id IS NOT NULL),
        newest AS (SELECT * FROM loads QUALIFY row_number() OVER (PARTITION BY batch, transaction_id, branch_id ORDER BY updated_at DESC, old, order_status) = 1),
        judged AS (
            SELECT n.*, r.nou_ymd, CASE WHEN n.customer_id IS NULL THEN NULL WHEN r.nou_ymd[1:6] = n.ym THEN 1 WHEN o.customer_id IS NOT NULL THEN 2 ELSE 3 END::INT AS user_type,
                CASE WHEN n.ymd = r.nou_ymd AND row_number() OVER (PARTITION BY n.batch, n.customer_id ORDER BY transaction_datetime, transaction_id, branch_id) = 1 THEN 1 ELSE 0 END::INT AS NOU
            FROM newest n LEFT JOIN registry r ON r.batch = n.batch AND r.customer_id = n.customer_id
            LEFT JOIN ordered_in o ON o.batch = n.batch AND o.customer_id = n.customer_id AND o.ym = strftime(strptime(n.ym || '01', '%Y%m%d') - INTERVAL 1 MONTH, '%Y%m')
        )
        SELECT ym AS trans_month, transaction_datetime::DATE AS trans_date, strftime(transaction_datetime, '%H:%M:%S') AS trans_time, (epoch_us(transaction_datetime) // 1000000)::BIGINT AS "timestamp",
            concat_ws('_', ymd, customer_id, transaction_id) AS trans_id, customer_id, user_type, NOU, nou_ymd, branch_id, channel, order_status, payment_type, trans_total_amount AS order_total_amount,
            transaction_datetime AS created_at, updated_at, ym, ymd
        FROM judged QUALIFY row_number() OVER (PARTITION BY transaction_id, branch_id ORDER BY batch DESC) = 1""",
    "job_gold_sales": _with(_TX) + f"""SELECT snapshot_date, customer_id, branch_id, user_type, channel, payment_type, strftime(snapshot_date, '%Y%m') AS ym, strftime(snapshot_date, '%Y%m%d') AS ymd,
        {_group("processing", "'W', 'O', 'D', 'P'")}, {_group("recognized", "'I'")}, {_group("returned", "'B'")}, {_group("cancelled", "'C', 'R'")}
        FROM silver, (SELECT unnest([DATE '1998-06-15', DATE '1998-06-16']) AS snapshot_date)
        WHERE (order_status IN ('W', 'O', 'D', 'P') AND trans_date <= snapshot_date) OR (order_status IN ('I', 'B', 'C', 'R') AND updated_at::DATE = snapshot_date) GROUP BY ALL""",
    "stream_alerts": _with(_SALES) + """SELECT CASE kind WHEN 'purchase' THEN 'sms' WHEN 'error' THEN 'email' ELSE 'push' END AS channel, user_id,
        CASE kind WHEN 'purchase' THEN 'Confirmed: ' || item || ' [' || array_to_string(['A1', 'A2', 'A3'][1:units], ', ') || ']'
            WHEN 'error' THEN 'Payment failed for ' || item || ': ' || CASE WHEN n % 2 = 0 THEN 'no funds' ELSE 'Unknown error' END ELSE 'Offer for ' || item END AS message
        FROM sale WHERE (kind = 'purchase' AND ok) OR kind IN ('error', 'view')""",
    "stream_running_sales": _with(_SALES) + "SELECT coalesce(sum(units), 0)::BIGINT AS units_sold, (coalesce(sum(units), 0) * 150000)::BIGINT AS revenue FROM sale WHERE kind = 'purchase' AND ok",
}

_VERSIONS = """
    v AS (
        SELECT customer_id, CASE WHEN k % 20 <> 0 THEN segment END AS first_name, updated_at, CASE WHEN updated_at < TIMESTAMP '2024-01-05' THEN '20240104' ELSE '20240105' END AS load
        FROM people QUALIFY row_number() OVER (PARTITION BY customer_id, load ORDER BY updated_at DESC) = 1
    ),
    n AS (SELECT *, lead(updated_at) OVER c AS next_at, lag(load) OVER c AS load_before FROM v WINDOW c AS (PARTITION BY customer_id ORDER BY load))"""

# Jobs and streams end at what their transformations give of the whole input.
ORACLES |= {
    "job_bronze_transactions": ORACLES["bronze_transactions"],
    "job_bronze_transaction_details": ORACLES["bronze_transaction_details"],
    "job_silver_customers": _with(_CUSTOMERS) + "SELECT * EXCLUDE (k, _cdc_operation) FROM latest",
    "report_users_by_day": ORACLES["exact_users_by_day"],
    "report_users_by_system": _with(_EVENTS) + "SELECT device_os, event_type, count(DISTINCT user_id) AS unique_users FROM ev WHERE event_time >= DATE '2024-01-20' - INTERVAL 7 DAY GROUP BY ALL",
    "report_buyers_by_item": f"SELECT 'item ' || (event_id % 50) AS item, count(DISTINCT user_id) AS unique_users FROM events WHERE event_type = 'purchase' AND {_WEEK.replace('hour', 'ts')} GROUP BY ALL",
    "job_bronze_changes": ORACLES["job_bronze_customers"],
    "job_history_customers": _with(_CUSTOMERS, _VERSIONS) + """SELECT customer_id, first_name, updated_at, updated_at AS valid_from, next_at AS valid_to,
        CASE WHEN next_at IS NULL THEN 'open' ELSE '20240105' END AS closed_in FROM n""",
    "job_history_changes": _with(_CUSTOMERS, _VERSIONS) + """SELECT customer_id, first_name, updated_at, CASE WHEN load_before IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change, load FROM n
        UNION ALL SELECT customer_id, first_name, updated_at, 'update_preimage', '20240105' FROM n WHERE next_at IS NOT NULL""",
    "job_silver_late_events": ORACLES["silver_events_cart"],
    "job_gold_events_cart": ORACLES["gold_events_cart"],
    "job_published_sales": ORACLES["gold_daily_customer_sales"],
    "stream_ingest_restarted": ORACLES["bronze_events"],
    "stream_sales_by_item": _with(_SALES) + "SELECT item, coalesce(sum(units), 0)::BIGINT AS units_sold, (coalesce(sum(units), 0) * 150000)::BIGINT AS revenue FROM sale WHERE kind = 'purchase' AND ok GROUP BY item",
}
