"""The registered queries in ANSI SQL over the raw tables, written independently of the jobs."""

from __future__ import annotations

SALES_TODAY = "DATE '2001-08-02'"
SHIPPING_TODAY = "DATE '2000-01-01'"
EVENTS_TODAY = "DATE '2024-01-31'"
BOUND_DAY = "DATE '1998-06-30'"


def _list(*words: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


SALE_COUNTRIES = _list("usa", "United Kingdom", "DE", "france", "Italia", "canada", "in", "Atlantis")
MASTER_COUNTRIES = _list("United States", " uk ", "Germany", "FR", "italy", "CA", "IN", "es")
SALE_ISO = _list("US", "GB", "DE", "FR", "IT", "CA", "IN", "XX")
MASTER_ISO = _list("US", "GB", "DE", "FR", "IT", "CA", "IN", "ES")
CARRIERS = _list("UPS", "FEDEX", "DHL", "USPS")
REASONS = _list("DAMAGED", "WRONG_ITEM", "LATE", "NOT_NEEDED", "OTHER")
CHANNELS = _list("email", "search", "social")


def _pick(words: str, number: str, n: int) -> str:
    return f"{words}[CAST({number} % {n} AS INTEGER) + 1]"


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def _day(x: str) -> str:
    return f"CAST(CAST({x} AS DATE) AS VARCHAR)"


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _int(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _ratio(a: str, b: str, digits: int) -> str:
    """Exact ratio of two amounts with at most two decimals, rounded half up; null when undefined."""
    over, under = (f"CAST(CAST({x} AS DECIMAL(18,2)) * 100 AS HUGEINT)" for x in (a, b))
    scaled = f"(abs({over}) * {2 * 10**digits} + {under}) // NULLIF(2 * {under}, 0)"
    return f"CAST(sign({over}) * ({scaled}) AS DOUBLE) / {10**digits}"


_TOTAL = (
    "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(14,2))"
)

# Shared inputs, each as one common table expression.
_INPUTS = {
    "fact_sales": f"""
        SELECT 'INV-' || o_orderkey AS invoice_no, o_custkey AS customer_sk, l_partkey AS product_sk,
               CAST(l_quantity AS BIGINT) AS quantity, {_TOTAL} AS line_total,
               {_pick(SALE_COUNTRIES, 'c_nationkey', 8)} AS country,
               {_pick(SALE_ISO, 'c_nationkey', 8)} AS iso,
               CAST(o_orderdate AS DATE) AS sale_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "fact_shipments": f"""
        SELECT l_orderkey || '-' || l_linenumber AS shipment_id, 'INV-' || l_orderkey AS invoice_no,
               {_pick(CARRIERS, 'l_suppkey', 4)} AS carrier, l_shipdate AS shipped_ts,
               CASE WHEN l_linestatus <> 'O' THEN l_shipdate + l_linenumber * INTERVAL 12 HOUR END AS delivered_ts
        FROM lineitem""",
    "fact_returns": f"""
        SELECT 'INV-' || l_orderkey AS invoice_no, l_partkey AS product_sk, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS refund_amount,
               {_pick(REASONS, 'l_partkey', 5)} AS reason_code,
               CAST(l_shipdate AS DATE) + l_linenumber AS return_date
        FROM lineitem WHERE l_returnflag = 'R'""",
    "store": """
        SELECT s_suppkey AS store_sk, r_name AS region
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "pos": """
        SELECT o_orderkey AS txn_id, o_orderkey % 10 AS store_sk, CAST(o_custkey AS VARCHAR) AS customer_id,
               'INV-' || o_orderkey AS invoice_no, o_orderdate AS txn_ts, o_orderkey % 7 + 1 AS line_count,
               CAST(o_totalprice AS DECIMAL(14,2)) AS gross, CAST(o_custkey % 50 AS DECIMAL(14,2)) AS discount,
               CAST(o_custkey % 20 AS DECIMAL(14,2)) AS tax, o_orderpriority AS tender_type,
               o_orderstatus = 'P' AS void_flag
        FROM orders""",
    "movements": """
        SELECT 'P-' || l_partkey AS sku, l_suppkey % 10 AS warehouse_sk, CAST(l_quantity AS BIGINT) AS quantity,
               CASE WHEN l_linenumber <= 2 THEN 'RECEIPT' WHEN l_linenumber = 3 THEN 'SHIP' ELSE 'PICK' END AS kind,
               l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS ts, l_partkey % 5000 + 1000 AS ms,
               l_partkey % 90 + l_linenumber AS cost
        FROM lineitem""",
    "keyed_orders": """
        SELECT o_orderkey, o_orderdate,
               strftime(o_orderdate, '%Y%m%d') || '_' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') AS date_ts
        FROM orders""",
    "web_log": f"""
        SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_ts, (event_id % 256) || '.0.0.1' AS ip,
               '/page/' || event_type AS url, CAST(user_id AS VARCHAR) AS user_id, 'City' || (user_id % 9) AS city,
               {_pick(SALE_COUNTRIES, 'user_id', 8)} AS country, 'S' || (user_id % 5) AS state,
               strftime(ts, '%Y%m%d_%H') AS date_ts
        FROM events""",
    "sessions": """
        SELECT *, CAST(user_sk AS VARCHAR) || '-' || CAST(sum(is_start) OVER (
                   PARTITION BY user_sk ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id
        FROM (SELECT event_id, user_id AS user_sk, ts AS event_ts, event_type, 'screen-' || event_type AS screen,
                     CAST(floor(value) AS BIGINT) AS amount, props, CASE WHEN event_type <> 'view' THEN 'item-' || (event_id % 50) END AS target,
                     ['iOS', 'Android', 'web'][user_id % 3 + 1] AS platform, ['US', 'DE', 'JP'][user_id % 3 + 1] AS country,
                     CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE
                          THEN 1 ELSE 0 END AS is_start
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
    "kpi": """
        SELECT warehouse_sk, hour, units_in, units_picked, units_shipped, ms, picks,
               sum(units_in - units_shipped) OVER (PARTITION BY warehouse_sk ORDER BY hour
                                                   ROWS UNBOUNDED PRECEDING) AS backlog
        FROM (SELECT warehouse_sk, date_trunc('hour', ts) AS hour,
                     sum(CASE WHEN kind = 'RECEIPT' THEN quantity ELSE 0 END) AS units_in,
                     sum(CASE WHEN kind = 'SHIP' THEN quantity ELSE 0 END) AS units_shipped,
                     sum(quantity) AS units_picked, sum(ms) AS ms, count(*) AS picks
              FROM movements GROUP BY ALL)""",
}


def _with(inputs: str, body: str) -> str:
    names = inputs.split()
    return "WITH " + ",\n".join(f"{n} AS ({_INPUTS[n]})" for n in names) + "\n" + body


def _bucket(orders: str, days: str) -> str:
    return f"""CASE WHEN {orders} = 0 THEN 'never' WHEN {days} <= 30 THEN 'active' WHEN {days} <= 90 THEN 'warm'
                    WHEN {days} <= 365 THEN 'cold' ELSE 'churned' END"""


_PROFILE = """
    SELECT 'orders' AS "table", count(*) AS row_count, count(DISTINCT CAST(o_orderdate AS DATE)) AS partition_count
    FROM keyed_orders {where}
    UNION ALL SELECT 'events', count(*), count(DISTINCT CAST(ts AS DATE)) FROM events"""
_BOUNDED = f"WHERE CAST(o_orderdate AS DATE) <= {BOUND_DAY}"
_CUSTOMER_PROFILE = " UNION ALL SELECT 'customer', count(*), CAST(NULL AS BIGINT) FROM customer"


def _parity(measure: str, where: str, customer: bool) -> str:
    have = _PROFILE.format(where=_BOUNDED) + _CUSTOMER_PROFILE
    want = _PROFILE.format(where="")
    return _with("keyed_orders", f""", have AS ({have}), want AS ({want})
        SELECT have."table", want.{measure} AS expected, have.{measure} AS actual,
               CASE WHEN want.{measure} IS NULL THEN 'SKIPPED' WHEN want.{measure} = have.{measure} THEN 'PASS'
                    ELSE 'FAIL' END AS status
        FROM have LEFT JOIN want ON have."table" = want."table" {where}""")


def _history(key: str, attributes: str, source: str, order: str, ts: str, show, more: str = "", reason: bool = True) -> str:
    names = [a.strip() for a in attributes.split(",")]
    changed = " OR ".join(f"{a} IS DISTINCT FROM lag({a}) OVER w" for a in names)
    return f"""
        WITH states AS ({source}),
        flagged AS (SELECT *, row_number() OVER w = 1 AS first_state, {changed} OR row_number() OVER w = 1 AS changed
                    FROM states
                    WINDOW w AS (PARTITION BY {key} ORDER BY {order}))
        SELECT {key}, {attributes}, {show(ts)} AS eff_from, {more}
               {show(f'lead({ts}) OVER w')} AS eff_to, lead({ts}) OVER w IS NULL AS is_current
               {", CASE WHEN first_state THEN 'initial' ELSE 'change' END AS change_reason" if reason else ""}
        FROM flagged WHERE changed WINDOW w AS (PARTITION BY {key} ORDER BY {order})"""


ORACLE: dict[str, str] = {
    # ------------------------------------------------------------ views
    "daily_sales_by_country": _with("fact_sales", f"""
        SELECT {_day('sale_date')} AS sale_date, country, count(DISTINCT invoice_no) AS orders,
               {_dbl('sum(line_total)')} AS revenue, {_int('sum(quantity)')} AS units,
               count(DISTINCT customer_sk) AS active_customers,
               round({_dbl('sum(line_total)')} / count(DISTINCT invoice_no), 6) AS aov,
               round({_dbl('sum(quantity)')} / count(DISTINCT invoice_no), 6) AS basket_size
        FROM fact_sales GROUP BY fact_sales.sale_date, country"""),
    "weekly_running_totals": _with("fact_sales", f""", weekly AS (
            SELECT CAST(floor((sale_date - DATE '1900-01-01') / 7.0) AS BIGINT) AS d_week_seq,
                   CAST(year(sale_date) AS BIGINT) AS d_year,
                   sum(line_total) AS wk_revenue, sum(quantity) AS wk_units
            FROM fact_sales GROUP BY 1, 2)
        SELECT d_week_seq, d_year, {_dbl('wk_revenue')} AS wk_revenue, {_int('wk_units')} AS wk_units,
               {_dbl('sum(wk_revenue) OVER (PARTITION BY d_year ORDER BY d_week_seq)')} AS ytd_revenue,
               round({_dbl('sum(wk_revenue) OVER r')} / count(*) OVER r, 2) AS rolling_13wk_avg,
               {_dbl('lag(wk_revenue, 52) OVER (ORDER BY d_week_seq, d_year)')} AS same_week_last_year,
               {_dbl('wk_revenue - coalesce(lag(wk_revenue, 52) OVER (ORDER BY d_week_seq, d_year), 0)')} AS yoy_delta
        FROM weekly WINDOW r AS (ORDER BY d_week_seq, d_year ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)"""),
    "customer_ltv": _with("fact_sales", f""", per_customer AS (
            SELECT c_custkey AS customer_sk, CAST(c_custkey AS VARCHAR) AS customer_id,
                   {_pick(MASTER_COUNTRIES, 'c_nationkey', 8)} AS country,
                   min(sale_date) AS first_day, max(sale_date) AS last_day,
                   count(DISTINCT invoice_no) AS orders, sum(line_total) AS revenue
            FROM customer LEFT JOIN fact_sales ON customer_sk = c_custkey GROUP BY 1, 2, 3)
        SELECT customer_sk, customer_id, country, {_day('first_day')} AS first_order_date,
               {_day('last_day')} AS last_order_date, orders, {_dbl('revenue')} AS lifetime_revenue,
               {_int(f'{SALES_TODAY} - last_day')} AS recency_days,
               {_bucket('orders', f'({SALES_TODAY} - last_day)')} AS rfm_bucket
        FROM per_customer"""),
    "product_performance": _with("fact_sales", f""", sold AS (
            SELECT p_partkey AS product_sk, 'P-' || p_partkey AS stock_code, p_name AS description, country,
                   sum(line_total) AS revenue, sum(quantity) AS units, count(DISTINCT invoice_no) AS orders
            FROM part JOIN fact_sales ON product_sk = p_partkey GROUP BY 1, 2, 3, 4)
        SELECT product_sk, stock_code, description, country, {_dbl('revenue')} AS revenue,
               {_int('units')} AS units, orders,
               rank() OVER (PARTITION BY country ORDER BY sold.revenue DESC) AS country_rank,
               dense_rank() OVER (ORDER BY sold.revenue DESC) AS global_rank
        FROM sold"""),
    "cohort_retention": _with("fact_sales", f""", first_order AS (
            SELECT customer_sk, min(sale_date) AS first_day FROM fact_sales GROUP BY 1)
        SELECT strftime(first_day, '%Y-%m') AS cohort_month,
               {_int("date_diff('month', first_day, sale_date)")} AS months_since_first,
               count(DISTINCT fact_sales.customer_sk) AS active_customers
        FROM fact_sales JOIN first_order ON fact_sales.customer_sk = first_order.customer_sk GROUP BY 1, 2"""),
    "session_attribution": f"""
        SELECT CAST(s.user_id AS VARCHAR) AS user_id, {_ts('s.ts')} AS session_ts,
               'https://ref/' || s.event_type AS referrer, 'EV-' || f.event_id AS invoice_no,
               {_ts('f.ts')} AS order_ts, {_dbl('CAST(f.value AS DECIMAL(14,2))')} AS line_total
        FROM events s LEFT JOIN customer ON c_custkey = s.user_id
        LEFT JOIN events f ON f.event_type = 'purchase' AND f.user_id = c_custkey
                          AND f.ts BETWEEN s.ts AND s.ts + INTERVAL 1 DAY
        WHERE s.event_type IS DISTINCT FROM 'purchase'""",
    "active_member_panel": _with("store", f"""
        SELECT region, count(DISTINCT user_id) AS exact_active_members,
               {_int('sum(CAST(floor(value) AS BIGINT))')} AS total_points_redeemed
        FROM events LEFT JOIN store ON store_sk = event_id % 10
        WHERE event_type = 'click' AND CAST(ts AS DATE) >= {EVENTS_TODAY} - 30 GROUP BY region"""),
    "sales_rollup": _with("fact_sales store", f"""
        SELECT region, store_sk, {_dbl('sum(line_total)')} AS total_revenue, count(*) AS line_count,
               {_int('GROUPING(region, store_sk)')} AS grouping_level
        FROM fact_sales JOIN store ON store_sk = customer_sk
        WHERE sale_date >= {SALES_TODAY} - 7 GROUP BY ROLLUP (region, store_sk)"""),
    "category_tree": """
        SELECT 'R' || r_regionkey AS category_id, r_name AS name, CASE WHEN r_regionkey % 2 = 0 THEN '' END AS parent_id,
               r_name AS path, 0::BIGINT AS depth FROM region
        UNION ALL
        SELECT 'N' || n_nationkey, n_name, 'R' || r_regionkey, concat_ws(' > ', r_name, n_name), 1
        FROM region JOIN nation ON n_regionkey = r_regionkey
        UNION ALL
        SELECT 'S' || s_suppkey, s_name, 'N' || n_nationkey, concat_ws(' > ', r_name, n_name, s_name), 2
        FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey""",
    "carrier_otd": _with("fact_shipments", f"""
        SELECT carrier, count(*) AS shipments,
               round(avg(CASE WHEN delivered_ts <= shipped_ts + INTERVAL 48 HOUR THEN 1.0 ELSE 0.0 END), 6) AS otd_rate,
               round(avg(epoch(delivered_ts) - epoch(shipped_ts)) / 3600.0, 6) AS avg_transit_hours
        FROM fact_shipments WHERE shipped_ts >= CAST({SHIPPING_TODAY} - 30 AS TIMESTAMP) GROUP BY carrier"""),
    "panel_continuity": _with("fact_sales", f"""
        SELECT customer_sk, count(DISTINCT sale_date) AS active_days, count(DISTINCT product_sk) AS distinct_products,
               {_dbl('sum(line_total)')} AS total_spend
        FROM fact_sales JOIN customer ON c_custkey = customer_sk AND {_pick(MASTER_ISO, 'c_nationkey', 8)} = iso
        WHERE sale_date >= {SALES_TODAY} - 90 GROUP BY customer_sk"""),
    "orders_with_consent": f"""
        WITH consent AS (
            SELECT c_custkey, pos, ['MARKETING', 'MARKETING', 'ANALYTICS'][pos + 1] AS kind,
                   (c_custkey + pos) % 4 <> 0 AS granted,
                   TIMESTAMP '1995-01-01' + (c_custkey % 300) * INTERVAL 1 DAY AS granted_ts,
                   CASE WHEN pos = 0 AND c_custkey % 5 = 0 THEN TIMESTAMP '1998-01-01'
                        WHEN pos = 1 AND c_custkey % 3 = 0 THEN TIMESTAMP '2000-06-15' END AS withdrawn_ts
            FROM customer, (VALUES (0), (1), (2)) v(pos))
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               upper({_pick(SALE_COUNTRIES, 'cu.c_nationkey', 8)}[1:2]) AS country_iso2,
               {_dbl('CAST(o_totalprice AS DECIMAL(14,2))')} AS line_total, 'EUR' AS currency_code,
               coalesce(granted, FALSE) AS marketing_consent, {_ts('granted_ts')} AS consent_granted_ts
        FROM orders JOIN customer cu ON cu.c_custkey = o_custkey
        LEFT JOIN consent c ON c.c_custkey = o_custkey AND kind = 'MARKETING' AND granted
                           AND (withdrawn_ts IS NULL OR withdrawn_ts > o_orderdate)""",
    "returns_pending": f"""
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS rma_id,
               CAST(o_custkey AS VARCHAR) AS customer_id, 'INV-' || l_orderkey AS invoice_no,
               'P-' || l_partkey AS stock_code, CAST(l_quantity AS BIGINT) AS quantity,
               {_ts('l_shipdate')} AS requested_at, {_int(f'{SALES_TODAY} - CAST(l_shipdate AS DATE)')} AS days_pending
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' AND l_linenumber % 3 <> 2""",
    "fraud_recent": f"""
        SELECT CAST(user_id AS VARCHAR) AS customer_id, event_type AS signal_type,
               round(event_id % 1000 / 1000.0, 6) AS score, strftime(ts, '%Y%m%d') AS signal_date,
               {_ts('ts')} AS signal_ts
        FROM events WHERE strftime(ts, '%Y%m%d') >= '20240119'""",
    "omniture": _with("web_log", "SELECT * FROM web_log"),
    # ------------------------------------------------------------ functions
    "country_code": _with(
        "fact_sales", "SELECT country, iso AS country_code, count(*) AS n FROM fact_sales GROUP BY country, iso"
    ),
    "email_hash": "SELECT c_custkey, sha256(lower(c_name) || '@example.com') AS email_hash FROM customer",
    "sku_parts": """
        SELECT p_partkey, sku, CASE WHEN regexp_full_match(sku, '[A-Z]{2}-[0-9]{3,5}-[0-9]{1,3}')
                                    THEN replace(sku, '-', '|') ELSE 'UNKNOWN|0|0' END AS sku_parts
        FROM (SELECT p_partkey, upper(p_name[1:2]) || '-' || p_partkey || '-' || p_size AS sku FROM part)""",
    "ip_region": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN 'x' ELSE '' END || o || '.7.7.7' AS ip,
               CASE WHEN event_type = 'error' THEN 'Unknown' WHEN o IN (10, 192, 172) THEN 'Internal'
                    WHEN o < 64 THEN 'Americas' WHEN o < 128 THEN 'EMEA' WHEN o < 192 THEN 'APAC'
                    ELSE 'Other' END AS ip_region
        FROM (SELECT *, event_id % 260 AS o FROM events)""",
    "payment_terms": """
        SELECT s_suppkey, printf('SUP-%03d', s_suppkey) AS supplier_id,
               CAST(CASE s_suppkey WHEN 2 THEN 45 WHEN 3 THEN 60 ELSE 30 END AS BIGINT) AS payment_term_days
        FROM supplier""",
    "sql_functions": f"""
        SELECT c_custkey, {_pick(SALE_ISO, 'c_nationkey', 8)} AS country,
               sha256(lower(c_name) || '@example.com') AS email,
               CASE WHEN c_custkey BETWEEN 100 AND 99999 THEN 'AB|' || c_custkey || '|7' ELSE 'UNKNOWN|0|0' END AS sku,
               CASE WHEN c_custkey % 256 IN (10, 172, 192) THEN 'Internal' WHEN c_custkey % 256 < 64 THEN 'Americas'
                    WHEN c_custkey % 256 < 128 THEN 'EMEA' WHEN c_custkey % 256 < 192 THEN 'APAC'
                    ELSE 'Other' END AS region,
               CAST(CASE c_custkey WHEN 2 THEN 45 WHEN 3 THEN 60 ELSE 30 END AS BIGINT) AS days
        FROM customer""",
    # ------------------------------------------------------------ ingest steps
    "bound_string": _with("keyed_orders", f"""
        SELECT o_orderkey, date_ts FROM keyed_orders WHERE CAST(o_orderdate AS DATE) <= {BOUND_DAY}"""),
    "bound_ts": f"""
        SELECT o_orderkey, {_ts('o_orderdate')} AS order_ts FROM orders
        WHERE o_orderdate <= TIMESTAMP '1998-06-30 00:00:00'""",
    "bound_date": f"""
        SELECT o_orderkey, {_day('o_orderdate')} AS order_date FROM orders
        WHERE CAST(o_orderdate AS DATE) <= {BOUND_DAY}""",
    "partition_date_from_key": _with("keyed_orders", f"""
        SELECT o_orderkey, date_ts, {_day('o_orderdate')} AS partition_date FROM keyed_orders"""),
    "partition_date_from_parts": f"""
        SELECT o_orderkey, {_day('o_orderdate')} AS partition_date,
               {_day("date_trunc('month', o_orderdate)")} AS partition_month FROM orders""",
    "epoch_ts": f"SELECT o_orderkey, {_ts('o_orderdate')} AS epoch_ms FROM orders",
    "map_json": """
        SELECT event_id, '{"kind":"' || event_type || '","user":"' || user_id || '"}' AS props_json FROM events""",
    "json_fields": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
               CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k FROM events""",
    "conform_types": f"""
        SELECT l_orderkey, {_int('l_linenumber')} AS l_linenumber, {_int('l_quantity')} AS l_quantity,
               {_dbl('CAST(l_extendedprice AS DECIMAL(14,2))')} AS l_extendedprice FROM lineitem""",
    "bounded_scan": _with("fact_sales", f"""
        SELECT {_day('sale_date')} AS sale_date, count(*) AS n, {_dbl('sum(line_total)')} AS revenue
        FROM fact_sales WHERE year(sale_date) = 1997 GROUP BY fact_sales.sale_date"""),
    # ------------------------------------------------------------ readers and writers
    "tsv_feed": """
        SELECT CAST(o_orderkey AS VARCHAR) AS col_1, CAST(o_custkey AS VARCHAR) AS col_2,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS col_3,
               CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS col_4,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS col_5 FROM orders""",
    "json_feed": """
        SELECT event_id, user_id, '{"kind":"' || event_type || '"}' AS properties FROM events""",
    "regex_feed": f"""
        SELECT {_ts("date_trunc('second', ts)")} AS event_ts, 'MBR' || user_id AS member_id,
               CASE WHEN event_type = 'click' THEN 'REDEEM' ELSE 'EARN' END AS event_type,
               CAST(floor(value) AS BIGINT) AS points, 'STORE' || (event_id % 10) AS store_id,
               'TXN' || event_id AS tx_id, '{{"channel":"' || event_type || '","tier":"gold"}}' AS meta,
               {_day('ts')} AS partition_date
        FROM events""",
    "snapshot_feed": f"""
        SELECT event_id, {_ts("date_trunc('millisecond', ts)")} AS last_updated_ts FROM events""",
    "partition_directories": f"""
        SELECT event_id, strftime(ts, '%Y%m%d') AS date_ts, {_day('ts')} AS partition_date FROM events""",
    "table_load": _with("keyed_orders", f"""
        SELECT o_orderkey, date_ts, {_day("date_trunc('month', o_orderdate)")} AS partition_month FROM keyed_orders
        WHERE CAST(o_orderdate AS DATE) <= {BOUND_DAY}"""),
    "load_report": """
        SELECT 'rows' AS name, count(*) AS n FROM orders
        UNION ALL SELECT '_corrupt_record', count(*) FROM orders WHERE o_orderkey % 7 = 0
        UNION ALL SELECT 'o_totalprice', count(*) FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 10 = 0""",
    "clustered_write": _with("fact_sales", f"""
        SELECT {_day("date_trunc('month', fact_sales.sale_date)")} AS sale_month,
               {_day('sale_date')} AS sale_date, count(*) AS n, {_dbl('sum(line_total)')} AS revenue
        FROM fact_sales GROUP BY fact_sales.sale_date"""),
    # ------------------------------------------------------------ checks
    "table_profile": _with("keyed_orders", _PROFILE.format(where=_BOUNDED) + _CUSTOMER_PROFILE),
    "row_parity": _parity("row_count", "", True),
    "partition_parity": _parity("partition_count", "WHERE have.partition_count IS NOT NULL", False),
    "parity_summary": _parity("row_count", "WHERE want.row_count IS NOT NULL", True),
    "null_key_check": _with("fact_shipments", """
        SELECT name AS "column", n AS null_count, CAST(0 AS BIGINT) AS expected,
               CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT 'shipment_id' AS name, count(*) FILTER (shipment_id IS NULL) AS n FROM fact_shipments
              UNION ALL SELECT 'invoice_no', count(*) FILTER (invoice_no IS NULL) FROM fact_shipments
              UNION ALL SELECT 'delivered_ts', count(*) FILTER (delivered_ts IS NULL) FROM fact_shipments)"""),
    "type_conformance": """
        SELECT name AS "column", kind AS declared_type, n AS bad_values,
               CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT 'order_no' AS name, 'bigint' AS kind, CAST(0 AS BIGINT) AS n
              UNION ALL SELECT 'priority', 'bigint',
                               count(*) FILTER (TRY_CAST(o_orderpriority AS BIGINT) IS NULL) FROM orders
              UNION ALL SELECT 'day', 'date', CAST(0 AS BIGINT))""",
    # ------------------------------------------------------------ derived tables
    "cleansed_orders": _with("pos", f""", retail AS (
            SELECT 'R-INV-' || o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
                   'INV-' || o_orderkey AS invoice_no, o_orderdate AS txn_ts, count(*) AS line_count,
                   CAST(sum(CAST(l_quantity AS BIGINT) * (l_linenumber + 1)) AS DECIMAL(14,2)) AS gross,
                   CAST(0 AS DECIMAL(14,2)) AS discount, CAST(0 AS DECIMAL(14,2)) AS tax,
                   CAST(NULL AS VARCHAR) AS tender_type, 'sales_retail' AS source_feed
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, o_orderdate),
        both_feeds AS (
            SELECT * FROM retail
            UNION ALL SELECT 'P-' || txn_id, customer_id, invoice_no, txn_ts, line_count, gross, discount, tax,
                             tender_type, 'pos_transactions' FROM pos WHERE NOT void_flag)
        SELECT order_id, customer_id, invoice_no, {_ts('txn_ts')} AS txn_ts, {_int('line_count')} AS line_count,
               {_dbl('gross')} AS gross_amount, {_dbl('discount')} AS discount, {_dbl('tax')} AS tax, tender_type,
               source_feed, {_dbl('gross - discount + tax')} AS net_amount, {_day('txn_ts')} AS order_date
        FROM both_feeds
        QUALIFY row_number() OVER (PARTITION BY invoice_no ORDER BY both_feeds.txn_ts DESC, source_feed) = 1"""),
    "dedup_clickstream": f"""
        WITH single AS (
            SELECT user_id, date_trunc('hour', ts) AS seen_at, '/p/' || event_type AS page_url,
                   min(CAST(event_id AS VARCHAR)) AS ip
            FROM events GROUP BY 1, 2, 3),
        scored AS (SELECT *, least(1.0, count(*) OVER (PARTITION BY user_id, seen_at) / 8.0) AS score FROM single)
        SELECT CAST(user_id AS VARCHAR) AS user_id, {_ts('seen_at')} AS event_ts, page_url,
               CAST(user_id AS VARCHAR) AS session_id, ip, {_pick(SALE_COUNTRIES, 'user_id', 8)} AS country,
               {_pick(SALE_COUNTRIES, 'user_id', 8)} AS country_partition, 'phone' AS device_type,
               'https://ref/' AS referrer_url, round({_dbl('score')}, 3) AS bot_score,
               strftime(seen_at, '%Y%m%d') AS date_ts, {_day('seen_at')} AS partition_date
        FROM scored WHERE score < 0.5""",
    "carrier_events": f"""
        SELECT 'T-' || l_orderkey || '-' || l_linenumber AS tracking_no, {_pick(CARRIERS, 'l_suppkey', 4)} AS carrier,
               {_pick(_list('PICKED_UP', 'IN_TRANSIT', 'OUT_FOR_DELIVERY', 'DELIVERED', 'EXCEPTION'), 'l_linenumber', 5)}
                   AS event_type,
               {_ts("CASE WHEN l_linestatus <> 'O' THEN l_shipdate + l_linenumber * INTERVAL 12 HOUR ELSE l_shipdate END")}
                   AS event_ts,
               'City' || (l_suppkey % 7) AS location_city, 'Region' AS location_region, 'US' AS location_country,
               strftime(l_shipdate, '%Y%m%d') AS date_ts, {_day('l_shipdate')} AS partition_date
        FROM lineitem
        UNION ALL
        SELECT 'PO-' || o_orderkey, 'POST',
               {_pick(_list('PICKED_UP', 'IN_TRANSIT', 'OUT_FOR_DELIVERY', 'DELIVERED', 'EXCEPTION', 'none'), 'o_orderkey', 6)},
               {_ts("CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 60 HOUR ELSE o_orderdate END")},
               'Depot' || (o_custkey % 5), NULL, NULL, strftime(o_orderdate, '%Y%m%d'), {_day('o_orderdate')}
        FROM orders""",
    "cdc_merge": f"""
        SELECT event_id // 3 AS return_id, 'INV-' || (event_id // 3) AS invoice_no, user_id AS customer_sk,
               {_ts('ts')} AS return_ts, {_dbl('CAST(value AS DECIMAL(12,2))')} AS refund_amount,
               {_pick(REASONS, 'user_id', 5)} AS reason_code, event_type AS status, {_day('ts')} AS snapshot_date, event_type = 'error' AS is_deleted
        FROM events QUALIFY row_number() OVER (PARTITION BY event_id // 3 ORDER BY ts DESC) = 1""",
    "fraud_scored": f"""
        WITH pos AS (
            SELECT event_id AS txn_id, CASE WHEN event_id % 11 > 0 THEN user_id END AS customer, ts AS txn_ts
            FROM events WHERE event_type = 'purchase'),
        signal AS (
            SELECT user_id, ts, event_type, event_id % 1000 / 1000.0 AS score FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id % 1000 DESC, event_type DESC) = 1),
        single AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS seen_at, event_type FROM events),
        click AS (SELECT user_id, seen_at, round({_dbl("least(1.0, count(*) / 8.0)")}, 3) AS bot FROM single GROUP BY ALL),
        last_signal AS (
            SELECT pos.*, s.ts AS signal_ts, s.event_type, s.score FROM pos ASOF LEFT JOIN signal s
            ON pos.customer = s.user_id AND pos.txn_ts >= s.ts),
        known AS (
            SELECT p.*, c.seen_at, greatest(coalesce(score, 0), coalesce(bot, 0)) AS risk, coalesce(bot, 0) >= 0.5 AS is_bot
            FROM last_signal p ASOF LEFT JOIN click c ON p.customer = c.user_id AND p.txn_ts >= c.seen_at)
        SELECT txn_id, CAST(customer AS VARCHAR) AS customer_id, {_dbl('risk')} AS fraud_score,
               CASE WHEN risk >= 0.8 THEN 'HIGH' WHEN risk >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band,
               concat_ws(',', event_type, CASE WHEN is_bot THEN 'bot' END) AS signals,
               {_ts('coalesce(greatest(signal_ts, seen_at), txn_ts)')} AS scored_at, {_day('txn_ts')} AS score_date
        FROM known""",
    "warehouse_kpi": _with("movements kpi", f"""
        SELECT 'W-' || warehouse_sk AS warehouse_id, {_ts('hour')} AS snapshot_ts, {_int('units_in')} AS units_in,
               {_int('units_picked')} AS units_picked, {_int('units_shipped')} AS units_shipped,
               {_ratio('units_picked * 3600000', 'ms', 2)} AS pick_rate_uph, {_int('backlog')} AS backlog_units,
               {_int('ms')} // picks AS avg_pick_ms, strftime(hour, '%Y%m%d') AS date_ts,
               {_day('hour')} AS partition_date
        FROM kpi"""),
    "hourly_warehouse_kpi": _with("movements kpi store", f"""
        SELECT warehouse_sk, {_int('units_in')} AS units_in, {_int('units_picked')} AS units_picked,
               {_int('units_shipped')} AS units_shipped, {_ratio('units_picked * 3600000', 'ms', 2)} AS pick_rate_uph,
               {_int('backlog')} AS backlog_units, {_ratio(f"{_int('ms')} // picks", '1000', 2)} AS avg_pick_seconds,
               strftime(hour, '%Y%m%d%H') AS snapshot_hour
        FROM kpi JOIN store ON store_sk = warehouse_sk"""),
    "inventory_snapshot": _with("movements", f""", daily AS (
            SELECT sku, warehouse_sk, CAST(ts AS DATE) AS day, max(ts) AS last_ts,
                   sum(CASE WHEN kind = 'RECEIPT' THEN quantity ELSE -quantity END) AS delta,
                   sum(CASE WHEN kind = 'RECEIPT' THEN quantity ELSE 0 END) AS received,
                   sum(CASE WHEN kind = 'RECEIPT' THEN quantity * cost END) AS paid,
                   sum(CASE WHEN kind = 'PICK' THEN quantity ELSE 0 END) AS picked,
                   sum(CASE WHEN kind = 'SHIP' THEN quantity ELSE 0 END) AS shipped
            FROM movements GROUP BY 1, 2, 3),
        upto AS (
            SELECT *, sum(delta) OVER w AS on_hand, sum(received) OVER w AS all_received, sum(paid) OVER w AS all_paid,
                   greatest(sum(picked) OVER w - sum(shipped) OVER w, 0) AS allocated
            FROM daily WINDOW w AS (PARTITION BY sku, warehouse_sk ORDER BY day ROWS UNBOUNDED PRECEDING))
        SELECT sku, warehouse_sk, {_day('day')} AS snapshot_date, {_ts('last_ts')} AS last_movement_ts,
               {_int('on_hand')} AS on_hand_units, {_int('allocated')} AS allocated_units,
               {_int('shipped')} AS in_transit_units, {_int('on_hand - allocated')} AS available_units,
               {_ratio('all_paid', 'all_received', 4)} AS avg_cost
        FROM upto"""),
    "daily_sales_by_store": _with("pos", f"""
        SELECT store_sk, {_day('txn_ts')} AS sale_date, {_dbl('sum(gross)')} AS gross_revenue,
               {_dbl('sum(gross - discount)')} AS net_revenue, {_int('sum(line_count)')} AS units_sold,
               count(*) AS txn_count, {_ratio('sum(gross)', 'count(*)', 2)} AS avg_basket
        FROM pos WHERE NOT void_flag GROUP BY store_sk, txn_ts"""),
    "daily_sales_by_product": _with("fact_sales fact_returns", f""", sold AS (
            SELECT product_sk, sale_date AS day, sum(quantity) AS units, sum(line_total) AS revenue
            FROM fact_sales GROUP BY 1, 2),
        back AS (SELECT product_sk, return_date AS day, sum(quantity) AS units FROM fact_returns GROUP BY 1, 2),
        both_sides AS (
            SELECT coalesce(s.product_sk, b.product_sk) AS product_sk, coalesce(s.day, b.day) AS day,
                   coalesce(s.units, 0) AS units, coalesce(s.revenue, 0) AS revenue, coalesce(b.units, 0) AS returned
            FROM sold s FULL JOIN back b ON s.product_sk = b.product_sk AND s.day = b.day),
        costed AS (
            SELECT b.*, CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(3,2)) * CAST(units AS BIGINT)
                             AS DECIMAL(16,2)) AS cogs
            FROM both_sides b LEFT JOIN part ON p_partkey = product_sk)
        SELECT product_sk, {_day('day')} AS sale_date, {_int('units')} AS units_sold,
               {_dbl('revenue')} AS gross_revenue, {_int('returned')} AS return_units, {_dbl('cogs')} AS cogs,
               {_int('units - returned')} AS net_units, {_ratio('revenue - cogs', 'revenue', 4)} AS margin_pct
        FROM costed"""),
    "weekly_customer_ltv": _with("fact_sales", f""", weekly AS (
            SELECT customer_sk, CAST(date_trunc('week', sale_date) AS DATE) AS week, sum(line_total) AS revenue,
                   count(DISTINCT invoice_no) AS orders, max(sale_date) AS last_day
            FROM fact_sales GROUP BY 1, 2),
        upto AS (
            SELECT *, sum(revenue) OVER w AS value, sum(orders) OVER w AS n, week + 6 - last_day AS idle
            FROM weekly WINDOW w AS (PARTITION BY customer_sk ORDER BY week ROWS UNBOUNDED PRECEDING))
        SELECT customer_sk, {_dbl('value')} AS ltv_to_date, {_int('n')} AS orders_to_date,
               {_ratio('value', 'n', 2)} AS avg_order_value, {_int('idle')} AS days_since_last_order,
               {_bucket('n', 'idle')} AS rfm_score, least(1.0, {_ratio('idle', '365', 3)}) AS churn_risk,
               {_day('week')} AS week_start_date
        FROM upto"""),
    "supplier_performance": f"""
        WITH lines AS (
            SELECT l_suppkey, date_trunc('month', o_orderdate) AS month, o_orderkey, o_orderdate, l_shipdate,
                   CAST(l_quantity AS BIGINT) AS ordered, greatest(CAST(l_quantity AS BIGINT) - l_linenumber % 3, 0) AS got,
                   CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS bad, CAST(l_extendedprice AS DECIMAL(14,2)) AS spend
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT l_suppkey AS supplier_sk, {_day('month')} AS month_start, count(DISTINCT o_orderkey) AS orders_placed,
               {_int('sum(got)')} AS units_received,
               {_ratio('count(*) FILTER (l_shipdate <= o_orderdate + INTERVAL 60 DAY)', 'count(*)', 4)} AS on_time_pct,
               {_ratio('sum(got)', 'sum(ordered)', 4)} AS fill_rate_pct,
               {_ratio("sum(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE))", 'count(*)', 2)} AS avg_lead_time_days,
               {_ratio('count(*) - sum(bad)', 'count(*)', 3)} AS quality_score, {_dbl('sum(spend)')} AS total_spend
        FROM lines GROUP BY l_suppkey, month""",
    "carrier_daily": _with("fact_shipments", f"""
        SELECT carrier, {_day('shipped_ts')} AS ship_date, count(*) AS shipments_total,
               count(*) FILTER (delivered_ts <= shipped_ts + INTERVAL 36 HOUR) AS delivered_on_time,
               count(*) FILTER (delivered_ts > shipped_ts + INTERVAL 36 HOUR) AS delivered_late,
               count(*) FILTER (delivered_ts IS NULL) AS in_transit,
               {_ratio('count(*) FILTER (delivered_ts <= shipped_ts + INTERVAL 36 HOUR)', 'count(delivered_ts)', 4)}
                   AS otd_pct,
               {_ratio('sum(epoch(delivered_ts) - epoch(shipped_ts))', 'count(delivered_ts) * 3600', 2)}
                   AS avg_transit_hours
        FROM fact_shipments GROUP BY carrier, shipped_ts"""),
    "attribution_cube": f"""
        WITH sales AS (
            SELECT date_trunc('month', o_orderdate) AS period, {_pick(CHANNELS, 'o_orderkey', 3)} AS channel, o_custkey % 4 AS campaign_sk,
                   'R' || n_regionkey AS region, CAST(o_totalprice AS DECIMAL(14,2)) AS revenue,
                   o_orderkey % 9 AS units, o_orderkey % 1000 * 100 AS cost
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
        SELECT {_day('period')} AS period_date, channel, campaign_sk, region,
               {_dbl('sum(revenue)')} AS attributed_revenue,
               {_int('sum(units)')} AS attributed_units, {_dbl('sum(cost)')} AS cost,
               {_int('GROUPING(channel, campaign_sk, region)')} AS grouping_id,
               {_ratio('sum(revenue)', 'sum(cost)', 4)} AS roas
        FROM sales GROUP BY period, CUBE (channel, campaign_sk, region)""",
    "returns_by_reason": _with("fact_returns fact_sales", f""", sold AS (
            SELECT invoice_no, min(sale_date) AS sale_date FROM fact_sales GROUP BY 1)
        SELECT reason_code, {_day("date_trunc('month', return_date)")} AS month_start, count(*) AS return_count,
               {_int('sum(quantity)')} AS return_units, {_dbl('sum(refund_amount)')} AS total_refunded,
               {_ratio('sum(return_date - sale_date)', 'count(sale_date)', 2)} AS avg_days_to_return
        FROM fact_returns LEFT JOIN sold ON fact_returns.invoice_no = sold.invoice_no
        GROUP BY reason_code, date_trunc('month', return_date)"""),
    "sales_cube": _with("fact_sales", f""", dated AS (
            SELECT *, CAST(year(sale_date) * 100 + month(sale_date) AS BIGINT) AS month_key FROM fact_sales)
        SELECT CAST(CASE GROUPING(country, month_key, product_sk) WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 3 THEN 1
                    ELSE 0 END AS BIGINT) AS dim_level,
               concat_ws('|', country, CAST(month_key AS VARCHAR), CAST(product_sk AS VARCHAR)) AS cube_key,
               country, month_key, product_sk, count(DISTINCT invoice_no) AS orders,
               {_dbl('sum(line_total)')} AS revenue, {_int('sum(quantity)')} AS units, '2001-08-02' AS as_of_date
        FROM dated GROUP BY GROUPING SETS ((country, month_key, product_sk), (country, month_key), (country), ())"""),
    "top_countries": _with("fact_sales", f""", daily AS (
            SELECT sale_date, country, count(DISTINCT invoice_no) AS orders, sum(line_total) AS revenue
            FROM fact_sales GROUP BY 1, 2)
        SELECT {_day('sale_date')} AS as_of_date, country, orders, {_dbl('revenue')} AS revenue,
               rank() OVER (PARTITION BY sale_date ORDER BY daily.revenue DESC) AS "rank"
        FROM daily QUALIFY rank() OVER (PARTITION BY sale_date ORDER BY daily.revenue DESC) <= 3"""),
    "address_history": _history(
        "customer_sk", "address_line1, address_city, address_region, address_country, address_postal",
        """SELECT o_custkey AS customer_sk, o_orderkey, 'Street ' || (o_orderkey % 2) AS address_line1,
                  o_orderstatus AS address_city, 'R' || (o_custkey % 7) AS address_region, 'US' AS address_country,
                  'Z' || (o_orderkey % 3) AS address_postal,
                  o_orderdate + (o_orderkey % 86400) * INTERVAL 1 SECOND AS seen_at FROM orders""",
        "seen_at, o_orderkey", "seen_at", _ts,
    ),
    "supplier_terms_history": _history(
        "supplier_sk", "payment_terms_days, discount_pct",
        """SELECT l_suppkey AS supplier_sk, CAST(min(l_linenumber) * 15 AS BIGINT) AS payment_terms_days,
                  CAST(min(l_linenumber) % 3 AS DOUBLE) AS discount_pct,
                  CAST(l_shipdate AS DATE) AS seen_at FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
        "seen_at", "seen_at", _day, "'buyer' || day(seen_at) AS changed_by,", reason=False,
    ),
    "employee_history": _history(
        "employee_sk", "role, department, home_store_sk, salary_band",
        """SELECT o_custkey AS employee_sk, min(o_orderpriority) AS role, min(o_orderstatus) AS department,
                  CAST(min(o_orderkey) % 2 AS BIGINT) AS home_store_sk, 'B' || (min(o_orderkey) % 2) AS salary_band,
                  CAST(o_orderdate AS DATE) AS seen_at FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)""",
        "seen_at", "seen_at", _day, "CAST(year(seen_at) AS BIGINT) AS eff_from_year,", reason=False,
    ),
    "store_history": _history(
        "store_sk", "store_type, manager_employee_sk, sq_ft",
        """SELECT l_suppkey AS store_sk, min(l_returnflag) AS store_type,
                  CAST(min(l_linenumber) AS BIGINT) AS manager_employee_sk,
                  CAST(max(l_linenumber) * 100 AS BIGINT) AS sq_ft,
                  CAST(l_shipdate AS DATE) AS seen_at FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
        "seen_at", "seen_at", _day,
    ),
    "sessionise": _with("sessions", f"""
        SELECT event_id, user_sk, {_ts('event_ts')} AS event_ts, event_type, screen, amount, session_id,
               {_day('event_ts')} AS event_date, target AS target_id, props AS properties, country AS geo_country, platform,
               'v' || (user_sk % 3) AS version, 'M' || (user_sk % 7) AS model, lower(platform) AS platform_partition
        FROM sessions"""),
    "session_state": _with("sessions", f"""
        SELECT session_id, CAST(arg_max(user_sk, event_ts) AS VARCHAR) AS user_id, {_ts('min(event_ts)')} AS started_ts,
               {_ts('max(event_ts)')} AS last_event_ts,
               {_dbl("sum(CASE WHEN event_type = 'purchase' THEN amount ELSE 0 END)")} AS cart_value,
               count(*) FILTER (event_type = 'purchase') AS cart_items,
               arg_max(screen, event_ts) AS current_screen, any_value(platform) AS platform, any_value(country) AS geo_country
        FROM sessions GROUP BY session_id"""),
    "points_ledger": f"""
        WITH entries AS (
            SELECT event_id, user_id, ts, CASE WHEN event_type = 'click' THEN 'REDEEM' ELSE 'EARN' END AS kind,
                   CASE WHEN event_type = 'click' THEN -1 ELSE 1 END * CAST(floor(value) AS BIGINT) AS delta
            FROM events)
        SELECT event_id AS entry_id, 'M' || user_id AS member_id, {_int('delta')} AS points_delta,
               {_ts('ts')} AS event_ts, kind AS event_type, 'TX' || event_id AS reference_id,
               {_ts("CASE WHEN kind = 'EARN' THEN ts + INTERVAL 365 DAY END")} AS expiry_ts,
               {_int('sum(delta) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)')}
                   AS running_balance
        FROM entries""",
    "supplier_invoice_lines": f"""
        WITH lines AS (
            SELECT *, 1 AS line_no, 'P-' || l_partkey AS sku, CAST(l_quantity AS BIGINT) AS qty,
                   l_partkey % 90 + 1 AS price FROM lineitem
            UNION ALL SELECT *, 2, 'FREIGHT', 1, l_linenumber * 3 FROM lineitem)
        SELECT 'SI-' || l_orderkey || '-' || l_partkey AS invoice_no, {_int('line_no')} AS line_no,
               l_suppkey AS supplier_sk, sku, qty AS quantity, {_dbl('price')} AS unit_cost,
               {_dbl('qty * price')} AS line_total, 'EUR' AS currency_code, {_ts('l_shipdate')} AS received_ts,
               {_int('year(l_shipdate)')} AS invoice_year, {_int('month(l_shipdate)')} AS invoice_month,
               {_day("date_trunc('month', l_shipdate)")} AS partition_month
        FROM lines""",
    "tracking_history": """
        WITH scans AS (
            SELECT 'SH-' || l_orderkey AS shipment_id, l_shipdate + l_linenumber * INTERVAL 1 HOUR AS ts,
                   ['PICKED_UP', 'IN_TRANSIT', 'DELIVERED'][l_linenumber % 3 + 1] AS status,
                   'D' || l_partkey AS location
            FROM lineitem),
        dated AS (SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS scan_date FROM scans)
        SELECT shipment_id, scan_date,
               string_agg(status || '@' || strftime(ts, '%Y-%m-%d %H') || '@' || location, ',' ORDER BY ts, status, location) AS history
        FROM dated GROUP BY shipment_id, scan_date""",
    "email_clicks": """
        WITH sends AS (
            SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS events, max(ts) AS last_ts,
                   arg_max(event_type, ts) AS last_type, '/l/' || arg_max(event_id, ts) AS last_link
            FROM events GROUP BY 1, 2),
        clicks AS (
            SELECT user_id, CAST(ts AS DATE) AS day, event_id,
                   row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS n
            FROM events WHERE event_type = 'click'),
        lists AS (
            SELECT user_id, day, string_agg('/l/' || event_id, ',' ORDER BY n) AS clicks FROM clicks GROUP BY 1, 2)
        SELECT 'SEND-' || s.user_id AS send_id, s.user_id % 7 AS campaign_sk, s.user_id AS user_sk,
               CAST(s.day AS VARCHAR) AS event_date, events, strftime(last_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts,
               last_type AS event_type, last_link AS link_url, coalesce(clicks, '') AS clicks
        FROM sends s LEFT JOIN lists l ON s.user_id = l.user_id AND s.day = l.day""",
    "cleansed_customers": f"""
        SELECT CAST(o_custkey AS VARCHAR) AS customer_id, 'mail' || o_orderkey || '@example.com' AS email_norm,
               '+490' || o_custkey || o_orderkey AS phone_norm, c_name AS first_name, 'Doe' AS last_name,
               'Street ' || (o_orderkey % 100) AS addr_line1, 'City' || (o_custkey % 40) AS addr_city,
               'R' AS addr_region, 'DE' AS addr_country, CAST(o_custkey % 40 + 10000 AS VARCHAR) AS addr_postal,
               {_ts('o_orderdate')} AS eff_from_ts, {_day('o_orderdate')} AS load_date,
               CASE WHEN o_custkey % 40 < 25 THEN CAST(o_custkey % 40 AS DOUBLE) / 2 END AS geocoded_lat,
               CASE WHEN o_custkey % 40 < 25 THEN CAST(o_custkey % 40 * 2 AS DOUBLE) END AS geocoded_lon
        FROM orders JOIN customer ON o_custkey = c_custkey
        QUALIFY row_number() OVER (PARTITION BY o_custkey
                ORDER BY o_orderdate DESC, ' Mail' || o_orderkey || '@Example.COM ' DESC) = 1""",
    "cleansed_products": """
        SELECT 'P-' || p_partkey AS sku, CAST(p_partkey * 7 AS VARCHAR) AS upc, lower(p_name) AS name_norm,
               lower(p_type) AS category_norm, p_brand AS subcategory, split_part(lower(p_name), ' ', 1) AS color_norm,
               CAST(p_size AS VARCHAR) AS size_norm, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS msrp,
               CAST(p_partkey % 500 AS DOUBLE) AS cost, CAST(p_partkey % 10 AS VARCHAR) AS supplier_id,
               p_partkey % 4 <> 0 AS available, '2024-01-31' AS load_date
        FROM part""",
    "geocoded_addresses": """
        WITH addresses AS (
            SELECT DISTINCT 'Street ' || (o_orderkey % 100) AS addr_line1, 'City' || (o_custkey % 40) AS addr_city,
                   o_custkey % 40 AS k FROM orders)
        SELECT sha256(lower(addr_line1) || '|' || lower(addr_city) || '|r|de|' || (k + 10000)) AS raw_addr_hash,
               addr_line1, addr_city, 'R' AS addr_region, 'DE' AS addr_country,
               CAST(k + 10000 AS VARCHAR) AS addr_postal,
               CASE WHEN k < 25 THEN CAST(k AS DOUBLE) / 2 END AS lat, CASE WHEN k < 25 THEN CAST(k * 2 AS DOUBLE) END AS lon,
               CASE WHEN k < 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence,
               CASE WHEN k < 25 THEN 'dim_geography' END AS provider, '2024-01-31' AS load_date
        FROM addresses""",
    "approx_members": _with("store", f"""
        SELECT DISTINCT region, TRUE AS close FROM events LEFT JOIN store ON store_sk = event_id % 10
        WHERE event_type = 'click' AND CAST(ts AS DATE) >= {EVENTS_TODAY} - 30"""),
    "web_session": _with("web_log", f"""
        SELECT {_ts('CAST(event_ts AS TIMESTAMP)')} AS event_ts, ip, url, user_id, city, state,
               event_ts[1:10] AS event_date, country FROM web_log"""),
    "date_dimension": f"""
        WITH days AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1),
        parts AS (SELECT *, DATE '1900-01-01' AS z, CAST(d + INTERVAL 6 MONTH AS DATE) AS f FROM days)
        SELECT {_day('d')} AS d_date, orders, {_int('d - z')} AS d_date_sk, strftime(d, '%Y%m%d') AS d_date_id,
               {_int('(year(d) - 1900) * 12 + month(d) - 1')} AS d_month_seq, {_int('(d - z) // 7')} AS d_week_seq,
               {_int('(year(d) - 1900) * 4 + quarter(d) - 1')} AS d_quarter_seq, {_int('year(d)')} AS d_year,
               {_int('isodow(d)')} AS d_dow, {_int('month(d)')} AS d_moy, {_int('day(d)')} AS d_dom,
               {_int('quarter(d)')} AS d_qoy, {_int('year(f)')} AS d_fy_year,
               {_int('(year(f) - 1900) * 4 + quarter(f) - 1')} AS d_fy_quarter_seq, dayname(d) AS d_day_name,
               CASE WHEN strftime(d, '%m-%d') IN ('01-01', '12-25') THEN 'Y' ELSE 'N' END AS d_holiday,
               CASE WHEN isodow(d) >= 6 THEN 'Y' ELSE 'N' END AS d_weekend,
               CASE WHEN strftime(d - 1, '%m-%d') IN ('01-01', '12-25') THEN 'Y' ELSE 'N' END AS d_following_holiday,
               {_int("CAST(date_trunc('month', d) AS DATE) - z")} AS d_first_dom,
               {_int('last_day(d) - z')} AS d_last_dom,
               {_int('CAST(d - INTERVAL 12 MONTH AS DATE) - z')} AS d_same_day_ly,
               {_int('CAST(d - INTERVAL 3 MONTH AS DATE) - z')} AS d_same_day_lq
        FROM parts""",
}

# ------------------------------------------------------------ streaming runs
ORACLE["stream_dedup"] = f"""
    SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, {_ts("date_trunc('hour', ts)")} AS event_ts,
           '/p/' || event_type AS page_url FROM events"""
ORACLE["stream_cdc"] = ORACLE["cdc_merge"]
ORACLE["stream_sessions"] = _with("sessions", f"""
    SELECT user_sk, {_ts('min(event_ts)')} AS started_ts, {_ts('max(event_ts)')} AS last_event_ts, count(*) AS clicks,
           max(event_ts) + INTERVAL 30 MINUTE >= (SELECT max(event_ts) FROM sessions) AS is_open
    FROM sessions GROUP BY user_sk, session_id""")

_ORDERS_FEED = f"""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
           {_dbl('CAST(o_totalprice AS DECIMAL(14,2))')} AS total, {_day('o_orderdate')} AS day FROM orders"""
ORACLE["csv_feed"] = _ORDERS_FEED
ORACLE["orc_feed"] = _ORDERS_FEED
ORACLE["parquet_feed"] = _ORDERS_FEED
# batches that keep a history up to date give the same history
ORACLE["address_history_merged"] = ORACLE["address_history"]
ORACLE["member_sketches"] = f"""
    SELECT region, exact_active_members, 0.0::DOUBLE AS members_beyond_bound, total_points_redeemed
    FROM ({ORACLE["active_member_panel"]})"""
ORACLE["stored_profile"] = """
    SELECT 'events' AS "table", count(*) AS row_count, count(DISTINCT CAST(ts AS DATE)) AS partition_count FROM events
    UNION ALL SELECT 'events_orc', count(*), count(DISTINCT CAST(ts AS DATE)) FROM events
    UNION ALL SELECT 'orders', count(*), NULL FROM orders UNION ALL SELECT 'orders_text', count(*), NULL FROM orders"""
ORACLE["variant_fields"] = """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_id % 7 < 2 AS is_null,
           CASE WHEN event_id % 7 > 2 THEN CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) END AS k,
           CASE WHEN event_id % 7 = 2 THEN 'many' WHEN event_id % 7 > 2 THEN regexp_extract(props, '"k": ([0-9]+)', 1) END AS k_text,
           CASE WHEN event_id % 7 = 2 THEN 2.5::DOUBLE END AS second
    FROM events"""
ORACLE["catalog_scan"] = _with("web_log", f"""
    SELECT strftime(d, '%Y-%m-%d') AS event_date, country, count(*) AS n, {_ts('max(seen_at)')} AS last_ts
    FROM (SELECT CAST(event_ts AS TIMESTAMP) AS seen_at, CAST(CAST(event_ts AS TIMESTAMP) AS DATE) AS d, country FROM web_log)
    WHERE d BETWEEN DATE '2024-01-10' AND DATE '2024-01-25' AND isodow(d) = 1 GROUP BY d, country""")
ORACLE["sequence_feed"] = """
    SELECT 'INV-' || o_orderkey AS invoice_no, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS customer_id FROM orders"""
ORACLE["dry_run"] = "SELECT count(*) AS row_count, 6::BIGINT AS columns, least(5, count(*)) AS preview_rows FROM lineitem"
ORACLE["audit_row"] = """
    SELECT '2024-01-31 12:30:00.000000' AS migration_completed_at, '1998-06-30 00:00:00.000000' AS frozen_watermark_w,
           count(DISTINCT o_orderstatus) AS total_tables_loaded, 'table_load' AS dag_id, 'run-7' AS dag_run_id FROM orders"""
ORACLE["lenient_bound"] = "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus"
ORACLE["carrier_events"] = f"""
    SELECT * REPLACE (nullif(event_type, 'none') AS event_type) FROM ({ORACLE["carrier_events"]})"""
ORACLE["shipments_tracked"] = f"""
    WITH scans AS (
        SELECT 'SH-' || l_orderkey AS shipment_id, l_shipdate + l_linenumber * INTERVAL 1 HOUR AS ts,
               ['PICKED_UP', 'IN_TRANSIT', 'DELIVERED'][l_linenumber % 3 + 1] AS status, 'D' || l_partkey AS location
        FROM lineitem),
    lists AS (
        SELECT shipment_id, string_agg(status || '@' || strftime(ts, '%Y-%m-%d %H') || '@' || location, ',' ORDER BY ts, status, location) AS events
        FROM scans GROUP BY shipment_id)
    SELECT 'SH-' || o_orderkey AS shipment_id, 'INV-' || o_orderkey AS invoice_no, o_custkey AS customer_sk, o_orderkey % 10 AS warehouse_sk,
           {_pick(CARRIERS, 'o_custkey', 4)} AS carrier, 'T-' || o_orderkey AS tracking_no, {_ts('o_orderdate')} AS shipped_ts,
           {_ts("CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 48 HOUR END")} AS delivered_ts, 36::BIGINT AS sla_hours,
           coalesce(events, '') AS tracking_events, year(o_orderdate) AS ship_year, month(o_orderdate) AS ship_month, day(o_orderdate) AS ship_day,
           {_pick(CARRIERS, 'o_custkey', 4)} AS carrier_partition, {_day('o_orderdate')} AS partition_date
    FROM orders LEFT JOIN lists ON shipment_id = 'SH-' || o_orderkey"""
