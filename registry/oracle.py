"""The same questions in DuckDB SQL, written from their definitions rather than from the Spark plans.

Amounts are exact decimals until the last step and are compared as doubles; averages are one
division of two exact numbers, so both engines give the same bits. Timestamps are compared as text.
"""

from __future__ import annotations

LOADED = "'2025-01-01 00:00:00.000000'"
GAP = "INTERVAL 6 HOURS"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def mean_cents(total: str, count: str) -> str:
    """Half-up average of a decimal(.,2) sum, in whole cents."""
    return f"((2 * CAST({total} * 100 AS HUGEINT) + {count}) // (2 * {count}))"


SEGMENT = """CASE
  WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
  WHEN r_score >= 4 AND f_score >= 3 THEN 'Loyal Customers'
  WHEN r_score >= 3 AND f_score >= 1 AND m_score >= 3 THEN 'Potential Loyalists'
  WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
  WHEN r_score >= 3 AND f_score <= 2 THEN 'Promising'
  WHEN r_score <= 2 AND f_score >= 4 THEN 'Cannot Lose Them'
  WHEN r_score <= 2 AND f_score >= 2 THEN 'At Risk'
  WHEN r_score <= 2 THEN 'Hibernating'
  ELSE 'Need Attention' END"""


def _windows(source: str, hours: str) -> str:
    return f"""
  SELECT window_start, window_start + INTERVAL {hours} AS window_end, category, country,
         sum(total_amount) AS total_amount, count(*) AS transaction_count,
         {mean_cents('sum(total_amount)', 'count(*)')} AS avg_cents
  FROM {source} GROUP BY window_start, category, country"""


# Common tables: name -> (names it needs, SQL).
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "first_line": ((), """
  SELECT l_orderkey, p_type FROM (
    SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS nth FROM lineitem
  ) JOIN part ON p_partkey = l_partkey WHERE nth = 1"""),
    "tx": (("first_line",), """
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS user_id,
         o_orderdate AS moment, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
         n_name AS country, o_orderpriority AS payment_method, coalesce(p_type, 'General') AS category
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN first_line ON l_orderkey = o_orderkey"""),
    "lines": ((), """
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS user_id,
         o_orderdate AS moment, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "daily_sales": (("tx",), _windows(
        "(SELECT *, date_trunc('day', moment) AS window_start FROM tx)", "1 DAY")),
    "fact": (("daily_sales",), "SELECT *, window_start AS date_time FROM daily_sales"),
    "ev": ((), """
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""),
    "purchases": (("ev",), """
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, ts AS moment,
         CAST(value AS DECIMAL(12,2)) AS total_amount, coalesce(p_type, 'General') AS category, n_name AS country,
         CAST(k AS VARCHAR) AS product_id
  FROM ev LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN part ON k = p_partkey WHERE event_type = 'purchase'"""),
    "sales": (("purchases",), _windows("""(
    SELECT *, make_timestamp((epoch_us(moment) // 1800000000 - back) * 1800000000) AS window_start
    FROM purchases CROSS JOIN (VALUES (0), (1)) AS slides(back))""", "1 HOUR")),
    "hourly_fact": (("sales",), """
  SELECT *, window_start AS date_time FROM sales WHERE epoch_us(window_start) % 3600000000 = 0"""),
    "event_end": ((), "SELECT max(ts) AS t FROM events"),
    "order_end": ((), "SELECT max(o_orderdate) AS t FROM orders"),
    "anomalies": (("lines",), """
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(NULL AS VARCHAR) AS product_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) / CAST(450000 AS DOUBLE) AS anomaly_score,
         'high_value' AS anomaly_type, o_orderdate AS detected_at,
         'High value transaction: $' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS description
  FROM orders WHERE o_totalprice > 450000
  UNION ALL
  SELECT transaction_id, user_id, product_id, total_amount,
         CAST(quantity AS DOUBLE) / CAST(45 AS DOUBLE), 'unusual_quantity', moment,
         'Unusual quantity: ' || CAST(quantity AS VARCHAR) || ' items'
  FROM lines WHERE quantity > 45"""),
    "status": ((), """
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_size * 20 AS BIGINT) AS current_stock, CAST(0 AS BIGINT) AS reserved_stock,
         CAST(p_size * 20 AS BIGINT) AS available_stock FROM part"""),
    "movements": (("lines",), """
  SELECT date_trunc('day', moment) AS window_start, product_id,
         CAST(sum(quantity) AS BIGINT) AS sold_quantity, count(*) AS transaction_count
  FROM lines GROUP BY ALL"""),
    "running": (("movements",), """
  SELECT *, CAST(sum(sold_quantity) OVER (PARTITION BY product_id ORDER BY window_start) AS BIGINT) AS sold,
         row_number() OVER (PARTITION BY product_id ORDER BY window_start) AS nth FROM movements"""),
    "levels": (("running", "status"), """
  SELECT running.*, product_name, category,
         greatest(current_stock - sold, 0) AS available,
         greatest(current_stock - sold + sold_quantity, 0) AS was_available
  FROM running JOIN status USING (product_id)"""),
    "stock_alerts": (("levels",), """
  SELECT *, available AS left_over FROM levels WHERE available < 300 AND was_available >= 300"""),
    "cart": (("ev",), """
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
         CAST(k AS VARCHAR) AS product_id, ts AS moment,
         CASE event_type WHEN 'click' THEN 'add' WHEN 'error' THEN 'remove' ELSE 'update' END AS action,
         CASE WHEN event_type = 'error' THEN 0 ELSE k % 5 + 1 END AS quantity,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id
  FROM ev WHERE event_type IN ('click', 'error', 'signup')"""),
    "adds": (("cart",), "SELECT * FROM cart WHERE action = 'add'"),
    "views": (("ev",), """
  SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS product_id, ts AS moment,
         5 + CAST(floor(value) AS INTEGER) % 296 AS duration_seconds,
         coalesce(p_type, 'General') AS category
  FROM ev LEFT JOIN part ON k = p_partkey WHERE event_type = 'view'"""),
    "islands": (("cart",), f"""
  SELECT *, sum(opens) OVER (PARTITION BY session_id, user_id ORDER BY moment, event_id
      ROWS UNBOUNDED PRECEDING) AS nth
  FROM (SELECT *, CASE WHEN moment - lag(moment) OVER (PARTITION BY session_id, user_id ORDER BY moment, event_id)
        <= {GAP} THEN 0 ELSE 1 END AS opens FROM cart)"""),
    "sessions": (("islands",), """
  SELECT session_id, user_id, min(moment) AS start_time, max(moment) AS end_time,
         epoch_us(max(moment)) // 1000000 - epoch_us(min(moment)) // 1000000 AS duration_seconds,
         count(*) AS page_views, count(*) FILTER (action = 'add') AS cart_adds,
         count(*) FILTER (action = 'remove') AS cart_removes
  FROM islands GROUP BY session_id, user_id, nth"""),
    "fixed_sessions": (("cart",), """
  SELECT session_id, user_id, min(moment) AS start_time, max(moment) AS end_time,
         epoch_us(max(moment)) // 1000000 - epoch_us(min(moment)) // 1000000 AS duration_seconds,
         count(*) AS page_views, count(*) FILTER (action = 'add') AS cart_adds,
         count(*) FILTER (action = 'remove') AS cart_removes
  FROM cart GROUP BY session_id, user_id, epoch_us(moment) // (6 * 3600000000)"""),
    "abandoned": (("sessions",), """
  SELECT session_id, user_id, cart_adds AS products_in_cart, CAST(0 AS DOUBLE) AS cart_value,
         end_time AS abandonment_time, duration_seconds // 60 AS time_in_cart_minutes
  FROM sessions WHERE cart_adds > 0 AND duration_seconds > 60"""),
    "upserted": (("sessions",), """
  SELECT newest.session_id, oldest.user_id, oldest.start_time, newest.end_time,
         newest.duration_seconds, newest.page_views, newest.cart_adds, newest.cart_removes
  FROM (SELECT * FROM sessions QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY end_time DESC) = 1) newest
  JOIN (SELECT * FROM sessions QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY end_time) = 1) oldest
  USING (session_id)"""),
    # What no later update or removal of the same product in the same cart undoes.
    "cart_left": (("cart",), """
  SELECT session_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM cart c
  WHERE action <> 'remove' AND NOT EXISTS (
    SELECT 1 FROM cart d WHERE d.session_id = c.session_id AND d.product_id = c.product_id AND d.action <> 'add'
      AND (d.moment > c.moment OR d.moment = c.moment AND d.event_id > c.event_id))
  GROUP BY ALL HAVING sum(quantity) > 0"""),
    "cart_totals": (("cart_left",), """
  SELECT session_id, sum(quantity * CAST(coalesce(p_retailprice, 0) AS DECIMAL(12,2))) AS cart_value
  FROM cart_left LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = product_id GROUP BY session_id"""),
    "valued": (("abandoned", "cart_totals"), """
  SELECT abandoned.* EXCLUDE (cart_value), coalesce(CAST(cart_totals.cart_value AS DOUBLE), 0) AS cart_value
  FROM abandoned LEFT JOIN cart_totals USING (session_id)"""),
    "rfm": ((), """
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, n_name AS country,
         date_diff('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS recency,
         count(*) AS frequency, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS monetary
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY o_custkey, n_name"""),
    "scores": (("rfm",), """
  SELECT *, ntile(5) OVER (ORDER BY recency DESC, user_id, country) AS r_score,
         ntile(5) OVER (ORDER BY frequency, user_id, country) AS f_score,
         ntile(5) OVER (ORDER BY monetary, user_id, country) AS m_score FROM rfm"""),
    "seg": (("scores",), f"""
  SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_segment,
         {SEGMENT} AS segment_name, (SELECT max(o_orderdate) FROM orders) AS analysis_date FROM scores"""),
    "performance": (("fact",), """
  SELECT *, total_revenue / everything * 100 AS revenue_share,
         row_number() OVER (ORDER BY total_revenue DESC, category) AS rank FROM (
    SELECT category, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
           CAST(sum(transaction_count) AS BIGINT) AS total_transactions,
           CAST(sum(avg_cents) AS DOUBLE) / 100 / count(*) AS avg_order_value,
           CAST(sum(total_amount) AS DOUBLE) / CAST(sum(transaction_count) AS DOUBLE) AS weighted_avg_order_value,
           count(*) AS data_points,
           CAST(sum(sum(total_amount)) OVER () AS DOUBLE) AS everything
    FROM fact GROUP BY category)"""),
    "trend_rows": (("fact",), """
  SELECT 'daily' AS period_type, strftime(date_time, '%Y-%m-%d') AS period,
         epoch(date_trunc('day', date_time)) AS nth, total_amount, transaction_count FROM fact
  UNION ALL
  SELECT 'weekly', CAST(year(date_time) AS VARCHAR) || '-W' || CAST(week(date_time) AS VARCHAR),
         year(date_time) * 100 + week(date_time), total_amount, transaction_count FROM fact
  UNION ALL
  SELECT 'monthly', CAST(year(date_time) AS VARCHAR) || '-' || CAST(month(date_time) AS VARCHAR),
         year(date_time) * 100 + month(date_time), total_amount, transaction_count FROM fact"""),
    "all_trends": (("trend_rows",), f"""
  SELECT period_type, period, revenue, transactions,
         CASE WHEN before IS NULL THEN 0 ELSE (revenue - before) / nullif(before, 0) * 100 END AS revenue_growth_rate,
         {LOADED} AS analysis_date
  FROM (SELECT *, lag(revenue) OVER (PARTITION BY period_type ORDER BY nth) AS before FROM (
    SELECT period_type, period, nth, CAST(sum(total_amount) AS DOUBLE) AS revenue,
           CAST(sum(transaction_count) AS BIGINT) AS transactions FROM trend_rows GROUP BY ALL))"""),
    # The events themselves, but for those of each partition's first hour, which nothing precedes.
    "topics": ((), """
  SELECT topic, timestamp, event_count, coalesce(CAST(event_count AS DOUBLE)
           / CAST(epoch_us(timestamp) // 1000000 - epoch_us(previous) // 1000000 AS DOUBLE), 0) AS rate
  FROM (SELECT topic, timestamp, count(*) FILTER (timestamp > first_hour) AS event_count,
               lag(timestamp) OVER (PARTITION BY topic ORDER BY timestamp) AS previous
        FROM (SELECT event_type AS topic, date_trunc('hour', ts) AS timestamp,
                     min(date_trunc('hour', ts)) OVER (PARTITION BY event_type, user_id % 4) AS first_hour FROM events)
        GROUP BY topic, timestamp)"""),
    "health": ((), """
  SELECT CASE event_type WHEN 'view' THEN 'cpu_usage' WHEN 'click' THEN 'memory_usage'
              WHEN 'error' THEN 'disk_usage' ELSE 'container_status' END AS metric_name,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 2 AS DECIMAL(15,2))
              ELSE CAST(value AS DECIMAL(15,2)) END AS metric_value,
         CASE WHEN event_type = 'signup' THEN 'status' ELSE 'gauge' END AS metric_type,
         ts AS timestamp,
         CASE WHEN event_type = 'signup' THEN 'c' || CAST(user_id % 8 AS VARCHAR) END AS metadata, event_id
  FROM events WHERE event_type <> 'purchase'"""),
}


def sql(body: str, *tables: str) -> str:
    """`body` behind the common tables it names, in order of need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in TABLES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in tables:
        visit(name)
    heads = ",\n".join(f"{name} AS ({TABLES[name][1]})" for name in ordered)
    return (f"WITH {heads}\n" if heads else "") + body


def _sales_select(source: str, tail: str = "") -> str:
    return f"""SELECT {ts('window_start')} AS window_start, {ts('window_end')} AS window_end, category, country,
  {dbl('total_amount')} AS total_amount, transaction_count, {dbl('avg_cents')} / 100 AS avg_transaction_value
FROM {source} {tail}"""


def _fact_select(source: str) -> str:
    return f"""SELECT {ts('window_start')} AS date_time, {big("strftime(window_start, '%Y%m%d')")} AS date_id,
  category, country, {dbl('total_amount')} AS total_amount, transaction_count,
  {dbl('avg_cents')} / 100 AS avg_transaction_value, {LOADED} AS loaded_at FROM {source}"""


def _trend(prefix: str, keys: dict[str, str], source: str = "fact") -> str:
    names = ", ".join(keys)
    selected = ", ".join(f"{big(e) if n not in ('date', 'hour') else e} AS {n}" for n, e in keys.items())
    return f"""SELECT {names}, revenue AS {prefix}_revenue, transactions AS {prefix}_transactions,
  averages / 100 / n AS avg_order_value, revenue / transactions AS weighted_avg_order_value,
  before AS prev_revenue,
  CASE WHEN before IS NULL THEN 0 ELSE (revenue - before) / nullif(before, 0) * 100 END AS revenue_growth_rate,
  '{prefix}' AS trend_type
FROM (SELECT *, lag(revenue) OVER (ORDER BY {names}) AS before FROM (
  SELECT {selected}, {dbl('sum(total_amount)')} AS revenue, {big('sum(transaction_count)')} AS transactions,
    {dbl('sum(avg_cents)')} AS averages, count(*) AS n FROM {source} GROUP BY ALL))"""


_DAY = {"date": "strftime(date_time, '%Y-%m-%d')"}
_WEEK = {"year": "year(date_time)", "week": "week(date_time)"}
_ISO_WEEK = {"year": "isoyear(date_time)", "week": "week(date_time)"}
_MONTH = {"year": "year(date_time)", "month": "month(date_time)"}
_HOUR = {"hour": "strftime(date_time, '%Y-%m-%d %H:00')"}

_SESSION = f"""session_id, user_id, {ts('start_time')} AS start_time, {ts('end_time')} AS end_time,
  duration_seconds, page_views, cart_adds, cart_removes"""
_ANOMALY = f"""transaction_id, user_id, product_id, {dbl('amount')} AS amount, anomaly_score, anomaly_type,
  {ts('detected_at')} AS detected_at, description"""
_NEWEST_ANOMALY = """ORDER BY detected_at DESC, transaction_id, anomaly_type, product_id NULLS FIRST, anomaly_score"""
_SEGMENTS = f"""user_id, country, {big('recency')} AS recency, frequency, {dbl('monetary')} AS monetary,
  {big('r_score')} AS r_score, {big('f_score')} AS f_score, {big('m_score')} AS m_score, rfm_segment,
  segment_name, {ts('analysis_date')} AS analysis_date"""
_STOCK = f"""product_id, product_name, category, current_stock, reserved_stock, available_stock,
  {LOADED} AS last_updated"""
_ALERT = f"""product_id, product_name, category, {big('available')} AS current_stock,
  CAST(300 AS BIGINT) AS threshold, {ts('window_start')} AS alert_time, 'active' AS status"""
_PERFORMANCE = f"""category, total_revenue, total_transactions, avg_order_value, weighted_avg_order_value,
  data_points, revenue_share,
  CASE WHEN revenue_share >= 20 THEN 'Excellent' WHEN revenue_share >= 10 THEN 'Good'
       WHEN revenue_share >= 5 THEN 'Average' ELSE 'Below Average' END AS performance_rating,
  rank, {LOADED} AS analysis_date"""


def _distribution(by: str) -> str:
    return f"""SELECT coalesce(nullif({by}, ''), 'Unknown') AS segment, count(*) AS customer_count,
  {dbl(mean_cents('sum(monetary)', 'count(*)'))} / 100 AS avg_customer_value,
  {dbl('sum(frequency)')} / {dbl('count(*)')} AS avg_frequency,
  {dbl('sum(monetary)')} AS total_segment_value FROM seg GROUP BY 1"""


def _kpis(tail: str = "") -> str:
    return f"""SELECT coalesce({dbl('sum(monetary)')}, 0) AS total_revenue,
  {big('coalesce(sum(frequency), 0)')} AS total_transactions,
  coalesce({dbl('sum(monetary)')} / {dbl('sum(frequency)')}, 0) AS avg_order_value FROM seg {tail}"""


def _totals(source: str, tail: str = "") -> str:
    return f"""SELECT coalesce({dbl('sum(total_amount)')}, 0) AS total_revenue,
  {big('coalesce(sum(transaction_count), 0)')} AS total_transactions,
  coalesce({dbl('sum(total_amount)')} / {dbl('sum(transaction_count)')}, 0) AS avg_order_value
FROM {source} {tail}"""


def _summary(period: str, start: str) -> str:
    return sql(f"""SELECT '{period}' AS period, count(*) AS window_count,
  {big('coalesce(sum(transaction_count), 0)')} AS transaction_count,
  coalesce({dbl('sum(total_amount)')}, 0) AS total_revenue,
  coalesce({dbl('sum(total_amount)')} / count(*), 0) AS avg_window_value,
  coalesce({dbl('min(total_amount)')}, 0) AS min_window, coalesce({dbl('max(total_amount)')}, 0) AS max_window
FROM sales, event_end WHERE window_start >= {start} AND window_end <= t""", "sales", "event_end")


def _funnel(keys: str) -> str:
    return sql(f"""SELECT viewed, carted, purchased, all_buyers,
  {dbl('carted')} / nullif({dbl('viewed')}, 0) AS cart_rate,
  {dbl('purchased')} / nullif({dbl('carted')}, 0) AS purchase_rate FROM (
  SELECT (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM views)) AS viewed,
         (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM views JOIN adds USING ({keys})
           WHERE adds.moment >= views.moment)) AS carted,
         (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM views JOIN adds USING ({keys})
           JOIN purchases USING ({keys}) WHERE adds.moment >= views.moment AND purchases.moment >= adds.moment)) AS purchased,
         (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM purchases)) AS all_buyers)""", "views", "adds", "purchases")


def _gauge(metric: str) -> str:
    return sql(f"""SELECT {dbl('metric_value')} AS metric_value FROM health
WHERE metric_name = '{metric}' ORDER BY timestamp DESC, metric_value DESC LIMIT 1""", "health")


_WIRE = """(SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
  WHERE event_type NOT IN ('error', 'signup'))"""


def all_oracles() -> dict[str, str]:
    q: dict[str, str] = {}

    # Metrics and facts
    q["sales_metrics_sliding"] = sql(_sales_select("sales"), "sales")
    q["sales_metrics_many_windows"] = sql(_sales_select("(" + _windows("""(
    SELECT *, make_timestamp((epoch_us(moment) // 300000000 - back) * 300000000) AS window_start
    FROM purchases CROSS JOIN range(12) AS slides(back))""", "1 HOUR") + ")"), "purchases")
    q["sales_metrics_tumbling"] = sql(_sales_select("hourly_fact"), "hourly_fact")
    q["sales_metrics_daily"] = sql(_sales_select("daily_sales"), "daily_sales")
    q["fact_sales"] = sql(_fact_select("hourly_fact"), "hourly_fact")
    q["fact_sales_all_windows"] = sql(_fact_select("sales"), "sales")
    for name, micros in (("fact_sales_10_3", 60_000_000), ("fact_sales_60_25", 300_000_000)):
        panes = _windows(f"""(SELECT *, make_timestamp(epoch_us(moment) // {micros} * {micros}) AS window_start
    FROM purchases)""", f"{micros} MICROSECONDS")
        q[name] = sql(_fact_select(f"(SELECT *, window_start AS date_time FROM ({panes}))"), "purchases")
    q["fact_sessions_with_outcome"] = sql(f"""SELECT {_SESSION}, bought > 0 AS purchase_completed,
  bought = 0 AND cart_adds > 0 AND duration_seconds > 60 AS abandoned, CAST(paid AS DOUBLE) AS total_amount,
  {big("strftime(start_time, '%Y%m%d')")} AS date_id, {LOADED} AS loaded_at FROM (
    SELECT s.*, (SELECT count(*) FROM purchases p WHERE p.user_id = s.user_id AND p.moment >= s.start_time
             AND p.moment <= s.end_time + {GAP}) AS bought,
           (SELECT sum(p.total_amount) FROM purchases p WHERE p.user_id = s.user_id AND p.moment >= s.start_time
             AND p.moment <= s.end_time + {GAP}) AS paid FROM sessions s)""", "sessions", "purchases")
    q["fact_sessions"] = sql(f"""SELECT {_SESSION}, false AS purchase_completed, false AS abandoned,
  CAST(NULL AS DOUBLE) AS total_amount, {big("strftime(start_time, '%Y%m%d')")} AS date_id,
  {LOADED} AS loaded_at FROM sessions""", "sessions")
    q["dim_time"] = f"""SELECT {big("strftime(d, '%Y%m%d')")} AS date_id, strftime(d, '%Y-%m-%d') AS date,
  year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, week(d) AS week,
  day(d) AS day, isodow(d) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)"""
    q["star_month_revenue"] = sql(f"""SELECT year(date_time) AS year, monthname(date_time) AS month_name,
  isodow(date_time) >= 6 AS is_weekend, {dbl('sum(total_amount)')} AS revenue,
  {big('sum(transaction_count)')} AS transactions FROM fact GROUP BY ALL""", "fact")
    q["dim_customers"] = sql(f"""SELECT customer_id, country, registration_date, segment_name AS segment,
  total_purchases, total_spent FROM (
    SELECT user_id AS customer_id, max(country) AS country, {ts('min(moment)')} AS registration_date,
           count(*) AS total_purchases, {dbl('sum(total_amount)')} AS total_spent FROM tx GROUP BY user_id)
  LEFT JOIN (SELECT user_id, segment_name FROM seg) ON user_id = customer_id""", "tx", "seg")
    q["dim_products"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
  p_retailprice AS price, CAST(p_size * 20 AS BIGINT) AS inventory FROM part"""
    q["fact_inventory"] = sql(f"""SELECT {big("strftime(window_start, '%Y%m%d')")} AS date_id, product_id, category,
  {big('sum(sold_quantity)')} AS units_sold, {big('sum(transaction_count)')} AS transactions,
  {dbl('sum(sold_quantity)')} / {dbl('sum(transaction_count)')} AS units_per_line
FROM movements JOIN status USING (product_id) GROUP BY 1, 2, 3""", "movements", "status")
    q["view_metrics"] = sql(f"""SELECT {ts('w')} AS window_start, {ts('w + INTERVAL 1 HOUR')} AS window_end, category,
  count(*) AS views, {big('sum(duration_seconds)')} AS total_duration,
  {dbl('sum(duration_seconds)')} / {dbl('count(*)')} AS avg_duration
FROM (SELECT *, date_trunc('hour', moment) AS w FROM views) GROUP BY w, category""", "views")
    q["funnel_by_user"] = _funnel("user_id")
    q["funnel_by_user_product"] = _funnel("user_id, product_id")
    q["topic_rates"] = sql(f"SELECT topic, event_count, rate, {ts('timestamp')} AS timestamp FROM topics", "topics")

    # Event parsing
    q["parsed_transactions"] = f"""SELECT CAST(event_id AS VARCHAR) AS transaction_id,
  CAST(user_id AS VARCHAR) AS user_id, {ts('ts')} AS timestamp, {dbl('CAST(value AS DECIMAL(12,2))')} AS total_amount,
  CASE WHEN event_type = 'view' THEN 'General' ELSE event_type END AS category FROM {_WIRE}"""
    q["parsed_product_lines"] = f"""SELECT CAST(event_id AS VARCHAR) AS transaction_id,
  CAST(user_id AS VARCHAR) AS user_id, {ts('ts')} AS timestamp, {dbl('CAST(value AS DECIMAL(12,2))')} AS total_amount,
  CAST(k AS VARCHAR) AS product_id, CAST(k % 5 AS BIGINT) AS quantity, value AS price FROM {_WIRE}"""
    q["dead_letters"] = """SELECT CASE event_type WHEN 'error' THEN 'unreadable' ELSE 'bad timestamp' END AS reason,
  count(*) AS lines FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1"""

    # Categories and trends
    q["category_performance"] = sql(f"SELECT {_PERFORMANCE} FROM performance", "performance")
    q["top_categories"] = sql(f"""SELECT category, {dbl('sum(total_amount)')} AS revenue FROM fact
GROUP BY category ORDER BY sum(total_amount) DESC, category LIMIT 10""", "fact")
    q["bottom_categories"] = sql(f"""SELECT category, {dbl('sum(total_amount)')} AS revenue,
  {big('sum(transaction_count)')} AS transactions FROM fact
GROUP BY category ORDER BY sum(total_amount), category LIMIT 10""", "fact")
    q["hourly_trend"] = sql(_trend("hourly", _HOUR, "hourly_fact"), "hourly_fact")
    q["daily_trend"] = sql(_trend("daily", _DAY), "fact")
    q["weekly_trend"] = sql(_trend("weekly", _WEEK), "fact")
    q["weekly_trend_iso_year"] = sql(_trend("weekly", _ISO_WEEK), "fact")
    q["monthly_trend"] = sql(_trend("monthly", _MONTH), "fact")
    q["last_seven_days"] = sql(_trend("daily", _DAY) + "\nORDER BY date DESC LIMIT 7", "fact")
    q["country_trend"] = sql(f"""SELECT country, strftime(date_time, '%Y-%m-%d') AS date,
  {dbl('sum(total_amount)')} AS daily_revenue, {big('sum(transaction_count)')} AS daily_transactions
FROM fact GROUP BY ALL""", "fact")
    q["combined_trends"] = q["united_trends"] = sql("SELECT * FROM all_trends", "all_trends")
    q["monthly_trends_descending"] = sql(
        "SELECT * FROM all_trends WHERE period_type = 'monthly' ORDER BY period DESC", "all_trends")

    # Customers
    q["rfm_scores"] = q["rfm_scores_by_range"] = sql(f"SELECT {_SEGMENTS} FROM seg", "seg")
    q["segment_summary"] = sql(f"""SELECT segment_name, count(*) AS customer_count,
  {dbl('sum(recency)')} / {dbl('count(*)')} AS avg_recency, {dbl('sum(frequency)')} / {dbl('count(*)')} AS avg_frequency,
  {dbl('sum(monetary)')} / {dbl('count(*)')} AS avg_monetary, {dbl('sum(monetary)')} AS total_revenue
FROM seg GROUP BY segment_name""", "seg")
    q["segment_distribution"] = sql(_distribution("rfm_segment"), "seg")
    q["segment_distribution_by_name"] = sql(_distribution("segment_name"), "seg")
    q["customer_rows"] = sql(f"""SELECT {_SEGMENTS} FROM seg WHERE segment_name = 'Champions'
ORDER BY user_id, country LIMIT 50""", "seg")
    q["customer_rows_by_code"] = sql(f"""SELECT {_SEGMENTS} FROM seg WHERE rfm_segment = '555'
ORDER BY user_id, country LIMIT 1000""", "seg")
    q["documented_segments"] = sql(f"""SELECT segment_name, count(*) AS customer_count,
  {dbl('sum(monetary)')} / {dbl('count(*)')} AS avg_monetary, {dbl('sum(frequency)')} / {dbl('count(*)')} AS avg_frequency,
  {dbl('sum(monetary)')} AS total_value FROM seg WHERE country = 'NATION_1' GROUP BY segment_name""", "seg")
    q["segments_by_name"] = sql(f"""SELECT segment_name, count(*) AS customer_count,
  {dbl('sum(monetary)')} / {dbl('count(*)')} AS avg_monetary FROM seg GROUP BY segment_name""", "seg")
    q["customer_kpis"] = sql(_kpis(), "seg")
    q["customer_kpis_of_country"] = sql(_kpis("WHERE country = 'NATION_3'"), "seg")
    q["segment_counts"] = sql("SELECT segment_name, count(*) AS customers FROM seg GROUP BY segment_name", "seg")
    q["country_overview"] = sql("""SELECT (SELECT count(DISTINCT country) FROM seg) AS total_countries,
  (SELECT country FROM seg GROUP BY country ORDER BY sum(monetary) DESC, country DESC LIMIT 1) AS top_country,
  (SELECT count(*) FROM seg) AS total_customers""", "seg")
    q["country_revenue"] = sql(
        f"SELECT country, {dbl('sum(monetary)')} AS revenue FROM seg GROUP BY country", "seg")
    q["country_stats"] = sql(f"""SELECT country, {dbl('sum(monetary)')} AS revenue,
  {big('sum(frequency)')} AS transactions, count(segment_name) AS customers FROM seg GROUP BY country
ORDER BY sum(monetary) DESC, country LIMIT 10""", "seg")
    q["customer_insights"] = sql(f"""SELECT count(*) AS total_customers,
  count(*) FILTER (segment_name = 'Champions') AS champions,
  {dbl('sum(frequency)')} / {dbl('count(*)')} AS avg_frequency,
  {dbl('sum(monetary)')} / {dbl('count(*)')} AS avg_monetary FROM seg""", "seg")
    q["segment_value"] = sql(
        f"SELECT segment_name, {dbl('sum(monetary)')} AS total_value FROM seg GROUP BY segment_name", "seg")
    q["segment_metrics"] = sql(f"""SELECT segment_name,
  {dbl(mean_cents('sum(frequency)', 'count(*)'))} / 100 AS avg_frequency,
  {dbl(mean_cents('sum(monetary)', 'count(*)'))} / 100 AS avg_monetary, count(*) AS customer_count
FROM seg GROUP BY segment_name""", "seg")
    q["customer_scatter"] = sql(
        f"SELECT frequency, {dbl('monetary')} AS monetary, segment_name FROM seg", "seg")

    # Anomalies
    q["anomalies"] = sql(f"SELECT {_ANOMALY} FROM anomalies", "anomalies")
    q["rapid_transactions"] = sql(f"""SELECT 'rapid-' || user_id || '-' || CAST(w * 21600 AS VARCHAR) AS transaction_id,
  user_id, CAST(NULL AS VARCHAR) AS product_id, {dbl('sum(total_amount)')} AS amount,
  {dbl('count(*)')} / {dbl('2')} AS anomaly_score, 'rapid_transactions' AS anomaly_type,
  {ts('make_timestamp((w + 1) * 21600000000)')} AS detected_at,
  'Rapid transactions: ' || CAST(count(*) AS VARCHAR) || ' in 6 hours' AS description
FROM (SELECT *, epoch_us(moment) // 21600000000 AS w FROM purchases) GROUP BY user_id, w HAVING count(*) > 2""", "purchases")
    q["anomaly_rows"] = sql(f"""SELECT {_ANOMALY} FROM (SELECT * FROM anomalies
{_NEWEST_ANOMALY} LIMIT 100)""", "anomalies")
    q["anomaly_rows_of_type"] = sql(f"""SELECT {_ANOMALY} FROM (SELECT * FROM anomalies
WHERE anomaly_type = 'high_value' AND detected_at >= '1999-01-01' {_NEWEST_ANOMALY} LIMIT 200)""", "anomalies")
    q["anomaly_check"] = sql(f"""SELECT 'anomaly_' || transaction_id AS alert_key, {_ANOMALY},
  CASE WHEN anomaly_score >= 1.08 THEN 'red' ELSE 'yellow' END AS severity, anomaly_score >= 1.1 AS urgent
FROM (SELECT * FROM anomalies WHERE detected_at >= '2000-01-01' AND anomaly_score >= 1.05
  ORDER BY anomaly_score DESC, transaction_id, anomaly_type, product_id NULLS FIRST LIMIT 20)""", "anomalies")
    q["anomaly_check_all"] = q["anomaly_check"].replace("'2000-01-01'", "'1999-01-01'").replace(" LIMIT 20", "")
    q["anomaly_count_24h"] = sql("""SELECT count(*) AS anomaly_count FROM anomalies, order_end
WHERE detected_at >= t - INTERVAL 24 HOURS""", "anomalies", "order_end")
    q["anomalies_page"] = sql(f"""SELECT {_ANOMALY} FROM (SELECT * FROM anomalies
{_NEWEST_ANOMALY} LIMIT 100 OFFSET 100)""", "anomalies")
    q["anomalies_by_type"] = sql(f"""SELECT anomaly_type, count(*) AS anomalies FROM (SELECT * FROM anomalies
{_NEWEST_ANOMALY} LIMIT 100) GROUP BY anomaly_type""", "anomalies")

    # Inventory
    q["stock_movements"] = sql(f"""SELECT {ts('window_start')} AS window_start, product_id, sold_quantity,
  transaction_count FROM movements""", "movements")
    q["stock_status"] = sql(f"""SELECT product_id, product_name, category,
  greatest(current_stock - coalesce(s, 0), 0) AS current_stock, reserved_stock,
  greatest(current_stock - coalesce(s, 0), 0) AS available_stock, {LOADED} AS last_updated
FROM status LEFT JOIN (SELECT product_id, {big('sum(sold_quantity)')} AS s FROM movements GROUP BY product_id)
USING (product_id)""", "status", "movements")
    q["stock_of_new_products"] = sql(f"""SELECT product_id,
  CASE WHEN known THEN product_name ELSE 'Product ' || product_id END AS product_name,
  CASE WHEN known THEN category ELSE 'General' END AS category,
  left_over AS current_stock, CAST(0 AS BIGINT) AS reserved_stock, left_over AS available_stock,
  {LOADED} AS last_updated
FROM (SELECT *, category <> 'ECONOMY' AS known,
        CASE WHEN category <> 'ECONOMY' THEN greatest(current_stock - coalesce(s, 0), 0)
             WHEN n = 1 THEN 2000 - s ELSE greatest(2000 - s, 0) END AS left_over
      FROM status LEFT JOIN (SELECT product_id, {big('sum(sold_quantity)')} AS s, count(*) AS n
        FROM movements GROUP BY product_id) USING (product_id))
WHERE known OR s IS NOT NULL""", "status", "movements")
    q["running_stock_levels"] = sql(f"""SELECT product_id, product_name, category,
  greatest(current_stock - s, 0) AS current_stock, reserved_stock, greatest(current_stock - s, 0) AS available_stock,
  {ts('newest')} AS last_updated
FROM status JOIN (SELECT product_id, {big('sum(sold_quantity)')} AS s, max(window_start) AS newest
  FROM movements GROUP BY product_id) USING (product_id)""", "status", "movements")
    q["running_stock_alerts"] = sql(f"SELECT {_ALERT} FROM stock_alerts", "stock_alerts")
    q["low_stock_alerts"] = sql(f"SELECT {_ALERT} FROM stock_alerts", "stock_alerts")
    q["low_stock_alerts_repeated"] = sql(f"SELECT {_ALERT} FROM levels WHERE available < 300", "levels")
    q["alerts_of_new_products"] = sql(f"""SELECT product_id,
  CASE WHEN known THEN product_name ELSE 'Product ' || product_id END AS product_name,
  CASE WHEN known THEN category ELSE 'General' END AS category, {big('after')} AS current_stock,
  CAST(300 AS BIGINT) AS threshold, {ts('window_start')} AS alert_time, 'active' AS status
FROM (SELECT *, greatest(opening - sold, 0) AS after, greatest(opening - sold + sold_quantity, 0) AS before
      FROM (SELECT running.*, product_name, category, category <> 'ECONOMY' AS known,
              CASE WHEN category <> 'ECONOMY' THEN current_stock ELSE 500 END AS opening
            FROM running JOIN status USING (product_id)))
WHERE after < 300 AND ((known AND before >= 300) OR (NOT known AND (nth = 2 OR (nth > 2 AND before >= 300))))
""", "running", "status")
    q["seed_inventory"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
  p_type AS category, CAST(80 AS BIGINT) AS current_stock, CAST(0 AS BIGINT) AS reserved_stock,
  CAST(80 AS BIGINT) AS available_stock FROM part"""
    q["seed_alerts"] = sql(f"""SELECT product_id, product_name, category, available_stock AS current_stock,
  CAST(300 AS BIGINT) AS threshold, {LOADED} AS alert_time, 'active' AS status FROM status
WHERE available_stock < 300 AND product_id NOT IN (SELECT product_id FROM stock_alerts)""", "status", "stock_alerts")
    q["low_stock_count_24h"] = sql("""SELECT count(*) AS low_stock_count FROM stock_alerts
WHERE window_start BETWEEN TIMESTAMP '1997-01-01' - INTERVAL 24 HOURS AND TIMESTAMP '1997-01-01'""", "stock_alerts")
    check = """SELECT 'low_stock_' || product_id || '_' || CAST(available_stock AS VARCHAR) AS alert_key, product_id,
  product_name, category, available_stock,
  CASE WHEN available_stock < 50 THEN 'red' ELSE 'yellow' END AS severity FROM status
WHERE available_stock > 0 AND """
    q["low_stock_check"] = sql(
        check + "available_stock < 100 ORDER BY available_stock, product_id LIMIT 20", "status")
    q["low_stock_check_all"] = sql(check + "available_stock < 400", "status")
    q["unsent_low_stock"] = sql(check + """available_stock < 400 AND category <> 'PROMO'
ORDER BY available_stock, product_id LIMIT 1000""", "status")
    q["alerts_due"] = sql(check + "available_stock < 400 AND available_stock > 0 AND category <> 'PROMO'", "status")
    q["stock_page"] = sql(f"""SELECT {_STOCK} FROM status WHERE available_stock < 500
ORDER BY available_stock, product_id LIMIT 100 OFFSET 20""", "status")
    q["stock_labels"] = sql("""SELECT substring(product_name, 1, 20) AS label, available_stock, product_id
FROM status WHERE available_stock < 500 ORDER BY available_stock, product_id LIMIT 10""", "status")

    # Sessions
    q["session_metrics"] = sql(f"SELECT {_SESSION} FROM fixed_sessions", "fixed_sessions")
    q["session_products"] = sql("""SELECT session_id, user_id, count(DISTINCT product_id) AS unique_products
FROM cart GROUP BY session_id, user_id, date_trunc('day', moment)""", "cart")
    q["session_products_approx"] = sql("""SELECT DISTINCT session_id, user_id, true AS close FROM cart""", "cart")
    q["distinct_products_of_months"] = sql(
        "SELECT DISTINCT strftime(moment, '%Y-%m') AS month, true AS close FROM cart", "cart")
    q["session_windows"] = q["session_windows_native"] = sql(f"SELECT {_SESSION} FROM sessions", "sessions")
    upsert = TABLES["upserted"][1].replace("FROM sessions", "FROM fixed_sessions")
    q["session_upsert"] = sql(f"SELECT {_SESSION} FROM ({upsert})", "fixed_sessions")
    q["session_upsert_compacted"] = q["session_upsert"]
    q["cart_abandonment"] = sql(f"""SELECT session_id, user_id, products_in_cart, cart_value,
  {ts('abandonment_time')} AS abandonment_time, time_in_cart_minutes FROM abandoned""", "abandoned")
    q["cart_contents"] = sql("SELECT * FROM cart_left", "cart_left")
    q["cart_abandonment_valued"] = sql(f"""SELECT session_id, user_id, products_in_cart, cart_value,
  {ts('abandonment_time')} AS abandonment_time, time_in_cart_minutes FROM valued""", "valued")
    q["valuable_abandoned_carts"] = q["cart_abandonment_valued"] + " WHERE cart_value > 5000"
    q["abandonment_spike_valued"] = sql("""SELECT * FROM (SELECT count(*) AS cart_count,
  coalesce(sum(cart_value), 0) AS total_value FROM valued, event_end
  WHERE abandonment_time BETWEEN t - INTERVAL 13 HOURS AND t - INTERVAL 12 HOURS) WHERE cart_count > 0""",
        "valued", "event_end")
    q["cart_values"] = sql(
        f"SELECT session_id, {dbl('cart_value')} AS cart_value FROM cart_totals", "cart_totals")
    q["valuable_carts"] = sql(
        f"SELECT session_id, {dbl('cart_value')} AS cart_value FROM cart_totals WHERE cart_value > 5000", "cart_totals")
    q["unpurchased_carts"] = sql(f"""SELECT {_SESSION} FROM sessions s WHERE cart_adds > 0 AND NOT EXISTS (
  SELECT 1 FROM purchases p WHERE p.user_id = s.user_id AND p.moment >= s.start_time
    AND p.moment <= s.end_time + {GAP})""", "sessions", "purchases")
    q["abandonment_spike"] = sql("""SELECT * FROM (SELECT count(*) AS cart_count,
  coalesce(sum(cart_value), 0) AS total_value FROM abandoned, event_end
  WHERE abandonment_time >= t - INTERVAL 1 HOUR) WHERE cart_count > 0""", "abandoned", "event_end")
    q["abandonment_count_24h"] = sql("""SELECT count(*) AS abandonment_count FROM abandoned, event_end
WHERE abandonment_time >= t - INTERVAL 24 HOURS""", "abandoned", "event_end")
    q["sessions_last_hour"] = sql("""SELECT count(*) AS sessions_last_hour FROM sessions, event_end
WHERE end_time >= t - INTERVAL 1 HOUR""", "sessions", "event_end")
    q["sessions_page"] = sql(f"""SELECT session_id, user_id, {ts('start_time')} AS start_time, duration_seconds,
  page_views, cart_adds, false AS abandoned FROM (SELECT * FROM upserted
  ORDER BY start_time DESC, session_id LIMIT 100 OFFSET 100)""", "upserted")

    # Sales reports
    newest = "ORDER BY window_start DESC, category, country LIMIT"
    q["sales_rows"] = sql(_sales_select("(SELECT * FROM daily_sales " + f"""WHERE window_start >= '1996-01-01'
  AND window_end <= '1999-12-31' AND category = 'PROMO' {newest} 500)"""), "daily_sales")
    q["sales_rows_of_country"] = sql(_sales_select(
        f"(SELECT * FROM daily_sales WHERE country = 'NATION_5' {newest} 100)"), "daily_sales")
    q["sales_summary_today"] = _summary("today", "date_trunc('day', t)")
    q["sales_summary_week"] = _summary("week", "t - INTERVAL 7 DAYS")
    q["sales_summary_month"] = _summary("month", "t - INTERVAL 30 DAYS")
    q["sales_totals"] = sql(_totals(
        "daily_sales", "WHERE window_start >= '1996-01-01' AND window_end <= '1997-01-01'"), "daily_sales")
    q["performance_rows"] = sql(
        f"SELECT {_PERFORMANCE} FROM performance ORDER BY total_revenue DESC, category LIMIT 4", "performance")
    q["performance_of_category"] = sql(
        f"SELECT {_PERFORMANCE} FROM performance WHERE category = 'PROMO'", "performance")
    q["top_performers"] = sql("""SELECT category, total_revenue FROM performance
ORDER BY total_revenue DESC, category LIMIT 3""", "performance")
    q["dashboard"] = sql(f"""WITH today AS (SELECT sales.* FROM sales, event_end WHERE window_start >= date_trunc('day', t)),
bought AS (SELECT purchases.* FROM purchases, event_end WHERE moment >= date_trunc('day', t))
SELECT coalesce({dbl('sum(total_amount)')}, 0) AS total_revenue_today,
  {big('coalesce(sum(transaction_count), 0)')} AS total_transactions_today,
  coalesce({dbl('sum(avg_cents)')} / 100 / count(*), 0) AS avg_transaction_value,
  (SELECT count(*) FROM bought WHERE total_amount > 100) AS anomalies_count,
  (SELECT category FROM performance ORDER BY rank LIMIT 1) AS top_category,
  (SELECT country FROM today GROUP BY country ORDER BY sum(total_amount) DESC, country DESC LIMIT 1) AS top_country,
  (SELECT count(DISTINCT user_id) FROM bought) AS active_users FROM today""", "sales", "event_end", "performance", "purchases")
    q["dashboard"] = q["dashboard"].replace("\nWITH today AS", ",\ntoday AS")
    q["revenue_24h"] = sql(f"""SELECT coalesce({dbl('sum(total_amount)')}, 0) AS total_revenue
FROM sales, event_end WHERE window_start >= t - INTERVAL 24 HOURS""", "sales", "event_end")
    q["transactions_24h"] = sql(f"""SELECT {big('coalesce(sum(transaction_count), 0)')} AS total_transactions
FROM sales, event_end WHERE window_start >= t - INTERVAL 24 HOURS""", "sales", "event_end")
    between = "FROM sales WHERE window_start >= '2024-01-05' AND window_start <= '2024-01-20' GROUP BY window_start"
    q["revenue_series"] = sql(
        f"SELECT {ts('window_start')} AS time, {dbl('sum(total_amount)')} AS revenue {between}", "sales")
    q["transaction_series"] = sql(
        f"SELECT {ts('window_start')} AS time, {big('sum(transaction_count)')} AS transactions {between}", "sales")
    stats = f"""SELECT category, {dbl('sum(total_amount)')} AS revenue, {big('sum(transaction_count)')} AS transactions,
  {dbl('(2 * sum(avg_cents) + count(*)) // (2 * count(*))')} / 100 AS avg_order_value FROM fact"""
    q["category_stats"] = sql(
        stats + " GROUP BY category ORDER BY sum(total_amount) DESC, category LIMIT 10", "fact")
    q["category_stats_of_country"] = sql(stats + " WHERE country = 'NATION_2' GROUP BY category", "fact")
    q["category_overview"] = sql(f"""SELECT count(DISTINCT category) AS total_categories,
  (SELECT category FROM fact GROUP BY category ORDER BY sum(total_amount) DESC, category DESC LIMIT 1) AS top_category,
  {dbl('sum(total_amount)')} AS total_revenue FROM fact""", "fact")
    q["sales_page"] = sql(_sales_select(f"(SELECT * FROM sales {newest} 100 OFFSET 200)"), "sales")
    q["page_totals"] = sql(_totals(f"(SELECT * FROM sales {newest} 100)"), "sales")
    q["page_revenue_by_category"] = sql(f"""SELECT category, {dbl('sum(total_amount)')} AS revenue
FROM (SELECT * FROM sales {newest} 100) GROUP BY category""", "sales")
    q["sales_by_category"] = sql(f"""SELECT category, {dbl('sum(total_amount)')} AS total_revenue,
  {big('sum(transaction_count)')} AS total_transactions FROM fact GROUP BY category""", "fact")
    q["adhoc_sql"] = sql(f"""SELECT country, category, {dbl('sum(total_amount)')} AS revenue, count(*) AS windows
FROM sales WHERE transaction_count > 1 GROUP BY country, category""", "sales")

    # Monitoring
    q["events_last_hour"] = sql(f"""SELECT {big('sum(event_count)')} AS total_events FROM topics, event_end
WHERE timestamp > t - INTERVAL 1 HOUR""", "topics", "event_end")
    q["event_rate"] = sql(f"""SELECT coalesce({dbl('sum(event_count)')}, 0) / {dbl('7200')} AS rate FROM topics, event_end
WHERE timestamp > t - INTERVAL 2 HOURS""", "topics", "event_end")
    q["topic_series"] = sql(f"""SELECT {ts('timestamp')} AS time, topic, event_count FROM topics, event_end
WHERE timestamp > t - INTERVAL 3 HOURS""", "topics", "event_end")
    q["topic_totals"] = sql(f"""SELECT topic, {big('sum(event_count)')} AS total_events FROM topics, event_end
WHERE timestamp > t - INTERVAL 6 HOURS GROUP BY topic""", "topics", "event_end")
    for name, metric in (("cpu", "cpu_usage"), ("memory", "memory_usage"), ("disk", "disk_usage")):
        q[f"latest_{name}"] = _gauge(metric)
    q["gauge_series"] = sql(f"""SELECT {ts('timestamp')} AS time, metric_name, {dbl('metric_value')} AS metric_value
FROM health, event_end WHERE metric_type = 'gauge' AND timestamp > t - INTERVAL 6 HOURS""", "health", "event_end")
    q["container_states"] = sql(f"""SELECT metadata AS container_name,
  CASE WHEN metric_value = 1 THEN 'UP' ELSE 'DOWN' END AS status, {ts('timestamp')} AS last_check FROM health
WHERE metric_name = 'container_status'
QUALIFY row_number() OVER (PARTITION BY metadata ORDER BY timestamp DESC, metric_value DESC) = 1""", "health")
    health = f"""metric_name, {dbl('metric_value')} AS metric_value, metric_type, {ts('timestamp')} AS timestamp,
  metadata, event_id"""
    q["own_containers"] = sql(f"SELECT {health} FROM health WHERE lower(metadata) LIKE '%c3%'", "health")
    q["system_alerts"] = sql(f"""SELECT {health}, CAST(90 AS DOUBLE) AS threshold FROM health
WHERE metric_name IN ('cpu_usage', 'memory_usage') AND metric_value > 90""", "health")
    q["red_gauges"] = sql(f"""SELECT {health}, CASE metric_name WHEN 'disk_usage' THEN CAST(85 AS DOUBLE)
  ELSE CAST(80 AS DOUBLE) END AS threshold FROM health WHERE (metric_name IN ('cpu_usage', 'memory_usage')
  AND metric_value > 80) OR (metric_name = 'disk_usage' AND metric_value > 85)""", "health")
    q["numbers_from_text"] = sql(f"""SELECT event_type, {dbl('sum(k)')} AS k_total, CAST(0 AS BIGINT) AS numeric_types
FROM ev GROUP BY event_type""", "ev")
    q["latest_event_per_user"] = f"""SELECT event_id, {ts('ts')} AS ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1"""

    # History and quality
    q["payment_history"] = q["payment_history_hot_keys"] = q["payment_history_amended"] = sql(f"""SELECT user_id, payment_method, {ts('moment')} AS valid_from,
  {ts('lead(moment) OVER w')} AS valid_to, lead(moment) OVER w IS NULL AS is_current FROM (
    SELECT *, lag(payment_method) OVER (PARTITION BY user_id ORDER BY moment) AS before
    FROM (SELECT user_id, moment, max(payment_method) AS payment_method FROM tx GROUP BY user_id, moment))
WHERE before IS NULL OR before <> payment_method WINDOW w AS (PARTITION BY user_id ORDER BY moment)""", "tx")
    old = "'2020-01-01 00:00:00.000000'"
    q["merged_history"] = f"""SELECT p_partkey AS product_id, p_type AS category, p_retailprice AS price, {old} AS valid_from,
  CASE WHEN p_size > 30 THEN {LOADED} END AS valid_to, p_size <= 30 AS is_current FROM part WHERE p_size <= 40
UNION ALL
SELECT p_partkey, p_type, p_retailprice + 1, {LOADED}, NULL, true FROM part WHERE p_size > 30"""
    rules = {
        "amount below 400000": "total_amount < 400000", "category known": "category <> 'General'",
        "user present": "user_id IS NOT NULL", "urgent payments marked": "payment_method = '1-URGENT'",
    }
    q["quality_report"] = sql("\nUNION ALL\n".join(
        f"""SELECT '{name}' AS rule, count(*) AS rows, count(*) FILTER (NOT ({rule})) AS failed,
  {dbl(f'count(*) FILTER (NOT ({rule}))')} / count(*) AS failed_share FROM tx""" for name, rule in rules.items()), "tx")
    q["quality_while_written"] = q["quality_report"]
    q["duplicate_lines"] = """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
    return q
