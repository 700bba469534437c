"""The query surface: each report is a function from stored tables to a DataFrame.

`as_of` may be a timestamp, its text, or a column such as a scalar subquery; nothing reads the clock.
Limits here are features of the report (pages and top lists) and always follow a total order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.functions.exact import as_timestamp, or_zero, ratio
from tillstream.functions.labels import known_or
from tillstream.operators.ranking import latest_per_key, page

SALES = [
    "window_start", "window_end", "category", "country", "total_amount", "transaction_count",
    "avg_transaction_value",
]


def _newest_sales() -> list[Column]:
    return [F.col("window_start").desc(), F.col("category").asc(), F.col("country").asc()]


def _newest_anomalies() -> list[Column]:
    return [
        F.col("detected_at").desc(), F.col("transaction_id").asc(), F.col("anomaly_type").asc(),
        F.col("product_id").asc(), F.col("anomaly_score").asc(),
    ]


def where(df: DataFrame, *conditions: Column | None) -> DataFrame:
    """All conditions that are given; plain predicates, so they reach the scan."""
    return reduce(DataFrame.filter, [c for c in conditions if c is not None], df)


def _equals(column: str, value: str | None) -> Column | None:
    return None if value in (None, "", "All") else F.col(column) == value


def _since(column: str, value) -> Column | None:
    return None if value is None else F.col(column) >= as_timestamp(value)


def _until(column: str, value) -> Column | None:
    return None if value is None else F.col(column) <= as_timestamp(value)


def within(df: DataFrame, column: str, as_of, interval: str, strict: bool = False) -> DataFrame:
    """Rows of the last `interval` up to `as_of`, for example "24 HOURS"."""
    now, at = as_timestamp(as_of), F.col(column)
    edge = now - F.expr(f"INTERVAL {interval}")
    return df.filter((at > edge if strict else at >= edge) & (at <= now))


def _checked(limit: int, most: int = 1000) -> int:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}")
    return limit


# Sales ---------------------------------------------------------------------------------------


def sales_rows(
    sales: DataFrame, start=None, end=None, category: str | None = None,
    country: str | None = None, limit: int = 100,
) -> DataFrame:
    """Sales windows with optional filters, newest first."""
    found = where(
        sales, _since("window_start", start), _until("window_end", end),
        _equals("category", category), _equals("country", country),
    )
    return page(found.select(*SALES), _newest_sales(), _checked(limit))


PERIODS = {"today": None, "week": "7 DAYS", "month": "30 DAYS"}


def sales_summary(sales: DataFrame, period: str, as_of) -> DataFrame:
    """Window totals of today, the last week or the last month; zeros when there are none.

    `window_count` and the minimum, average and maximum are over window rows;
    `transaction_count` is the true number of transactions.
    """
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}")
    now = as_timestamp(as_of)
    start = F.date_trunc("day", now) if PERIODS[period] is None else now - F.expr(f"INTERVAL {PERIODS[period]}")
    rows = sales.filter((F.col("window_start") >= start) & (F.col("window_end") <= now))
    amount = F.col("total_amount")
    totals = rows.agg(
        F.count("*").alias("window_count"), F.sum("transaction_count").alias("_transactions"),
        F.sum(amount).alias("_revenue"), F.min(amount).alias("_min"), F.max(amount).alias("_max"),
    )
    return totals.select(
        F.lit(period).alias("period"), "window_count",
        F.coalesce("_transactions", F.lit(0)).alias("transaction_count"),
        or_zero(F.col("_revenue").cast("double")).alias("total_revenue"),
        or_zero(ratio("_revenue", "window_count")).alias("avg_window_value"),
        or_zero(F.col("_min").cast("double")).alias("min_window"),
        or_zero(F.col("_max").cast("double")).alias("max_window"),
    )


def sales_totals(sales: DataFrame, start=None, end=None, country: str | None = None) -> DataFrame:
    """Revenue, transactions and average order value of a period."""
    found = where(
        sales, _since("window_start", start), _until("window_end", end), _equals("country", country)
    )
    return _totals(found)


def _totals(sales: DataFrame) -> DataFrame:
    summed = sales.agg(
        F.sum("total_amount").alias("_revenue"), F.sum("transaction_count").alias("_transactions"),
    )
    return summed.select(
        or_zero(F.col("_revenue").cast("double")).alias("total_revenue"),
        F.coalesce("_transactions", F.lit(0)).alias("total_transactions"),
        or_zero(ratio("_revenue", "_transactions")).alias("avg_order_value"),
    )


# Customers -----------------------------------------------------------------------------------


def customer_rows(
    segments: DataFrame, code: str | None = None, name: str | None = None,
    country: str | None = None, limit: int = 100,
) -> DataFrame:
    found = where(
        segments, _equals("rfm_segment", code), _equals("segment_name", name),
        _equals("country", country),
    )
    return page(found, [F.col("user_id").asc(), F.col("country").asc()], _checked(limit))


def documented_segments(segments: DataFrame, country: str | None = None) -> DataFrame:
    """Per segment name: customers, average money and purchases, total value."""
    return where(segments, _equals("country", country)).groupBy("segment_name").agg(
        F.count("*").alias("customer_count"), F.sum("monetary").alias("total_value"),
        F.sum("frequency").alias("_frequency"),
    ).select(
        "segment_name", "customer_count",
        ratio("total_value", "customer_count").alias("avg_monetary"),
        ratio("_frequency", "customer_count").alias("avg_frequency"), "total_value",
    )


# Products ------------------------------------------------------------------------------------


def performance_rows(
    performance: DataFrame, category: str | None = None, sort_by: str = "total_revenue",
    limit: int = 100,
) -> DataFrame:
    """Category performance, best first. Unknown or absent sort fields fall back to revenue."""
    allowed = {"total_revenue", "units_sold", "performance_score"} & set(performance.columns)
    field = sort_by if sort_by in allowed else "total_revenue"
    found = where(performance, _equals("category", category))
    return page(found, [F.col(field).desc(), F.col("category").asc()], _checked(limit))


def top_performers(performance: DataFrame, n: int = 10) -> DataFrame:
    """The n best entries. Fields that the performance table lacks are left out."""
    wanted = ["product_id", "product_name", "category", "total_revenue", "units_sold"]
    rows = page(performance, [F.col("total_revenue").desc(), F.col("category").asc()], _checked(n, 100))
    return rows.select(*[c for c in wanted if c in performance.columns])


# Anomalies and dashboard -----------------------------------------------------------------------


def anomaly_rows(
    anomalies: DataFrame, kind: str | None = None, start=None, limit: int = 100, offset: int = 0,
) -> DataFrame:
    """Recent anomalies, newest first."""
    found = where(anomalies, _equals("anomaly_type", kind), _since("detected_at", start))
    return page(found, _newest_anomalies(), _checked(limit), offset)


def dashboard(
    sales: DataFrame, anomalies: DataFrame, performance: DataFrame, as_of,
    transactions: DataFrame | None = None,
) -> DataFrame:
    """One row: today's revenue, transactions, average, anomalies, top category and country."""
    end = as_timestamp(as_of)
    today = F.date_trunc("day", end)
    now = sales.filter((F.col("window_start") >= today) & (F.col("window_start") <= end))
    summed = now.agg(
        F.sum("total_amount").alias("revenue"), F.sum("transaction_count").alias("transactions"),
        F.sum("avg_transaction_value").alias("averages"),
        F.count("avg_transaction_value").alias("windows"),
    )
    count = anomalies.filter(F.col("detected_at").between(today, end)).agg(F.count("*"))
    best = performance.agg(F.max_by("category", F.struct(
        "total_revenue", F.lit(0) - F.col("rank"),
    )))
    country = now.groupBy("country").agg(F.sum("total_amount").alias("revenue")).agg(
        F.max_by("country", F.struct("revenue", "country"))
    )
    columns = [
        or_zero(F.col("revenue").cast("double")).alias("total_revenue_today"),
        F.coalesce("transactions", F.lit(0)).alias("total_transactions_today"),
        or_zero(ratio("averages", "windows")).alias("avg_transaction_value"),
        count.scalar().alias("anomalies_count"),
        F.coalesce(best.scalar(), F.lit("N/A")).alias("top_category"),
        F.coalesce(country.scalar(), F.lit("N/A")).alias("top_country"),
    ]
    if transactions is not None:
        users = transactions.filter(F.col("timestamp").between(today, end)).agg(F.count_distinct("user_id"))
        columns.append(users.scalar().alias("active_users"))
    return summed.select(*columns)


# Panels --------------------------------------------------------------------------------------


def revenue_since(sales: DataFrame, as_of, interval: str = "24 HOURS") -> DataFrame:
    return within(sales, "window_start", as_of, interval).agg(
        or_zero(F.sum("total_amount").cast("double")).alias("total_revenue")
    )


def transactions_since(sales: DataFrame, as_of, interval: str = "24 HOURS") -> DataFrame:
    return within(sales, "window_start", as_of, interval).agg(
        F.coalesce(F.sum("transaction_count"), F.lit(0)).alias("total_transactions")
    )


def count_since(df: DataFrame, column: str, as_of, interval: str, name: str) -> DataFrame:
    """Rows of the last `interval`: anomalies, low-stock alerts, abandoned carts, sessions."""
    return within(df, column, as_of, interval).agg(F.count("*").alias(name))


def sales_series(sales: DataFrame, measure: str, name: str, start=None, end=None) -> DataFrame:
    """Sum of `measure` per window start inside a time range, in time order."""
    rows = where(sales, _since("window_start", start), _until("window_start", end))
    return rows.groupBy(F.col("window_start").alias("time")).agg(
        F.sum(measure).alias(name)
    ).orderBy("time")


def events_since(topics: DataFrame, as_of, interval: str = "1 HOUR") -> DataFrame:
    return within(topics, "timestamp", as_of, interval, strict=True).agg(
        F.sum("event_count").alias("total_events")
    )


def event_rate(topics: DataFrame, as_of, interval: str = "1 MINUTE", seconds: int = 60) -> DataFrame:
    total = or_zero(F.sum("event_count").cast("double"))
    return within(topics, "timestamp", as_of, interval, strict=True).agg(
        (total / F.lit(float(seconds))).alias("rate")
    )


def topic_series(topics: DataFrame, as_of, interval: str = "1 HOUR") -> DataFrame:
    return within(topics, "timestamp", as_of, interval, strict=True).select(
        F.col("timestamp").alias("time"), "topic", "event_count"
    ).orderBy("time", "topic")


def topic_totals(topics: DataFrame, as_of, interval: str = "6 HOURS") -> DataFrame:
    return within(topics, "timestamp", as_of, interval, strict=True).groupBy("topic").agg(
        F.sum("event_count").alias("total_events")
    ).orderBy(F.col("total_events").desc(), "topic")


def latest_gauge(health: DataFrame, metric: str) -> DataFrame:
    """The newest value of one metric."""
    tie = [F.col("metric_value").desc()]
    rows = health.filter(F.col("metric_name") == metric).select("metric_value", "timestamp")
    return page(rows, [F.col("timestamp").desc(), *tie], 1).select("metric_value")


def gauge_series(health: DataFrame, as_of, interval: str = "6 HOURS") -> DataFrame:
    rows = within(health.filter("metric_type = 'gauge'"), "timestamp", as_of, interval, strict=True)
    return rows.select(
        F.col("timestamp").alias("time"), "metric_name", "metric_value"
    ).orderBy("time", "metric_name", "metric_value")


def container_states(health: DataFrame) -> DataFrame:
    """Newest state of each container."""
    rows = health.filter("metric_name = 'container_status'").select(
        "metadata", "metric_value", "timestamp"
    )
    return latest_per_key(rows, ["metadata"], "timestamp", tie=["metric_value"]).select(
        F.col("metadata").alias("container_name"),
        F.when(F.col("metric_value") == 1, "UP").otherwise("DOWN").alias("status"),
        F.col("timestamp").alias("last_check"),
    )


def own_containers(health: DataFrame, name_part: str) -> DataFrame:
    """Container rows whose name contains `name_part`, in any case."""
    return health.filter(F.lower("metadata").contains(name_part.lower()))


# Executive dashboard ---------------------------------------------------------------------------


def customer_kpis(segments: DataFrame, country: str | None = None) -> DataFrame:
    summed = where(segments, _equals("country", country)).agg(
        F.sum("monetary").alias("_revenue"), F.sum("frequency").alias("_orders")
    )
    return summed.select(
        or_zero(F.col("_revenue").cast("double")).alias("total_revenue"),
        F.coalesce("_orders", F.lit(0)).alias("total_transactions"),
        or_zero(ratio("_revenue", "_orders")).alias("avg_order_value"),
    )


def segment_counts(segments: DataFrame, country: str | None = None) -> DataFrame:
    return where(segments, _equals("country", country)).groupBy("segment_name").agg(
        F.count("*").alias("customers")
    ).orderBy(F.col("customers").desc(), "segment_name")


def country_overview(segments: DataFrame, country: str | None = None) -> DataFrame:
    """Number of all countries (NULL counts as one), richest country and customers shown."""
    everywhere = segments.groupBy("country").agg(F.lit(1).alias("one")).agg(F.count("*"))
    per_country = where(segments, _equals("country", country)).groupBy("country").agg(
        F.sum("monetary").alias("revenue"), F.count("*").alias("customers")
    )
    named = F.when(F.col("country").isNotNull(), F.struct(F.col("revenue"), F.col("country")))
    return per_country.agg(
        F.coalesce(F.max_by("country", named), F.lit("N/A")).alias("top_country"),
        F.coalesce(F.sum("customers"), F.lit(0)).alias("total_customers"),
    ).select(everywhere.scalar().alias("total_countries"), "top_country", "total_customers")


def country_revenue(segments: DataFrame, country: str | None = None) -> DataFrame:
    return where(segments, _equals("country", country)).groupBy("country").agg(
        F.sum("monetary").alias("revenue")
    ).orderBy(F.col("revenue").desc(), "country")


def country_stats(segments: DataFrame, country: str | None = None, n: int = 10) -> DataFrame:
    stats = where(segments, _equals("country", country)).groupBy("country").agg(
        F.round(F.sum("monetary"), 2).alias("revenue"), F.sum("frequency").alias("transactions"),
        F.count("segment_name").alias("customers"),
    )
    return page(stats, [F.col("revenue").desc(), F.col("country").asc()], n)


def category_stats(fact: DataFrame, country: str | None = None, n: int | None = None) -> DataFrame:
    """Revenue, transactions and mean window average per category, best first."""
    stats = where(fact, _equals("country", country)).groupBy("category").agg(
        F.sum("total_amount").alias("revenue"), F.sum("transaction_count").alias("transactions"),
        F.sum("avg_transaction_value").alias("_averages"),
        F.count("avg_transaction_value").alias("_n"),
    ).select(
        "category", "revenue", "transactions",
        F.round(F.try_divide(F.col("_averages"), F.col("_n")), 2).alias("avg_order_value"),
    )
    ordered = stats.orderBy(F.col("revenue").desc(), "category")
    return ordered if n is None else ordered.limit(n)


def category_overview(fact: DataFrame, country: str | None = None) -> DataFrame:
    """Number of categories, the best one and total revenue."""
    per_category = where(fact, _equals("country", country)).groupBy("category").agg(
        F.sum("total_amount").alias("revenue")
    )
    return per_category.agg(
        F.count("*").alias("total_categories"),
        F.coalesce(F.max_by("category", F.struct("revenue", "category")), F.lit("N/A"))
        .alias("top_category"),
        or_zero(F.sum("revenue").cast("double")).alias("total_revenue"),
    )


def customer_insights(segments: DataFrame, country: str | None = None) -> DataFrame:
    summed = where(segments, _equals("country", country)).agg(
        F.count("*").alias("total_customers"),
        F.count_if(F.col("segment_name") == "Champions").alias("champions"),
        F.sum("frequency").alias("_frequency"), F.sum("monetary").alias("_monetary"),
    )
    return summed.select(
        "total_customers", "champions",
        ratio("_frequency", "total_customers").alias("avg_frequency"),
        ratio("_monetary", "total_customers").alias("avg_monetary"),
    )


def segment_value(segments: DataFrame, country: str | None = None) -> DataFrame:
    return where(segments, _equals("country", country)).groupBy("segment_name").agg(
        F.sum("monetary").alias("total_value")
    ).orderBy(F.col("total_value").desc(), "segment_name")


def segment_metrics(segments: DataFrame, country: str | None = None) -> DataFrame:
    return where(segments, _equals("country", country)).groupBy("segment_name").agg(
        F.sum("frequency").alias("_frequency"), F.sum("monetary").alias("_monetary"),
        F.count("*").alias("customer_count"),
    ).select(
        "segment_name",
        F.round(F.try_divide(F.col("_frequency").cast("decimal(22,0)"), F.col("customer_count")), 2)
        .alias("avg_frequency"),
        F.round(F.try_divide(F.col("_monetary"), F.col("customer_count")), 2).alias("avg_monetary"),
        "customer_count",
    ).orderBy("segment_name")


def customer_scatter(segments: DataFrame, country: str | None = None) -> DataFrame:
    return where(segments, _equals("country", country)).select("frequency", "monetary", "segment_name")


# Explorer ------------------------------------------------------------------------------------


def sales_page(sales: DataFrame, offset: int = 0, limit: int = 100) -> DataFrame:
    return page(sales.select(*SALES), _newest_sales(), limit, offset)


def sessions_page(sessions: DataFrame, offset: int = 0, limit: int = 100) -> DataFrame:
    flags = sessions if "abandoned" in sessions.columns else sessions.withColumn("abandoned", F.lit(False))
    rows = flags.select(
        "session_id", "user_id", "start_time", "duration_seconds", "page_views", "cart_adds", "abandoned"
    )
    return page(rows, [F.col("start_time").desc(), F.col("session_id").asc()], limit, offset)


def stock_page(status: DataFrame, below: int = 100, offset: int = 0, limit: int = 100) -> DataFrame:
    rows = status.filter(F.col("available_stock") < below)
    return page(rows, [F.col("available_stock").asc(), F.col("product_id").asc()], limit, offset)


def anomalies_page(anomalies: DataFrame, offset: int = 0, limit: int = 100) -> DataFrame:
    rows = anomalies.select(
        "transaction_id", "user_id", "product_id", "amount", "anomaly_score", "anomaly_type",
        "detected_at", "description",
    )
    return page(rows, _newest_anomalies(), limit, offset)


page_totals = _totals


def revenue_by_category(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.sum("total_amount").alias("revenue"))


def count_by_type(rows: DataFrame) -> DataFrame:
    return rows.groupBy("anomaly_type").agg(F.count("*").alias("anomalies"))


def chart_labels(status_rows: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of a stock page with names cut to 20 characters."""
    return page(status_rows, [F.col("available_stock").asc(), F.col("product_id").asc()], n).select(
        F.substring("product_name", 1, 20).alias("label"), "available_stock", "product_id"
    )


# Warehouse -----------------------------------------------------------------------------------


def sales_by_category(fact: DataFrame) -> DataFrame:
    return fact.groupBy("category").agg(
        F.sum("total_amount").alias("total_revenue"),
        F.sum("transaction_count").alias("total_transactions"),
    ).orderBy(F.col("total_revenue").desc(), "category")


def segments_by_name(segments: DataFrame) -> DataFrame:
    return segments.groupBy(known_or("segment_name").alias("segment_name")).agg(
        F.count("*").alias("customer_count"), F.sum("monetary").alias("_monetary"),
    ).select("segment_name", "customer_count", ratio("_monetary", "customer_count").alias("avg_monetary"))


def trends_of(trends: DataFrame, period_type: str = "monthly") -> DataFrame:
    """Stored trends of one grain, by period text descending."""
    return trends.filter(F.col("period_type") == period_type).orderBy(F.col("period").desc())


# Ad-hoc SQL ----------------------------------------------------------------------------------


def run_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run one read-only statement over the given tables.

    Only SELECT and WITH queries are accepted; Spark's own parser must find no command in them, no function that calls
    into the JVM, and no relation but the given tables and the query's own named parts where they can be
    seen: no files, no other tables. A temporary view of the caller that has the name of a given table is back afterwards.
    """
    if not text or not text.strip():
        raise ValueError("a query is required")
    if text.strip().split(None, 1)[0].upper().rstrip("(") not in ("SELECT", "WITH"):
        raise PermissionError("only SELECT and WITH queries are allowed")
    tables = tables or {}
    _admit(spark._jsparkSession.sessionState().sqlParser().parsePlan(text), {name.lower() for name in tables})
    own = {v.name.lower(): spark.table(v.name) for v in spark.catalog.listTables() if v.isTemporary}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(text)  # resolved here; the views are not needed to run it
    finally:
        for name in tables:
            if name.lower() in own:
                own[name.lower()].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


#: Functions that call any method of the JVM.
_CALLS_OUT = {"reflect", "java_method", "try_reflect"}


#: Expressions that hold a query of their own.
_WITH_PLAN = {"ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"}


def _each(sequence):
    return (sequence.apply(i) for i in range(sequence.size()))


def _admit(plan, known: set[str]) -> None:
    """Raises PermissionError unless a parsed plan only reads relations in `known` and its own named parts."""
    kind = plan.getClass().getSimpleName()
    if any(word in plan.getClass().getName() for word in ("Command", "InsertInto", "plans.logical.Merge")):
        raise PermissionError("only queries that read are allowed")
    if kind == "UnresolvedRelation":
        name = plan.multipartIdentifier().mkString(".")
        if name.lower() not in known:
            raise PermissionError(f"not one of the given tables: {name}")
    if kind == "UnresolvedWith":
        known = set(known)
        for part in _each(plan.cteRelations()):
            # A part sees those before it; one that names itself is recursive or reads a given table.
            _admit(part._2(), known | {part._1().lower()} if plan.allowRecursion() else known)
            known.add(part._1().lower())
    for expression in _each(plan.expressions()):
        _admit_expression(expression, known)
    for child in _each(plan.children()):
        _admit(child, known)


def _admit_expression(expression, known: set[str]) -> None:
    if expression.getClass().getSimpleName() == "UnresolvedFunction":
        if expression.nameParts().last().lower() in _CALLS_OUT:
            raise PermissionError(f"not allowed: {expression.nameParts().last()}")
    if expression.getClass().getSimpleName() in _WITH_PLAN:
        _admit(expression.plan(), known)
    for child in _each(expression.children()):
        _admit_expression(child, known)

