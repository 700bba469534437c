"""Named queries: each takes (spark, folder of the given tables) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillstream.functions.exact import as_number
from tillstream.operators import (
    alerts, anomalies, categories, inventory, metrics, quality, ranking, rfm, running_stock, sessions, trends,
    warehouse,
)
from tillstream.plans import serving
from tillstream.settings import AlertRules, AnomalyRules, SalesWindows, StockRules
from tillstream.sources import events as event_source
from tillstream.session import stage, staging_root
from tillstream.sources.given import GivenTables
from tillstream.sources.tables import TableStore
from tillstream.streaming import jobs

LOADED_AT = "2025-01-01 00:00:00"
# The given orders and events have other ranges than the defaults were made for.
RULES = AnomalyRules(high_value=450_000.0, quantity=45, rapid_limit=2, rapid_window="6 hours")
STOCK_THRESHOLD = 300
_QUALITY = {
    "amount below 400000": "total_amount < 400000",
    "category known": "category <> 'General'",
    "user present": "user_id IS NOT NULL",
    "urgent payments marked": "payment_method = '1-URGENT'",
}
SESSION_GAP = 6 * 3600
HOURLY = SalesWindows(length="1 hour", slide="30 minutes")
ALERTS = AlertRules(anomaly_score=1.05, high_risk_score=1.08, urgent_score=1.1, carts_per_hour=0,
                    cart_value=5000.0)


class Retail:
    """The retail tables that the queries start from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.given = spark, GivenTables(spark, folder)

    # Points in time stay inside the plan as scalar subqueries.
    @cached_property
    def order_end(self):
        return self.given.table("orders").agg(F.max("o_orderdate")).scalar()

    @cached_property
    def event_end(self):
        return self.given.table("events").agg(F.max("ts")).scalar()

    @cached_property
    def transactions(self) -> DataFrame:
        return self.given.transactions()

    @cached_property
    def orders(self) -> DataFrame:
        """Transactions without their category, which costs no scan of line items."""
        return self.given.transactions(categories=False)

    @cached_property
    def order_amounts(self) -> DataFrame:
        """Transactions without category and country, which costs no join."""
        return self.given.transactions(categories=False, countries=False)

    @cached_property
    def purchases(self) -> DataFrame:
        return self.given.purchases()

    @cached_property
    def purchase_times(self) -> DataFrame:
        return self.given.purchase_times()

    @cached_property
    def daily_sales(self) -> DataFrame:
        return metrics.sales_metrics(self.transactions, "1 day", None)

    @cached_property
    def fact(self) -> DataFrame:
        # Tumbling windows never overlap, so there is nothing to filter.
        return warehouse.fact_sales(self.daily_sales, LOADED_AT, non_overlapping=False)

    @cached_property
    def sales(self) -> DataFrame:
        return metrics.sales_metrics(self.purchases, HOURLY.length, HOURLY.slide)

    def sales_between(self, since, until) -> DataFrame:
        """The same windows, of which only those that start in a range are summed."""
        return metrics.sales_metrics(self.purchases, HOURLY.length, HOURLY.slide, since=since, until=until)

    def sales_of_last(self, interval: str) -> DataFrame:
        end = F.col("t")
        return self.sales_between(self.event_time(end - F.expr(f"INTERVAL {interval}")), self.event_end)

    @property
    def sales_of_today(self) -> DataFrame:
        return self.sales_between(self.event_time(F.date_trunc("day", "t")), self.event_end)

    def event_time(self, of: Column) -> Column:
        """A time that depends on that of the last event, `t`."""
        return self.given.table("events").agg(F.max("ts").alias("t")).select(of).scalar()

    def daily_sales_between(self, since=None, until=None) -> DataFrame:
        return metrics.sales_metrics(self.transactions, "1 day", None, since=since, until=until)

    @cached_property
    def hourly_fact(self) -> DataFrame:
        return warehouse.fact_sales(self.sales, LOADED_AT, windows=HOURLY)

    @cached_property
    def anomalies(self) -> DataFrame:
        return anomalies.detect_anomalies(self.order_amounts, RULES, lines=self.given.order_lines())

    @cached_property
    def status(self) -> DataFrame:
        return self.given.inventory_status().withColumn(
            "last_updated", F.lit(LOADED_AT).cast("timestamp")
        )

    @cached_property
    def movements(self) -> DataFrame:
        return inventory.stock_movements(self.given.order_lines(), "1 day")

    @property
    def kept_stock(self) -> DataFrame:
        rules = StockRules(initial=2000, threshold=STOCK_THRESHOLD, window="1 day")
        return running_stock.running_stock(self.given.order_lines(), self.status, rules)

    @cached_property
    def cart(self) -> DataFrame:
        return self.given.cart_events()

    @cached_property
    def sessions(self) -> DataFrame:
        return sessions.gap_sessions(self.cart, SESSION_GAP)

    @cached_property
    def abandoned(self) -> DataFrame:
        return sessions.cart_abandonment(self.sessions)

    @cached_property
    def valued_carts(self) -> DataFrame:
        return sessions.cart_abandonment(
            self.sessions, values=sessions.cart_values(self.cart, self.given.products()))

    @cached_property
    def segments(self) -> DataFrame:
        return rfm.rfm_scores(self.orders, self.order_end)

    @cached_property
    def performance(self) -> DataFrame:
        return categories.category_performance(self.fact, LOADED_AT)

    @cached_property
    def topics(self) -> DataFrame:
        return metrics.topic_rates(self.given.topic_offsets())

    @cached_property
    def health(self) -> DataFrame:
        return self.given.system_health()


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, small ints as longs and timestamps as text, for any engine to compare."""
    def column(field: T.StructField):
        kind, value = field.dataType, F.col(field.name)
        if isinstance(kind, T.DecimalType):
            value = value.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            value = value.cast("bigint")
        elif isinstance(kind, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return value.alias(field.name)
    return df.select(*[column(field) for field in df.schema])


_BUILDERS: dict[str, Callable[[Retail], DataFrame]] = {}


def query(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    _BUILDERS[build.__name__] = build
    return build


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build):
        return lambda spark, folder: portable(build(Retail(spark, folder)))
    return {name: runner(build) for name, build in _BUILDERS.items()}


def _queries(**builders: Callable[[Retail], DataFrame]) -> None:
    _BUILDERS.update(builders)


# Metrics and facts -------------------------------------------------------------------------------


def _pane_fact(r: Retail, window: str, slide: str) -> DataFrame:
    """Facts of windows that the slide does not divide: by their common panes."""
    pane = metrics.pane(window, slide)
    return warehouse.fact_sales(
        metrics.sales_panes(r.purchases, window, slide), LOADED_AT, windows=SalesWindows(length=pane, slide=pane))


_queries(
    sales_metrics_sliding=lambda r: r.sales,
    sales_metrics_many_windows=lambda r: metrics.sales_metrics(r.purchases, "1 hour", "5 minutes"),
    sales_metrics_tumbling=lambda r: metrics.sales_metrics(r.purchases, "1 hour", None),
    sales_metrics_daily=lambda r: r.daily_sales,
    fact_sales=lambda r: r.hourly_fact,
    fact_sales_all_windows=lambda r: warehouse.fact_sales(r.sales, LOADED_AT, non_overlapping=False),
    fact_sales_10_3=lambda r: _pane_fact(r, "10 minutes", "3 minutes"),
    fact_sales_60_25=lambda r: _pane_fact(r, "60 minutes", "25 minutes"),
    fact_sessions_with_outcome=lambda r: warehouse.fact_sessions(
        sessions.with_outcome(r.sessions, r.purchase_times, SESSION_GAP), LOADED_AT),
    fact_sessions=lambda r: warehouse.fact_sessions(r.sessions, LOADED_AT),
    dim_time=lambda r: warehouse.dim_time_covering(r.given.table("orders"), "o_orderdate"),
    dim_customers=lambda r: warehouse.dim_customers(r.orders, r.segments),
    dim_products=lambda r: warehouse.dim_products(r.given.products()).drop("ratings"),
    fact_inventory=lambda r: warehouse.fact_inventory(r.status, r.movements),
    view_metrics=lambda r: metrics.view_metrics(r.given.product_views(), "1 hour"),
    funnel_by_user=lambda r: metrics.funnel(
        r.given.product_views(), r.cart, r.purchase_times, ["user_id"]),
    funnel_by_user_product=lambda r: metrics.funnel(
        r.given.product_views(), r.cart, r.purchase_times, ["user_id", "product_id"]),
    topic_rates=lambda r: r.topics,
)


@query
def star_month_revenue(r: Retail) -> DataFrame:
    days = warehouse.dim_time_covering(r.given.table("orders"), "o_orderdate")
    return warehouse.with_time(r.fact.drop("category"), days).groupBy(
        "year", "month_name", "is_weekend"
    ).agg(
        F.sum("total_amount").alias("revenue"), F.sum("transaction_count").alias("transactions"),
    )


# Event parsing -----------------------------------------------------------------------------------


def _purchase_json(r: Retail) -> DataFrame:
    """Every event as one JSON line of the transaction topic; errors are cut off mid-line."""
    rows = r.given.table("events")
    wire = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "signup", "nope")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("timestamp"),
        F.array(F.struct(
            F.get_json_object("props", "$.k").alias("product_id"),
            (F.get_json_object("props", "$.k").cast("int") % 5).alias("quantity"),
            F.col("value").alias("price"),
        )).alias("products"),
        F.col("value").alias("total_amount"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("category"),
    ))
    return rows.select(
        F.when(F.col("event_type") == "error", "{bad").otherwise(wire).alias("value")
    )


_queries(
    parsed_transactions=lambda r: event_source.stored_transactions(
        event_source.parse_transactions(_purchase_json(r)).events
    ).select("transaction_id", "user_id", "timestamp", "total_amount", "category"),
    parsed_product_lines=lambda r: event_source.product_lines(
        event_source.parse_transactions(_purchase_json(r)).events),
    dead_letters=lambda r: event_source.parse_transactions(_purchase_json(r)).dead_letters
    .groupBy("reason").agg(F.count("*").alias("lines")),
)


# Categories and trends ---------------------------------------------------------------------------

_queries(
    category_performance=lambda r: r.performance,
    top_categories=lambda r: categories.top_categories(r.fact),
    bottom_categories=lambda r: categories.bottom_categories(r.fact),
    hourly_trend=lambda r: trends.period_trend(r.hourly_fact, "hourly"),
    daily_trend=lambda r: trends.period_trend(r.fact, "daily"),
    weekly_trend=lambda r: trends.period_trend(r.fact, "weekly"),
    weekly_trend_iso_year=lambda r: trends.period_trend(r.fact, "weekly", iso_year=True),
    monthly_trend=lambda r: trends.period_trend(r.fact, "monthly"),
    last_seven_days=lambda r: trends.last_periods(trends.period_trend(r.fact, "daily"), 7),
    country_trend=lambda r: trends.country_trend(r.fact),
    combined_trends=lambda r: trends.all_trends(r.fact, LOADED_AT),
    united_trends=lambda r: trends.combine_trends(
        *[trends.period_trend(r.fact, g) for g in ("daily", "weekly", "monthly")], as_of=LOADED_AT),
    monthly_trends_descending=lambda r: serving.trends_of(trends.all_trends(r.fact, LOADED_AT)),
)

# Customers -----------------------------------------------------------------------------------------

_queries(
    rfm_scores=lambda r: r.segments,
    rfm_scores_by_range=lambda r: r.segments,
    segment_summary=lambda r: rfm.segment_summary(r.segments),
    segment_distribution=lambda r: rfm.segment_distribution(r.segments),
    segment_distribution_by_name=lambda r: rfm.segment_distribution(r.segments, "segment_name"),
    customer_rows=lambda r: serving.customer_rows(r.segments, name="Champions", limit=50),
    customer_rows_by_code=lambda r: serving.customer_rows(r.segments, code="555", limit=1000),
    documented_segments=lambda r: serving.documented_segments(r.segments, "NATION_1"),
    segments_by_name=lambda r: serving.segments_by_name(r.segments),
    customer_kpis=lambda r: serving.customer_kpis(r.segments),
    customer_kpis_of_country=lambda r: serving.customer_kpis(r.segments, "NATION_3"),
    segment_counts=lambda r: serving.segment_counts(r.segments),
    country_overview=lambda r: serving.country_overview(r.segments),
    country_revenue=lambda r: serving.country_revenue(r.segments),
    country_stats=lambda r: serving.country_stats(r.segments),
    customer_insights=lambda r: serving.customer_insights(r.segments),
    segment_value=lambda r: serving.segment_value(r.segments),
    segment_metrics=lambda r: serving.segment_metrics(r.segments),
    customer_scatter=lambda r: serving.customer_scatter(r.segments),
)

# Anomalies -----------------------------------------------------------------------------------------

_queries(
    anomalies=lambda r: r.anomalies,
    rapid_transactions=lambda r: anomalies.rapid_transactions(
        r.purchase_times, RULES.rapid_limit, RULES.rapid_window),
    anomaly_rows=lambda r: serving.anomaly_rows(r.anomalies),
    anomaly_rows_of_type=lambda r: serving.anomaly_rows(
        r.anomalies, "high_value", "1999-01-01", limit=200),
    anomaly_check=lambda r: alerts.anomaly_check(r.anomalies, "2000-01-01", ALERTS, limit=ALERTS.page),
    anomaly_check_all=lambda r: alerts.anomaly_check(r.anomalies, "1999-01-01", ALERTS),
    anomaly_count_24h=lambda r: serving.count_since(
        r.anomalies, "detected_at", r.order_end, "24 HOURS", "anomaly_count"),
    anomalies_page=lambda r: serving.anomalies_page(r.anomalies, offset=100),
    anomalies_by_type=lambda r: serving.count_by_type(serving.anomalies_page(r.anomalies)),
)

# Inventory -----------------------------------------------------------------------------------------

_queries(
    stock_movements=lambda r: r.movements,
    stock_status=lambda r: inventory.apply_stock_movements(r.status, r.movements, as_of=LOADED_AT),
    low_stock_alerts=lambda r: inventory.low_stock_alerts(r.status, r.movements, STOCK_THRESHOLD),
    low_stock_alerts_repeated=lambda r: inventory.low_stock_alerts(
        r.status, r.movements, STOCK_THRESHOLD, repeat=True),
    seed_inventory=lambda r: inventory.seed_inventory(r.given.products()),
    seed_alerts=lambda r: inventory.seed_alerts(
        r.status, inventory.low_stock_alerts(r.status, r.movements, STOCK_THRESHOLD),
        STOCK_THRESHOLD, LOADED_AT),
    low_stock_count_24h=lambda r: serving.count_since(
        inventory.low_stock_alerts(r.status, r.movements, STOCK_THRESHOLD), "alert_time",
        F.lit("1997-01-01").cast("timestamp"), "24 HOURS", "low_stock_count"),
    low_stock_check=lambda r: alerts.low_stock_check(
        r.status, AlertRules(low_stock=100, critical_stock=50), limit=ALERTS.page),
    low_stock_check_all=lambda r: alerts.low_stock_check(r.status, AlertRules(low_stock=400, critical_stock=50)),
    stock_page=lambda r: serving.stock_page(r.status, below=500, offset=20),
    stock_labels=lambda r: serving.chart_labels(serving.stock_page(r.status, below=500)),
)


@query
def running_stock_levels(r: Retail) -> DataFrame:
    """What the stock-keeping stream ends with over all lines, from one state per product."""
    return running_stock.levels(r.kept_stock)


@query
def running_stock_alerts(r: Retail) -> DataFrame:
    return running_stock.alerts(r.kept_stock)


@query
def stock_of_new_products(r: Retail) -> DataFrame:
    """Products unknown to the stock table are opened at the initial level."""
    known = r.status.filter(F.col("category") != "ECONOMY")
    return inventory.apply_stock_movements(known, r.movements, initial=2000, as_of=LOADED_AT)


@query
def alerts_of_new_products(r: Retail) -> DataFrame:
    known = r.status.filter(F.col("category") != "ECONOMY")
    return inventory.low_stock_alerts(known, r.movements, STOCK_THRESHOLD, initial=500)


@query
def unsent_low_stock(r: Retail) -> DataFrame:
    """Low-stock alerts beyond those already sent for promotional products."""
    sent = r.status.filter(F.col("category") == "PROMO").select(
        F.concat_ws("_", F.lit("low_stock"), "product_id", F.col("available_stock").cast("string"))
        .alias("alert_key"))
    return alerts.low_stock_check(
        r.status, AlertRules(low_stock=400, critical_stock=50), limit=1000, sent=sent)


@query
def session_upsert_compacted(r: Retail) -> DataFrame:
    """The upsert from a store whose first two of three batches were folded, bucket by bucket, into a base."""
    store = TableStore(r.given.spark, f"{staging_root(r.given.spark)}/sessions-{uuid.uuid4().hex}")
    found = stage(sessions.windowed_sessions(r.cart, "6 hours", unique_products=None), "session-rows")
    first, last = found.agg(F.min("end_time"), F.max("end_time")).first()
    cuts = [first + (last - first) * k / 3 for k in (1, 2)] if first else []
    turn = sum((F.when(F.col("end_time") >= F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))
    for number in range(3):
        store.put_batch("session_metrics", found.filter(turn == number), number)
        if number < 2:
            jobs.compact_sessions(store)
    return jobs.sessions_now(store).select(found.columns)


@query
def alerts_due(r: Retail) -> DataFrame:
    """Low-stock alerts against a stored ledger: promotional products were reported half an hour ago, large ones
    three hours ago."""
    keys = r.status.select("product_id", "category", F.concat_ws(
        "_", F.lit("low_stock"), "product_id", F.col("available_stock").cast("string")).alias("alert_key"))
    ledger = TableStore(r.given.spark, f"{staging_root(r.given.spark)}/ledger-{uuid.uuid4().hex}")
    at = F.lit(LOADED_AT).cast("timestamp")
    for number, (category, age) in enumerate({"LARGE": "3 HOURS", "PROMO": "30 MINUTES"}.items()):
        ledger.put_batch("sent_alerts", keys.filter(F.col("category") == category).withColumn(
            "sent_at", at - F.expr(f"INTERVAL {age}")), number)
    found = alerts.low_stock_check(r.status, AlertRules(low_stock=400, critical_stock=50))
    return alerts.due(found, ledger.changes("sent_alerts"), LOADED_AT)


# Sessions ------------------------------------------------------------------------------------------


def _approximation(r: Retail) -> DataFrame:
    """Whether each session's approximate number of products is within four standard errors (5 % each)."""
    counted = [
        sessions.windowed_sessions(r.cart, "1 day", unique_products=how).select(
            "session_id", "user_id", F.col("unique_products").alias(how))
        for how in ("approx", "exact")
    ]
    away = F.abs(F.col("approx") - F.col("exact"))
    return counted[0].join(counted[1], ["session_id", "user_id"]).select(
        "session_id", "user_id", (away <= F.greatest(F.lit(1.0), 0.2 * F.col("exact"))).alias("close"))


_queries(
    session_metrics=lambda r: sessions.windowed_sessions(r.cart, "6 hours", unique_products=None),
    session_products=lambda r: sessions.windowed_sessions(
        r.cart, "1 day", unique_products="exact").select("session_id", "user_id", "unique_products"),
    session_products_approx=lambda r: _approximation(r),
    session_windows=lambda r: r.sessions,
    session_windows_native=lambda r: sessions.streamed_sessions(
        r.cart, SESSION_GAP, unique_products=None),
    session_upsert=lambda r: sessions.upserted_sessions(
        sessions.windowed_sessions(r.cart, "6 hours", unique_products=None)),
    cart_abandonment=lambda r: r.abandoned,
    cart_contents=lambda r: sessions.cart_contents(r.cart),
    cart_abandonment_valued=lambda r: r.valued_carts,
    abandonment_spike_valued=lambda r: alerts.abandonment_spike(
        r.valued_carts, r.event_time(F.col("t") - F.expr("INTERVAL 12 HOURS")), rules=ALERTS),
    valuable_abandoned_carts=lambda r: alerts.valuable_carts(r.valued_carts, ALERTS),
    cart_values=lambda r: sessions.cart_values(r.cart, r.given.products()),
    unpurchased_carts=lambda r: sessions.unpurchased_carts(
        r.sessions, r.purchase_times, SESSION_GAP),
    abandonment_spike=lambda r: alerts.abandonment_spike(r.abandoned, r.event_end, rules=ALERTS),
    valuable_carts=lambda r: alerts.valuable_carts(
        sessions.cart_values(r.cart, r.given.products()), ALERTS),
    abandonment_count_24h=lambda r: serving.count_since(
        r.abandoned, "abandonment_time", r.event_end, "24 HOURS", "abandonment_count"),
    sessions_last_hour=lambda r: serving.count_since(
        r.sessions, "end_time", r.event_end, "1 HOUR", "sessions_last_hour"),
    sessions_page=lambda r: serving.sessions_page(sessions.upserted_sessions(r.sessions), offset=100),
)

# Sales reports ---------------------------------------------------------------------------------------

_queries(
    sales_rows=lambda r: serving.sales_rows(
        r.daily_sales_between("1996-01-01", "1999-12-31"), "1996-01-01", "1999-12-31", category="PROMO", limit=500),
    sales_rows_of_country=lambda r: serving.sales_rows(r.daily_sales, country="NATION_5"),
    sales_summary_today=lambda r: serving.sales_summary(r.sales_of_today, "today", r.event_end),
    sales_summary_week=lambda r: serving.sales_summary(r.sales_of_last("7 DAYS"), "week", r.event_end),
    sales_summary_month=lambda r: serving.sales_summary(r.sales_of_last("30 DAYS"), "month", r.event_end),
    sales_totals=lambda r: serving.sales_totals(
        r.daily_sales_between("1996-01-01", "1997-01-01"), "1996-01-01", "1997-01-01"),
    performance_rows=lambda r: serving.performance_rows(r.performance, sort_by="units_sold", limit=4),
    performance_of_category=lambda r: serving.performance_rows(r.performance, category="PROMO"),
    top_performers=lambda r: serving.top_performers(r.performance, 3),
    dashboard=lambda r: serving.dashboard(
        r.sales_of_today, anomalies.high_value(r.purchase_times, 100.0), r.performance, r.event_end,
        r.purchase_times),
    revenue_24h=lambda r: serving.revenue_since(r.sales_of_last("24 HOURS"), r.event_end),
    transactions_24h=lambda r: serving.transactions_since(r.sales_of_last("24 HOURS"), r.event_end),
    revenue_series=lambda r: serving.sales_series(
        r.sales_between("2024-01-05", "2024-01-20"), "total_amount", "revenue", "2024-01-05", "2024-01-20"),
    transaction_series=lambda r: serving.sales_series(
        r.sales_between("2024-01-05", "2024-01-20"), "transaction_count", "transactions", "2024-01-05", "2024-01-20"),
    category_stats=lambda r: serving.category_stats(r.fact, n=10),
    category_stats_of_country=lambda r: serving.category_stats(r.fact, "NATION_2"),
    category_overview=lambda r: serving.category_overview(r.fact),
    sales_page=lambda r: serving.sales_page(r.sales, offset=200),
    page_totals=lambda r: serving.page_totals(serving.sales_page(r.sales)),
    page_revenue_by_category=lambda r: serving.revenue_by_category(serving.sales_page(r.sales)),
    sales_by_category=lambda r: serving.sales_by_category(r.fact),
    adhoc_sql=lambda r: serving.run_sql(r.spark, """
        SELECT country, category, sum(total_amount) AS revenue, count(*) AS windows
        FROM sales_metrics WHERE transaction_count > 1 GROUP BY country, category
    """, {"sales_metrics": r.sales}),
)

# Monitoring ------------------------------------------------------------------------------------------

_queries(
    events_last_hour=lambda r: serving.events_since(r.topics, r.event_end, "1 HOUR"),
    event_rate=lambda r: serving.event_rate(r.topics, r.event_end, "2 HOURS", 7200),
    topic_series=lambda r: serving.topic_series(r.topics, r.event_end, "3 HOURS"),
    topic_totals=lambda r: serving.topic_totals(r.topics, r.event_end),
    latest_cpu=lambda r: serving.latest_gauge(r.health, "cpu_usage"),
    latest_memory=lambda r: serving.latest_gauge(r.health, "memory_usage"),
    latest_disk=lambda r: serving.latest_gauge(r.health, "disk_usage"),
    gauge_series=lambda r: serving.gauge_series(r.health, r.event_end),
    container_states=lambda r: serving.container_states(r.health),
    own_containers=lambda r: serving.own_containers(r.health, "C3"),
    system_alerts=lambda r: alerts.system_alerts(r.health),
    red_gauges=lambda r: alerts.system_alerts(r.health, alerts.RED_GAUGES),
    numbers_from_text=lambda r: r.given.table("events").groupBy("event_type").agg(
        F.sum(as_number(F.get_json_object("props", "$.k"))).alias("k_total"),
        F.count(as_number("event_type")).alias("numeric_types")),
    latest_event_per_user=lambda r: ranking.latest_per_key(
        r.given.table("events").drop("props"), ["user_id"], "ts", tie=["event_id"]),
)

# History and quality ---------------------------------------------------------------------------------


def _payments(r: Retail) -> DataFrame:
    """Type-2 history of each customer's payment method, observed once a day."""
    daily = r.order_amounts.groupBy("user_id", "timestamp").agg(F.max("payment_method").alias("payment_method"))
    return warehouse.history(daily, ["user_id"], ["payment_method"], "timestamp")


_queries(
    payment_history=_payments,
    payment_history_hot_keys=_payments,
)


@query
def quality_while_written(r: Retail) -> DataFrame:
    """The quality report as it falls off while the transactions are stored."""
    watched, report = quality.checked_while_written(r.transactions, _QUALITY)
    stage(watched, "checked-transactions")
    return report()


@query
def distinct_products_of_months(r: Retail) -> DataFrame:
    """Whether stored day sketches, united by month, are within four standard errors of the exact count."""
    days = stage(sessions.product_sketches(r.cart, "1 day"), "product-sketches")
    month = F.date_format("window_start", "yyyy-MM").alias("month")
    exact = r.cart.filter("timestamp IS NOT NULL").groupBy(F.date_format("timestamp", "yyyy-MM").alias("month")).agg(
        F.count_distinct("product_id").alias("exact"))
    off = F.abs(F.col("unique_products") - F.col("exact"))
    return sessions.distinct_products(days, month).join(exact, "month").select(
        "month", (off <= 4 * sessions.SKETCH_ERROR * F.col("exact") + 1).alias("close"))


@query
def payment_history_amended(r: Retail) -> DataFrame:
    """The history of the even months' payments, corrected by those of the odd months, which arrive late."""
    daily = stage(r.order_amounts.groupBy("user_id", "timestamp").agg(F.max("payment_method").alias("payment_method")), "payments")
    odd = F.month("timestamp") % 2 == 1
    first, late = daily.filter(~odd), daily.filter(odd)
    keys, tracked = ["user_id"], ["payment_method"]
    known = warehouse.history(first, keys, tracked, "timestamp")
    return warehouse.amend_history(known, first, late, keys, tracked, "timestamp")


@query
def merged_history(r: Retail) -> DataFrame:
    """A product dimension brought up to date with a catalogue whose large sizes changed price."""
    dimension = r.given.table("part").filter("p_size <= 40").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.lit("2020-01-01").cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"),
    )
    incoming = r.given.table("part").filter("p_size > 10").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"),
        F.when(F.col("p_size") > 30, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice"))
        .alias("price"),
    )
    return warehouse.merge_history(
        dimension, incoming, ["product_id"], ["category", "price"], LOADED_AT)


_queries(
    quality_report=lambda r: quality.quality_report(r.transactions, _QUALITY),
    duplicate_lines=lambda r: quality.duplicate_keys(
        r.given.table("lineitem"), ["l_orderkey", "l_linenumber"]),
)
