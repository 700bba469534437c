"""Declared schemas of every table. Nothing in the library infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIMESTAMP, BOOLEAN, DATE = T.TimestampType(), T.BooleanType(), T.DateType()
AMOUNT = T.DecimalType(12, 2)
TOTAL = T.DecimalType(22, 2)
SCORE = T.DecimalType(10, 4)
METRIC = T.DecimalType(15, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PRODUCT_LINE = _struct(product_id=STRING, quantity=INT, price=DOUBLE)

# Events as they arrive: the timestamp is still ISO-8601 text.
TRANSACTION_EVENT = _struct(
    transaction_id=STRING, user_id=STRING, timestamp=STRING,
    products=T.ArrayType(PRODUCT_LINE), total_amount=DOUBLE,
    payment_method=STRING, country=STRING, category=STRING,
)
PRODUCT_VIEW_EVENT = _struct(
    event_id=STRING, user_id=STRING, product_id=STRING, timestamp=STRING,
    session_id=STRING, duration_seconds=INT, category=STRING,
)
CART_EVENT = _struct(
    event_id=STRING, user_id=STRING, product_id=STRING, timestamp=STRING,
    action=STRING, quantity=INT, session_id=STRING,
)
EVENTS = {
    "transactions": TRANSACTION_EVENT,
    "product_views": PRODUCT_VIEW_EVENT,
    "cart_events": CART_EVENT,
}

# Stored tables.
TABLES = {
    "users": _struct(
        user_id=STRING, email=STRING, country=STRING, age=INT,
        registration_date=TIMESTAMP, preferences=T.ArrayType(STRING),
    ),
    "products": _struct(
        product_id=STRING, name=STRING, category=STRING, price=DOUBLE,
        inventory=INT, ratings=DOUBLE,
    ),
    "transactions": _struct(
        transaction_id=STRING, user_id=STRING, timestamp=TIMESTAMP, total_amount=AMOUNT,
        category=STRING, country=STRING, payment_method=STRING,
    ),
    "sales_metrics": _struct(
        window_start=TIMESTAMP, window_end=TIMESTAMP, category=STRING, country=STRING,
        total_amount=TOTAL, transaction_count=LONG, avg_transaction_value=AMOUNT,
    ),
    "transaction_anomalies": _struct(
        transaction_id=STRING, user_id=STRING, product_id=STRING, amount=AMOUNT,
        anomaly_score=SCORE, anomaly_type=STRING, detected_at=TIMESTAMP, description=STRING,
    ),
    "inventory_status": _struct(
        product_id=STRING, product_name=STRING, category=STRING, current_stock=LONG,
        reserved_stock=LONG, available_stock=LONG, last_updated=TIMESTAMP,
    ),
    "stock_movements": _struct(
        window_start=TIMESTAMP, product_id=STRING, sold_quantity=LONG, transaction_count=LONG,
    ),
    "low_stock_alerts": _struct(
        product_id=STRING, product_name=STRING, category=STRING, current_stock=LONG,
        threshold=INT, alert_time=TIMESTAMP, status=STRING,
    ),
    "session_metrics": _struct(
        session_id=STRING, user_id=STRING, start_time=TIMESTAMP, end_time=TIMESTAMP,
        duration_seconds=LONG, page_views=LONG, cart_adds=LONG, cart_removes=LONG,
        purchase_completed=BOOLEAN, abandoned=BOOLEAN, total_amount=AMOUNT,
    ),
    "cart_abandonment": _struct(
        session_id=STRING, user_id=STRING, products_in_cart=LONG, cart_value=AMOUNT,
        abandonment_time=TIMESTAMP, time_in_cart_minutes=LONG,
    ),
    "kafka_metrics": _struct(topic=STRING, event_count=LONG, rate=DOUBLE, timestamp=TIMESTAMP),
    "topic_offsets": _struct(topic=STRING, partition=INT, end_offset=LONG, timestamp=TIMESTAMP),
    "system_health_metrics": _struct(
        metric_name=STRING, metric_value=METRIC, metric_type=STRING,
        timestamp=TIMESTAMP, metadata=STRING,
    ),
    "dashboard_metrics": _struct(
        metric_name=STRING, metric_value=METRIC, metric_type=STRING, timestamp=TIMESTAMP,
    ),
    "fact_sales": _struct(
        date_time=TIMESTAMP, date_id=INT, category=STRING, country=STRING, total_amount=TOTAL,
        transaction_count=LONG, avg_transaction_value=AMOUNT, loaded_at=TIMESTAMP,
    ),
    "fact_sessions": _struct(
        session_id=STRING, user_id=STRING, start_time=TIMESTAMP, end_time=TIMESTAMP,
        duration_seconds=LONG, page_views=LONG, cart_adds=LONG, cart_removes=LONG,
        purchase_completed=BOOLEAN, abandoned=BOOLEAN, total_amount=AMOUNT,
        date_id=INT, loaded_at=TIMESTAMP,
    ),
    "dim_time": _struct(
        date_id=INT, date=STRING, year=INT, quarter=INT, month=INT, month_name=STRING,
        week=INT, day=INT, day_of_week=INT, day_name=STRING, is_weekend=BOOLEAN,
    ),
    "dim_customers": _struct(
        customer_id=STRING, country=STRING, registration_date=TIMESTAMP, segment=STRING,
        total_purchases=LONG, total_spent=TOTAL,
    ),
    "dim_products": _struct(
        product_id=STRING, name=STRING, category=STRING, price=DOUBLE, inventory=INT,
        ratings=DOUBLE,
    ),
    "customer_segments": _struct(
        user_id=STRING, country=STRING, recency=INT, frequency=LONG, monetary=TOTAL,
        r_score=INT, f_score=INT, m_score=INT, rfm_segment=STRING, segment_name=STRING,
        analysis_date=TIMESTAMP,
    ),
    "product_performance": _struct(
        category=STRING, total_revenue=T.DecimalType(32, 2), total_transactions=LONG,
        avg_order_value=DOUBLE, weighted_avg_order_value=DOUBLE, data_points=LONG,
        revenue_share=DOUBLE, performance_rating=STRING, rank=INT, analysis_date=TIMESTAMP,
    ),
    "sales_trends": _struct(
        period_type=STRING, period=STRING, revenue=T.DecimalType(32, 2), transactions=LONG,
        revenue_growth_rate=DOUBLE, analysis_date=TIMESTAMP,
    ),
}

# The given Parquet tables, as far as this library reads them. Their timestamps carry no zone
# and are taken as UTC.
GIVEN = {
    "nation": _struct(n_nationkey=INT, n_name=STRING, n_regionkey=INT),
    "customer": _struct(
        c_custkey=LONG, c_name=STRING, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=STRING,
    ),
    "part": _struct(
        p_partkey=LONG, p_name=STRING, p_brand=STRING, p_type=STRING, p_size=INT,
        p_retailprice=DOUBLE,
    ),
    "orders": _struct(
        o_orderkey=LONG, o_custkey=LONG, o_orderstatus=STRING, o_totalprice=DOUBLE,
        o_orderdate=TIMESTAMP, o_orderpriority=STRING,
    ),
    "lineitem": _struct(
        l_orderkey=LONG, l_partkey=LONG, l_suppkey=LONG, l_linenumber=INT, l_quantity=DOUBLE,
        l_extendedprice=DOUBLE, l_discount=DOUBLE, l_tax=DOUBLE, l_returnflag=STRING,
        l_linestatus=STRING, l_shipdate=TIMESTAMP,
    ),
    "events": _struct(
        event_id=LONG, ts=TIMESTAMP, user_id=LONG, event_type=STRING, value=DOUBLE, props=STRING,
    ),
}
TABLES["inventory_openings"] = TABLES["inventory_status"]
TABLES["sent_alerts"] = _struct(alert_key=STRING, kind=STRING, severity=STRING, subject=STRING, message=STRING, sent_at=TIMESTAMP)
TABLES["alert_deliveries"] = _struct(sent_at=TIMESTAMP, alerts=LONG)
TABLES["query_progress"] = _struct(query=STRING, run=STRING, batch=LONG, timestamp=TIMESTAMP, input_rows=LONG, value=STRING)
TABLES["etl_consumed"] = _struct(table=STRING, batch_run=STRING, last_batch=LONG)
TABLES["stock_levels"] = TABLES["inventory_status"]
TABLES["stock_alerts"] = TABLES["low_stock_alerts"]
TABLES["rapid_anomalies"] = TABLES["transaction_anomalies"]
TABLES["view_metrics"] = _struct(
    window_start=TIMESTAMP, window_end=TIMESTAMP, category=STRING, views=LONG,
    total_duration=LONG, avg_duration=DOUBLE,
)
