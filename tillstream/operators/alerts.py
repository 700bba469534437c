"""Alert checks over stored tables, and suppression of alerts already sent."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.functions.exact import as_timestamp
from tillstream.settings import AlertRules

RULES = AlertRules()
# Percentages from which the gauges are shown in red.
RED_GAUGES = {"cpu_usage": 80.0, "memory_usage": 80.0, "disk_usage": 85.0}


def low_stock_check(
    status: DataFrame, rules: AlertRules = RULES, limit: int | None = None,
    sent: DataFrame | None = None,
) -> DataFrame:
    """Products with little stock left (but some), scarcest first; red where critical.

    All of them, or the first `limit` for a report's page; alerts in `sent` are left out before.
    """
    available = F.col("available_stock")
    found = status.filter((available < rules.low_stock) & (available > 0)).select(
        F.concat_ws("_", F.lit("low_stock"), "product_id", available.cast("string")).alias("alert_key"),
        "product_id", "product_name", "category", "available_stock",
        F.when(available < rules.critical_stock, "red").otherwise("yellow").alias("severity"),
    )
    found = found if sent is None else suppress_sent(found, sent)
    ordered = found.orderBy("available_stock", "product_id")
    return ordered if limit is None else ordered.limit(limit)


def anomaly_check(
    anomalies: DataFrame, since, rules: AlertRules = RULES, limit: int | None = None,
    sent: DataFrame | None = None,
) -> DataFrame:
    """Risky anomalies since the last check, highest score first; without those in `sent`.

    All of them, or the first `limit` for a report's page.
    """
    score = F.col("anomaly_score")
    found = anomalies.filter(
        (F.col("detected_at") >= as_timestamp(since)) & (score >= rules.anomaly_score)
    ).select(
        F.concat(F.lit("anomaly_"), "transaction_id").alias("alert_key"),
        "transaction_id", "user_id", "product_id", "amount", "anomaly_score", "anomaly_type",
        "detected_at", "description",
        F.when(score >= rules.high_risk_score, "red").otherwise("yellow").alias("severity"),
        (score >= rules.urgent_score).alias("urgent"),
    )
    found = found if sent is None else suppress_sent(found, sent)
    order = [F.col("anomaly_score").desc(), "transaction_id", "anomaly_type", "product_id"]
    ordered = found.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def abandonment_spike(
    abandoned: DataFrame, as_of, limit: int | None = None, rules: AlertRules = RULES,
) -> DataFrame:
    """Count and value of the last hour's abandoned carts; no row unless more than `limit`."""
    threshold = rules.carts_per_hour if limit is None else limit
    now = as_timestamp(as_of)
    return abandoned.filter(F.col("abandonment_time").between(now - F.expr("INTERVAL 1 HOUR"), now)).agg(
        F.count("*").alias("cart_count"),
        F.coalesce(F.sum("cart_value"), F.lit(0)).alias("total_value"),
    ).filter(F.col("cart_count") > threshold)


def valuable_carts(abandoned: DataFrame, rules: AlertRules = RULES) -> DataFrame:
    return abandoned.filter(F.col("cart_value") > rules.cart_value)


def system_alerts(health: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Gauge readings above the limit of their metric."""
    limits = limits or {"cpu_usage": RULES.cpu_percent, "memory_usage": RULES.memory_percent}
    threshold = F.coalesce(*[
        F.when(F.col("metric_name") == name, F.lit(float(limit))) for name, limit in limits.items()
    ])
    return health.filter(F.col("metric_name").isin(*limits)).withColumn("threshold", threshold).filter(
        F.col("metric_value").cast("double") > F.col("threshold")
    )


def suppress_sent(alerts: DataFrame, sent: DataFrame) -> DataFrame:
    """Alerts whose key is not in `sent`."""
    return alerts.join(sent.select("alert_key"), "alert_key", "left_anti")


def due(alerts: DataFrame, ledger: DataFrame, at, rules: AlertRules = RULES) -> DataFrame:
    """Alerts whose key was not sent within `repeat_after` before `at`.

    The ledger is reduced to that span before the join; its time filter reaches the scan. A null key is never
    known as sent; of alerts with one key all pass or none.
    """
    now = as_timestamp(at)
    recent = ledger.filter((F.col("sent_at") > now - F.expr(f"INTERVAL {rules.repeat_after}")) & (F.col("sent_at") <= now))
    return suppress_sent(alerts, recent)


def suppress_repeats(alerts: DataFrame, at: str, rules: AlertRules = RULES) -> DataFrame:
    """Streaming form: an alert key passes once per `repeat_after`."""
    return alerts.withWatermark(at, rules.repeat_after).dropDuplicatesWithinWatermark(["alert_key"])
