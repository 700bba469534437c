"""The alerting job: checks over stored tables, and a ledger of what was sent.

A round is named by its time. It computes the alerts due, writes them to the ledger as one batch, and hands the
stored rows on; then it marks the round as delivered. A round that is repeated reads the ledger without its own
batch, so it finds the same alerts, and hands nothing on if it was delivered before. A crash between handing
on and marking repeats that round's rows under the same keys and time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.exact import as_timestamp
from tillstream.operators import alerts
from tillstream.settings import AlertRules
from tillstream.sources.tables import TableStore

RULES = AlertRules()


def _as_alert(found: DataFrame, kind: str, subject: Column, message: Column, severity: Column | None = None) -> DataFrame:
    return found.select("alert_key", F.lit(kind).alias("kind"), (F.col("severity") if severity is None else severity).alias("severity"),
                        subject.alias("subject"), message.alias("message"))


def all_alerts(tables: TableStore, since, at, rules: AlertRules = RULES) -> DataFrame:
    """Low stock, risky anomalies since the last round, the last hour's abandoned carts if many, and valuable ones."""
    stock = alerts.low_stock_check(tables.read("inventory_status"), rules)
    risky = alerts.anomaly_check(tables.read("transaction_anomalies").filter(F.col("detected_at") <= as_timestamp(at)), since, rules)
    carts = tables.read("cart_abandonment").filter(F.col("abandonment_time") <= as_timestamp(at))
    spike = alerts.abandonment_spike(carts, at, rules=rules)
    valuable = alerts.valuable_carts(carts.filter(F.col("abandonment_time") >= as_timestamp(since)), rules)
    return _as_alert(
        stock, "low_stock", F.col("product_id"),
        F.concat(F.col("available_stock").cast("string"), F.lit(" left of "), F.col("product_name")),
    ).unionByName(_as_alert(
        # A transaction with several anomalies has them under one key.
        risky.groupBy("alert_key", "transaction_id").agg(F.max_by("description", F.struct("anomaly_score", "description")).alias("description"),
                                                         F.min("severity").alias("severity")),
        "anomaly", F.col("transaction_id"), F.col("description"),
    )).unionByName(_as_alert(
        spike.withColumn("alert_key", F.lit("abandonment_spike")), "abandonment", F.lit("carts"),
        F.concat(F.col("cart_count").cast("string"), F.lit(" carts worth "), F.col("total_value").cast("string")), F.lit("yellow"),
    )).unionByName(_as_alert(
        valuable.withColumn("alert_key", F.concat(F.lit("cart_"), "session_id")), "valuable_cart", F.col("session_id"),
        F.concat(F.lit("cart worth "), F.col("cart_value").cast("string")), F.lit("yellow")))


def _number(at) -> int:
    return int(at.timestamp())


def run_round(
    tables: TableStore, ledger: TableStore, since, at, deliver: Callable[[DataFrame], None] | None = None,
    rules: AlertRules = RULES,
) -> DataFrame:
    """One round at the time `at`; returns what the ledger has of it. `deliver` gets these rows once."""
    number = _number(at)
    earlier = ledger.changes("sent_alerts").filter(F.col("batch_id") < number)
    found = alerts.due(all_alerts(tables, since, at, rules), earlier, at, rules).withColumn("sent_at", as_timestamp(at))
    if not ledger.changes("alert_deliveries").filter(F.col("batch_id") == number).isEmpty():
        return _stored(ledger, number)
    ledger.put_batch("sent_alerts", found, number)
    stored = _stored(ledger, number)
    if deliver:
        deliver(stored)
    ledger.put_batch("alert_deliveries", stored.agg(as_timestamp(at).alias("sent_at"), F.count("*").alias("alerts")), number)
    return stored


def _stored(ledger: TableStore, number: int) -> DataFrame:
    return ledger.changes("sent_alerts").filter(F.col("batch_id") == number).drop("run", "batch_id")
