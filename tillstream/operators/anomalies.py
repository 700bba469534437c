"""Unusual transactions: high value, unusual quantity, rapid sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.settings import AnomalyRules


def _amount_text(amount: Column) -> Column:
    # Via decimal: large doubles would print in exponent form.
    return F.concat(F.lit("High value transaction: $"), amount.cast("decimal(12,2)").cast("string"))


def _quantity_text(quantity: Column) -> Column:
    return F.concat(F.lit("Unusual quantity: "), quantity.cast("string"), F.lit(" items"))


def _times(value: Column, threshold: float) -> Column:
    return value.cast("double") / F.lit(float(threshold))


def _finding(kind: str, product: Column, score: Column, text: Column) -> Column:
    return F.struct(
        product.alias("product_id"), score.alias("anomaly_score"),
        F.lit(kind).alias("anomaly_type"), text.alias("description"),
    )


def _high_value(threshold: float) -> Column:
    amount = F.col("total_amount")
    return _finding(
        "high_value", F.lit(None).cast("string"), _times(amount, threshold), _amount_text(amount))


def _unusual_quantity(product: Column, quantity: Column, threshold: int) -> Column:
    return _finding("unusual_quantity", product, _times(quantity, threshold), _quantity_text(quantity))


def _reported(found: DataFrame) -> DataFrame:
    """Anomaly rows from rows with a `finding`."""
    return found.select(
        "transaction_id", "user_id", "finding.product_id", F.col("total_amount").alias("amount"),
        "finding.anomaly_score", "finding.anomaly_type", F.col("timestamp").alias("detected_at"),
        "finding.description",
    )


def high_value(transactions: DataFrame, threshold: float = 5000.0) -> DataFrame:
    """Transactions above `threshold` (strictly)."""
    return _reported(
        transactions.filter(F.col("total_amount") > threshold)
        .withColumn("finding", _high_value(threshold))
    )


def unusual_quantity(lines: DataFrame, threshold: int = 10) -> DataFrame:
    """Product lines with more than `threshold` items; `amount` is the whole transaction's."""
    product, quantity = F.col("product_id"), F.col("quantity")
    return _reported(
        lines.filter(quantity > threshold)
        .withColumn("finding", _unusual_quantity(product, quantity, threshold))
    )


def rapid_transactions(
    transactions: DataFrame, limit: int = 5, window: str = "1 minute", watermark: str | None = None,
) -> DataFrame:
    """Users with more than `limit` transactions in one window.

    The anomaly belongs to the user, so it carries an id of its own and the window's total.
    """
    rows = transactions.filter("timestamp IS NOT NULL")
    if watermark:
        rows = rows.withWatermark("timestamp", watermark)
    busy = rows.groupBy(F.window("timestamp", window), "user_id").agg(
        F.count("*").alias("n"), F.sum("total_amount").alias("window_amount"),
    ).filter(F.col("n") > limit).select(
        F.concat_ws("-", F.lit("rapid"), "user_id", F.unix_seconds("window.start").cast("string"))
        .alias("transaction_id"),
        "user_id", "window_amount", "n", F.col("window.end").alias("window_end"),
    )
    text = F.concat(F.lit("Rapid transactions: "), F.col("n").cast("string"), F.lit(" in " + window))
    return busy.select(
        "transaction_id", "user_id", F.lit(None).cast("string").alias("product_id"),
        F.col("window_amount").alias("amount"), _times(F.col("n"), limit).alias("anomaly_score"),
        F.lit("rapid_transactions").alias("anomaly_type"), F.col("window_end").alias("detected_at"),
        text.alias("description"),
    )


def detect_anomalies(
    transactions: DataFrame, rules: AnomalyRules = AnomalyRules(), lines: DataFrame | None = None,
) -> DataFrame:
    """High-value transactions and unusual quantities. Stateless, so it also runs on streams.

    Transactions with nested `products` are read once and give all their findings together. Where
    product lines are stored flat, `lines`, the two kinds are found apart and united.
    """
    if lines is not None:
        return high_value(transactions, rules.high_value).unionByName(
            unusual_quantity(lines, rules.quantity))
    expensive = F.when(
        F.col("total_amount") > rules.high_value, F.array(_high_value(rules.high_value)))
    bulky = F.transform(
        F.filter("products", lambda line: line["quantity"] > rules.quantity),
        lambda line: _unusual_quantity(line["product_id"], line["quantity"], rules.quantity),
    )
    findings = F.flatten(F.array_compact(F.array(expensive, bulky)))
    return _reported(transactions.withColumn("finding", F.explode(findings)))
