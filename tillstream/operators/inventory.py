"""Stock levels from sold quantities, and low-stock alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.functions.exact import as_timestamp


def stock_movements(
    lines: DataFrame, window: str = "1 minute", watermark: str | None = None,
) -> DataFrame:
    """Units sold and number of lines per (window, product)."""
    rows = lines.filter("timestamp IS NOT NULL")
    if watermark:
        rows = rows.withWatermark("timestamp", watermark)
    return rows.groupBy(F.window("timestamp", window), "product_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("sold_quantity"),
        F.count("*").alias("transaction_count"),
    ).select(
        F.col("window.start").alias("window_start"), "product_id", "sold_quantity",
        "transaction_count",
    )


def _default_name() -> Column:
    return F.concat(F.lit("Product "), F.col("product_id"))


def apply_stock_movements(
    status: DataFrame, movements: DataFrame, initial: int = 80, as_of=None,
) -> DataFrame:
    """Stock levels after all `movements`.

    Known products fall to no less than 0. A product unknown so far starts at `initial`, and its
    first movement is taken off unclamped. As stock only falls, clamping once after the sum equals
    clamping after every movement.
    """
    sold = movements.groupBy("product_id").agg(
        F.sum("sold_quantity").alias("sold"), F.count("*").alias("movements"),
    )
    both = status.join(sold, "product_id", "full_outer")
    known, moved = F.col("current_stock").isNotNull(), F.col("sold").isNotNull()
    left = F.col("current_stock") - F.col("sold")
    fresh = F.lit(initial) - F.col("sold")
    fresh = F.when(F.col("movements") == 1, fresh).otherwise(F.greatest(fresh, F.lit(0)))
    current = (
        F.when(known & moved, F.greatest(left, F.lit(0)))
        .when(known, F.col("current_stock")).otherwise(fresh)
    )
    available = (
        F.when(known & moved, F.greatest(left - F.col("reserved_stock"), F.lit(0)))
        .when(known, F.col("available_stock")).otherwise(fresh)
    )
    updated = F.when(moved, as_timestamp(as_of)) if as_of is not None else F.lit(None).cast("timestamp")
    if "last_updated" in status.columns:
        updated = F.coalesce(updated, "last_updated")
    return both.select(
        "product_id",
        F.coalesce("product_name", _default_name()).alias("product_name"),
        F.coalesce("category", F.lit("General")).alias("category"),
        current.cast("bigint").alias("current_stock"),
        F.coalesce("reserved_stock", F.lit(0)).cast("bigint").alias("reserved_stock"),
        available.cast("bigint").alias("available_stock"),
        updated.alias("last_updated"),
    )


def low_stock_alerts(
    status: DataFrame, movements: DataFrame, threshold: int = 65, initial: int = 80,
    repeat: bool = False,
) -> DataFrame:
    """Alerts raised while `movements` are taken from the stock in `status`.

    One alert per product, at the movement that first brings it below `threshold`; with `repeat`,
    one at every movement that leaves it there. The first movement of an unknown product raises
    none. `movements` holds one row per (window, product), so a best-seller's sort is as long as
    the number of windows, not the number of sales.
    """
    in_order = Window.partitionBy("product_id").orderBy("window_start")
    running = movements.select("product_id", "window_start", "sold_quantity").withColumn(
        "sold", F.sum("sold_quantity").over(
            in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("nth", F.row_number().over(in_order))
    known = F.col("current_stock").isNotNull()
    start = F.coalesce("current_stock", F.lit(initial))
    reserved = F.coalesce("reserved_stock", F.lit(0))
    left = running.join(status.drop("last_updated"), "product_id", "left").withColumn(
        "available", F.greatest(start - F.col("sold") - reserved, F.lit(0))
    ).withColumn("was_available", F.greatest(
        start - (F.col("sold") - F.col("sold_quantity")) - reserved, F.lit(0)
    ))
    alerts = left.filter((F.col("available") < threshold) & (known | (F.col("nth") > 1)))
    if not repeat:
        first_chance = ~known & (F.col("nth") == 2)
        alerts = alerts.filter((F.col("was_available") >= threshold) | first_chance)
    return alerts.select(
        "product_id",
        F.coalesce("product_name", _default_name()).alias("product_name"),
        F.coalesce("category", F.lit("General")).alias("category"),
        F.col("available").cast("bigint").alias("current_stock"),
        F.lit(threshold).alias("threshold"),
        F.col("window_start").alias("alert_time"), F.lit("active").alias("status"),
    )


def seed_inventory(products: DataFrame, existing: DataFrame | None = None, initial: int = 80) -> DataFrame:
    """Full stock for every distinct product that `existing` does not list yet.

    Products without a category get one by hash, so a repeated run gives the same rows.
    """
    described = [c for c in ("name", "category") if c in products.columns]
    # The smallest description survives, so that repeated runs agree.
    fresh = products.groupBy("product_id").agg(*[F.min(c).alias(c) for c in described]) \
        if described else products.select("product_id").distinct()
    if existing is not None:
        fresh = fresh.join(existing.select("product_id"), "product_id", "left_anti")
    options = F.array(F.lit("Electronics"), F.lit("Clothing"), F.lit("Home & Garden"))
    by_hash = F.element_at(options, (F.pmod(F.xxhash64("product_id"), F.lit(3)) + 1).cast("int"))
    stock = F.lit(initial).cast("bigint")
    return fresh.select(
        "product_id",
        (F.coalesce("name", _default_name()) if "name" in fresh.columns else _default_name())
        .alias("product_name"),
        (F.coalesce("category", by_hash) if "category" in fresh.columns else by_hash).alias("category"),
        stock.alias("current_stock"), F.lit(0).cast("bigint").alias("reserved_stock"),
        stock.alias("available_stock"),
    )


def seed_alerts(status: DataFrame, alerts: DataFrame, threshold: int = 65, as_of=None) -> DataFrame:
    """Alerts for products already below `threshold` that have none yet."""
    at = as_timestamp(as_of) if as_of is not None else F.lit(None).cast("timestamp")
    return status.filter(F.col("available_stock") < threshold).join(
        alerts.select("product_id"), "product_id", "left_anti"
    ).select(
        "product_id", "product_name", "category", F.col("available_stock").alias("current_stock"),
        F.lit(threshold).alias("threshold"), at.alias("alert_time"), F.lit("active").alias("status"),
    )
