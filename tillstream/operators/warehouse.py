"""Star schema: sales and session facts, time, customer and product dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillstream.functions.exact import as_timestamp, ratio
from tillstream.functions.periods import aligned, date_id, seconds_of
from tillstream.settings import SalesWindows


def fact_sales(
    sales: DataFrame, loaded_at, non_overlapping: bool = True, windows: SalesWindows = SalesWindows(),
) -> DataFrame:
    """Sales facts keyed by day.

    Overlapping windows hold every sale several times; by default only windows that tile the time
    line are taken, and `windows` must be those that `sales` was summed by. Where the slide does not
    divide the window no choice of windows holds each sale once: that raises, as does a row of another
    length; sum by `metrics.sales_panes` instead. `non_overlapping=False` copies all windows.
    """
    rows = sales
    if non_overlapping:
        length, step = seconds_of(windows.length), seconds_of(windows.slide or windows.length)
        if not length or not step or length % step:
            raise ValueError(f"windows of {windows.length} every {windows.slide} can't tile the time line")
        found = F.unix_seconds("window_end") - F.unix_seconds("window_start")
        other = F.raise_error(F.concat(F.lit(f"not a window of {windows.length}: seconds "), found.cast("string")))
        rows = sales.filter(F.when(found == length, aligned("window_start", "window_end")).otherwise(
            other.cast("boolean")))
    return rows.select(
        F.col("window_start").alias("date_time"), date_id("window_start").alias("date_id"),
        "category", "country", "total_amount", "transaction_count", "avg_transaction_value",
        as_timestamp(loaded_at).alias("loaded_at"),
    )


def fact_sessions(sessions: DataFrame, loaded_at) -> DataFrame:
    """Session facts keyed by start day; flags and amount default to false and NULL."""
    defaults = {
        "purchase_completed": F.lit(False), "abandoned": F.lit(False),
        "total_amount": F.lit(None).cast("decimal(12,2)"),
    }
    missing = {name: value for name, value in defaults.items() if name not in sessions.columns}
    return sessions.withColumns(missing).select(
        "session_id", "user_id", "start_time", "end_time", "duration_seconds", "page_views",
        "cart_adds", "cart_removes", "purchase_completed", "abandoned", "total_amount",
        date_id("start_time").alias("date_id"), as_timestamp(loaded_at).alias("loaded_at"),
    )


def dim_time_of(bounds: DataFrame) -> DataFrame:
    """One row per day of a one-row frame (start, end), both included."""
    days = bounds.select(F.explode(F.sequence(
        F.col("start").cast("date"), F.col("end").cast("date"), F.expr("INTERVAL 1 DAY")
    )).alias("day_date"))
    return days.select(
        date_id("day_date").alias("date_id"),
        F.date_format("day_date", "yyyy-MM-dd").alias("date"),
        F.year("day_date").alias("year"), F.quarter("day_date").alias("quarter"),
        F.month("day_date").alias("month"), F.date_format("day_date", "MMMM").alias("month_name"),
        F.weekofyear("day_date").alias("week"), F.dayofmonth("day_date").alias("day"),
        (F.weekday("day_date") + 1).alias("day_of_week"),
        F.date_format("day_date", "EEEE").alias("day_name"),
        (F.weekday("day_date") >= 5).alias("is_weekend"),
    )


def dim_time(spark: SparkSession, start: date, end: date) -> DataFrame:
    return dim_time_of(spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end")))


def dim_time_covering(df: DataFrame, column: str) -> DataFrame:
    """The days from the first to the last value of `column`."""
    return dim_time_of(df.agg(F.min(column).alias("start"), F.max(column).alias("end")))


def with_time(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts with the attributes of their day. `dim` has one row per calendar day."""
    return fact.join(dim, "date_id")


def dim_customers(transactions: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """Customers as seen in their transactions: country of the last one, date of the first."""
    totals = transactions.groupBy("user_id").agg(
        F.max_by("country", F.struct("timestamp", "transaction_id")).alias("country"),
        F.min("timestamp").alias("registration_date"),
        F.count("*").alias("total_purchases"), F.sum("total_amount").alias("total_spent"),
    )
    if segments is None:
        totals = totals.withColumn("segment", F.lit(None).cast("string"))
    else:
        named = segments.select("user_id", "country", F.col("segment_name").alias("segment"))
        totals = totals.join(named, ["user_id", "country"], "left")
    return totals.select(
        F.col("user_id").alias("customer_id"), "country", "registration_date", "segment",
        "total_purchases", "total_spent",
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "name", "category", "price", "inventory", "ratings")


def fact_inventory(status: DataFrame, movements: DataFrame) -> DataFrame:
    """Daily units sold per product with the product's category."""
    daily = movements.groupBy("product_id", date_id("window_start").alias("date_id")).agg(
        F.sum("sold_quantity").alias("units_sold"),
        F.sum("transaction_count").alias("transactions"),
    )
    return daily.join(status.select("product_id", "category"), "product_id", "left").select(
        "date_id", "product_id", F.coalesce("category", F.lit("General")).alias("category"),
        "units_sold", "transactions", ratio("units_sold", "transactions").alias("units_per_line"),
    )


def history(changes: DataFrame, keys: list[str], tracked: list[str], at: str) -> DataFrame:
    """Type-2 history: one row per key and unbroken stretch of equal `tracked` values.

    `changes` holds one observation per key and time. Observations are sorted by (key, day), never a
    whole key in one task.
    """
    seen = changes.filter(F.col(at).isNotNull()).select(*keys, at, F.struct(*tracked).alias("_state"))
    return _stretches_by_day(seen, keys, at).select(
        *keys, *[F.col(f"_state.{c}").alias(c) for c in tracked],
        F.col(at).alias("valid_from"), F.col("_until").alias("valid_to"),
        F.col("_until").isNull().alias("is_current"),
    )


def _stretches_by_day(seen: DataFrame, keys: list[str], at: str) -> DataFrame:
    """(keys, at, _state, _until) of every change of `_state`. Days meet in their last state and first change."""
    in_key = Window.partitionBy(*keys).orderBy("_day")
    in_day = Window.partitionBy(*keys, "_day").orderBy(at)
    # The branches below share this one shuffle of the observations.
    seen = seen.withColumn("_day", F.to_date(at)).filter("_day IS NOT NULL").repartition(*keys, "_day")
    previous_day = seen.groupBy(*keys, "_day").agg(
        F.max_by("_state", at).alias("_last")
    ).select(*keys, "_day", F.lag("_last").over(in_key).alias("_carried"))
    changed = seen.withColumn("_before", F.lag("_state").over(in_day)).join(
        previous_day, [*keys, "_day"]
    ).filter(~F.col("_state").eqNullSafe(F.coalesce("_before", "_carried")))
    next_day = changed.groupBy(*keys, "_day").agg(F.min(at).alias("_first")).select(
        *keys, "_day", F.lead("_first").over(in_key).alias("_following")
    )
    return changed.join(next_day, [*keys, "_day"]).select(
        *keys, at, "_state", F.coalesce(F.lead(at).over(in_day), "_following").alias("_until")
    )


def amend_history(
    dimension: DataFrame, seen: DataFrame, late: DataFrame, keys: list[str], tracked: list[str], at: str,
) -> DataFrame:
    """A type-2 history after observations that arrived late, also between or before stored ones.

    A stretch doesn't say when its values were confirmed, so keys with late observations get their rows from `seen`,
    the observations so far, and `late`; intervals are split, joined or moved as these say. Rows of all other keys
    stay as they are. A late observation replaces one of the same key and time. Any order of arrival ends
    in `history` over all observations. Null keys are one key.
    """
    columns = [*keys, at, *tracked]
    touched = late.filter(F.col(at).isNotNull()).select(*keys).distinct()

    def of_touched(df: DataFrame, how: str) -> DataFrame:
        same = F.lit(True)
        for key in keys:
            same = same & df[key].eqNullSafe(touched[key])
        return df.join(touched, same, how)

    every = of_touched(seen.select(*columns), "left_semi").withColumn("_turn", F.lit(0)).unionByName(
        late.select(*columns).withColumn("_turn", F.lit(1)))
    newest = every.groupBy(*keys, at).agg(F.max_by(F.struct(*tracked), "_turn").alias("_row")).select(*keys, at, "_row.*")
    return of_touched(dimension, "left_anti").unionByName(history(newest, keys, tracked, at))


def merge_history(
    dimension: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str], as_of,
) -> DataFrame:
    """Apply newly observed rows to a type-2 dimension in one full outer join by key.

    A changed key's current row is closed at `as_of` and a new one opened; new keys are opened;
    the rest is kept as it is.
    """
    now = as_timestamp(as_of)
    current = dimension.filter("is_current")
    old = current.select(*keys, F.struct(*tracked, "valid_from").alias("old"))
    new = incoming.select(*keys, F.struct(*tracked).alias("new"))
    both = old.join(new, keys, "full_outer")
    differs = F.col("old").isNotNull() & F.col("new").isNotNull() & ~(
        F.struct(*[F.col(f"old.{c}").alias(c) for c in tracked]).eqNullSafe(F.col("new"))
    )
    kept = F.when(F.col("old").isNotNull(), F.struct(
        *[F.col(f"old.{c}").alias(c) for c in tracked],
        F.col("old.valid_from").alias("valid_from"),
        F.when(differs, now).alias("valid_to"), (~differs).alias("is_current"),
    ))
    opened = F.when(F.col("old").isNull() | differs, F.struct(
        *[F.col(f"new.{c}").alias(c) for c in tracked],
        now.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    ))
    rows = both.select(*keys, F.explode(F.array_compact(F.array(kept, opened))).alias("row"))
    return dimension.filter("NOT is_current").unionByName(rows.select(*keys, "row.*"))
