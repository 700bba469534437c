"""Revenue by hour, day, week, month and country."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tillstream.functions.exact import as_timestamp, growth_percent, ratio
from tillstream.functions.periods import period_columns, period_text

# Key columns by grain; the grain also prefixes the revenue and transaction columns.
_KEYS = {"hourly": ["hour"], "daily": ["date"], "weekly": ["year", "week"], "monthly": ["year", "month"]}


def period_trend(fact: DataFrame, grain: str, iso_year: bool = False) -> DataFrame:
    """Revenue, transactions, averages and growth on the previous period.

    The window without partitions sees one row per period.
    """
    keys, revenue, transactions = _KEYS[grain], f"{grain}_revenue", f"{grain}_transactions"
    per_period = fact.groupBy(*period_columns(grain, "date_time", iso_year)).agg(
        F.sum("total_amount").alias(revenue),
        F.sum("transaction_count").alias(transactions),
        F.sum("avg_transaction_value").alias("_averages"),
        F.count("avg_transaction_value").alias("_n"),
    )
    return per_period.withColumn(
        "prev_revenue", F.lag(revenue).over(Window.orderBy(*keys))
    ).select(
        *keys, revenue, transactions, ratio("_averages", "_n").alias("avg_order_value"),
        ratio(revenue, transactions).alias("weighted_avg_order_value"),
        "prev_revenue", growth_percent(revenue, "prev_revenue").alias("revenue_growth_rate"),
        F.lit(grain).alias("trend_type"),
    ).orderBy(*keys)


def last_periods(trend: DataFrame, n: int = 7) -> DataFrame:
    keys = _KEYS["daily"] if "date" in trend.columns else [
        c for c in ("hour", "year", "week", "month") if c in trend.columns
    ]
    return trend.orderBy(*[F.col(k).desc() for k in keys]).limit(n)


def country_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("country", *period_columns("daily", "date_time")).agg(
        F.sum("total_amount").alias("daily_revenue"),
        F.sum("transaction_count").alias("daily_transactions"),
    ).orderBy("country", "date")


def combine_trends(*trends: DataFrame, as_of) -> DataFrame:
    """Trends of any grains as (period_type, period, revenue, transactions, growth)."""
    def normal(trend: DataFrame) -> DataFrame:
        grain = next(g for g in _KEYS if f"{g}_revenue" in trend.columns)
        return trend.select(
            F.lit(grain).alias("period_type"), period_text(grain).alias("period"),
            F.col(f"{grain}_revenue").alias("revenue"),
            F.col(f"{grain}_transactions").alias("transactions"), "revenue_growth_rate",
        )

    return reduce(DataFrame.unionByName, map(normal, trends)).withColumn(
        "analysis_date", as_timestamp(as_of)
    )


def all_trends(fact: DataFrame, as_of, grains=("daily", "weekly", "monthly"), iso_year: bool = False) -> DataFrame:
    """The combined trends from one scan: days are summed first, then rolled up to each grain."""
    days = fact.groupBy(F.to_date("date_time").alias("day")).agg(
        F.sum("total_amount").alias("revenue"), F.sum("transaction_count").alias("transactions"),
    )
    texts = {
        "daily": F.date_format("day", "yyyy-MM-dd"),
        "weekly": F.concat_ws("-W", *[c.cast("string") for c in period_columns("weekly", "day", iso_year)]),
        "monthly": F.concat_ws("-", *[c.cast("string") for c in period_columns("monthly", "day")]),
    }
    orders = {
        "daily": F.datediff("day", F.lit("1970-01-01").cast("date")),
        "weekly": period_columns("weekly", "day", iso_year)[0] * 100 + F.weekofyear("day"),
        "monthly": F.year("day") * 100 + F.month("day"),
    }
    tagged = days.select("revenue", "transactions", F.explode(F.array(*[
        F.struct(F.lit(g).alias("period_type"), texts[g].alias("period"), orders[g].alias("nth"))
        for g in grains
    ])).alias("p")).select("p.*", "revenue", "transactions")
    periods = tagged.groupBy("period_type", "period", "nth").agg(
        F.sum("revenue").alias("revenue"), F.sum("transactions").alias("transactions"),
    )
    before = Window.partitionBy("period_type").orderBy("nth")
    return periods.withColumn("prev_revenue", F.lag("revenue").over(before)).select(
        "period_type", "period", "revenue", "transactions",
        growth_percent("revenue", "prev_revenue").alias("revenue_growth_rate"),
        as_timestamp(as_of).alias("analysis_date"),
    )
