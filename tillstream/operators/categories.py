"""Category revenue, share, rating and rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillstream.functions.exact import as_timestamp, ratio
from tillstream.functions.labels import performance_rating


def category_performance(fact: DataFrame, as_of) -> DataFrame:
    """Revenue, share of all revenue in percent, rating and rank of each category.

    `avg_order_value` is the plain mean of the window averages; the weighted one is revenue over
    transactions. The window without partitions sees one row per category.
    """
    per_category = fact.groupBy("category").agg(
        F.sum("total_amount").alias("total_revenue"),
        F.sum("transaction_count").alias("total_transactions"),
        F.sum("avg_transaction_value").alias("_averages"), F.count("*").alias("data_points"),
        F.count("avg_transaction_value").alias("_n"),
    )
    everything = Window.partitionBy()
    by_revenue = Window.orderBy(F.col("total_revenue").desc(), F.col("category").asc())
    return per_category.withColumn("_all", F.sum("total_revenue").over(everything)).withColumn(
        "rank", F.row_number().over(by_revenue)
    ).withColumn("revenue_share", ratio("total_revenue", "_all") * 100).select(
        "category", "total_revenue", "total_transactions",
        ratio("_averages", "_n").alias("avg_order_value"),
        ratio("total_revenue", "total_transactions").alias("weighted_avg_order_value"),
        "data_points", "revenue_share", performance_rating().alias("performance_rating"), "rank",
        as_timestamp(as_of).alias("analysis_date"),
    ).orderBy("rank")


def top_categories(fact: DataFrame, n: int = 10) -> DataFrame:
    return fact.groupBy("category").agg(F.sum("total_amount").alias("revenue")).orderBy(
        F.col("revenue").desc(), "category"
    ).limit(n)


def bottom_categories(fact: DataFrame, n: int = 10) -> DataFrame:
    return fact.groupBy("category").agg(
        F.sum("total_amount").alias("revenue"), F.sum("transaction_count").alias("transactions"),
    ).orderBy("revenue", "category").limit(n)
