"""Customer scores by recency, frequency and money spent."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.functions.exact import as_timestamp, ratio
from tillstream.functions.labels import known_or, segment_name
from tillstream.operators.ranking import global_ntile
from tillstream.settings import RfmRules


def rfm_base(transactions: DataFrame, as_of) -> DataFrame:
    """Days since the last purchase, purchases and amount per (user, country), as of one time."""
    return transactions.groupBy("user_id", "country").agg(
        F.max("timestamp").alias("_last"), F.count("*").alias("frequency"),
        F.sum("total_amount").alias("monetary"),
    ).select(
        "user_id", "country", F.datediff(as_timestamp(as_of), "_last").alias("recency"),
        "frequency", "monetary", as_timestamp(as_of).alias("analysis_date"),
    )


def rfm_scores(transactions: DataFrame, as_of, rules: RfmRules = RfmRules()) -> DataFrame:
    """Quantile scores (highest is best), code and segment name per (user, country).

    The customers are range sorted and staged once for each score (see `ranked_by_range`). Ties are broken by user and country.
    """
    tie = [F.col("user_id").asc(), F.col("country").asc()]
    scored = global_ntile(
        rfm_base(transactions, as_of),
        {
            "r_score": [F.col("recency").desc(), *tie],
            "f_score": [F.col("frequency").asc(), *tie],
            "m_score": [F.col("monetary").asc(), *tie],
        },
        rules.quantiles,
    )
    code = F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")])
    return scored.select(
        "user_id", "country", "recency", "frequency", "monetary", "r_score", "f_score", "m_score",
        code.alias("rfm_segment"), segment_name().alias("segment_name"),
        "analysis_date",
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers, averages and revenue per segment, richest first."""
    return segments.groupBy("segment_name").agg(
        F.count("*").alias("customer_count"), F.sum("recency").alias("_recency"),
        F.sum("frequency").alias("_frequency"), F.sum("monetary").alias("total_revenue"),
    ).select(
        "segment_name", "customer_count",
        ratio("_recency", "customer_count").alias("avg_recency"),
        ratio("_frequency", "customer_count").alias("avg_frequency"),
        ratio("total_revenue", "customer_count").alias("avg_monetary"), "total_revenue",
    ).orderBy(F.col("total_revenue").desc(), "segment_name")


def segment_distribution(segments: DataFrame, by: str = "rfm_segment") -> DataFrame:
    """Customers and value per segment code (or `segment_name`), most frequent first."""
    return segments.groupBy(known_or(by).alias("segment")).agg(
        F.count("*").alias("customer_count"), F.sum("frequency").alias("_frequency"),
        F.sum("monetary").alias("total_segment_value"),
    ).select(
        "segment", "customer_count",
        F.round(F.try_divide(F.col("total_segment_value"), F.col("customer_count")), 2)
        .alias("avg_customer_value"),
        ratio("_frequency", "customer_count").alias("avg_frequency"), "total_segment_value",
    ).orderBy(F.col("customer_count").desc(), "segment")
