"""Names and ratings derived from scores. The rules below are fixed values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def segment_name(r="r_score", f="f_score", m="m_score") -> Column:
    """Customer segment of an RFM score triple; the first matching rule wins."""
    r, f, m = _col(r), _col(f), _col(m)
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 4) & (f >= 3), "Loyal Customers")
        .when((r >= 3) & (f >= 1) & (m >= 3), "Potential Loyalists")
        .when((r >= 4) & (f <= 2), "New Customers")
        .when((r >= 3) & (f <= 2), "Promising")
        .when((r <= 2) & (f >= 4), "Cannot Lose Them")
        .when((r <= 2) & (f >= 2), "At Risk")
        .when(r <= 2, "Hibernating")
        .otherwise("Need Attention")
    )


def performance_rating(share="revenue_share") -> Column:
    """Rating of a category by its percentage of all revenue."""
    share = _col(share)
    return (
        F.when(share >= 20, "Excellent")
        .when(share >= 10, "Good")
        .when(share >= 5, "Average")
        .otherwise("Below Average")
    )


def known_or(column, default: str = "Unknown") -> Column:
    """The value, or `default` where it is NULL or empty text."""
    return F.coalesce(F.nullif(_col(column), F.lit("")), F.lit(default))
