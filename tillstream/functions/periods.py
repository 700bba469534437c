"""Date keys, calendar periods and window alignment."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_id(ts: str) -> Column:
    """yyyyMMdd as an int."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds_of(duration: str) -> int | None:
    """Seconds of a duration such as "5 minutes"; None for other forms."""
    parts = duration.lower().split()
    unit = _UNIT_SECONDS.get(parts[1].rstrip("s")) if len(parts) == 2 else None
    return int(parts[0]) * unit if unit and parts[0].isdigit() else None


def aligned(start: str, end: str) -> Column:
    """True for windows starting on a multiple of their own length.

    Of overlapping sliding windows these cover every event exactly once.
    """
    length = F.unix_seconds(end) - F.unix_seconds(start)
    return F.unix_seconds(start) % length == 0


def period_columns(grain: str, ts: str, iso_year: bool = False) -> list[Column]:
    """Grouping columns of a period, in sort order."""
    if grain == "hourly":
        return [F.date_format(ts, "yyyy-MM-dd HH:00").alias("hour")]
    if grain == "daily":
        return [F.date_format(ts, "yyyy-MM-dd").alias("date")]
    if grain == "weekly":
        # Calendar year with ISO week by default: 2024-12-30 is 2024 week 1.
        year = F.extract(F.lit("YEAROFWEEK"), ts) if iso_year else F.year(ts)
        return [year.cast("int").alias("year"), F.weekofyear(ts).alias("week")]
    if grain == "monthly":
        return [F.year(ts).alias("year"), F.month(ts).alias("month")]
    raise ValueError(f"unknown grain {grain!r}")


def period_text(grain: str) -> Column:
    """Display text of a period: 2024-01-31, 2024-W5, 2024-1."""
    if grain == "weekly":
        return F.concat(F.col("year").cast("string"), F.lit("-W"), F.col("week").cast("string"))
    if grain == "monthly":
        return F.concat(F.col("year").cast("string"), F.lit("-"), F.col("month").cast("string"))
    return F.col("hour" if grain == "hourly" else "date")
