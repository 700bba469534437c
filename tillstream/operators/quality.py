"""Data-quality checks, all in one pass over a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F


def _counters(checks: list[Column]) -> list[Column]:
    return [F.count("*").alias("rows"), *[
        F.count_if(~F.coalesce(check, F.lit(False))).alias(f"_{i}") for i, check in enumerate(checks)]]


def _columns(rules: dict[str, Column | str]) -> dict[str, Column]:
    return {name: F.expr(rule) if isinstance(rule, str) else rule for name, rule in rules.items()}


def checked_while_written(df: DataFrame, rules: dict[str, Column | str]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """`df`, to be written once, and a function that then gives its `quality_report` without another scan.

    The counters are taken while the rows pass (an observation), so they are those of the rows that were written.
    A batch that is written again needs its own call. Before the write has ended the function waits.
    """
    checks, seen = _columns(rules), Observation()
    watched = df.observe(seen, *_counters(list(checks.values())))

    def report() -> DataFrame:
        found = seen.get
        rows = [(name, found["rows"], found[f"_{i}"], found[f"_{i}"] / found["rows"] if found["rows"] else 0.0)
                for i, name in enumerate(checks)]
        return df.sparkSession.createDataFrame(rows, "rule string, rows bigint, failed bigint, failed_share double")

    return watched, report


def quality_report(df: DataFrame, rules: dict[str, Column | str]) -> DataFrame:
    """(rule, rows, failed, failed_share) for each rule, an expression that must be true.

    NULL results count as failed. One aggregate of counters, no shuffle of rows.
    """
    checks = _columns(rules)
    counted = df.agg(*_counters(list(checks.values())))
    listed = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col("rows"), F.col(f"_{i}").alias("failed"))
        for i, name in enumerate(checks)
    ])
    return counted.select(F.explode(listed).alias("r")).select("r.*").withColumn(
        "failed_share", F.coalesce(F.try_divide(F.col("failed").cast("double"), F.col("rows")), F.lit(0.0))
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")
