"""Windowed metrics over sales, product views and topics, and the purchase funnel."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from tillstream.functions.exact import as_timestamp, mean_money, ratio
from tillstream.functions.periods import seconds_of
from tillstream.schemas import TOTAL


def _on_event_time(df: DataFrame, watermark: str | None) -> DataFrame:
    rows = df.filter("timestamp IS NOT NULL")
    return rows.withWatermark("timestamp", watermark) if watermark else rows


# From this many windows per sale on, tables are summed per slide before they are spread over windows.
_MANY_WINDOWS = 4


def pane(window: str, slide: str) -> str:
    """The longest span that tiles both `window` and `slide`."""
    length, step = seconds_of(window), seconds_of(slide)
    if not length or not step:
        raise ValueError(f"{window!r} and {slide!r} must be whole seconds, minutes, hours, days or weeks")
    return f"{math.gcd(length, step)} seconds"


def sales_panes(transactions: DataFrame, window: str, slide: str) -> DataFrame:
    """Sales per pane of sliding windows: every sale once, also where the slide does not divide the window."""
    return sales_metrics(transactions, pane(window, slide), None)


def sales_metrics(
    transactions: DataFrame, window: str = "1 minute", slide: str | None = "30 seconds",
    watermark: str | None = None, since=None, until=None,
) -> DataFrame:
    """Amount, count and average per (window, category, country).

    `since` and `until` keep only windows that start in that range, both ends included; the sales that
    these windows can hold are filtered by their own time, so that the range reaches the scan.

    With a `slide` shorter than `window` every transaction counts in window/slide windows. Where
    these are many, tables are first summed per slide, and only the sums are copied into each
    window; streams and few windows take one pass.
    """
    rows = _on_event_time(transactions, watermark)
    if since is not None:
        rows = rows.filter(F.col("timestamp") >= as_timestamp(since))
    if until is not None:
        rows = rows.filter(F.col("timestamp") <= as_timestamp(until) + F.expr(f"INTERVAL {window}"))
    rows = rows.select(
        "timestamp", "category", "country", "total_amount", F.lit(1).cast("bigint").alias("n")
    )
    length, step = seconds_of(window), seconds_of(slide or window)
    if (length and step and length % step == 0 and length // step >= _MANY_WINDOWS
            and not transactions.isStreaming):
        rows = rows.groupBy(F.window("timestamp", slide).alias("span"), "category", "country").agg(
            F.sum("total_amount").alias("total_amount"), F.sum("n").alias("n"),
        ).select(F.col("span.start").alias("timestamp"), "category", "country", "total_amount", "n")
    span = F.window("timestamp", window, slide) if slide else F.window("timestamp", window)
    summed = rows.groupBy(span, "category", "country").agg(
        F.sum("total_amount").cast(TOTAL).alias("total_amount"), F.sum("n").alias("transaction_count"),
    )
    if since is not None:
        summed = summed.filter(F.col("window.start") >= as_timestamp(since))
    if until is not None:
        summed = summed.filter(F.col("window.start") <= as_timestamp(until))
    return summed.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "category", "country", "total_amount", "transaction_count",
        mean_money(F.col("total_amount"), F.col("transaction_count")).alias("avg_transaction_value"),
    )


def view_metrics(views: DataFrame, window: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """Views and viewing time per (window, category)."""
    return _on_event_time(views, watermark).groupBy(F.window("timestamp", window), "category").agg(
        F.count("*").alias("views"),
        F.sum(F.col("duration_seconds").cast("bigint")).alias("total_duration"),
    ).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "category", "views", "total_duration",
        ratio("total_duration", "views").alias("avg_duration"),
    )


def funnel(views: DataFrame, carts: DataFrame, purchases: DataFrame, keys: list[str]) -> DataFrame:
    """How many distinct `keys` viewed, later added to a cart, and later still purchased.

    Only times decide: the first addition at or after the first view, and whether the last purchase
    is at or after that. Each step is a hash aggregate by key and one narrow join, so a hot key is
    reduced to a time before it is shuffled, and no pairs are made.
    """
    def times(df: DataFrame) -> DataFrame:
        return df.filter("timestamp IS NOT NULL").select(*keys, "timestamp")

    viewed = times(views).groupBy(*keys).agg(F.min("timestamp").alias("viewed"))
    bought = times(purchases).groupBy(*keys).agg(F.max("timestamp").alias("bought"))
    carted = times(carts.filter("action = 'add'")).join(viewed, keys).filter(
        F.col("timestamp") >= F.col("viewed")).groupBy(*keys).agg(F.min("timestamp").alias("carted"))
    steps = viewed.join(carted, keys, "left").join(bought, keys, "full_outer").agg(
        F.count("viewed").alias("viewed"), F.count("carted").alias("carted"),
        F.count_if(F.expr("bought >= carted")).alias("purchased"),
        F.count("bought").alias("all_buyers"),
    )
    return steps.select(
        "viewed", "carted", "purchased", "all_buyers",
        ratio("carted", "viewed").alias("cart_rate"),
        ratio("purchased", "carted").alias("purchase_rate"),
    )


def topic_rates(offsets: DataFrame) -> DataFrame:
    """Events and events per second of each topic since its previous sample.

    Each partition counts from its own previous sample, however long ago: its first sample counts 0,
    and so does a falling offset. The rate uses the time since the topic's previous sample.
    """
    in_partition = Window.partitionBy("topic", "partition").orderBy("timestamp")
    moved = F.greatest(F.col("end_offset") - F.lag("end_offset").over(in_partition), F.lit(0))
    samples = offsets.withColumn("moved", F.coalesce(moved, F.lit(0))).groupBy("topic", "timestamp").agg(
        F.sum("moved").alias("moved"))
    before = Window.partitionBy("topic").orderBy("timestamp")
    elapsed = F.unix_seconds("timestamp") - F.unix_seconds(F.lag("timestamp").over(before))
    return samples.select(
        "topic", F.col("moved").cast("bigint").alias("event_count"),
        elapsed.alias("elapsed"), "timestamp",
    ).select(
        "topic", "event_count",
        F.coalesce(ratio("event_count", "elapsed"), F.lit(0.0)).alias("rate"), "timestamp",
    )


_PROGRESS = "timestamp string, sources array<struct<endOffset: map<string, map<string, bigint>>>>"


def offsets_from_progress(progress: DataFrame) -> DataFrame:
    """(topic, partition, end_offset, timestamp) from the JSON progress reports of streaming queries.

    `progress` has the reports in a text column `value`; sources other than topics give no rows.
    """
    report = progress.select(F.explode(F.array(F.from_json("value", _PROGRESS))).alias("p"))
    sources = report.select(
        F.try_to_timestamp("p.timestamp").alias("timestamp"), F.explode("p.sources.endOffset").alias("ends")
    )
    topics = sources.select("timestamp", F.explode("ends").alias("topic", "partitions"))
    return topics.select("timestamp", "topic", F.explode("partitions").alias("partition", "end_offset")).select(
        "topic", F.col("partition").cast("int").alias("partition"), "end_offset", "timestamp"
    )
