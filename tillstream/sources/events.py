"""Event scans and JSON parsing, the same for batch and streaming frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillstream import schemas

DEFAULT_CATEGORY = "General"
_RAW = T.StructType([T.StructField("value", T.StringType())])


def kafka_options(servers: str, topic: str, starting: str = "latest", **extra: str) -> dict[str, str]:
    """Options of a topic subscription. `extra` keys use `__` for dots."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    options.update({key.replace("__", "."): value for key, value in extra.items()})
    return options


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of one topic as `value` text; needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka").options(**options).load()
        .select(F.col("value").cast("string").alias("value"))
    )


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of JSON lines, one event per line, from a growing folder."""
    reader = spark.readStream.format("text").schema(_RAW)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def file_events(spark: SparkSession, path: str) -> DataFrame:
    """The same folder as a batch frame."""
    return spark.read.schema(_RAW).text(path)


@dataclass(frozen=True)
class Parsed:
    """Typed events, and the raw lines that could not be typed."""

    events: DataFrame
    dead_letters: DataFrame


def _typed(raw: DataFrame, schema: T.StructType, required: list[str]) -> DataFrame:
    # As a generator the JSON is parsed once per line. As a plain column, the filters below would
    # be pushed beneath it, each repeating the parse.
    opened = raw.select("value", F.explode(F.array(F.from_json("value", schema))).alias("event"))
    stamped = opened.withColumn("at", F.try_to_timestamp("event.timestamp"))
    reason = F.when(F.col(f"event.{required[0]}").isNull(), "unreadable")
    for name in required[1:]:
        reason = reason.when(F.col(f"event.{name}").isNull(), f"no {name}")
    return stamped.withColumn("reason", reason.when(F.col("at").isNull(), "bad timestamp"))


def _split(checked: DataFrame, columns: list) -> Parsed:
    return Parsed(
        events=checked.filter("reason IS NULL").select(*columns),
        dead_letters=checked.filter("reason IS NOT NULL").select("value", "reason"),
    )


def parse_transactions(raw: DataFrame) -> Parsed:
    """`value` JSON -> transactions with `products`. Amounts become exact decimals."""
    checked = _typed(raw, schemas.TRANSACTION_EVENT, ["transaction_id"])
    amount = F.expr("try_cast(event.total_amount AS DECIMAL(12,2))")
    unfit = F.col("event.total_amount").isNotNull() & F.col("total_amount").isNull()
    checked = checked.withColumn("total_amount", amount).withColumn(
        "reason", F.coalesce("reason", F.when(unfit, "amount out of range"))
    )
    return _split(checked, [
        "event.transaction_id", "event.user_id", F.col("at").alias("timestamp"),
        "event.products", "total_amount", "event.payment_method", "event.country",
        F.coalesce("event.category", F.lit(DEFAULT_CATEGORY)).alias("category"),
    ])


def parse_cart_events(raw: DataFrame) -> Parsed:
    return _split(_typed(raw, schemas.CART_EVENT, ["event_id", "session_id"]), [
        "event.event_id", "event.user_id", "event.product_id", F.col("at").alias("timestamp"),
        "event.action", "event.quantity", "event.session_id",
    ])


def parse_product_views(raw: DataFrame) -> Parsed:
    return _split(_typed(raw, schemas.PRODUCT_VIEW_EVENT, ["event_id"]), [
        "event.event_id", "event.user_id", "event.product_id", F.col("at").alias("timestamp"),
        "event.session_id", "event.duration_seconds",
        F.coalesce("event.category", F.lit(DEFAULT_CATEGORY)).alias("category"),
    ])


def stored_transactions(transactions: DataFrame) -> DataFrame:
    """The columns kept of each transaction for customer analysis."""
    return transactions.select(
        "transaction_id", "user_id", "timestamp",
        F.col("total_amount").cast(schemas.AMOUNT).alias("total_amount"),
        "category", "country", "payment_method",
    )


def deduplicated(transactions: DataFrame, within: str = "1 hour") -> DataFrame:
    """One row per transaction id: on streams the first that comes within the time, on tables the earliest."""
    if transactions.isStreaming:
        return transactions.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["transaction_id"])
    rest = [c for c in transactions.columns if c != "transaction_id"]
    order = F.struct("timestamp", F.xxhash64(*rest))
    return transactions.groupBy("transaction_id").agg(F.min_by(F.struct(*rest), order).alias("row")).select(
        "transaction_id", "row.*").select(*transactions.columns)


def product_lines(transactions: DataFrame) -> DataFrame:
    """One row per product line; transactions without products give none."""
    return transactions.select(
        "transaction_id", "user_id", "timestamp", "total_amount",
        F.explode("products").alias("line"),
    ).select(
        "transaction_id", "user_id", "timestamp", "total_amount",
        "line.product_id", "line.quantity", "line.price",
    )
