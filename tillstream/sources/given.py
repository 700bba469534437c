"""The given Parquet tables seen as retail tables.

Every view reads only the columns and joins it needs, so that filters and projections of the
caller reach the Parquet scans. Joins carry no hints: Spark broadcasts a side only where its size
is known to be below `spark.sql.autoBroadcastJoinThreshold`, and otherwise shuffles, splitting
skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.schemas import GIVEN
from tillstream.sources.events import DEFAULT_CATEGORY

# Event types of the given log that stand for cart actions.
CART_ACTIONS = {"click": "add", "error": "remove", "signup": "update"}
# One line per order is chosen by the smallest (line number, part); both are packed into one long
# so that the choice is a plain hash aggregate.
_PART_BITS = 48


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


class GivenTables:
    def __init__(self, spark: SparkSession, folder: str):
        # Day and week functions and text forms of timestamps follow the session zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    # Orders ------------------------------------------------------------------------------------

    def _countries(self) -> DataFrame:
        """(c_custkey, country)"""
        return self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select("c_custkey", F.col("n_name").alias("country"))

    def _order_categories(self) -> DataFrame:
        """(l_orderkey, p_type) of the first line of each order."""
        packed = F.shiftleft(F.col("l_linenumber").cast("bigint"), _PART_BITS) + F.col("l_partkey")
        first = self.table("lineitem").groupBy("l_orderkey").agg(F.min(packed).alias("first_line"))
        part_key = F.col("first_line").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
        return first.select("l_orderkey", part_key.alias("part_key")).join(
            self.table("part").select("p_partkey", "p_type"), F.col("part_key") == F.col("p_partkey")
        ).select("l_orderkey", "p_type")

    def transactions(self, categories: bool = True, countries: bool = True) -> DataFrame:
        """One row per order.

        Without `categories` neither line items nor parts are read, without `countries` neither
        customers nor nations.
        """
        orders = self.table("orders")
        columns = [
            F.col("o_orderkey").cast("string").alias("transaction_id"),
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("o_orderdate").alias("timestamp"),
            _money("o_totalprice").alias("total_amount"),
            F.col("o_orderpriority").alias("payment_method"),
        ]
        if countries:
            orders = orders.join(self._countries(), F.col("o_custkey") == F.col("c_custkey"))
            columns.append("country")
        if categories:
            orders = orders.join(
                self._order_categories(), F.col("o_orderkey") == F.col("l_orderkey"), "left"
            )
            columns.append(F.coalesce("p_type", F.lit(DEFAULT_CATEGORY)).alias("category"))
        return orders.select(*columns)

    def order_lines(self) -> DataFrame:
        """One row per line item with its order, in the form of exploded `products`."""
        return self.table("lineitem").join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        ).select(
            F.col("o_orderkey").cast("string").alias("transaction_id"),
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("o_orderdate").alias("timestamp"),
            _money("o_totalprice").alias("total_amount"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
        )

    # Event log ---------------------------------------------------------------------------------

    def _events(self, *types: str) -> DataFrame:
        return self.table("events").filter(F.col("event_type").isin(*types)).withColumn(
            "k", F.get_json_object("props", "$.k").cast("int")
        )

    def purchase_times(self) -> DataFrame:
        """Purchases without country and category, which costs no join."""
        return self._events("purchase").select(
            F.col("event_id").cast("string").alias("transaction_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("ts").alias("timestamp"), _money("value").alias("total_amount"),
            F.col("k").cast("string").alias("product_id"),
        )

    def purchases(self) -> DataFrame:
        """Transactions with times to the second; unknown customers have no country, unknown parts are General."""
        parts = self.table("part").select("p_partkey", "p_type")
        return (
            self._events("purchase")
            .join(self._countries(), F.col("user_id") == F.col("c_custkey"), "left")
            .join(parts, F.col("k") == F.col("p_partkey"), "left")
            .select(
                F.col("event_id").cast("string").alias("transaction_id"),
                F.col("user_id").cast("string").alias("user_id"),
                F.col("ts").alias("timestamp"),
                _money("value").alias("total_amount"),
                F.coalesce("p_type", F.lit(DEFAULT_CATEGORY)).alias("category"), "country",
                F.lit("credit_card").alias("payment_method"),
                F.col("k").cast("string").alias("product_id"),
            )
        )

    @staticmethod
    def _session_id() -> Column:
        return F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))

    def cart_events(self) -> DataFrame:
        action = F.create_map(*[F.lit(x) for pair in CART_ACTIONS.items() for x in pair])
        quantity = F.when(F.col("event_type") == "error", 0).otherwise(F.col("k") % 5 + 1)
        return self._events(*CART_ACTIONS).select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("k").cast("string").alias("product_id"),
            F.col("ts").alias("timestamp"),
            action[F.col("event_type")].alias("action"),
            quantity.alias("quantity"),
            self._session_id().alias("session_id"),
        )

    def product_views(self) -> DataFrame:
        parts = self.table("part").select("p_partkey", "p_type")
        return self._events("view").join(
            parts, F.col("k") == F.col("p_partkey"), "left"
        ).select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("k").cast("string").alias("product_id"),
            F.col("ts").alias("timestamp"),
            self._session_id().alias("session_id"),
            (F.lit(5) + F.floor("value").cast("int") % 296).alias("duration_seconds"),
            F.coalesce("p_type", F.lit(DEFAULT_CATEGORY)).alias("category"),
        )

    # Dimensions and monitoring -------------------------------------------------------------------

    def users(self) -> DataFrame:
        return self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("c_custkey").cast("string").alias("user_id"),
            F.col("c_name").alias("name"), F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("market"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("name"), F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
            (F.col("p_size") * 20).alias("inventory"),
            F.lit(None).cast("double").alias("ratings"),
        )

    def inventory_status(self, units_per_size: int = 20) -> DataFrame:
        stock = (F.col("p_size") * units_per_size).cast("bigint")
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
            stock.alias("current_stock"), F.lit(0).cast("bigint").alias("reserved_stock"),
            stock.alias("available_stock"),
        )

    def topic_offsets(self) -> DataFrame:
        """End offsets per event type and hour, as a running count over four partitions."""
        from pyspark.sql import Window

        hourly = self.table("events").groupBy(
            F.col("event_type").alias("topic"),
            (F.col("user_id") % 4).cast("int").alias("partition"),
            F.date_trunc("hour", "ts").alias("timestamp"),
        ).agg(F.count("*").alias("n"))
        running = Window.partitionBy("topic", "partition").orderBy("timestamp")
        return hourly.withColumn("end_offset", F.sum("n").over(running)).drop("n")

    def system_health(self) -> DataFrame:
        """Gauges from three event types, container states from another."""
        kind = F.col("event_type")
        name = (
            F.when(kind == "view", "cpu_usage").when(kind == "click", "memory_usage")
            .when(kind == "error", "disk_usage").when(kind == "signup", "container_status")
        )
        is_state = kind == "signup"
        return self.table("events").filter(kind != "purchase").select(
            name.alias("metric_name"),
            F.when(is_state, (F.col("event_id") % 2).cast("decimal(15,2)"))
            .otherwise(F.col("value").cast("decimal(15,2)")).alias("metric_value"),
            F.when(is_state, "status").otherwise("gauge").alias("metric_type"),
            F.col("ts").alias("timestamp"),
            F.when(is_state, F.concat(F.lit("c"), (F.col("user_id") % 8).cast("string")))
            .alias("metadata"),
            "event_id",
        )
