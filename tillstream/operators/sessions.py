"""Shopping sessions, abandoned carts and carts without a purchase."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillstream.operators.ranking import latest_per_key

_COLUMNS = [
    "session_id", "user_id", "start_time", "end_time", "duration_seconds", "page_views",
    "cart_adds", "cart_removes",
]


def _counts():
    return [
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"),
        F.count("*").alias("page_views"),
        F.count_if(F.expr("action = 'add'")).alias("cart_adds"),
        F.count_if(F.expr("action = 'remove'")).alias("cart_removes"),
    ]


def _distinct(unique_products: str | None):
    if unique_products is None:
        return []
    count = {"approx": F.approx_count_distinct, "exact": F.count_distinct}[unique_products]
    return [count("product_id").alias("unique_products")]


def _duration():
    return F.unix_seconds("end_time") - F.unix_seconds("start_time")


def windowed_sessions(
    cart: DataFrame, window: str = "2 minutes", watermark: str | None = None,
    unique_products: str | None = "approx",
) -> DataFrame:
    """Cart activity per (session, user, fixed window); `page_views` counts cart events."""
    rows = cart.filter("timestamp IS NOT NULL")
    if watermark:
        rows = rows.withWatermark("timestamp", watermark)
    counted = rows.groupBy("session_id", "user_id", F.window("timestamp", window)).agg(
        *_counts(), *_distinct(unique_products)
    )
    extra = ["unique_products"] if unique_products else []
    return counted.withColumn("duration_seconds", _duration()).select(*_COLUMNS, *extra)


#: Sketches of 2**12 registers; the standard error of their counts.
SKETCH_BITS, SKETCH_ERROR = 12, 1.04 / 2 ** 6


def product_sketches(cart: DataFrame, window: str = "1 day", watermark: str | None = None) -> DataFrame:
    """A mergeable sketch of the products that carts had in each window, to be stored instead of the events."""
    rows = cart.filter("timestamp IS NOT NULL")
    if watermark:
        rows = rows.withWatermark("timestamp", watermark)
    return rows.groupBy(F.window("timestamp", window)).agg(
        F.hll_sketch_agg("product_id", F.lit(SKETCH_BITS)).alias("products")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "products")


def distinct_products(sketches: DataFrame, *by) -> DataFrame:
    """About how many products the windows of each group of `by` had in all, each counted once.

    Windows of any span can be united, overlapping ones too; a group without windows has no row.
    """
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("products")).alias("unique_products"))


def streamed_sessions(
    cart: DataFrame, gap_seconds: int = 120, watermark: str | None = None,
    unique_products: str | None = "approx",
) -> DataFrame:
    """Sessions closed by a pause longer than the gap; in streams for append mode only."""
    rows = cart.filter("timestamp IS NOT NULL")
    if watermark:
        rows = rows.withWatermark("timestamp", watermark)
    span = F.session_window("timestamp", f"{gap_seconds} seconds")
    counted = rows.groupBy("session_id", "user_id", span).agg(*_counts(), *_distinct(unique_products))
    extra = ["unique_products"] if unique_products else []
    return counted.withColumn("duration_seconds", _duration()).select(*_COLUMNS, *extra)


def gap_sessions(cart: DataFrame, gap_seconds: int = 120) -> DataFrame:
    """The same sessions on tables, safe for a session id that holds much of the data.

    Events of one gap-long time slot are never more than the gap apart, so they always share a
    session. They are summed per slot first (with map-side combine); only slot rows are sorted.
    """
    slot = F.floor(F.unix_seconds("timestamp") / gap_seconds).alias("slot")
    slots = cart.filter("timestamp IS NOT NULL").groupBy("session_id", "user_id", slot).agg(*_counts())
    in_order = Window.partitionBy("session_id", "user_id").orderBy("slot")
    pause = F.unix_micros("start_time") - F.unix_micros("previous")
    stays = F.coalesce(pause <= gap_seconds * 1_000_000, F.lit(False))
    numbered = slots.withColumn("previous", F.lag("end_time").over(in_order)).withColumn(
        "nth", F.sum(F.when(stays, 0).otherwise(1)).over(
            in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return numbered.groupBy("session_id", "user_id", "nth").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
        F.sum("page_views").alias("page_views"), F.sum("cart_adds").alias("cart_adds"),
        F.sum("cart_removes").alias("cart_removes"),
    ).withColumn("duration_seconds", _duration()).select(*_COLUMNS)


def upserted_sessions(sessions: DataFrame) -> DataFrame:
    """One row per session id: counts of its last row, user and start of its first one."""
    return latest_per_key(sessions, ["session_id"], "end_time", ["user_id", "start_time"])


def cart_abandonment(sessions: DataFrame, min_seconds: int = 60, values: DataFrame | None = None) -> DataFrame:
    """Sessions with additions that lasted longer than `min_seconds`.

    `values` (session_id, cart_value) gives what is left in the carts, as from `cart_values`; carts
    without an entry, or all without `values`, are worth 0.
    """
    value = F.lit(0).cast("decimal(22,2)")
    if values is not None:
        sessions = sessions.join(values.select("session_id", "cart_value"), "session_id", "left")
        value = F.coalesce("cart_value", value)
    return sessions.filter((F.col("cart_adds") > 0) & (F.col("duration_seconds") > min_seconds)).select(
        "session_id", "user_id", F.col("cart_adds").alias("products_in_cart"),
        value.alias("cart_value"),
        F.col("end_time").alias("abandonment_time"),
        F.expr("duration_seconds div 60").alias("time_in_cart_minutes"),
    )


def cart_contents(cart: DataFrame) -> DataFrame:
    """What is left in each session's cart: the actions on a product taken in order of time.

    An addition adds its quantity, an update replaces the quantity, a removal leaves none. So only the
    last update or removal counts, and the additions after it. Events of one time go by `event_id`.
    Two hash aggregates and one narrow join; nothing is sorted by session.
    """
    at = F.struct("timestamp", "event_id")
    rows = cart.filter("timestamp IS NOT NULL").select("session_id", "product_id", "action", "quantity", at.alias("at"))
    resets = rows.filter("action IN ('remove', 'update')").groupBy("session_id", "product_id").agg(
        F.max(F.struct("at", F.when(F.col("action") == "update", F.col("quantity")).otherwise(0).alias("left"))).alias("reset"))
    added = rows.filter("action = 'add'").join(resets, ["session_id", "product_id"], "left").filter(
        F.col("reset").isNull() | (F.col("at") > F.col("reset.at"))).groupBy("session_id", "product_id").agg(
        F.sum("quantity").alias("added"))
    return added.join(resets, ["session_id", "product_id"], "full_outer").select(
        "session_id", "product_id",
        (F.coalesce("added", F.lit(0)) + F.coalesce("reset.left", F.lit(0))).alias("quantity"),
    ).filter("quantity > 0")


def cart_values(cart: DataFrame, products: DataFrame) -> DataFrame:
    """Value of what is left in each session's cart, at list price; unlisted products are worth 0."""
    price = F.coalesce(F.col("price").cast("decimal(12,2)"), F.lit(0))
    return cart_contents(cart).join(products.select("product_id", "price"), "product_id", "left").groupBy(
        "session_id"
    ).agg(F.sum(F.col("quantity") * price).cast("decimal(22,2)").alias("cart_value"))


def with_outcome(
    sessions: DataFrame, purchases: DataFrame, horizon_seconds: int = 1800, min_seconds: int = 60,
) -> DataFrame:
    """`sessions` with purchase_completed, abandoned and total_amount (NULL without a purchase).

    A purchase belongs to the user's sessions from whose start to end + horizon it falls; a session is
    abandoned if it had additions, lasted longer than `min_seconds` and led to no purchase. Sessions
    are cut into horizon-long slots, so a purchase meets the few sessions of its user and slot.
    """
    width = horizon_seconds * 1_000_000
    since, until = F.unix_micros("start_time"), F.unix_micros("end_time") + width
    slots = sessions.select(
        "session_id", "user_id", "start_time", since.alias("_from"), until.alias("_to"),
        F.explode(F.sequence(F.floor(since / width), F.floor(until / width))).alias("_slot"))
    at = F.unix_micros("timestamp")
    paid = purchases.filter("timestamp IS NOT NULL").select(
        "user_id", at.alias("_at"), F.floor(at / width).alias("_slot"), "total_amount")
    sums = slots.join(paid, ["user_id", "_slot"]).filter(F.col("_at").between(F.col("_from"), F.col("_to"))).groupBy(
        "session_id", "user_id", "start_time"
    ).agg(F.count("*").alias("_bought"), F.sum("total_amount").alias("total_amount"))
    bought = F.col("_bought").isNotNull()
    return sessions.join(sums, ["session_id", "user_id", "start_time"], "left").select(
        *sessions.columns, bought.alias("purchase_completed"),
        (~bought & (F.col("cart_adds") > 0) & (F.col("duration_seconds") > min_seconds)).alias("abandoned"),
        "total_amount",
    )


def unpurchased_carts(
    sessions: DataFrame, purchases: DataFrame, horizon_seconds: int = 1800,
) -> DataFrame:
    """Sessions with additions and no purchase by the user from start to end + horizon.

    Time is cut into horizon-long slots. A session spans at least two of them, so a purchase
    inside its first slot counts if the slot's last purchase is late enough, one inside its last
    slot if the slot's first is early enough, and one between always. Purchases thus shrink to
    (user, slot, first, last) before the join, which matches each session slot to at most one row:
    a busy user yields neither a huge group nor all pairs.
    """
    width = horizon_seconds * 1_000_000
    carts = sessions.filter("cart_adds > 0").withColumn("_from", F.unix_micros("start_time")).withColumn(
        "_to", F.unix_micros("end_time") + width
    )
    bought = purchases.filter("timestamp IS NOT NULL").groupBy(
        "user_id", F.floor(F.unix_micros("timestamp") / width).alias("_slot")
    ).agg(
        F.min(F.unix_micros("timestamp")).alias("_first"),
        F.max(F.unix_micros("timestamp")).alias("_last"),
    )
    low, high = F.floor(F.col("_from") / width), F.floor(F.col("_to") / width)
    slots = carts.withColumn("_slot", F.explode(F.sequence(low, high)))
    hit = (
        F.col("_first").isNotNull()
        & ((F.col("_slot") > low) | (F.col("_last") >= F.col("_from")))
        & ((F.col("_slot") < high) | (F.col("_first") <= F.col("_to")))
    )
    columns = sessions.columns
    return slots.join(bought, ["user_id", "_slot"], "left").withColumn("_hit", hit).groupBy(
        *columns
    ).agg(F.max("_hit").alias("_hit")).filter(~F.col("_hit")).select(*columns)
