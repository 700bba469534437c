"""The transaction, inventory and session jobs.

Each takes the raw `value` stream of its topic and starts its queries; wait for them with
`spark.streams.awaitAnyTermination()`. `pace` is `available_now=True` or `every="1 minute"`.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from tillstream.operators import anomalies, inventory, metrics, running_stock, sessions
from tillstream.settings import AnomalyRules, SalesWindows, SessionRules, StockRules
from tillstream.sources.events import (
    deduplicated, parse_cart_events, parse_product_views, parse_transactions, product_lines,
    stored_transactions,
)
from tillstream.sources.tables import TableStore
from tillstream.streaming import sinks


#: How session rows replace earlier ones of the same id.
SESSION_UPSERT = {"keys": ["session_id"], "keep_first": ["user_id", "start_time"], "tie": ("end_time",)}


def monitor_transactions(
    raw: DataFrame, store: TableStore, checkpoints: str, *, rules: AnomalyRules = AnomalyRules(),
    windows: SalesWindows = SalesWindows(), debug: bool = False, once_within: str | None = None, **pace,
) -> list:
    """Stored transactions and anomalies (one query), and windowed sales metrics.

    With `once_within` ("1 hour") a transaction id that comes again within that time counts once.
    """
    events = parse_transactions(raw).events
    if once_within:
        events = deduplicated(events, once_within)
    rows = sinks.fan_out({
        "transactions": stored_transactions,
        "transaction_anomalies": lambda batch: anomalies.detect_anomalies(batch, rules),
    }, store)
    late = None if once_within else windows.watermark  # a stream has one watermark
    sales = metrics.sales_metrics(events, windows.length, windows.slide, late)
    rapid = anomalies.rapid_transactions(events, rules.rapid_limit, rules.rapid_window, late)
    queries = [
        sinks.start(events, rows, "transaction_rows", checkpoints, **pace),
        sinks.start(
            sales, sinks.into_table(store, "sales_metrics"), "sales_metrics", checkpoints,
            **pace,
        ),
        sinks.start(
            rapid, sinks.into_table(store, "rapid_anomalies"), "rapid_anomalies", checkpoints,
            **pace,
        ),
    ]
    if debug:
        queries.append(sinks.to_console(events, "transactions_console"))
    return queries


def track_inventory(
    raw: DataFrame, store: TableStore, checkpoints: str, *, rules: StockRules = StockRules(),
    debug: bool = False, **pace,
) -> list:
    """Units sold per (window, product), in update mode.

    Update mode reports running totals, so they are stored as changes keyed by (window, product)
    and never subtracted from a stock level; `stock_now` takes the newest of each.
    """
    lines = product_lines(parse_transactions(raw).events)
    moved = inventory.stock_movements(lines, rules.window, rules.watermark)
    queries = [sinks.start(
        moved, sinks.into_table(store, "stock_movements"), "stock_movements", checkpoints,
        mode="update", **pace,
    )]
    if debug:
        queries.append(sinks.to_console(lines, "inventory_console"))
    return queries


def keep_stock(
    raw: DataFrame, store: TableStore, checkpoints: str, *, rules: StockRules = StockRules(), **pace,
) -> list:
    """Stock levels and low-stock alerts kept by the stream itself, from the stock stored when it first starts.

    Levels go to `stock_levels` in update mode, one row a micro-batch for each product that moved; alerts go to
    `stock_alerts`, once a crossing. `kept_levels` has the newest level of every product.
    """
    lines = product_lines(parse_transactions(raw).events)
    changes = running_stock.running_stock(lines, store.read("inventory_status"), rules)
    write = sinks.fan_out({"stock_levels": running_stock.levels, "stock_alerts": running_stock.alerts}, store)
    return [sinks.start(changes, write, "running_stock", checkpoints, mode="update", **pace)]


def kept_levels(store: TableStore) -> DataFrame:
    """Stock of all products, those that didn't move included."""
    moved = store.current("stock_levels", ["product_id"])
    still = store.read("inventory_status").join(moved.select("product_id"), "product_id", "left_anti")
    return moved.unionByName(still)


def anomalies_now(store: TableStore) -> DataFrame:
    """Anomalies of all kinds."""
    return store.read("transaction_anomalies").unionByName(store.read("rapid_anomalies"))


def movements_now(store: TableStore, since: date | None = None, before: date | None = None) -> DataFrame:
    """The newest total of each (window, product). Totals only grow, so the largest is newest."""
    rows = store.changes("stock_movements")
    if since is not None:
        rows = rows.filter(F.col("window_start") >= F.lit(since).cast("timestamp"))
    if before is not None:
        rows = rows.filter(F.col("window_start") < F.lit(before).cast("timestamp"))
    return rows.groupBy("window_start", "product_id").agg(
        F.max("sold_quantity").alias("sold_quantity"),
        F.max("transaction_count").alias("transaction_count"),
    )


def _opening_stock(store: TableStore) -> tuple[DataFrame, date | None]:
    """Stock as last closed, and the day from which movements are still to be taken off."""
    newest = store.newest_batch("inventory_openings")
    if newest is None:
        return store.read("inventory_status"), None
    rows = store.changes("inventory_openings").filter(F.col("batch_id") == newest).drop("run", "batch_id")
    return rows, datetime.strptime(str(newest), "%Y%m%d").date()


def close_stock(store: TableStore, day: date, rules: StockRules = StockRules()) -> None:
    """Fix the stock at the start of `day`, so that later readers skip all earlier movements.

    Run it once the watermark has passed `day`. Products below the threshold without an alert get
    one. A repeated run changes nothing; after a crash it starts over.
    """
    opening, since = _opening_stock(store)
    if since is not None and since >= day:
        return
    number = int(day.strftime("%Y%m%d"))
    moved = movements_now(store, since, day)
    closing = inventory.apply_stock_movements(opening, moved, rules.initial, day)
    raised = inventory.low_stock_alerts(opening, moved, rules.threshold, rules.initial)
    earlier = store.changes("low_stock_alerts").filter(F.col("batch_id") < number).drop("run", "batch_id")
    seeded = inventory.seed_alerts(closing, earlier.unionByName(raised), rules.threshold, day)
    store.put_batch("low_stock_alerts", raised.unionByName(seeded), number)
    # Last, as it marks the day as closed.
    store.put_batch("inventory_openings", closing, number)


def stock_now(store: TableStore, rules: StockRules = StockRules(), as_of=None) -> DataFrame:
    """Stock levels: the last closed (or first) stock less all movements since."""
    opening, since = _opening_stock(store)
    return inventory.apply_stock_movements(opening, movements_now(store, since), rules.initial, as_of)


def alerts_now(store: TableStore, rules: StockRules = StockRules()) -> DataFrame:
    """Low-stock alerts raised so far, one per product and crossing."""
    opening, since = _opening_stock(store)
    open_alerts = inventory.low_stock_alerts(
        opening, movements_now(store, since), rules.threshold, rules.initial)
    if since is None:
        return open_alerts
    closed = store.changes("low_stock_alerts").filter(
        F.col("batch_id") <= int(since.strftime("%Y%m%d"))).drop("run", "batch_id")
    return closed.unionByName(open_alerts)


def analyze_sessions(
    raw: DataFrame, store: TableStore, checkpoints: str, *, rules: SessionRules = SessionRules(),
    fixed_windows: bool = False, debug: bool = False, **pace,
) -> list:
    """Sessions by inactivity gap (append mode), or by fixed window (update mode, upserted)."""
    cart = parse_cart_events(raw).events
    if fixed_windows:
        found, mode = sessions.windowed_sessions(
            cart, f"{rules.gap_seconds} seconds", rules.watermark), "update"
    else:
        found, mode = sessions.streamed_sessions(cart, rules.gap_seconds, rules.watermark), "append"
    queries = [sinks.start(
        found, sinks.into_table(store, "session_metrics"), "session_metrics", checkpoints,
        mode=mode, **pace,
    )]
    if debug:
        queries.append(sinks.to_console(cart, "sessions_console"))
    return queries


def sessions_now(store: TableStore) -> DataFrame:
    """One row per session id; user and start time stay as first written."""
    return store.current("session_metrics", **SESSION_UPSERT)


def compact_sessions(store: TableStore) -> None:
    """Fold the session rows written so far into the base that `sessions_now` starts from."""
    store.compact("session_metrics", **SESSION_UPSERT)


def abandonment_now(store: TableStore, rules: SessionRules = SessionRules()) -> DataFrame:
    """Abandoned carts, one per session id."""
    return sessions.cart_abandonment(sessions_now(store), rules.abandoned_after_seconds)


def watch_views(
    raw: DataFrame, store: TableStore, checkpoints: str, *, window: str = "1 hour",
    watermark: str = "5 minutes", **pace,
) -> list:
    """Product views and viewing time per (window, category)."""
    views = metrics.view_metrics(parse_product_views(raw).events, window, watermark)
    return [sinks.start(
        views, sinks.into_table(store, "view_metrics"), "view_metrics", checkpoints,
        **pace,
    )]


def archive_raw(raw: DataFrame, folder: str, checkpoints: str, name: str = "raw_events", **pace):
    """Copy the unparsed lines into Parquet folders by event day."""
    day = F.to_date(F.try_to_timestamp(F.get_json_object("value", "$.timestamp")))
    return sinks.into_files(
        raw.select("value", day.alias("day")), "parquet", folder, name, checkpoints, by=("day",), **pace
    )


def keep_dead_letters(dead: DataFrame, folder: str, checkpoints: str, **pace):
    """Store unreadable lines with their reason, as JSON."""
    return sinks.into_files(dead, "json", folder, "dead_letters", checkpoints, **pace)


def carts_without_purchase(
    cart: DataFrame, purchases: DataFrame, horizon_seconds: int = 1800,
    watermark: str = "5 minutes",
) -> DataFrame:
    """Cart additions that no purchase by the same user follows within the horizon.

    A stream cannot anti-join a stream; an outer interval join gives unmatched additions once the
    watermark has passed their horizon. Purchases are first reduced to the first and last of each
    (user, horizon-long window), which loses nothing: no window is long enough to have purchases
    on both sides of the horizon but none in it. So an addition meets at most three rows, however
    busy its user is.
    """
    added = cart.filter("action = 'add'").withWatermark("timestamp", watermark)
    slots = purchases.withWatermark("timestamp", watermark).groupBy(
        F.col("user_id").alias("buyer"), F.window("timestamp", f"{horizon_seconds} seconds"),
    ).agg(
        F.min("timestamp").alias("first_bought"), F.max("timestamp").alias("last_bought"),
    ).select("buyer", "first_bought", "last_bought", F.window_time("window").alias("bought_by"))
    since, horizon = F.col("timestamp"), F.expr(f"INTERVAL {horizon_seconds} SECONDS")
    return added.join(
        slots,
        (F.col("user_id") == F.col("buyer"))
        & (F.col("bought_by") >= since) & (F.col("bought_by") <= since + horizon + horizon)
        & (F.col("last_bought") >= since) & (F.col("first_bought") <= since + horizon),
        "leftOuter",
    ).filter("buyer IS NULL").select(*cart.columns)
