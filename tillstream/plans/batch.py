"""Batch jobs: operational tables -> warehouse -> analysis tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from tillstream.operators import categories, rfm, sessions, trends, warehouse
from tillstream.settings import RfmRules, SalesWindows, SessionRules, StockRules
from tillstream.sources.tables import TableStore
from tillstream.streaming import jobs


def run_snapshots(
    changes: TableStore, target: TableStore, as_of, *, stock: StockRules = StockRules(),
    visits: SessionRules = SessionRules(),
) -> None:
    """Current operational tables from what the streaming jobs have written so far.

    Update-mode logs hold several rows per key, so reports and the ETL read these tables instead.
    """
    if changes.root == target.root:
        raise ValueError("snapshots need a root folder of their own")
    target.overwrite("sales_metrics", changes.read("sales_metrics"))
    target.overwrite("transactions", changes.read("transactions"))
    target.overwrite("transaction_anomalies", jobs.anomalies_now(changes))
    target.overwrite("inventory_status", jobs.stock_now(changes, stock, as_of))
    target.overwrite("low_stock_alerts", jobs.alerts_now(changes, stock))
    target.overwrite("session_metrics", jobs.sessions_now(changes))
    target.overwrite("cart_abandonment", sessions.cart_abandonment(
        target.read("session_metrics"), visits.abandoned_after_seconds
    ))


def run_etl(
    source: TableStore, target: TableStore, as_of, *, non_overlapping: bool = True, since=None,
    windows: SalesWindows = SalesWindows(),
) -> None:
    """Sales and session facts, and a time dimension from a year back to a month ahead.

    With `since` (a day) only rows from that day on are read, and only their days are replaced.
    """
    sales, visits = source.read("sales_metrics"), source.read("session_metrics")
    if since is not None:
        day_start = F.lit(since).cast("timestamp")
        sales = sales.filter(F.col("window_start") >= day_start)
        visits = visits.filter(F.col("start_time") >= day_start)
    only_days = since is not None
    target.overwrite("fact_sales", warehouse.fact_sales(sales, as_of, non_overlapping, windows), only_days)
    target.overwrite("fact_sessions", warehouse.fact_sessions(visits, as_of), only_days)
    day = as_of.date()
    target.overwrite("dim_time", warehouse.dim_time(
        source.spark, day - timedelta(days=365), day + timedelta(days=30)
    ))


def run_etl_of_changes(
    source: TableStore, target: TableStore, as_of, *, non_overlapping: bool = True, windows: SalesWindows = SalesWindows(),
) -> dict[str, list]:
    """Facts from change logs: only the days that batches not consumed so far have rows for are rewritten.

    A ledger in `target` has the last batch of each run and table. It is written after the facts, so a crash in
    between repeats the same days. A session counts for the day of its current start, whichever batch it came in.
    Returns the days rewritten, by table.
    """
    ledger = target.newest_batch("etl_consumed")
    consumed = {} if ledger is None else {
        (r.table, r.batch_run): r.last_batch
        for r in target.changes("etl_consumed").filter(F.col("batch_id") == ledger).collect()}
    done, now = {}, dict(consumed)
    plans = {
        "sales_metrics": ("fact_sales", "window_start", source.read("sales_metrics"),
                          lambda rows: warehouse.fact_sales(rows, as_of, non_overlapping, windows)),
        "session_metrics": ("fact_sessions", "start_time", jobs.sessions_now(source),
                            lambda rows: warehouse.fact_sessions(rows, as_of)),
    }
    for name, (fact, at, current, build) in plans.items():
        fresh = source.changes(name)
        for (table, run), last in consumed.items():
            if table == name:
                fresh = fresh.filter(~((F.col("run") == run) & (F.col("batch_id") <= last)))
        now.update({(name, r.run): r.last for r in fresh.groupBy("run").agg(F.max("batch_id").alias("last")).collect()})
        rows = current
        day = F.to_date(at)
        touched = rows.join(fresh.select("session_id").distinct(), "session_id", "left_semi") if name == "session_metrics" else fresh
        # As many as the calendar has days.
        days = sorted(r.day for r in touched.select(day.alias("day")).distinct().collect() if r.day is not None)
        if days:
            # The time range reaches the scan, the days are exact.
            span = F.col(at).between(F.lit(days[0]).cast("timestamp"), F.lit(days[-1] + timedelta(days=1)).cast("timestamp"))
            target.overwrite(fact, build(rows.filter(span & day.isin(days))), only_days=True)
        done[fact] = days
    if now != consumed:
        listed = source.spark.createDataFrame([(*k, last) for k, last in sorted(now.items())], "table string, batch_run string, last_batch bigint")
        target.put_batch("etl_consumed", listed, 0 if ledger is None else ledger + 1)
    return done


def run_rfm(source: TableStore, target: TableStore, as_of, rules: RfmRules = RfmRules()) -> DataFrame:
    """Score and store customers; returns the segment summary."""
    target.overwrite("customer_segments", rfm.rfm_scores(source.read("transactions"), as_of, rules))
    return rfm.segment_summary(target.read("customer_segments"))


def run_category_performance(warehouse_store: TableStore, as_of) -> None:
    fact = warehouse_store.read("fact_sales")
    warehouse_store.overwrite("product_performance", categories.category_performance(fact, as_of))


def run_trends(warehouse_store: TableStore, as_of, iso_year: bool = False) -> None:
    fact = warehouse_store.read("fact_sales")
    warehouse_store.overwrite("sales_trends", trends.all_trends(fact, as_of, iso_year=iso_year))


def run_all(
    source: TableStore, target: TableStore, as_of, rules: RfmRules = RfmRules(),
    windows: SalesWindows = SalesWindows(),
) -> None:
    run_etl(source, target, as_of, windows=windows)
    run_rfm(source, target, as_of, rules)
    run_category_performance(target, as_of)
    run_trends(target, as_of)
