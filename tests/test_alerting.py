"""The alerting job with its ledger, and the collected progress of streams."""

from datetime import timedelta

import pytest

from tests.test_streaming import T0, drop_file, finish, rows, tx_line
from tillstream.operators import metrics
from tillstream.plans import alerting
from tillstream.sources import events
from tillstream.sources.tables import TableStore
from tillstream.streaming import jobs, progress


@pytest.fixture
def tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    put_stock(store, {"a": 3, "b": 8, "c": 50, "d": 0})
    store.overwrite("transaction_anomalies", spark.createDataFrame(
        [("t1", "u", "p", 0.97, T0), ("t1", "u", "q", 0.85, T0), ("t2", "u", "p", 0.5, T0)],
        "transaction_id string, user_id string, product_id string, anomaly_score double, detected_at timestamp"))
    store.overwrite("cart_abandonment", spark.createDataFrame(
        [(f"s{i}", "u", 1, 1500 if i == 0 else 10, T0 - timedelta(minutes=i)) for i in range(25)],
        "session_id string, user_id string, products_in_cart bigint, cart_value int, abandonment_time timestamp"))
    return store


def put_stock(store, left):
    store.overwrite("inventory_status", store.spark.createDataFrame(
        [(k, k.upper(), "C", n, 0, n, T0) for k, n in left.items()],
        "product_id string, product_name string, category string, current_stock bigint, reserved_stock bigint, "
        "available_stock bigint, last_updated timestamp"))


def test_rounds_send_each_alert_once_an_hour(spark, tmp_path, tables):
    ledger, sent = TableStore(spark, str(tmp_path / "ledger")), []

    def run(minutes, since=0):
        at = T0 + timedelta(minutes=minutes)
        before = len(sent)
        stored = alerting.run_round(tables, ledger, T0 - timedelta(minutes=since), at, lambda df: sent.extend(df.collect()))
        return sorted(r.alert_key for r in stored.collect()), len(sent) - before

    first = ["abandonment_spike", "anomaly_t1", "cart_s0", "low_stock_a_3", "low_stock_b_8"]
    assert run(1, since=5) == (first, 5)
    assert run(1, since=5) == (first, 0)  # the same round again
    put_stock(tables, {"a": 2, "b": 8})
    assert run(10, since=-5) == (["low_stock_a_2"], 1)  # another level is another alert
    assert run(10, since=-5) == (["low_stock_a_2"], 0)
    assert run(75, since=-60) == (["low_stock_a_2", "low_stock_b_8"], 2)  # after an hour again
    assert len(sent) == ledger.changes("sent_alerts").count() == 8


def test_a_round_that_broke_off_is_taken_up(spark, tmp_path, tables):
    ledger, at = TableStore(spark, str(tmp_path / "ledger")), T0 + timedelta(minutes=1)

    def fail(_):
        raise RuntimeError("mail server away")

    with pytest.raises(RuntimeError):
        alerting.run_round(tables, ledger, T0, at, fail)
    sent = []
    alerting.run_round(tables, ledger, T0, at, lambda df: sent.extend(df.collect()))
    assert len(sent) == ledger.changes("sent_alerts").count() > 3


def test_empty_tables_raise_nothing(spark, tmp_path):
    empty, ledger = TableStore(spark, str(tmp_path / "none")), TableStore(spark, str(tmp_path / "ledger"))
    assert alerting.run_round(empty, ledger, T0, T0).count() == 0
    assert alerting.run_round(empty, ledger, T0, T0 + timedelta(minutes=1)).count() == 0


def test_progress_is_collected(spark, tmp_path):
    source, store = tmp_path / "in", TableStore(spark, str(tmp_path / "out"))
    collector = progress.collect_progress(spark, store)
    try:
        for n in range(2):
            drop_file(source, f"{n}.json", [tx_line(f"{n}-{i}", i) for i in range(3 + n)])
            finish(jobs.track_inventory(events.file_stream(spark, str(source), 1), store, str(tmp_path / "cp"), available_now=True))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(50):  # reports arrive on a thread of their own
            if progress.reports(store).count() >= 2:
                break
    finally:
        spark.streams.removeListener(collector)
    found = progress.reports(store).where("query = 'stock_movements'")
    assert [r.input_rows for r in found.orderBy("batch").collect()] == [3, 4]  # batches without rows add nothing
    first, second = progress.query_rates(found).orderBy("timestamp").collect()
    assert (first.event_count, first.rate, second.event_count) == (3, 0.0, 4) and second.rate > 0
    assert progress.topic_offsets(found).count() == 0  # a folder has no topics
    assert metrics.topic_rates(progress.topic_offsets(found)).count() == 0


def test_sketches_of_any_span_unite(spark):
    """Overlapping spans, one product in many windows, and an error within what is stated."""
    from pyspark.sql import functions as F
    from tillstream.operators import sessions

    cart = spark.range(40_000).selectExpr(
        "CAST(id * 7919 % 9000 AS STRING) AS product_id", "timestamp_seconds(1704067200 + id * 30) AS timestamp")
    days = sessions.product_sketches(cart, "1 day")
    united = sessions.distinct_products(days).first().unique_products
    assert abs(united - 9000) <= 4 * sessions.SKETCH_ERROR * 9000
    twice = sessions.distinct_products(days.union(days)).first().unique_products
    assert twice == united
    by_day = {r.d: r.unique_products for r in sessions.distinct_products(days, F.to_date("window_start").alias("d")).collect()}
    exact = {r.d: r.n for r in cart.groupBy(F.to_date("timestamp").alias("d")).agg(F.count_distinct("product_id").alias("n")).collect()}
    assert by_day.keys() == exact.keys() and all(abs(by_day[d] - n) <= 4 * sessions.SKETCH_ERROR * n + 1 for d, n in exact.items())
    assert sessions.distinct_products(days.limit(0), F.to_date("window_start").alias("d")).count() == 0


def test_quality_of_what_is_written(spark, tmp_path):
    from tillstream.operators import quality

    rules = {"small": "x < 3", "known": "y IS NOT NULL"}
    df = spark.createDataFrame([(1, "a"), (2, None), (5, "b"), (None, None)], "x int, y string")
    watched, report = quality.checked_while_written(df, rules)
    watched.write.parquet(str(tmp_path / "t"))
    assert rows(report()) == rows(quality.quality_report(df, rules)) and spark.read.parquet(str(tmp_path / "t")).count() == 4
    watched, report = quality.checked_while_written(df.limit(0), rules)
    watched.write.parquet(str(tmp_path / "empty"))
    assert rows(report()) == [("known", 0, 0, 0.0), ("small", 0, 0, 0.0)]
