"""Streams against the batch operators on the same rows, replays, restarts and late rows."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.operators import anomalies, inventory, metrics, sessions
from tillstream.plans import batch as batch_jobs
from tillstream.settings import AnomalyRules, SalesWindows
from tillstream.sources import events
from tillstream.sources.given import GivenTables
from tillstream.sources.tables import TableStore, conform
from tillstream.streaming import jobs, sinks

T0 = datetime(2024, 1, 1, 12)
FAR = "2031-01-01T00:00:00"


def tx_line(i, seconds, amount=10.0, products=(("p", 1),), user="u", country="UK", category="X", at=None):
    return json.dumps({
        "transaction_id": i, "user_id": user,
        "timestamp": at or (T0 + timedelta(seconds=seconds)).isoformat(),
        "products": [{"product_id": p, "quantity": q, "price": 1.0, "category": "ignored"} for p, q in products],
        "total_amount": amount, "payment_method": "paypal", "country": country, "category": category,
    })


def cart_line(i, session, seconds, action="add", user="u", at=None):
    return json.dumps({
        "event_id": i, "user_id": user, "product_id": "p", "session_id": session, "action": action,
        "quantity": 1, "timestamp": at or (T0 + timedelta(seconds=seconds)).isoformat(),
    })


def drop_file(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def finish(queries):
    for query in queries:
        query.awaitTermination()


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


def test_dead_letters_keep_every_line(spark):
    lines = [
        tx_line("ok", 0), "{bad", "", tx_line("late", 0, at="nope"), tx_line("big", 0, amount=1e12),
        tx_line(None, 0), tx_line("general", 0, category=None),
    ]
    raw = spark.createDataFrame([(line,) for line in lines], "value string")
    parsed = events.parse_transactions(raw)
    assert rows(parsed.events, "transaction_id", "category") == [("general", "General"), ("ok", "X")]
    assert sorted(r.reason for r in parsed.dead_letters.collect()) == [
        "amount out of range", "bad timestamp", "unreadable", "unreadable", "unreadable"]


def test_transaction_job_matches_batch(spark, tmp_path):
    source, store = tmp_path / "in", TableStore(spark, str(tmp_path / "out"))
    drop_file(source, "1.json", [tx_line(str(i), i * 5, amount=float(i)) for i in range(40)])
    drop_file(source, "2.json", [tx_line("high", 210, amount=6000.5), tx_line("many", 215, products=(("a", 11), ("b", 2)))])
    drop_file(source, "3.json", ["{bad"] + [tx_line(f"r{i}", 230 + i, user="fast") for i in range(7)])
    finish(jobs.monitor_transactions(
        events.file_stream(spark, str(source), 1), store, str(tmp_path / "cp"), available_now=True))
    # A far event closes all windows; the run resumes from the checkpoints.
    drop_file(source, "4.json", [tx_line("far", 0, at=FAR)])
    finish(jobs.monitor_transactions(
        events.file_stream(spark, str(source), 1), store, str(tmp_path / "cp"), available_now=True))

    batch = events.parse_transactions(events.file_events(spark, str(source))).events
    assert store.read("transactions").count() == 50
    kinds = ["transaction_id", "anomaly_type", "product_id", "amount", "anomaly_score"]
    assert rows(store.read("transaction_anomalies"), *kinds) == rows(
        conform(anomalies.detect_anomalies(batch), "transaction_anomalies"), *kinds)
    closed = batch.filter("transaction_id <> 'far'")
    wanted = ["window_start", "category", "country", "total_amount", "transaction_count", "avg_transaction_value"]
    assert rows(store.read("sales_metrics"), *wanted) == rows(
        conform(metrics.sales_metrics(closed), "sales_metrics"), *wanted)
    assert rows(store.read("rapid_anomalies"), "transaction_id", "user_id", "amount") == rows(
        conform(anomalies.rapid_transactions(closed), "rapid_anomalies"), "transaction_id", "user_id", "amount")


def test_replayed_batch_changes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    writer = sinks.fan_out({
        "transactions": events.stored_transactions,
        "transaction_anomalies": lambda b: anomalies.detect_anomalies(b, AnomalyRules()),
    }, store)
    raw = spark.createDataFrame([(tx_line("a", 0, 9000.0),), (tx_line("b", 1),)], "value string")
    batch = events.parse_transactions(raw).events
    for _ in range(2):
        writer(batch, 7)
    assert store.read("transactions").count() == 2
    assert store.read("transaction_anomalies").count() == 1
    writer(batch.limit(0), 8)
    assert store.read("transactions").count() == 2


def test_new_checkpoint_adds_to_what_is_stored(spark, tmp_path):
    """A changed query needs a new checkpoint; its batch 0 must not replace the first one's."""
    store = TableStore(spark, str(tmp_path / "out"))
    for n, names in enumerate((["1", "2", "3"], ["4", "5"], ["6"])):
        drop_file(tmp_path / f"in{n}", "1.json", [tx_line(i, 0) for i in names])
    for source, checkpoint in (("in0", "cp1"), ("in1", "cp2"), ("in2", "cp3")):
        finish(jobs.monitor_transactions(
            events.file_stream(spark, str(tmp_path / source)), store, str(tmp_path / checkpoint), available_now=True))
    assert rows(store.read("transactions"), "transaction_id") == [(str(i),) for i in range(1, 7)]


def test_later_run_wins_an_upsert(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    schema = "session_id string, user_id string, start_time timestamp, page_views bigint, end_time timestamp"
    for run, batch, views in (("000000000000001-x", 5, 1), ("000000000000002-a", 0, 2)):
        store.put_batch("session_metrics", spark.createDataFrame([("s", "u", T0, views, T0)], schema), batch, run)
    assert [r.page_views for r in store.current("session_metrics", ["session_id"]).collect()] == [2]
    assert [r.page_views for r in jobs.sessions_now(store).collect()] == [2]


def test_repeated_transaction_is_stored_once(spark, tmp_path):
    source, store = tmp_path / "in", TableStore(spark, str(tmp_path / "out"))
    drop_file(source, "1.json", [tx_line("a", 0), tx_line("a", 1), tx_line("b", 2)])
    drop_file(source, "2.json", [tx_line("b", 3), tx_line("far", 0, at=FAR)])
    finish(jobs.monitor_transactions(
        events.file_stream(spark, str(source), 1), store, str(tmp_path / "cp"), once_within="1 hour", available_now=True))
    assert rows(store.read("transactions"), "transaction_id") == [("a",), ("b",), ("far",)]
    assert store.read("sales_metrics").agg(F.max("transaction_count")).first()[0] == 2


def test_late_rows_are_dropped_once_the_watermark_passed(spark, tmp_path):
    source, store = tmp_path / "in", TableStore(spark, str(tmp_path / "out"))
    windows = SalesWindows(length="1 minute", slide=None, watermark="1 minute")
    # The late filter lags one batch behind the watermark, hence the file in between.
    for n, line in enumerate([
        tx_line("a", 0), tx_line("b", 3600), tx_line("c", 3700), tx_line("late", 1), tx_line("far", 0, at=FAR),
    ]):
        drop_file(source, f"{n}.json", [line])
        finish(jobs.monitor_transactions(
            events.file_stream(spark, str(source), 1), store, str(tmp_path / "cp"), windows=windows,
            available_now=True))
    assert store.read("sales_metrics").agg(F.sum("transaction_count")).first()[0] == 3
    assert store.read("transactions").count() == 5


def test_inventory_job_does_not_count_running_totals_twice(spark, tmp_path):
    source, store = tmp_path / "in", TableStore(spark, str(tmp_path / "out"))
    store.overwrite("inventory_status", spark.createDataFrame(
        [("p", "Pen", "C", 80, 0, 80, T0)],
        "product_id string, product_name string, category string, current_stock bigint, "
        "reserved_stock bigint, available_stock bigint, last_updated timestamp"))
    for n, line in enumerate([
        tx_line("a", 1, products=(("p", 2),)), tx_line("b", 2, products=(("p", 3),)),
        tx_line("c", 70, products=(("p", 12), ("new", 4))),
    ]):
        drop_file(source, f"{n}.json", [line])
        finish(jobs.track_inventory(
            events.file_stream(spark, str(source), 1), store, str(tmp_path / "cp"), available_now=True))
    # Update mode reported 2, then 5 for the first minute.
    assert store.changes("stock_movements").filter("product_id = 'p'").agg(F.sum("sold_quantity")).first()[0] == 19
    levels = {r.product_id: r.available_stock for r in jobs.stock_now(store).collect()}
    assert levels == {"p": 80 - 17, "new": 76}
    raised = jobs.alerts_now(store).collect()
    assert [(r.product_id, r.current_stock) for r in raised] == [("p", 63)]
    tables = TableStore(spark, str(tmp_path / "tables"))
    batch_jobs.run_snapshots(store, tables, T0)
    assert rows(tables.read("inventory_status"), "product_id", "available_stock") == [("new", 76), ("p", 63)]
    assert tables.read("low_stock_alerts").count() == 1
    assert tables.read("session_metrics").count() == tables.read("transaction_anomalies").count() == 0


def test_closing_the_stock_keeps_levels_and_alerts(spark, tmp_path):
    from datetime import date

    def filled(root):
        store = TableStore(spark, str(tmp_path / root))
        store.overwrite("inventory_status", spark.createDataFrame(
            [(p, p, "C", n, 0, n, T0) for p, n in (("a", 80), ("b", 90), ("c", 70))],
            "product_id string, product_name string, category string, current_stock bigint, "
            "reserved_stock bigint, available_stock bigint, last_updated timestamp"))
        day = timedelta(days=1)
        moves = [(T0, "a", 10), (T0, "new", 30), (T0 + day, "a", 10), (T0 + day, "b", 20), (T0 + 2 * day, "b", 10),
                 (T0 + 2 * day, "a", 5), (T0 + 2 * day, "new", 60)]
        store.put_batch("stock_movements", spark.createDataFrame(
            [(t, p, q, 1) for t, p, q in moves],
            "window_start timestamp, product_id string, sold_quantity bigint, transaction_count bigint"), 0)
        return store

    whole, closed = filled("whole"), filled("closed")
    for day in (date(2024, 1, 2), date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 2)):
        jobs.close_stock(closed, day)
    levels = ["product_id", "product_name", "category", "current_stock", "available_stock"]
    assert rows(jobs.stock_now(closed), *levels) == rows(jobs.stock_now(whole), *levels)
    alerts = ["product_id", "current_stock", "alert_time"]
    assert rows(jobs.alerts_now(whole), *alerts) == sorted([
        ("a", 60, T0 + timedelta(days=1)), ("b", 60, T0 + timedelta(days=2)), ("new", 0, T0 + timedelta(days=2))], key=repr)
    # The new product is below the threshold when the first day is closed, and is reported then.
    assert rows(jobs.alerts_now(closed), *alerts) == sorted([
        ("a", 60, T0 + timedelta(days=1)), ("b", 60, T0 + timedelta(days=2)), ("new", 50, datetime(2024, 1, 2))], key=repr)
    assert closed.newest_batch("inventory_openings") == 20240103
    plan = jobs.stock_now(closed)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(window_start" in plan


@pytest.mark.parametrize("fixed", [False, True])
def test_session_job(spark, tmp_path, fixed):
    source, store = tmp_path / "in", TableStore(spark, str(tmp_path / "out"))
    drop_file(source, "1.json", [cart_line("1", "s", 0), cart_line("2", "s", 61), cart_line("3", "t", 5, "remove")])
    drop_file(source, "2.json", [cart_line("4", "s", 100, "remove"), cart_line("5", "t", 600)])
    finish(jobs.analyze_sessions(
        events.file_stream(spark, str(source), 1), store, str(tmp_path / "cp"), fixed_windows=fixed, available_now=True))
    drop_file(source, "3.json", [cart_line("6", "far", 0, at=FAR)])
    finish(jobs.analyze_sessions(
        events.file_stream(spark, str(source), 1), store, str(tmp_path / "cp"), fixed_windows=fixed, available_now=True))
    found = {r.session_id: (r.start_time, r.duration_seconds, r.page_views, r.cart_adds, r.cart_removes)
             for r in jobs.sessions_now(store).filter("session_id <> 'far'").collect()}
    assert found == {
        "s": (T0, 100, 3, 2, 1), "t": (T0 + timedelta(seconds=5), 0, 1, 1, 0)}
    assert [(r.session_id, r.time_in_cart_minutes) for r in jobs.abandonment_now(store).collect()] == [("s", 1)]
    if not fixed:
        batch = events.parse_cart_events(events.file_events(spark, str(source))).events.filter("session_id <> 'far'")
        columns = ["session_id", "start_time", "end_time", "page_views"]
        assert rows(store.read("session_metrics"), *columns) == rows(sessions.gap_sessions(batch), *columns)


def test_view_job_and_dead_letters(spark, tmp_path):
    source, store = tmp_path / "in", TableStore(spark, str(tmp_path / "out"))
    def view(i, seconds, at=None):
        return json.dumps({"event_id": i, "user_id": "u", "product_id": "p", "session_id": "s", "category": "X",
                           "duration_seconds": 30, "timestamp": at or (T0 + timedelta(seconds=seconds)).isoformat()})
    drop_file(source, "1.json", [view("1", 0), view("2", 10), "{bad"])
    drop_file(source, "2.json", [view("far", 0, FAR)])
    raw = events.file_stream(spark, str(source), 1)
    finish(jobs.watch_views(raw, store, str(tmp_path / "cp"), available_now=True))
    finish([jobs.keep_dead_letters(
        events.parse_product_views(raw).dead_letters, str(tmp_path / "dead"), str(tmp_path / "cp"), available_now=True)])
    finish([jobs.archive_raw(raw, str(tmp_path / "raw"), str(tmp_path / "cp"), available_now=True)])
    archived = spark.read.schema("value string, day date").parquet(str(tmp_path / "raw"))
    assert archived.count() == 4 and archived.filter("day = '2024-01-01'").count() == 2
    assert [(r.views, r.total_duration, r.avg_duration) for r in store.read("view_metrics").collect()] == [(2, 60, 30.0)]
    assert spark.read.schema("value string, reason string").json(str(tmp_path / "dead")).first()[:] == ("{bad", "unreadable")


def test_carts_without_purchase_stream(spark, tmp_path):
    carts, buys = tmp_path / "c", tmp_path / "t"
    adds = {"before": 100, "edge": 60 - 1800, "early": 59 - 1800, "same": 60, "after": 61, "other": 0}
    drop_file(carts, "1.json", [
        cart_line(i, "s", at, user="nobody" if i == "other" else "buyer") for i, at in adds.items()])
    drop_file(buys, "1.json", [tx_line("a", 60, user="buyer"), tx_line("b", -9000, user="buyer")])
    # Both watermarks must pass, and unmatched rows come out one batch later.
    for n in (2, 3, 4):
        drop_file(carts, f"{n}.json", [cart_line(f"x{n}", "far", 0, at=FAR)])
        drop_file(buys, f"{n}.json", [tx_line(f"x{n}", 0, at=FAR)])
    left = jobs.carts_without_purchase(
        events.parse_cart_events(events.file_stream(spark, str(carts), 1)).events,
        events.parse_transactions(events.file_stream(spark, str(buys), 1)).events)
    query = (left.writeStream.format("memory").queryName("left_carts").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r.event_id for r in spark.table("left_carts").collect()) == ["after", "before", "early", "other"]


def test_repeated_alerts_pass_once(spark, tmp_path):
    from tillstream.operators.alerts import suppress_repeats
    source = tmp_path / "in"
    for n, key in enumerate(["k", "k", "other"]):
        drop_file(source, f"{n}.json", [json.dumps({"alert_key": key, "at": (T0 + timedelta(minutes=n)).isoformat()})])
    stream = spark.readStream.schema("alert_key string, at timestamp").option("maxFilesPerTrigger", 1).json(str(source))
    query = (suppress_repeats(stream, "at").writeStream.format("memory").queryName("passed").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r.alert_key for r in spark.table("passed").collect()) == ["k", "other"]


def test_given_orders_through_the_wire_format(spark, tmp_path):
    """Nested JSON of the given orders gives the same anomalies and movements as the flat tables."""
    tables = GivenTables(spark, "/root/testdata/sf0.001")
    lines = tables.order_lines().groupBy("transaction_id").agg(
        F.collect_list(F.struct("product_id", "quantity", "price")).alias("products"))
    wire = tables.transactions().join(lines, "transaction_id", "left").withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    wire.select(F.to_json(F.struct("*")).alias("value")).write.text(str(tmp_path / "in"))
    parsed = events.parse_transactions(events.file_events(spark, str(tmp_path / "in"))).events
    rules = AnomalyRules(high_value=450_000.0, quantity=45)
    flat = anomalies.detect_anomalies(tables.transactions(), rules, tables.order_lines())
    assert rows(anomalies.detect_anomalies(parsed, rules)) == rows(flat)
    assert rows(inventory.stock_movements(events.product_lines(parsed), "1 day")) == rows(
        inventory.stock_movements(tables.order_lines(), "1 day"))
