"""Hand-made edge cases of the batch operators."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tillstream import schemas
from tillstream.functions.labels import segment_name
from tillstream.operators import (
    alerts, anomalies, categories, inventory, metrics, quality, ranking, rfm, sessions, trends,
    warehouse,
)
from tillstream.settings import SalesWindows
from tillstream.sources import events as event_source
from tillstream.sources.events import product_lines

T0 = datetime(2024, 1, 1)
SLOW = dict(deadline=None, suppress_health_check=list(HealthCheck))


def transactions(spark, rows):
    """rows: (id, user, seconds, amount, [(product, quantity)], category)"""
    data = [(
        i, u, T0 + timedelta(seconds=s), Decimal(a),
        None if p is None else [(pid, q, 1.0) for pid, q in p], "card", "UK", c,
    ) for i, u, s, a, p, c in rows]
    return spark.createDataFrame(data, (
        "transaction_id string, user_id string, timestamp timestamp, total_amount decimal(12,2), "
        "products array<struct<product_id:string,quantity:int,price:double>>, "
        "payment_method string, country string, category string"
    ))


def test_anomaly_thresholds_are_strict(spark):
    tx = transactions(spark, [
        ("a", "u", 0, "5000.00", [("p", 10)], "X"),
        ("b", "u", 1, "60000.00", [("p", 11), ("q", 24), ("r", 1)], "X"),
        ("c", "u", 2, "1.00", None, "X"), ("d", "u", 3, "1.00", [], "X"),
    ])
    found = {
        (r.transaction_id, r.anomaly_type, r.product_id): (r.anomaly_score, r.amount, r.description)
        for r in anomalies.detect_anomalies(tx).collect()
    }
    assert found == {
        ("b", "high_value", None): (12.0, Decimal("60000.00"), "High value transaction: $60000.00"),
        ("b", "unusual_quantity", "p"): (1.1, Decimal("60000.00"), "Unusual quantity: 11 items"),
        ("b", "unusual_quantity", "q"): (2.4, Decimal("60000.00"), "Unusual quantity: 24 items"),
    }


def test_nested_and_flat_lines_give_the_same_anomalies(spark):
    tx = transactions(spark, [
        (str(i), "u", i, f"{i * 997}.25", None if i % 5 == 0 else [("p", i), ("q", 14 - i)], "X") for i in range(15)])
    nested, flat = anomalies.detect_anomalies(tx), anomalies.detect_anomalies(tx, lines=product_lines(tx))
    assert nested.dtypes == flat.dtypes
    assert sorted(map(tuple, nested.collect()), key=repr) == sorted(map(tuple, flat.collect()), key=repr)
    assert nested._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_rapid_transactions_need_more_than_the_limit(spark):
    tx = transactions(spark, [(str(i), "fast", i, "1.00", None, "X") for i in range(6)]
                      + [(f"s{i}", "slow", i, "1.00", None, "X") for i in range(5)])
    row = anomalies.rapid_transactions(tx).collect()
    assert [(r.user_id, r.anomaly_score, r.amount) for r in row] == [("fast", 1.2, Decimal("6.00"))]


def test_sliding_windows_count_every_sale_twice(spark):
    tx = transactions(spark, [(str(i), "u", i * 7, "2.00", None, "X") for i in range(50)])
    both = metrics.sales_metrics(tx)
    assert both.agg(F.sum("transaction_count")).first()[0] == 100
    kept = warehouse.fact_sales(both, T0)
    assert kept.agg(F.sum("transaction_count"), F.sum("total_amount")).first()[:] == (50, Decimal("100.00"))
    assert warehouse.fact_sales(both, T0, non_overlapping=False).count() == both.count()


def test_many_windows_equal_one_pass(spark, monkeypatch):
    tx = transactions(spark, [(str(i), "u", i * i % 7000, f"{i}.10", None, "XY"[i % 2]) for i in range(120)])
    summed = metrics.sales_metrics(tx, "1 hour", "5 minutes")
    monkeypatch.setattr(metrics, "_MANY_WINDOWS", 99)
    direct = metrics.sales_metrics(tx, "1 hour", "5 minutes")
    assert summed.schema == direct.schema
    assert sorted(map(tuple, summed.collect())) == sorted(map(tuple, direct.collect()))


def test_offsets_from_progress(spark):
    reports = spark.createDataFrame([
        ('{"timestamp":"2024-01-01T00:00:00.000Z","sources":[{"endOffset":{"transactions":{"0":5,"1":7}}},'
         '{"endOffset":{"cart_events":{"0":2}}}]}',),
        ('{"timestamp":"2024-01-01T00:00:10.000Z","sources":[{"endOffset":{"transactions":{"0":9,"1":13}}}]}',),
        ('{"timestamp":"2024-01-01T00:00:10.000Z","sources":[{"endOffset":"{\\"logOffset\\":3}"}]}',),
    ], "value string")
    offsets = metrics.offsets_from_progress(reports)
    assert offsets.count() == 5
    rates = metrics.topic_rates(offsets).filter("topic = 'transactions'").orderBy("timestamp")
    assert [(r.event_count, r.rate) for r in rates.collect()] == [(0, 0.0), (10, 1.0)]


def test_averages_round_half_up(spark):
    tx = transactions(spark, [("a", "u", 0, "0.01", None, "X"), ("b", "u", 1, "0.02", None, "X")])
    row = metrics.sales_metrics(tx, "1 minute", None).first()
    assert row.avg_transaction_value == Decimal("0.02")


def status_frame(spark, rows):
    return spark.createDataFrame(
        [(p, f"name {p}", "C", c, r, max(c - r, 0), T0) for p, c, r in rows],
        schemas.TABLES["inventory_status"])


def movement_frame(spark, rows):
    return spark.createDataFrame(
        [(T0 + timedelta(minutes=m), p, q, 1) for m, p, q in rows], schemas.TABLES["stock_movements"])


def test_stock_falls_and_alerts_once(spark):
    status = status_frame(spark, [("a", 80, 0), ("b", 80, 0), ("idle", 80, 0), ("exact", 75, 0)])
    moves = movement_frame(spark, [
        (0, "a", 10), (1, "a", 10), (2, "a", 1), (0, "b", 90), (0, "new", 90), (0, "exact", 10),
    ])
    after = {r.product_id: (r.current_stock, r.available_stock, r.product_name, r.category)
             for r in inventory.apply_stock_movements(status, moves).collect()}
    assert after == {
        "a": (59, 59, "name a", "C"), "b": (0, 0, "name b", "C"), "idle": (80, 80, "name idle", "C"),
        "exact": (65, 65, "name exact", "C"), "new": (-10, -10, "Product new", "General"),
    }

    def listed(df):
        return sorted((r.product_id, r.alert_time.minute, r.current_stock) for r in df.collect())

    assert listed(inventory.low_stock_alerts(status, moves)) == [("a", 1, 60), ("b", 0, 0)]
    assert listed(inventory.low_stock_alerts(status, moves, repeat=True)) == [
        ("a", 1, 60), ("a", 2, 59), ("b", 0, 0)]


def sequential(status, moves, initial=80, threshold=65):
    """One update per movement, as an operational database would do it."""
    stock = {p: [c, r, max(c - r, 0), True] for p, c, r in status}
    raised = []
    for minute, product, sold in sorted(moves):
        if product not in stock:
            stock[product] = [initial - sold, 0, initial - sold, False]
            continue
        current, reserved, _, known = stock[product]
        stock[product] = [max(current - sold, 0), reserved, max(current - sold - reserved, 0), known]
        if stock[product][2] < threshold:
            raised.append((product, minute, stock[product][2]))
    return {p: (c, a) for p, (c, _, a, _) in stock.items()}, sorted(raised)


@settings(max_examples=12, **SLOW)
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 120), st.integers(0, 30)),
             unique_by=lambda x: x[0], max_size=3),
    st.lists(st.tuples(st.integers(0, 9), st.sampled_from("abcd"), st.integers(0, 60)),
             unique_by=lambda x: x[:2], max_size=14),
)
def test_stock_equals_a_sequential_fold(spark, status, moves):
    status_df, moves_df = status_frame(spark, status), movement_frame(spark, moves)
    levels, raised = sequential(status, moves)
    after = inventory.apply_stock_movements(status_df, moves_df).collect()
    assert {r.product_id: (r.current_stock, r.available_stock) for r in after} == levels
    found = inventory.low_stock_alerts(status_df, moves_df, repeat=True).collect()
    assert sorted((r.product_id, r.alert_time.minute, r.current_stock) for r in found) == raised
    # Rolling the stock forward over the early movements first leaves the same levels.
    early, late = moves_df.filter("minute(window_start) < 5"), moves_df.filter("minute(window_start) >= 5")
    rolled = inventory.apply_stock_movements(status_df, early)
    after = inventory.apply_stock_movements(rolled, late).collect()
    assert {r.product_id: (r.current_stock, r.available_stock) for r in after} == levels


def test_seeding_is_repeatable_and_skips_known(spark):
    products = spark.createDataFrame([("p1",), ("p2",), ("p2",)], "product_id string")
    first = inventory.seed_inventory(products)
    assert sorted(r.product_id for r in first.collect()) == ["p1", "p2"]
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, inventory.seed_inventory(products).collect()))
    assert inventory.seed_inventory(products, existing=first).count() == 0
    low = status_frame(spark, [("x", 10, 0), ("y", 64, 0), ("z", 65, 0)])
    none = spark.createDataFrame([("x",)], "product_id string")
    assert [r.product_id for r in inventory.seed_alerts(low, none).collect()] == ["y"]


def cart_frame(spark, rows):
    data = [(f"e{n}", u, "p", T0 + timedelta(seconds=s), a, 1, sid)
            for n, (sid, u, s, a) in enumerate(rows)]
    return spark.createDataFrame(data, (
        "event_id string, user_id string, product_id string, timestamp timestamp, action string, "
        "quantity int, session_id string"))


@settings(max_examples=12, **SLOW)
@given(st.lists(st.tuples(
    st.sampled_from(["s1", "s2"]), st.just("u"), st.integers(0, 1500), st.sampled_from(["add", "remove", "update"]),
), max_size=30))
def test_slotted_sessions_equal_native_ones(spark, rows):
    cart = cart_frame(spark, rows)
    native = sessions.streamed_sessions(cart, 120, unique_products=None)
    slotted = sessions.gap_sessions(cart, 120)
    assert sorted(map(tuple, native.collect())) == sorted(map(tuple, slotted.collect()))


def test_pause_of_exactly_the_gap_continues_the_session(spark):
    cart = cart_frame(spark, [("s", "u", 0, "add"), ("s", "u", 120, "add"), ("s", "u", 241, "add")])
    for found in (sessions.gap_sessions(cart, 120), sessions.streamed_sessions(cart, 120)):
        assert sorted(r.page_views for r in found.collect()) == [1, 2]


def test_abandonment_is_strict(spark):
    cart = cart_frame(spark, [
        ("long", "u", 0, "add"), ("long", "u", 61, "update"),
        ("short", "v", 0, "add"), ("short", "v", 60, "update"),
        ("empty", "w", 0, "remove"), ("empty", "w", 90, "update"),
    ])
    row = sessions.cart_abandonment(sessions.gap_sessions(cart)).collect()
    assert [(r.session_id, r.products_in_cart, r.time_in_cart_minutes) for r in row] == [("long", 1, 1)]


@settings(max_examples=12, **SLOW)
@given(
    st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 900)), max_size=8),
    st.lists(st.integers(0, 8000), max_size=12),
)
def test_unpurchased_carts_equal_a_nested_loop(spark, spans, bought):
    horizon = 600
    columns = ("session_id string, user_id string, start_time timestamp, end_time timestamp, "
               "duration_seconds bigint, page_views bigint, cart_adds bigint, cart_removes bigint")
    carts = spark.createDataFrame([
        (f"s{n}", "u", T0 + timedelta(seconds=a), T0 + timedelta(seconds=a + d), d, 1, 1, 0)
        for n, (a, d) in enumerate(spans)], columns)
    purchases = spark.createDataFrame(
        [("u", T0 + timedelta(seconds=b)) for b in bought], "user_id string, timestamp timestamp")
    expected = sorted(
        f"s{n}" for n, (a, d) in enumerate(spans) if not any(a <= b <= a + d + horizon for b in bought))
    found = sessions.unpurchased_carts(carts, purchases, horizon)
    assert sorted(r.session_id for r in found.collect()) == expected


def test_upsert_keeps_first_start_and_last_counts(spark):
    rows = [("s", "u1", T0, T0, 0, 1, 1, 0),
            ("s", "u2", T0 + timedelta(minutes=2), T0 + timedelta(minutes=3), 60, 5, 2, 1)]
    frame = spark.createDataFrame(rows, (
        "session_id string, user_id string, start_time timestamp, end_time timestamp, "
        "duration_seconds bigint, page_views bigint, cart_adds bigint, cart_removes bigint"))
    assert sessions.upserted_sessions(frame).first()[:] == (
        "s", "u1", T0, T0 + timedelta(minutes=3), 60, 5, 2, 1)


def rule(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if r >= 4 and f >= 3:
        return "Loyal Customers"
    if r >= 3 and m >= 3:
        return "Potential Loyalists"
    if r >= 4:
        return "New Customers"
    if r == 3:
        return "Promising" if f <= 2 else "Need Attention"
    return "Cannot Lose Them" if f >= 4 else "At Risk" if f >= 2 else "Hibernating"


def test_all_score_codes(spark):
    codes = spark.createDataFrame(
        [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)],
        "r_score int, f_score int, m_score int")
    for row in codes.withColumn("name", segment_name()).collect():
        assert row.name == rule(row.r_score, row.f_score, row.m_score)


@pytest.mark.parametrize("rows", [0, 1, 3, 5, 7, 503])
def test_range_ranking_equals_ntile(spark, rows):
    frame = spark.range(rows).select(
        F.col("id"), (F.pmod(F.xxhash64("id"), F.lit(3))).alias("value"))
    order = {"tile": [F.col("value").desc(), F.col("id").asc()], "up": [F.col("value").asc(), F.col("id").asc()]}
    ranged = ranking.global_ntile(frame, order, 5)
    plain = frame.withColumn("tile", F.ntile(5).over(Window.orderBy(*order["tile"]))).withColumn(
        "up", F.ntile(5).over(Window.orderBy(*order["up"])))
    assert sorted(map(tuple, ranged.collect())) == sorted(map(tuple, plain.collect()))


def test_range_ranking_splits_a_hot_value(spark):
    """A value held by most rows is spread over partitions by the tie-break."""
    frame = spark.range(4000).select("id", F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("value"))
    staged = frame.repartitionByRange(8, "value", "id").groupBy(F.spark_partition_id()).count()
    assert staged.agg(F.max("count")).first()[0] < 1500


def test_rfm_of_three_customers(spark):
    tx = transactions(spark, [
        ("1", "a", 0, "10.00", None, "X"), ("2", "b", 86400, "20.00", None, "X"),
        ("3", "b", 86401, "5.00", None, "X"), ("4", "c", 172800, "90.00", None, "X"),
    ])
    rows = {r.user_id: (r.recency, r.frequency, r.r_score, r.f_score, r.m_score)
            for r in rfm.rfm_scores(tx, T0 + timedelta(days=3)).collect()}
    assert rows == {"a": (3, 1, 1, 1, 1), "b": (2, 2, 2, 3, 2), "c": (1, 1, 3, 2, 3)}


def fact_frame(spark, rows):
    return spark.createDataFrame(
        [(t, int(t.strftime("%Y%m%d")), c, "UK", Decimal(a), n, Decimal(a), T0) for t, c, a, n in rows],
        schemas.TABLES["fact_sales"])


def test_growth_after_a_zero_period_is_null(spark):
    fact = fact_frame(spark, [
        (datetime(2024, 1, 1), "X", "0.00", 1), (datetime(2024, 1, 2), "X", "10.00", 1),
        (datetime(2024, 1, 3), "X", "15.00", 1),
    ])
    assert [r.revenue_growth_rate for r in trends.period_trend(fact, "daily").collect()] == [0.0, None, 50.0]


def test_week_around_new_year(spark):
    fact = fact_frame(spark, [(datetime(2024, 12, 30), "X", "1.00", 1)])
    parts = [trends.combine_trends(trends.period_trend(fact, "weekly", iso), as_of=T0).first().period
             for iso in (False, True)]
    assert parts == ["2024-W1", "2025-W1"]
    assert {r.period for r in trends.all_trends(fact, T0, iso_year=True).collect()} == {
        "2024-12-30", "2025-W1", "2024-12"}


def test_category_shares_add_up_and_rate(spark):
    fact = fact_frame(spark, [(T0, c, a, 2) for c, a in (
        ("a", "60.00"), ("b", "20.00"), ("c", "11.00"), ("d", "5.00"), ("e", "4.00"))])
    rows = categories.category_performance(fact, T0).collect()
    assert [(r["category"], r["rank"], r["performance_rating"]) for r in rows] == [
        ("a", 1, "Excellent"), ("b", 2, "Excellent"), ("c", 3, "Good"), ("d", 4, "Average"),
        ("e", 5, "Below Average")]
    assert abs(sum(r.revenue_share for r in rows) - 100) < 1e-9


def test_dim_time_range(spark):
    rows = warehouse.dim_time(spark, date(2024, 12, 28), date(2024, 12, 30)).collect()
    assert [(r.date_id, r.week, r.day_of_week, r.day_name, r.is_weekend) for r in rows] == [
        (20241228, 52, 6, "Saturday", True), (20241229, 52, 7, "Sunday", True),
        (20241230, 1, 1, "Monday", False)]
    assert warehouse.dim_time(spark, date(2023, 6, 1), date(2024, 6, 30)).count() == 396


def test_topic_rates_start_at_zero_and_ignore_resets(spark):
    offsets = spark.createDataFrame(
        [("t", 0, 10, T0), ("t", 1, 5, T0), ("t", 0, 30, T0 + timedelta(seconds=10)),
         ("t", 1, 5, T0 + timedelta(seconds=10)), ("t", 0, 3, T0 + timedelta(seconds=20))],
        "topic string, partition int, end_offset bigint, timestamp timestamp")
    rows = metrics.topic_rates(offsets).orderBy("timestamp").collect()
    assert [(r.event_count, r.rate) for r in rows] == [(0, 0.0), (20, 2.0), (0, 0.0)]


def test_alert_checks(spark):
    status = status_frame(spark, [("none", 0, 0), ("few", 4, 0), ("some", 9, 0), ("limit", 10, 0)])
    found = alerts.low_stock_check(status).collect()
    assert [(r.alert_key, r.severity) for r in found] == [("low_stock_few_4", "red"), ("low_stock_some_9", "yellow")]
    sent = spark.createDataFrame([("low_stock_few_4",)], "alert_key string")
    assert [r.product_id for r in alerts.low_stock_check(status, sent=sent, limit=1).collect()] == ["some"]
    spike = spark.createDataFrame([(T0, Decimal("1.50"))] * 21, "abandonment_time timestamp, cart_value decimal(12,2)")
    assert alerts.abandonment_spike(spike, T0).first()[:] == (21, Decimal("31.50"))
    assert alerts.abandonment_spike(spike.limit(20), T0).count() == 0
    assert alerts.abandonment_spike(spike, T0 + timedelta(hours=2)).count() == 0


def test_funnel_and_quality_on_empty_input(spark):
    views = spark.createDataFrame([], "user_id string, timestamp timestamp")
    carts = spark.createDataFrame([], "user_id string, action string, timestamp timestamp")
    assert metrics.funnel(views, carts, views, ["user_id"]).first()[:] == (0, 0, 0, 0, None, None)
    report = quality.quality_report(views, {"has user": "user_id IS NOT NULL"}).first()
    assert report[:] == ("has user", 0, 0, 0.0)


def test_funnel_goes_by_time(spark):
    def log(*rows):
        return spark.createDataFrame([(u, T0 + timedelta(minutes=m)) for u, m in rows], "user_id string, timestamp timestamp")

    views = log(("all", 1), ("all", 9), ("early cart", 5), ("early purchase", 1), ("same", 3), ("none", 1))
    carts = log(("all", 2), ("early cart", 4), ("early purchase", 6), ("same", 3), ("unseen", 1)).withColumn(
        "action", F.lit("add"))
    bought = log(("all", 3), ("early purchase", 5), ("same", 3), ("early cart", 8))
    assert metrics.funnel(views, carts, bought, ["user_id"]).first()[:4] == (5, 3, 2, 4)


@settings(max_examples=40, **SLOW)
@given(st.lists(st.tuples(st.sampled_from(["add", "remove", "update"]), st.integers(1, 4)), max_size=8))
def test_cart_is_a_fold_over_its_actions(spark, actions):
    left = 0
    for action, quantity in actions:
        left = {"add": left + quantity, "remove": 0, "update": quantity}[action]
    cart = spark.createDataFrame(
        [("s", "p", a, q, T0 + timedelta(seconds=i // 2), f"{i:03d}") for i, (a, q) in enumerate(actions)],
        "session_id string, product_id string, action string, quantity int, timestamp timestamp, event_id string")
    assert [r.quantity for r in sessions.cart_contents(cart).collect()] == ([left] if left else [])
    prices = spark.createDataFrame([("p", 10.0)], "product_id string, price double")
    values = [r.cart_value for r in sessions.cart_values(cart, prices).collect()]
    assert values == ([Decimal(10 * left).quantize(Decimal("0.01"))] if left else [])


def test_panes_hold_every_sale_once_and_other_windows_are_refused(spark):
    tx = transactions(spark, [(str(i), "u", i * 97, "2.00", None, "X") for i in range(50)])
    for window, slide in (("10 minutes", "3 minutes"), ("1 hour", "25 minutes"), ("1 hour", "30 minutes")):
        pane = metrics.pane(window, slide)
        kept = warehouse.fact_sales(
            metrics.sales_panes(tx, window, slide), T0, windows=SalesWindows(length=pane, slide=pane))
        assert kept.agg(F.sum("transaction_count"), F.sum("total_amount")).first()[:] == (50, Decimal("100.00"))
    sliding = metrics.sales_metrics(tx, "10 minutes", "3 minutes")
    with pytest.raises(ValueError, match="tile"):
        warehouse.fact_sales(sliding, T0, windows=SalesWindows(length="10 minutes", slide="3 minutes"))
    with pytest.raises(Exception, match="not a window of 1 minute"):
        warehouse.fact_sales(sliding, T0).collect()


def test_range_of_windows_equals_a_filter(spark):
    tx = transactions(spark, [(str(i), "u", i * 611, "2.00", None, "X") for i in range(60)])
    since, until = T0 + timedelta(hours=2), T0 + timedelta(hours=5)
    for slide in ("30 minutes", "5 minutes", None):
        every = metrics.sales_metrics(tx, "1 hour", slide)
        part = metrics.sales_metrics(tx, "1 hour", slide, since=since, until=until)
        wanted = every.filter(F.col("window_start").between(since, until))
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, wanted.collect())) != []


def test_checks_return_all_unless_a_page_is_asked_for(spark):
    status = spark.range(50).select(
        F.col("id").cast("string").alias("product_id"), F.lit("n").alias("product_name"),
        F.lit("c").alias("category"), F.lit(3).alias("available_stock"))
    assert alerts.low_stock_check(status).count() == 50
    assert alerts.low_stock_check(status, limit=20).count() == 20
    assert alerts.low_stock_check(status, limit=0).count() == 0


def test_partitions_without_a_sample_keep_their_count(spark):
    """A partition that lacks a sample neither lowers the topic nor counts its history again."""
    offsets = spark.createDataFrame(
        [("t", 0, 5, T0), ("t", 1, 100, T0), ("t", 0, 7, T0 + timedelta(hours=1)),
         ("t", 0, 8, T0 + timedelta(hours=2)), ("t", 1, 104, T0 + timedelta(hours=2))],
        "topic string, partition int, end_offset bigint, timestamp timestamp")
    assert [r.event_count for r in metrics.topic_rates(offsets).orderBy("timestamp").collect()] == [0, 2, 5]


def test_outcome_of_sessions(spark):
    def at(m):
        return T0 + timedelta(minutes=m)

    visits = spark.createDataFrame(
        [("a", "u", at(0), at(10), 600, 3, 1, 0), ("b", "v", at(0), at(10), 600, 3, 1, 0), ("c", "w", at(0), at(10), 600, 3, 0, 0)],
        "session_id string, user_id string, start_time timestamp, end_time timestamp, duration_seconds bigint, "
        "page_views bigint, cart_adds bigint, cart_removes bigint")
    paid = spark.createDataFrame(
        [("u", at(40), Decimal("5.00")), ("u", at(0), Decimal("2.00")), ("u", at(41), Decimal("9.00")),
         ("v", at(-1), Decimal("1.00")), ("w", None, Decimal("1.00"))],
        "user_id string, timestamp timestamp, total_amount decimal(12,2)")
    found = {r.session_id: (r.purchase_completed, r.abandoned, r.total_amount)
             for r in sessions.with_outcome(visits, paid).collect()}
    assert found == {"a": (True, False, Decimal("7.00")), "b": (False, True, None), "c": (False, False, None)}


def test_repeated_transactions_on_tables_count_once(spark):
    tx = transactions(spark, [("1", "u", 0, "2.00", None, "X"), ("1", "u", 5, "3.00", None, "X"), ("2", "u", 1, "1.00", None, "X")])
    found = event_source.deduplicated(tx).agg(F.count("*"), F.sum("total_amount")).first()
    assert found[:] == (2, Decimal("3.00"))


def test_history_merge(spark):
    schema = ("id string, price int, valid_from timestamp, valid_to timestamp, is_current boolean")
    dim = spark.createDataFrame([
        ("a", 1, T0, T0 + timedelta(days=1), False), ("a", 2, T0 + timedelta(days=1), None, True),
        ("b", 5, T0, None, True), ("gone", 7, T0, None, True)], schema)
    now = T0 + timedelta(days=9)
    incoming = spark.createDataFrame([("a", 3), ("b", 5), ("c", None)], "id string, price int")
    merged = warehouse.merge_history(dim, incoming, ["id"], ["price"], now)
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted([
        ("a", 1, T0, T0 + timedelta(days=1), False), ("a", 2, T0 + timedelta(days=1), now, False),
        ("a", 3, now, None, True), ("b", 5, T0, None, True), ("c", None, now, None, True),
        ("gone", 7, T0, None, True)], key=repr)


def test_exploding_products(spark):
    tx = transactions(spark, [("a", "u", 0, "1.00", [("p", 1), ("p", 2)], "X"), ("b", "u", 0, "1.00", None, "X")])
    assert sorted(r.quantity for r in product_lines(tx).collect()) == [1, 2]


def test_system_alerts(spark):
    health = spark.createDataFrame(
        [("cpu_usage", Decimal("90.00")), ("cpu_usage", Decimal("90.01")), ("disk_usage", Decimal("99.00"))],
        "metric_name string, metric_value decimal(15,2)")
    assert alerts.system_alerts(health).count() == 1
    assert alerts.system_alerts(health, alerts.RED_GAUGES).count() == 3


@settings(max_examples=12, **SLOW)
@given(st.dictionaries(
    st.tuples(st.sampled_from("ab"), st.integers(0, 60)), st.sampled_from(["x", "y", None]), max_size=25))
def test_history_equals_a_sequential_scan(spark, seen):
    def hour(n):
        return T0 + timedelta(hours=n)

    expected = []
    for key in "ab":
        times = sorted(n for k, n in seen if k == key)
        starts = [n for i, n in enumerate(times) if i == 0 or seen[key, n] != seen[key, times[i - 1]]]
        for n, until in zip(starts, [*starts[1:], None]):
            expected.append((key, seen[key, n], hour(n), None if until is None else hour(until), until is None))
    frame = spark.createDataFrame([(k, v, hour(n)) for (k, n), v in seen.items()], "id string, v string, at timestamp")
    found = warehouse.history(frame, ["id"], ["v"], "at")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
