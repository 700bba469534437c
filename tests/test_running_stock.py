"""The stock that a stream keeps, against the batch operators on the same lines."""

import os
import random
import re
import shutil
from collections import Counter
from datetime import timedelta

from pyspark.sql import functions as F

from tests.test_streaming import T0, drop_file, finish, rows, tx_line
from tillstream.operators import inventory, running_stock
from tillstream.settings import StockRules
from tillstream.sources import events
from tillstream.sources.tables import TableStore
from tillstream.streaming import jobs

STATUS = ("product_id string, product_name string, category string, current_stock bigint, "
          "reserved_stock bigint, available_stock bigint, last_updated timestamp")
LEVEL = ["product_id", "product_name", "category", "current_stock", "reserved_stock", "available_stock"]


def opening(spark):
    return spark.createDataFrame([("a", "Ant", "C", 80, 0, 80, T0), ("b", "Bee", "C", 70, 6, 64, T0), ("c", "Cat", "C", 90, 0, 90, T0)], STATUS)


def made_up(seed, n=120):
    draw = random.Random(seed)
    return [tx_line(str(i), i * 7, products=[(draw.choice("aabbx"), draw.randrange(1, 4))]) for i in range(n)]


def batch_side(spark, lines):
    raw = spark.createDataFrame([(line,) for line in lines], "value string")
    moved = inventory.stock_movements(events.product_lines(events.parse_transactions(raw).events), "1 minute")
    status = opening(spark)
    after = inventory.apply_stock_movements(status, moved)
    return rows(after, *LEVEL), rows(inventory.low_stock_alerts(status, moved))


def test_levels_and_alerts_equal_the_batch_operators(spark, tmp_path):
    """In several runs from one checkpoint; a far event lets all windows end."""
    lines = made_up(1)
    source, store = tmp_path / "in", TableStore(spark, str(tmp_path / "out"))
    store.overwrite("inventory_status", opening(spark))
    start = lambda: finish(jobs.keep_stock(
        events.file_stream(spark, str(source), 1), store, str(tmp_path / "cp"), available_now=True))
    for k in range(3):
        for half in range(2):  # files are taken by age
            drop_file(source, f"{k}-{half}.json", lines[k * 40 + half * 20:k * 40 + half * 20 + 20])
            os.utime(source / f"{k}-{half}.json", (1_700_000_000 + 2 * k + half,) * 2)
        start()
    levels, alerts = batch_side(spark, lines)
    assert rows(jobs.kept_levels(store), *LEVEL) == levels
    drop_file(source, "9.json", [tx_line("far", 100_000, products=(("c", 1),))])
    start()
    assert rows(store.changes("stock_alerts").drop("run", "batch_id")) == alerts and alerts
    # A line of a window that was taken is left out.
    drop_file(source, "99.json", [tx_line("late", 3, products=(("a", 50),))])
    start()
    left = {r.product_id: r.current_stock for r in jobs.kept_levels(store).collect()}
    assert left["c"] == 89 and [left[r[0]] for r in levels if r[0] != "c"] == [r[3] for r in levels if r[0] != "c"]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The last commit is lost, as after a crash between sink and checkpoint."""
    lines = made_up(2)
    source, store, checkpoint = tmp_path / "in", TableStore(spark, str(tmp_path / "out")), tmp_path / "cp"
    store.overwrite("inventory_status", opening(spark))
    for k in range(2):
        drop_file(source, f"{k}.json", lines[k * 60:k * 60 + 60])
        finish(jobs.keep_stock(events.file_stream(spark, str(source), 1), store, str(checkpoint), available_now=True))
    before = rows(store.changes("stock_levels")), rows(store.changes("stock_alerts"))
    last = max((checkpoint / "running_stock" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    kept = tmp_path / "kept"
    shutil.copytree(checkpoint / "running_stock" / "commits", kept)
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    finish(jobs.keep_stock(events.file_stream(spark, str(source), 1), store, str(checkpoint), available_now=True))
    assert (rows(store.changes("stock_levels")), rows(store.changes("stock_alerts"))) == before
    assert rows(jobs.kept_levels(store), *LEVEL) == batch_side(spark, lines)[0]


def test_odd_lines(spark):
    lines = spark.createDataFrame([("a", 2, None), (None, 1, T0), ("n", 30, T0)], "product_id string, quantity int, timestamp timestamp")
    found = running_stock.running_stock(lines, opening(spark), StockRules())
    assert rows(running_stock.levels(found), "product_id", "current_stock") == [("n", 50), (None, 79)]
    assert running_stock.alerts(found).count() == 0
    assert running_stock.running_stock(lines.limit(0), opening(spark)).count() == 0


def test_a_table_is_taken_as_the_processor_would(spark):
    """Against the stream's own rule, window by window; many products need no state or call to Python each."""
    draw, rules = random.Random(5), StockRules()
    start = T0.replace(second=0, microsecond=0)
    sold = [(draw.choice(["a", "b", "c", "x", "y", None]), draw.choice([1, 7, 12, None]), start + timedelta(seconds=draw.randrange(900)))
            for _ in range(90)]
    lines = spark.createDataFrame(sold + [("z", 90, start)], "product_id string, quantity int, timestamp timestamp")
    found = running_stock.running_stock(lines, opening(spark), rules)
    assert not re.search("Python|Pandas|StateIn", found._jdf.queryExecution().executedPlan().toString())
    keeper, want = running_stock.StockKeeper(rules), []
    for product in {p for p, _, _ in sold} | {"z"}:
        known = {"a": ("Ant", "C", 80, 0), "b": ("Bee", "C", 70, 6), "c": ("Cat", "C", 90, 0)}.get(product)
        state = [*known, True, 0, 0] if known else [f"Product {product}", "General", rules.initial, 0, False, 0, 0]
        units = Counter()
        for p, n, at in sold + [("z", 90, start)]:
            if p == product:
                units[at.replace(second=0)] += n or 0
        want += [keeper._taken(product, state, at, units[at]) for at in sorted(units)]
        want.append(keeper._row("level", product, state, *keeper._left(state, state[5], state[6]), max(units)))
    columns = [c.split()[0] for c in running_stock.CHANGES.split(", ")]
    assert found.columns == columns
    assert rows(found) == sorted((tuple(w[c] for c in columns) for w in want if w), key=str)
    assert {w["kind"] for w in want if w} == {"alert", "level"}


def test_openings_listed_twice_or_without_a_stock(spark):
    lines = spark.createDataFrame([("a", 2, T0), ("d", 5, T0)], "product_id string, quantity int, timestamp timestamp")
    status = opening(spark).union(opening(spark)).union(
        spark.createDataFrame([("d", None, None, None, None, None, T0)], STATUS))
    assert rows(running_stock.levels(running_stock.running_stock(lines, status)), *LEVEL) == [
        ("a", "Ant", "C", 78, 0, 78), ("d", "Product d", "General", 75, 0, 75)]
