"""Compaction, and the ETL that follows the batches it has not seen.

Upserts from a compacted log equal those from the whole log, also after a crash in the middle.
"""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tests.test_streaming import rows
from tillstream import schemas
from tillstream.plans import batch as batch_jobs
from tillstream.sources.tables import TableStore

LEVELS = "product_id string, product_name string, current_stock bigint"


def put(store, batch_id, draw, run="0"):
    store.put_batch("stock_levels", store.spark.createDataFrame(
        [(f"p{draw.randrange(30)}", f"{run}-{batch_id}", draw.randrange(100)) for _ in range(4)], LEVELS).dropDuplicates(["product_id"]),
        batch_id, run)


def views(store):
    whole = TableStore(store.spark, store.root)
    whole._base = lambda name: None
    return [rows(s.current("stock_levels", ["product_id"], ["product_name"])) for s in (store, whole)]


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def test_equal_before_and_after(store):
    draw = random.Random(3)
    compact = lambda: store.compact("stock_levels", ["product_id"], ["product_name"], buckets=4)
    compact()  # nothing to fold yet
    assert store.current("stock_levels", ["product_id"]).count() == 0
    for batch in range(6):
        put(store, batch, draw, "0" if batch < 4 else "1")
        if batch % 2:
            compact()
        compacted, whole = views(store)
        assert compacted == whole and whole
    before = store._base("stock_levels")
    compact()  # no new batch: no new generation
    assert store._base("stock_levels") == before


def test_only_changed_buckets_are_rewritten(store, tmp_path):
    draw = random.Random(5)
    for batch in range(3):
        put(store, batch, draw)
    store.compact("stock_levels", ["product_id"], buckets=8)
    one = store.spark.createDataFrame([("p1", "x", 1)], LEVELS)
    store.put_batch("stock_levels", one, 3)
    store.compact("stock_levels", ["product_id"], buckets=8)
    base = store._base("stock_levels")
    assert sorted(base["places"].values()).count(1) == 1 and base["covered"] == {"0": 3}
    written = [p.name for p in (tmp_path / "store" / "stock_levels_base" / "rows" / "generation=1").glob("bucket=*")]
    assert len(written) == 1
    # Folded batches are left out by their folder names.
    plan = store._behind("stock_levels", base)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert store._behind("stock_levels", base).count() == 0


def test_a_crash_before_the_list_changes_nothing(store, monkeypatch):
    draw = random.Random(7)
    for batch in range(2):
        put(store, batch, draw)
    store.compact("stock_levels", ["product_id"], ["product_name"], buckets=4)
    put(store, 2, draw)
    before = views(store)[1]

    def broken(*_, **__):
        raise OSError("the driver went away")

    with monkeypatch.context() as m:
        m.setattr(store.spark, "createDataFrame", broken)  # the list is the only thing made on the driver
        with pytest.raises(OSError):
            store.compact("stock_levels", ["product_id"], ["product_name"])
    assert views(store) == [before, before]
    put(store, 3, draw)
    store.compact("stock_levels", ["product_id"], ["product_name"])
    compacted, whole = views(store)
    assert compacted == whole


def test_etl_rewrites_the_days_of_new_batches_only(spark, tmp_path):
    source, target = TableStore(spark, str(tmp_path / "ops")), TableStore(spark, str(tmp_path / "wh"))
    day = [datetime(2024, 1, d, 10) for d in range(1, 6)]

    def sell(number, *sold):
        source.put_batch("sales_metrics", spark.createDataFrame(
            [(t, t + timedelta(minutes=1), "X", "UK", Decimal(a), 1, Decimal(a)) for t, a in sold],
            schemas.TABLES["sales_metrics"]), number)

    def visit(number, session, start, minutes):
        source.put_batch("session_metrics", spark.createDataFrame(
            [(session, "u", start, start + timedelta(minutes=minutes), minutes * 60, 0, 1, 0, False, False, None)],
            schemas.TABLES["session_metrics"]), number)

    def run(as_of):
        return batch_jobs.run_etl_of_changes(source, target, as_of)

    def loaded():
        return {(r.date_time.day, str(r.total_amount), r.loaded_at.day) for r in target.read("fact_sales").collect()}

    assert run(day[0]) == {"fact_sales": [], "fact_sessions": []}
    sell(0, (day[0], "1.00"), (day[1], "2.00"))
    visit(0, "s", day[1], 5)
    found = run(datetime(2024, 2, 1))
    assert [d.day for d in found["fact_sales"]] == [1, 2] and [d.day for d in found["fact_sessions"]] == [2]
    sell(1, (day[3], "4.00"))
    sell(2, (day[0] + timedelta(minutes=1), "9.00"))  # late, for an old day
    visit(1, "s", day[1] + timedelta(minutes=3), 40)  # its start stays as first written
    found = run(datetime(2024, 2, 2))
    assert [d.day for d in found["fact_sales"]] == [1, 4] and [d.day for d in found["fact_sessions"]] == [2]
    assert loaded() == {(1, "1.00", 2), (1, "9.00", 2), (2, "2.00", 1), (4, "4.00", 2)}
    assert [(r.session_id, r.duration_seconds) for r in target.read("fact_sessions").collect()] == [("s", 2400)]
    assert run(datetime(2024, 2, 3)) == {"fact_sales": [], "fact_sessions": []} and len(loaded()) == 4
    whole = TableStore(spark, str(tmp_path / "whole"))
    batch_jobs.run_etl_of_changes(source, whole, datetime(2024, 2, 2))
    assert rows(whole.read("fact_sales").drop("loaded_at")) == rows(target.read("fact_sales").drop("loaded_at"))


def test_late_observations_in_any_order(spark):
    """The history after every arrival equals that over all observations so far."""
    from tillstream.operators import warehouse

    draw = random.Random(11)
    start = datetime(2024, 1, 1, 22)
    all_seen = [(k, start + timedelta(hours=3 * i), draw.choice("xxy")) for k in ("a", "b", None) for i in range(12)]
    draw.shuffle(all_seen)
    kind = "k string, t timestamp, v string"
    seen, history = spark.createDataFrame([], kind), None
    for n in range(0, len(all_seen), 9):
        late = spark.createDataFrame(all_seen[n:n + 9] + [("a", None, "z")], kind)
        if history is None:
            history = warehouse.history(late, ["k"], ["v"], "t")
        else:
            history = warehouse.amend_history(history, seen, late, ["k"], ["v"], "t")
        seen = spark.createDataFrame(all_seen[:n + 9], kind)
        history = spark.createDataFrame(history.collect(), history.schema)
        assert rows(history) == rows(warehouse.history(seen, ["k"], ["v"], "t"))
    corrected = spark.createDataFrame([("a", start, "new")], kind)
    found = warehouse.amend_history(history, seen, corrected, ["k"], ["v"], "t")
    assert found.where("k = 'a'").orderBy("valid_from").first().v == "new"
    assert rows(found.where("k <> 'a'")) == rows(history.where("k <> 'a'"))
