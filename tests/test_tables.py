"""Stored tables, batch jobs, ad-hoc SQL and connector options."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators import categories, rfm, trends
from tillstream.plans import batch, serving
from tillstream.settings import RfmRules, SalesWindows
from tillstream.sources import events, tables
from tillstream.sources.given import GivenTables
from tillstream.sources.tables import TableStore

NOW = datetime(2024, 2, 1)


def test_missing_table_is_empty_with_its_schema(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.read("fact_sales").columns == schemas.TABLES["fact_sales"].names
    assert store.current("session_metrics", ["session_id"]).count() == 0


def test_current_row_per_key(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))

    def put(batch_id, *rows):
        store.put_batch("session_metrics", spark.createDataFrame(
            rows, "session_id string, user_id string, start_time timestamp, page_views bigint"), batch_id)

    put(1, ("a", "u", NOW, 1), ("b", "u", NOW, 1))
    put(2, ("a", "other", NOW + timedelta(hours=1), 5))
    put(2, ("a", "other", NOW + timedelta(hours=1), 6))
    found = store.current("session_metrics", ["session_id"], ["user_id", "start_time"])
    assert {r.session_id: (r.user_id, r.start_time, r.page_views) for r in found.collect()} == {
        "a": ("u", NOW, 6), "b": ("u", NOW, 1)}


def test_conform_rejects_what_does_not_fit(spark):
    frame = spark.createDataFrame([(Decimal("10000000000.00"),)], "amount decimal(15,2)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        tables.conform(frame, "transaction_anomalies").collect()


def test_csv_export(spark, tmp_path):
    tables.export_csv(spark.createDataFrame([("a,b", 1)], "name string, n int"), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).first()[:] == ("a,b", "1")


def test_connector_options(spark):
    options = events.kafka_options("broker:9092", "transactions", kafka__security__protocol="SSL")
    assert options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "transactions",
        "startingOffsets": "latest", "kafka.security.protocol": "SSL"}
    assert tables.jdbc_write_options("jdbc:x:y", "t", {"user": "u"}) == {
        "url": "jdbc:x:y", "dbtable": "t", "batchsize": "10000", "user": "u"}


def test_batch_jobs_end_to_end(spark, tmp_path):
    given = GivenTables(spark, "/root/testdata/sf0.001")
    source, target = TableStore(spark, str(tmp_path / "ops")), TableStore(spark, str(tmp_path / "wh"))
    from tillstream.operators import metrics, sessions

    sales = metrics.sales_metrics(given.purchases(), "1 hour", "30 minutes")
    source.overwrite("sales_metrics", sales)
    source.overwrite("transactions", given.purchases())
    source.overwrite("session_metrics", sessions.gap_sessions(given.cart_events(), 3600))
    batch.run_all(source, target, NOW, RfmRules(), SalesWindows(length="1 hour", slide="30 minutes"))

    fact = target.read("fact_sales")
    bought = given.purchases()
    assert fact.agg(F.sum("transaction_count"), F.sum("total_amount")).first()[:] == (
        bought.count(), bought.agg(F.sum("total_amount")).first()[0])
    assert target.read("dim_time").count() == 396
    assert target.read("fact_sessions").count() == source.read("session_metrics").count()
    assert target.read("customer_segments").count() == bought.select("user_id", "country").distinct().count()
    report = target.read("product_performance")
    assert [r["rank"] for r in report.orderBy("rank").collect()] == list(range(1, report.count() + 1))
    kinds = {r.period_type for r in target.read("sales_trends").select("period_type").distinct().collect()}
    assert kinds == {"daily", "weekly", "monthly"}
    # A filter on the day prunes folders.
    plan = fact.filter("date_id = 20240105")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date_id" in plan


def test_incremental_etl_replaces_only_later_days(spark, tmp_path):
    source, target = TableStore(spark, str(tmp_path / "ops")), TableStore(spark, str(tmp_path / "wh"))

    def sales(*rows):
        source.overwrite("sales_metrics", spark.createDataFrame(
            [(t, t + timedelta(minutes=1), "X", "UK", Decimal(a), 1, Decimal(a)) for t, a in rows],
            schemas.TABLES["sales_metrics"]))

    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    sales((day[0], "1.00"), (day[1], "2.00"))
    batch.run_etl(source, target, NOW)
    sales((day[0], "99.00"), (day[1], "5.00"), (day[2], "7.00"))
    batch.run_etl(source, target, NOW, since=day[1].date())
    facts = target.read("fact_sales").orderBy("date_time").collect()
    assert [r.total_amount for r in facts] == [Decimal("1.00"), Decimal("5.00"), Decimal("7.00")]
    with pytest.raises(ValueError):
        target.overwrite("dim_time", target.read("dim_time"), only_days=True)


def test_command_line(spark, tmp_path):
    from tillstream import __main__ as command

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(
        '{"transaction_id":"a","user_id":"u","timestamp":"2024-01-01T00:00:00","total_amount":7.5,'
        '"products":[],"country":"UK","payment_method":"paypal"}\n')
    ops, wh = str(tmp_path / "ops"), str(tmp_path / "wh")
    command.main(["stream", "transactions", "--folder", str(tmp_path / "in"), "--tables", ops,
                  "--checkpoints", str(tmp_path / "cp"), "--available-now"])
    assert TableStore(spark, ops).read("transactions").first().category == "General"
    command.main(["batch", "rfm", "--source", ops, "--target", wh, "--as-of", "2024-02-01"])
    assert TableStore(spark, wh).read("customer_segments").first().recency == 31
    TableStore(spark, ops).overwrite("inventory_status", spark.createDataFrame(
        [("p", 5)], "product_id string, current_stock bigint"))
    command.main(["batch", "close-stock", "--source", ops, "--target", wh, "--as-of", "2024-02-01"])
    assert TableStore(spark, ops).newest_batch("inventory_openings") == 20240201
    with pytest.raises(ValueError):
        batch.run_snapshots(TableStore(spark, ops), TableStore(spark, ops + "/"), NOW)
    with pytest.raises(SystemExit):
        command.arguments(["stream", "transactions", "--tables", ops, "--checkpoints", "x"])


def test_settings_follow_the_data():
    from tillstream.session import sized_for

    assert sized_for(1 << 30, 100)["spark.sql.shuffle.partitions"] == "200"
    assert sized_for(1 << 40, 100)["spark.sql.shuffle.partitions"] == "4096"
    assert sized_for(100 << 40, 4000)["spark.sql.shuffle.partitions"] == "409600"


def test_adhoc_sql_reads_only(spark):
    frame = {"sales_rows": spark.range(3)}
    assert serving.run_sql(spark, "  select count(*) AS n from sales_rows", frame).first().n == 3
    assert serving.run_sql(spark, "WITH t AS (SELECT 1 AS x) SELECT * FROM t").first().x == 1
    assert serving.run_sql(spark, "SELECT (SELECT max(1) FROM sales_rows) AS m", frame).first().m == 1
    nested = "WITH t AS (SELECT * FROM sales_rows), u AS (SELECT * FROM t) SELECT count(*) AS n FROM u JOIN t USING (id)"
    assert serving.run_sql(spark, nested, frame).count() == 1
    for text in ("SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`", "SELECT * FROM other",
                 "SELECT (SELECT count(*) FROM json.`/etc/passwd`)", "SELECT * FROM default.sales_rows"):
        with pytest.raises(PermissionError):
            serving.run_sql(spark, text, frame)
    assert not spark.catalog.tableExists("sales_rows")
    for text in ("DROP TABLE sales_rows", "CREATE TABLE x AS SELECT 1", "INSERT INTO x SELECT 1", "SHOW TABLES",
                 "WITH t AS (SELECT 1 AS x) INSERT INTO y SELECT * FROM t"):
        with pytest.raises(PermissionError):
            serving.run_sql(spark, text, frame)
    with pytest.raises(ValueError):
        serving.run_sql(spark, "  ")


def test_report_arguments_are_checked(spark):
    sales = spark.createDataFrame([], schemas.TABLES["sales_metrics"])
    for limit in (0, 1001):
        with pytest.raises(ValueError):
            serving.sales_rows(sales, limit=limit)
    with pytest.raises(ValueError):
        serving.sales_summary(sales, "year", NOW)
    assert serving.sales_summary(sales, "today", NOW).first()[1:] == (0, 0, 0.0, 0.0, 0.0, 0.0)
    assert serving.sales_totals(sales).first()[:] == (0.0, 0, 0.0)
    assert serving.revenue_since(sales, NOW).first()[0] == 0.0


def test_reports_on_empty_tables(spark):
    segments = spark.createDataFrame([], schemas.TABLES["customer_segments"])
    fact = spark.createDataFrame([], schemas.TABLES["fact_sales"])
    assert serving.country_overview(segments).first()[:] == (0, "N/A", 0)
    assert serving.category_overview(fact).first()[:] == (0, "N/A", 0.0)
    assert serving.customer_kpis(segments).first()[:] == (0.0, 0, 0.0)
    assert categories.category_performance(fact, NOW).count() == 0
    assert trends.all_trends(fact, NOW).count() == 0
    tx = spark.createDataFrame([], schemas.TABLES["transactions"])
    assert rfm.rfm_scores(tx, NOW).count() == 0


def test_null_country_counts_as_one(spark):
    segments = spark.createDataFrame(
        [("a", None, Decimal("50.00")), ("b", "UK", Decimal("5.00")), ("c", "UK", Decimal("6.00"))],
        "user_id string, country string, monetary decimal(22,2)")
    assert serving.country_overview(segments).first()[:] == (2, "UK", 3)


# Plans ---------------------------------------------------------------------------------------------


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_task_over_rows(spark):
    """The range path of the customer scores never gathers rows in one partition."""
    given = GivenTables(spark, "/root/testdata/sf0.001")
    scored = rfm.rfm_scores(given.transactions(categories=False), NOW)
    lines = executed(scored).splitlines()
    single = [n for n, line in enumerate(lines) if "SinglePartition" in line]
    # Only the sizes of the range partitions, one row each, and one partial count a task are gathered.
    below = [lines[n + 1] for n in single]
    assert below and all("HashAggregate" in b and "count(" in b for b in below)


def test_filters_and_columns_reach_the_scan(spark):
    given = GivenTables(spark, "/root/testdata/sf0.001")
    from tillstream.operators import anomalies

    plan = executed(anomalies.unusual_quantity(given.order_lines(), 45))
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "IsNotNull(l_orderkey)" in scan and "l_tax" not in scan and "l_shipdate" not in scan
    no_category = executed(given.transactions(categories=False))
    assert "lineitem.parquet" not in no_category


@pytest.fixture
def whole_plans(spark):
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "4000")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name, column", [
    ("sales_rows", "o_orderdate"), ("sales_totals", "o_orderdate"), ("revenue_series", "ts"), ("transaction_series", "ts"),
])
def test_time_ranges_reach_the_scan(spark, name, column, whole_plans):
    from registry.queries import all_queries

    plan = executed(all_queries()[name](spark, "/root/testdata/sf0.001"))
    table = "orders" if column == "o_orderdate" else "events"
    scan = next(line for line in plan.splitlines() if f"{table}.parquet" in line)
    assert f"GreaterThanOrEqual({column}" in scan and f"LessThanOrEqual({column}" in scan


@pytest.mark.parametrize("name", [
    "sales_summary_today", "sales_summary_week", "sales_summary_month", "revenue_24h", "transactions_24h", "dashboard"])
def test_times_of_the_last_event_reach_the_scan(spark, name, whole_plans):
    """The bound is a subquery, so the scan has it as a filter on the stored column."""
    from registry.queries import all_queries

    plan = executed(all_queries()[name](spark, "/root/testdata/sf0.001"))
    scans = [line for line in plan.splitlines() if "events.parquet" in line]
    assert any("ts#" in line and ">= " in line.partition("DataFilters")[2].partition("Format")[0] and "ubquery" in line
               for line in scans)


def test_json_is_parsed_once(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    plan = executed(events.parse_transactions(raw).events)
    assert plan.count("from_json") == 1


def test_adhoc_guard_walks_the_plan(spark):
    given = {"sales_rows": spark.range(3).withColumnRenamed("id", "x")}
    spark.range(7).createOrReplaceTempView("hidden")
    spark.range(9).createOrReplaceTempView("sales_rows")
    refused = [
        "SELECT 'CTE [hidden]' AS x, h.* FROM hidden h",
        "SELECT 'UnresolvedRelation [sales_rows]' AS x, (SELECT max(id) FROM hidden) AS y",
        "SELECT * FROM (WITH hidden AS (SELECT 1 AS id) SELECT * FROM hidden) t JOIN hidden USING (id)",
        "SELECT x FROM sales_rows WHERE x IN (SELECT id FROM hidden)",
        "SELECT x FROM sales_rows WHERE EXISTS (SELECT 1 FROM hidden)",
        "SELECT * FROM sales_rows, LATERAL (SELECT id FROM hidden)",
        "WITH a AS (SELECT * FROM hidden) SELECT * FROM a",
        "SELECT java_method('java.lang.System', 'getProperty', 'user.name') AS p",
        "SELECT x FROM sales_rows WHERE x = length(reflect('java.util.UUID', 'randomUUID'))",
        "SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`",
    ]
    for text in refused:
        with pytest.raises(PermissionError):
            serving.run_sql(spark, text, given)
    allowed = "WITH hidden AS (SELECT 5 AS id) SELECT count(*) AS n FROM sales_rows WHERE x < (SELECT max(id) FROM hidden)"
    assert serving.run_sql(spark, allowed, given).first().n == 3
    # The caller's own views are as they were.
    assert spark.table("sales_rows").count() == 9 and spark.table("hidden").count() == 7
    spark.catalog.dropTempView("hidden")
    spark.catalog.dropTempView("sales_rows")
