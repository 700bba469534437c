"""Progress reports of streaming queries, kept as a table, and the topic counts that follow from them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tillstream.functions.exact import ratio
from tillstream.operators.metrics import offsets_from_progress
from tillstream.schemas import TABLES
from tillstream.sources.tables import TableStore

_TABLE = "query_progress"


class ProgressCollector(StreamingQueryListener):
    """Writes a small file for each report into the store, named by query, run and batch.

    It runs no Spark job, so it can't wait for the queries it listens to. A batch that is reported again
    replaces its file; reports of batches without a source, of idle triggers, have no rows and add nothing.
    """

    def __init__(self, store: TableStore):
        super().__init__()
        self.spark, self.folder = store.spark, store.path(_TABLE)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        report = event.progress
        row = {"query": report.name, "run": str(report.runId), "batch": report.batchId, "timestamp": report.timestamp,
               "input_rows": sum(s.numInputRows for s in report.sources), "value": report.json}
        if row["input_rows"]:
            self._put(f"{report.id}-{report.batchId}.json", json.dumps(row))

    def _put(self, name: str, text: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()


def collect_progress(spark: SparkSession, store: TableStore) -> ProgressCollector:
    """Listens to all queries of the session from now on; take it off with `spark.streams.removeListener`."""
    collector = ProgressCollector(store)
    spark.streams.addListener(collector)
    return collector


def reports(store: TableStore) -> DataFrame:
    """All reports so far, one a query and batch."""
    if not store.exists(_TABLE):
        return store.spark.createDataFrame([], TABLES[_TABLE])
    return store.spark.read.schema(TABLES[_TABLE]).json(store.path(_TABLE))


def query_rates(found: DataFrame) -> DataFrame:
    """query, event_count, rate, timestamp of each batch: rows read, and rows a second since the query's last report."""
    before = Window.partitionBy("query").orderBy("timestamp", "batch")
    elapsed = F.unix_millis("timestamp") - F.unix_millis(F.lag("timestamp").over(before))
    return found.select("query", F.col("input_rows").alias("event_count"), elapsed.alias("elapsed"), "timestamp").select(
        "query", "event_count", F.coalesce(ratio(F.col("event_count") * 1000, F.col("elapsed")), F.lit(0.0)).alias("rate"), "timestamp")


def topic_offsets(found: DataFrame) -> DataFrame:
    """The topics' end offsets in the reports, as `metrics.topic_rates` takes them."""
    return offsets_from_progress(found.select("value"))
