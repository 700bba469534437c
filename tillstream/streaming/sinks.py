"""foreachBatch writers. Each may run again for the same batch id without changing the result."""

from __future__ import annotations

import math
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F

from tillstream.sources.tables import FIRST_RUN, TableStore, conform, jdbc_write_options, run_of

#: Stores a micro-batch, given its id and the name of the query's run.
Writer = Callable[[DataFrame, int, str], None]
ROWS_PER_FILE = 1_000_000


@contextmanager
def held(batch: DataFrame):
    """The batch persisted, with its number of rows.

    Otherwise counting and every write would run the micro-batch again, state included. Blocks may
    spill to local disk and are recomputed if an executor goes away.
    """
    kept = batch.persist()
    try:
        yield kept, kept.count()
    finally:
        kept.unpersist()


def _files(df: DataFrame, rows: int) -> DataFrame:
    """As many files as the rows fill; adaptive coalescing does not reach into streams."""
    return df.coalesce(math.ceil(rows / ROWS_PER_FILE))


def into_table(store: TableStore, name: str) -> Writer:
    """Every batch is one folder of the table, replaced as a whole on replay."""
    return fan_out({name: lambda batch: batch}, store)


def fan_out(routes: dict[str, Callable[[DataFrame], DataFrame]], store: TableStore) -> Writer:
    """Several tables from one micro-batch, which is read from the source and parsed once."""
    def write(batch: DataFrame, batch_id: int, run: str = FIRST_RUN) -> None:
        with held(batch) as (rows, count):
            if count:
                for name, select in routes.items():
                    store.put_batch(name, _files(select(rows), count), batch_id, run)
    return write


def into_jdbc(url: str, table: str, properties: dict[str, str], schema_name: str, query: str) -> Writer:
    """Append to a database table, each row marked with (query and its run, batch id).

    A replayed batch can so be told apart and removed; a database key on those columns plus the
    row key rejects it outright.
    """
    options = jdbc_write_options(url, table, properties)

    def write(batch: DataFrame, batch_id: int, run: str = FIRST_RUN) -> None:
        with held(batch) as (rows, count):
            if count:
                marked = conform(rows, schema_name).withColumns({
                    "source_query": F.lit(f"{query} {run}"), "batch_id": F.lit(batch_id).cast("bigint"),
                })
                marked.write.format("jdbc").mode("append").options(**options).save()
    return write


def start(
    df: DataFrame, writer: Writer, name: str, checkpoints: str, mode: str = "append",
    available_now: bool = False, every: str | None = None,
):
    """Start a named query with a checkpoint folder of its own, so that a restart resumes.

    `every` ("1 minute") spaces the micro-batches, and with them the files; by default one follows
    the other.
    """
    checkpoint = f"{checkpoints.rstrip('/')}/{name}"
    runs: list[str] = []

    def store(batch: DataFrame, batch_id: int) -> None:
        if not runs:
            runs.append(run_of(batch.sparkSession, checkpoint))
        writer(batch, batch_id, runs[0])

    query = df.writeStream.foreachBatch(store).queryName(name).outputMode(mode).option(
        "checkpointLocation", checkpoint)
    return _paced(query, available_now, every).start()


def _paced(query, available_now: bool, every: str | None):
    if available_now:
        return query.trigger(availableNow=True)
    return query.trigger(processingTime=every) if every else query


def into_files(
    df: DataFrame, form: str, folder: str, name: str, checkpoints: str,
    available_now: bool = False, every: str | None = None, by: tuple[str, ...] = (),
):
    """Append a stream to a folder of files, exactly once."""
    query = (
        df.writeStream.format(form).option("path", folder).partitionBy(*by).queryName(name)
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{name}").outputMode("append")
    )
    return _paced(query, available_now, every).start()


def to_console(df: DataFrame, name: str):
    """Print a stream while debugging."""
    return (
        df.writeStream.format("console").option("truncate", False).queryName(name)
        .outputMode("append").start()
    )
