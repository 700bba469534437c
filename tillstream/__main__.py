"""Run a job: python -m tillstream stream transactions ... | python -m tillstream batch all ..."""

from __future__ import annotations

import argparse
from datetime import date, datetime

from tillstream.plans import batch
from tillstream.session import build_session
from tillstream.settings import SalesWindows
from tillstream.sources import events
from tillstream.sources.tables import TableStore
from tillstream.streaming import jobs

STREAMS = {
    "transactions": (jobs.monitor_transactions, "transactions"),
    "inventory": (jobs.track_inventory, "transactions"),
    "stock": (jobs.keep_stock, "transactions"),
    "sessions": (jobs.analyze_sessions, "cart_events"),
    "views": (jobs.watch_views, "product_views"),
}
BATCHES = {
    "close-stock": lambda a, src, dst: jobs.close_stock(src, a.as_of.date()),
    "snapshots": lambda a, src, dst: batch.run_snapshots(src, dst, a.as_of),
    "etl": lambda a, src, dst: batch.run_etl(src, dst, a.as_of, since=a.since, windows=_windows(a)),
    "etl-changes": lambda a, src, dst: batch.run_etl_of_changes(src, dst, a.as_of, windows=_windows(a)),
    "compact-sessions": lambda a, src, dst: jobs.compact_sessions(src),
    "rfm": lambda a, src, dst: batch.run_rfm(src, dst, a.as_of).show(),
    "categories": lambda a, src, dst: batch.run_category_performance(dst, a.as_of),
    "trends": lambda a, src, dst: batch.run_trends(dst, a.as_of),
    "all": lambda a, src, dst: batch.run_all(src, dst, a.as_of, windows=_windows(a)),
}
PARSERS = {
    "transactions": events.parse_transactions, "inventory": events.parse_transactions,
    "stock": events.parse_transactions,
    "sessions": events.parse_cart_events, "views": events.parse_product_views,
}


def _windows(given: argparse.Namespace) -> SalesWindows:
    return SalesWindows(length=given.window, slide=given.slide)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillstream")
    kinds = parser.add_subparsers(dest="kind", required=True)
    stream = kinds.add_parser("stream", help="run a streaming job until stopped")
    stream.add_argument("job", choices=STREAMS)
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--folder", help="folder of JSON lines")
    stream.add_argument("--starting", default="latest", help="where a new Kafka query starts: latest, earliest or JSON")
    stream.add_argument("--most-per-batch", help="Kafka records in a micro-batch at most")
    stream.add_argument("--dead-letters", help="folder for the lines that can't be read")
    stream.add_argument("--archive", help="folder for a copy of all lines, by day")
    stream.add_argument("--tables", required=True, help="root folder of the result tables")
    stream.add_argument("--checkpoints", required=True)
    stream.add_argument("--every", help='time between micro-batches, such as "1 minute"')
    stream.add_argument("--available-now", action="store_true", help="stop when all input is read")
    tables = kinds.add_parser("batch", help="run a batch job once")
    tables.add_argument("job", choices=BATCHES)
    tables.add_argument("--source", required=True, help="root folder of the operational tables")
    tables.add_argument("--target", required=True, help="root folder of the warehouse")
    tables.add_argument("--as-of", type=datetime.fromisoformat, required=True)
    tables.add_argument("--window", default=SalesWindows.length, help="window of the stored sales")
    tables.add_argument("--slide", default=SalesWindows.slide, help="slide of the stored sales")
    tables.add_argument("--since", type=date.fromisoformat, help="etl: replace only days from here on")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    given = arguments(argv)
    spark = build_session(f"tillstream-{given.job}")
    if given.kind == "batch":
        BATCHES[given.job](given, TableStore(spark, given.source), TableStore(spark, given.target))
        return
    start, topic = STREAMS[given.job]
    if given.servers:
        rate = {"maxOffsetsPerTrigger": given.most_per_batch} if given.most_per_batch else {}
        raw = events.topic_stream(spark, events.kafka_options(given.servers, topic, given.starting, **rate))
    else:
        raw = events.file_stream(spark, given.folder)
    pace = {"available_now": given.available_now, "every": given.every}
    queries = start(raw, TableStore(spark, given.tables), given.checkpoints, **pace)
    if given.archive:
        queries.append(jobs.archive_raw(raw, given.archive, given.checkpoints, **pace))
    if given.dead_letters:
        dead = PARSERS[given.job](raw).dead_letters
        queries.append(jobs.keep_dead_letters(dead, given.dead_letters, given.checkpoints, **pace))
    if given.available_now:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
