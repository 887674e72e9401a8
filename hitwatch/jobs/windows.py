"""Sliding error windows of lines from a socket or a folder: alerts and metrics to the
console, errors as JSON and the URLs of each window to files. Console output passes the
driver, so rows without a bound go to files only. ``--top`` keeps the most frequent URLs of
closed windows in state of fixed size, and ``--late`` the errors that came too late for some of
their windows, next to the windows; the number of late rows is printed too.

    spark-submit hitwatch/jobs/windows.py --errors DIR --checkpoint DIR [--folder DIR]
    spark-submit hitwatch/jobs/windows.py --open CHECKPOINT/metrics

The second form shows, as JSON, the windows that are still open in the state of a query.
"""

from __future__ import annotations

import argparse

from hitwatch.operators.windows import flat_window
from hitwatch.session import build_session, run_name, state_partitions
from hitwatch.sinks.batches import to_parquet
from hitwatch.sinks.ledger import to_ledger
from hitwatch.sinks.streams import console, parquet_files, text_files
from hitwatch.sources.lines import line_file_stream, socket_stream
from hitwatch.streaming.lifecycle import until_any_ends
from hitwatch.streaming.progress import BatchLog
from hitwatch.streaming.queries import (
    EVERY_TEN_SECONDS,
    error_json,
    start,
    start_latest,
    start_windows_and_late,
    window_metrics,
    window_metrics_alerts,
    window_top_urls,
    window_urls,
)
from hitwatch.streaming.state import open_windows


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--host", default="localhost")
    parser.add_argument("--port", type=int, default=9999)
    parser.add_argument("--folder", help="read lines from files instead of a socket")
    parser.add_argument("--errors", help="folder for the JSON errors")
    parser.add_argument("--top", help="folder for the most frequent URLs of each window; left out without it")
    parser.add_argument("--late", help="folder for closed windows and late errors; left out without it")
    parser.add_argument("--open", help="show the open windows of the query with this checkpoint, and end")
    parser.add_argument("--urls", help="folder for the URLs of each window; left out without it")
    parser.add_argument("--checkpoint", help="shared folder, one below per query")
    parser.add_argument("--state-partitions", type=int, help="fixed by the first checkpoint")
    parser.add_argument("--max-files-per-trigger", type=int, help="files of a micro-batch")
    args = parser.parse_args(argv)
    if not args.open and not (args.errors and args.checkpoint):
        parser.error("--errors and --checkpoint are needed")

    spark = build_session("access-log-windows")
    try:
        if args.open:
            shown = flat_window(open_windows(spark, args.open)).orderBy("window_start", "status")
            for text in shown.toJSON().toLocalIterator():
                print(text)
            return
        spark.streams.addListener(BatchLog(print))
        if args.folder:
            lines = line_file_stream(spark, args.folder, args.max_files_per_trigger)
        else:
            lines = socket_stream(spark, args.host, args.port)
        # a socket cannot be read again, so its queries never resume an older run
        run = "" if args.folder else f"/{run_name()}"

        def below(name: str) -> str:
            return f"{args.checkpoint}{run}/{name}"

        every = EVERY_TEN_SECONDS
        with state_partitions(spark, args.state_partitions):
            queries = [
                start(console(window_metrics_alerts(lines), "append"), below("alerts"), every),
                start(text_files(error_json(lines), f"{args.errors}{run}"), below("errors"), every),
                start(console(window_metrics(lines), "update"), below("metrics"), every),
            ]
            if args.urls:
                deliver = to_parquet(f"{args.urls}{run}")
                urls = flat_window(window_urls(lines))
                queries.append(start_latest(urls, deliver, below("urls"), every))
            if args.top:
                rows = flat_window(window_top_urls(lines))
                queries.append(start(parquet_files(rows, f"{args.top}{run}"), below("top"), every))
            if args.late:
                windows, late = (to_ledger(f"{args.late}{run}/{name}") for name in ("windows", "errors"))
                queries.append(start_windows_and_late(lines, windows, late, below("late"), every))
        until_any_ends(spark, *queries)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
