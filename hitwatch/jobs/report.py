"""Error-rate report of lines from a socket, one line every ten seconds.

    spark-submit hitwatch/jobs/report.py HOST PORT OUTPUT_DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse

from hitwatch.session import build_session, run_name
from hitwatch.sinks.batches import to_text
from hitwatch.sources.lines import socket_stream
from hitwatch.streaming.lifecycle import until_any_ends
from hitwatch.streaming.queries import start_report


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("host")
    parser.add_argument("port", type=int)
    parser.add_argument("output", help="folder for the report lines")
    parser.add_argument("--checkpoint", required=True, help="shared folder of this query")
    args = parser.parse_args(argv)

    spark = build_session("access-log-report")
    try:
        lines = socket_stream(spark, args.host, args.port)
        # a socket cannot be read again: every run has its own checkpoint and folder
        run = run_name()
        report = start_report(lines, to_text(f"{args.output}/{run}", files=1), f"{args.checkpoint}/{run}")
        until_any_ends(spark, report)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
