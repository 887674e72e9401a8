"""Compaction of a table that a job keeps micro-batch by micro-batch, such as the offset steps
of ``throughput.py --follow``.

    spark-submit hitwatch/jobs/compact.py ROOT [--schema DDL] [--kind parquet|text]

Puts the micro-batches of each day that is over into few files and deletes what has not
counted for ``--keep-seconds``. Run it once a day; readers go on meanwhile.
"""

from __future__ import annotations

import argparse

from hitwatch.schema import STEP_SCHEMA
from hitwatch.session import build_session
from hitwatch.sinks.ledger import KEEP_SECONDS, compact


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("root")
    parser.add_argument("--schema", default=f"{STEP_SCHEMA}, batch long", help="columns of the table")
    parser.add_argument("--kind", default="parquet", choices=("parquet", "text"))
    parser.add_argument("--keep-seconds", type=float, default=KEEP_SECONDS)
    args = parser.parse_args(argv)

    spark = build_session("compaction")
    try:
        print(f"{compact(spark, args.root, args.schema, args.kind, args.keep_seconds)} days put together")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
