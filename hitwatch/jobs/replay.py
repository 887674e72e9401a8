"""Send the access log derived from an events table to Kafka: each line to the log
topic and each record as JSON to the monitoring topic.

    spark-submit --packages <kafka connector> hitwatch/jobs/replay.py TABLES --checkpoint DIR
"""

from __future__ import annotations

import argparse

from hitwatch.operators.records import fan_out
from hitwatch.schema import LOG_TOPIC
from hitwatch.session import build_session
from hitwatch.sinks.streams import kafka_topics
from hitwatch.sources.derived import access_log_records
from hitwatch.sources.lines import table_stream
from hitwatch.streaming.lifecycle import until_done
from hitwatch.streaming.queries import start


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("tables", help="folder that holds events.parquet")
    parser.add_argument("--topic", default=LOG_TOPIC)
    parser.add_argument("--brokers", help="default: the environment's")
    parser.add_argument("--checkpoint", required=True, help="shared folder of this query")
    args = parser.parse_args(argv)

    spark = build_session("access-log-replay")
    try:
        messages = fan_out(access_log_records(table_stream(spark, args.tables, "events")), args.topic)
        writer = kafka_topics(messages, args.brokers)
        until_done(start(writer, args.checkpoint, {"availableNow": True}))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
