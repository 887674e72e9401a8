"""Alerts from a Kafka topic to a Kafka topic.

    spark-submit --packages <kafka connector> hitwatch/jobs/alerts.py --checkpoint DIR [--by-time]

With ``--by-time`` alerts are counted by spans of event time instead of micro-batches.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from hitwatch.operators.records import alerts_as_json
from hitwatch.schema import ALERT_TOPIC, LOG_TOPIC, Thresholds
from hitwatch.session import build_session
from hitwatch.sinks.batches import to_kafka
from hitwatch.sinks.streams import kafka_topics
from hitwatch.sources.kafka import kafka_stream
from hitwatch.streaming.lifecycle import until_any_ends
from hitwatch.streaming.progress import BatchLog
from hitwatch.streaming.queries import start, start_alerts, timed_alerts


def main(argv: list[str] | None = None) -> None:
    normal = Thresholds()
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--brokers", help="default: the environment's")
    parser.add_argument("--topic", default=LOG_TOPIC)
    parser.add_argument("--alert-topic", default=ALERT_TOPIC)
    parser.add_argument("--checkpoint", required=True, help="shared folder of this query")
    parser.add_argument("--min-partitions", help="scan tasks per batch, default one per partition")
    parser.add_argument("--max-offsets-per-trigger", help="messages of a micro-batch, default all")
    parser.add_argument("--global-rate", type=float, default=normal.everything)
    parser.add_argument("--url-rate", type=float, default=normal.url)
    parser.add_argument("--ip-rate", type=float, default=normal.ip)
    parser.add_argument("--by-time", action="store_true", help="alerts by spans of event time")
    args = parser.parse_args(argv)

    spark = build_session("access-log-alerts")
    try:
        spark.streams.addListener(BatchLog(print))
        given = {
            "minPartitions": args.min_partitions, "maxOffsetsPerTrigger": args.max_offsets_per_trigger
        }
        options = {name: value for name, value in given.items() if value}
        lines = kafka_stream(spark, args.topic, args.brokers, **options)
        thresholds = Thresholds(args.global_rate, args.url_rate, args.ip_rate)
        if args.by_time:
            messages = alerts_as_json(timed_alerts(lines, thresholds)).withColumn("topic", F.lit(args.alert_topic))
            query = start(kafka_topics(messages, args.brokers), args.checkpoint, None)
        else:
            query = start_alerts(lines, to_kafka(args.alert_topic, args.brokers), args.checkpoint, thresholds)
        until_any_ends(spark, query)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
