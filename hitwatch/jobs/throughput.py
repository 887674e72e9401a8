"""Topic throughput tables from a messages table or from Kafka.

    spark-submit hitwatch/jobs/throughput.py OUTPUT_DIR --messages DIR
    spark-submit --packages <kafka connector> hitwatch/jobs/throughput.py OUTPUT_DIR --topics a,b
    spark-submit hitwatch/jobs/throughput.py --live DIR --steps DIR --checkpoint DIR
    spark-submit hitwatch/jobs/throughput.py OUTPUT_DIR --steps DIR

Writes one parquet table per query below the output folder. With ``--steps`` it starts
from stored offset steps and reads no messages; with ``--follow DIR`` it writes such
steps from Kafka as messages come in, micro-batch by micro-batch, and nothing else; readers
of ``DIR`` see whole micro-batches only, and ``compact.py`` keeps its files few.
``--live DIR`` follows such steps and writes the increases of each topic partition over the last
minute as soon as a tick is closed. ``--topic`` and ``--partition`` choose series by whole patterns, ``--since`` and
``--until`` a range of time in epoch seconds.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from hitwatch.operators import throughput
from hitwatch.schema import ALERT_TOPIC, LOG_TOPIC, MESSAGE_SCHEMA, MONITORING_TOPIC, STEP_SCHEMA
from hitwatch.session import build_session, remove, work_dir
from hitwatch.sinks.ledger import listed, read_ledger, to_ledger
from hitwatch.sinks.streams import parquet_files
from hitwatch.sources.kafka import kafka_messages, kafka_stream
from hitwatch.streaming.lifecycle import until_any_ends
from hitwatch.streaming.queries import EVERY_TEN_SECONDS, start, start_steps
from hitwatch.streaming.rates import live_increases


def throughput_tables(
    steps: DataFrame, since: int | None = None, until: int | None = None, **labels: str
) -> dict[str, DataFrame]:
    """Every throughput query by name, all over one stored table of offset steps."""
    steps = throughput.matching(steps, **labels)
    first, last = throughput.covered_range(steps)
    tick = throughput.SCRAPE_SECONDS
    if since is not None:
        first = max(first, since - since % tick)
    if until is not None:
        last = min(last, until - until % tick)
    samples = throughput.offset_samples(steps, first, last)
    rates = throughput.rate_by_topic(samples)
    deltas = throughput.delta_by_topic(samples)
    consumers = throughput.delta_by_consumer(samples)
    alerts = throughput.matching(samples, topic=ALERT_TOPIC)
    return {
        "topic_offsets": samples,
        "alert_count_series": alerts,
        "topic_rate_1m": rates,
        "topic_rate_legend": throughput.legend(rates),
        "topic_delta_5m": deltas,
        "topic_delta_legend": throughput.legend(deltas),
        "consumer_delta_5m": consumers,
        "consumer_delta_legend": throughput.legend(consumers, ("consumergroup", "topic")),
        "partitions_per_topic": throughput.partitions_per_topic(steps),
        "topic_values": throughput.label_values(steps, "topic", throughput.INTERNAL_TOPICS),
        "new_alert_rule": throughput.new_message_rule(alerts),
        "alert_rule_spans": throughput.rule_spans(throughput.rule_states(alerts, first, last)),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("output", nargs="?", default="throughput")
    parser.add_argument("--messages", help="parquet folder of a messages table")
    parser.add_argument("--steps", help="parquet folder of offset steps")
    parser.add_argument("--follow", help="folder to write offset steps to, for as long as it runs")
    parser.add_argument("--live", help="folder to write increases to, for as long as it runs; needs --steps")
    parser.add_argument("--checkpoint", help="shared folder of the query behind --follow or --live")
    parser.add_argument("--topics", default=f"{LOG_TOPIC},{MONITORING_TOPIC},{ALERT_TOPIC}")
    parser.add_argument("--brokers", help="default: the environment's")
    parser.add_argument("--max-offsets-per-trigger", help="messages of a micro-batch, default all")
    parser.add_argument("--topic", default=".*", help="pattern of the topics shown")
    parser.add_argument("--partition", default=".*", help="pattern of the partitions shown")
    parser.add_argument("--since", type=int, help="first second shown")
    parser.add_argument("--until", type=int, help="last second shown")
    args = parser.parse_args(argv)
    if (args.follow or args.live) and not args.checkpoint:
        parser.error("--follow and --live need --checkpoint")
    if args.live and not args.steps:
        parser.error("--live needs --steps")

    spark = build_session("topic-throughput")
    try:
        if args.follow:
            limit = args.max_offsets_per_trigger
            options = {"maxOffsetsPerTrigger": limit} if limit else {}
            messages = kafka_stream(
                spark, args.topics, args.brokers, startingOffsets="earliest", **options
            )
            until_any_ends(spark, start_steps(messages, to_ledger(args.follow), args.checkpoint))
            return
        if args.live:
            # an attempt that does not count has the steps of the one that does, which are put
            # together by their maximum, and what compaction writes once more is late
            steps = spark.readStream.schema(STEP_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{args.steps}/data")
            rows = live_increases(steps)
            until_any_ends(spark, start(parquet_files(rows, args.live), args.checkpoint, EVERY_TEN_SECONDS))
            return
        own = None
        if args.steps:
            # parts of micro-batches or whole steps
            if listed(spark, args.steps):
                parts = read_ledger(spark, args.steps, STEP_SCHEMA)
            else:
                parts = spark.read.schema(STEP_SCHEMA).parquet(args.steps)
            steps = throughput.merged_steps(parts)
        else:
            if args.messages:
                messages = spark.read.schema(MESSAGE_SCHEMA).parquet(args.messages)
            else:
                messages = kafka_messages(spark, args.topics, args.brokers)
            own = work_dir(spark, "offset-steps")
            throughput.offset_steps(messages).write.parquet(own)
            steps = spark.read.schema(STEP_SCHEMA).parquet(own)
        tables = throughput_tables(
            steps, args.since, args.until, topic=args.topic, partition=args.partition
        )
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{args.output}/{name}")
        if own:
            remove(spark, own)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
