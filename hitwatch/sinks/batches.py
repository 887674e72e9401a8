"""Delivery of one micro-batch.

Spark may run a micro-batch again after a failure. The file deliveries give each
batch its own folder and replace it, so that a second run leaves one copy; Kafka
keeps both, and readers drop repeats with ``first_deliveries``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from hitwatch.sources.kafka import kafka_options

Deliver = Callable[[DataFrame, int], None]


def to_kafka(topic: str | None, brokers: str | None = None) -> Deliver:
    """Append ``value`` rows to ``topic``, or where their ``topic`` column says."""

    def deliver(rows: DataFrame, batch_id: int) -> None:
        writer = rows.write.format("kafka").options(**kafka_options(brokers))
        if topic:
            writer = writer.option("topic", topic)
        writer.mode("append").save()

    return deliver


def to_text(path: str, files: int | None = None) -> Deliver:
    """Lines of the single text column below ``path``, in at most ``files`` files a batch."""

    def deliver(rows: DataFrame, batch_id: int) -> None:
        (rows.coalesce(files) if files else rows).write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return deliver


def to_parquet(path: str) -> Deliver:
    def deliver(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return deliver
