"""Streaming writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from hitwatch.sources.kafka import kafka_options


def console(rows: DataFrame, mode: str) -> DataStreamWriter:
    """Untruncated console output; ``mode`` is ``append`` or ``update``."""
    return rows.writeStream.outputMode(mode).format("console").option("truncate", "false")


def text_files(rows: DataFrame, path: str) -> DataStreamWriter:
    """Exactly-once text files of a single text column."""
    return rows.writeStream.outputMode("append").format("text").option("path", path)


def parquet_files(rows: DataFrame, path: str) -> DataStreamWriter:
    return rows.writeStream.outputMode("append").format("parquet").option("path", path)


def kafka_topics(rows: DataFrame, brokers: str | None = None) -> DataStreamWriter:
    """To the topics named in the ``topic`` column.

    Producer settings: whole acknowledgement, five retries, small linger.
    """
    producer = {"acks": "all", "retries": 5, "linger.ms": 100, "batch.size": 16384}
    return (
        rows.writeStream.outputMode("append")
        .format("kafka")
        .options(**kafka_options(brokers))
        .options(**{f"kafka.{key}": str(value) for key, value in producer.items()})
    )
