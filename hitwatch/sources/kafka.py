"""Kafka connection options and scans. The connector jar must be on the class path."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Environment names and defaults of the monitored deployment.
BROKERS_ENV, DEFAULT_BROKERS = "KAFKA_BROKER", "kafka:9093"
PROTOCOL_ENV, DEFAULT_PROTOCOL = "KAFKA_SECURITY_PROTOCOL", "PLAINTEXT"
STORES = ("truststore", "keystore")


def kafka_options(
    brokers: str | None = None, environ: Mapping[str, str] = os.environ
) -> dict[str, str]:
    """Connection options for reading and writing.

    TLS settings apply only when the protocol is not ``PLAINTEXT``, and a store only
    when both its location and its password are given.
    """
    options = {"kafka.bootstrap.servers": brokers or environ.get(BROKERS_ENV, DEFAULT_BROKERS)}
    protocol = environ.get(PROTOCOL_ENV, DEFAULT_PROTOCOL)
    if protocol == DEFAULT_PROTOCOL:
        return options
    options["kafka.security.protocol"] = protocol
    for store in STORES:
        given = {
            part: environ.get(f"KAFKA_SSL_{store.upper()}_{part.upper()}")
            for part in ("location", "password")
        }
        if all(given.values()):
            options.update({f"kafka.ssl.{store}.{part}": v for part, v in given.items()})
    return options


def kafka_stream(
    spark: SparkSession, topic: str, brokers: str | None = None, **options: object
) -> DataFrame:
    """Unbounded scan of a topic, from its end unless ``startingOffsets`` is given.

    ``minPartitions`` splits a topic with few partitions over more tasks and
    ``maxOffsetsPerTrigger`` bounds a micro-batch when catching up.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(brokers))
    return reader.option("subscribe", topic).options(**options).load()


def kafka_messages(
    spark: SparkSession, topics: str, brokers: str | None = None, **options: object
) -> DataFrame:
    """Everything the topics hold now, as a messages table."""
    reader = spark.read.format("kafka").options(**kafka_options(brokers))
    return reader.option("subscribe", topics).options(**options).load()
