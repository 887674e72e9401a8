"""Rows to JSON messages and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitwatch.schema import ALERT_SCHEMA, LOG_TOPIC, MONITORING_TOPIC

ALERT_COLUMNS = [field.strip().split(" ")[0] for field in ALERT_SCHEMA.split(",")]


def rows_as_json(rows: DataFrame, columns: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """One JSON text per row in ``value``; nulls leave their key out."""
    return rows.select(*keep, F.to_json(F.struct(*(columns or rows.columns))).alias("value"))


def alerts_as_json(alerts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Alert messages: ``url`` and ``ip`` appear only in alerts of that kind."""
    return rows_as_json(alerts, ALERT_COLUMNS, keep)


def alerts_from_json(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Alert columns from JSON messages.

    Unfolded rather than selected field by field: Spark moves a selection below a
    limit, and would then sort all messages to find the latest few.
    """
    record = F.from_json(F.col("value").cast("string"), ALERT_SCHEMA)
    return messages.select(*keep, F.inline(F.array(record)))


def fan_out(records: DataFrame, topic: str = LOG_TOPIC, keep: Sequence[str] = ()) -> DataFrame:
    """Each record twice: its line to the topic, its JSON to the monitoring topic.

    ``records`` holds ``line`` and the monitoring fields. Only topic names are
    multiplied, so the texts are rendered above the expansion and fall away from
    plans that do not use them. A Kafka sink routes rows by the ``topic`` column.
    """
    monitoring = MONITORING_TOPIC if topic == LOG_TOPIC else f"{topic}-monitoring"
    record = F.struct("ip", "timestamp", "method", "url", "status", "size")
    return records.withColumn("topic", F.explode(F.array(F.lit(topic), F.lit(monitoring)))).select(
        *keep,
        "topic",
        F.when(F.col("topic") == topic, F.col("line")).otherwise(F.to_json(record)).alias("value"),
    )
