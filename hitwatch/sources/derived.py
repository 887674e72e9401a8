"""Access logs and topic messages derived from an ``events`` table.

Every event becomes one request, by arithmetic on its own columns only: no order
and no other row is needed, so the derivation is a projection at any size, batch
or streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitwatch.functions.log_line import log_line, log_time_text
from hitwatch.functions.times import iso_text
from hitwatch.operators.alerts import error_rate_alerts
from hitwatch.operators.parse import parse_access_log
from hitwatch.operators.records import alerts_as_json, fan_out
from hitwatch.schema import ALERT_TOPIC

# What requests can look like.
URLS = [
    "/index.html", "/login", "/logout", "/products", "/cart", "/api/data", "/images/logo.png",
    "/search", "/checkout", "/user/profile", "/admin/dashboard", "/help", "/home",
    "/product/chaussette1", "/product/chaussette2", "/product/chaussette3", "/signup",
    "/contact", "/about",
]
METHODS = ["GET", "POST", "PUT", "DELETE"]
GOOD_STATUS = [200, 201, 301, 302]
ERROR_STATUS = [400, 401, 403, 404, 500, 502, 503]
SHORT_FORM_HOST = "http://localhost"
SHORT_FORM_URLS = [
    "/home", "/product/chaussette1", "/product/chaussette2", "/cart", "/login", "/signup",
    "/checkout",
]

# Shape of the derived log.
LINES_PER_BATCH = 200
LINES_PER_SECOND = 50
FIRST_SECOND = 1704067200  # 2024-01-01 00:00:00 UTC
RISKY_URLS = 3
LOG_TOPIC_PARTITIONS = 4
BATCHES_PER_BLOCK = 10_000


def _pick(values: list, index: Column) -> Column:
    listed = F.expr(f"array({', '.join(map(repr, values))})")
    return F.element_at(listed, (index % len(values) + 1).cast("int"))


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def arrival_second(event_id: Column) -> Column:
    return F.lit(FIRST_SECOND) + _div(event_id, LINES_PER_SECOND)


def access_log_records(events: DataFrame) -> DataFrame:
    """Structured requests with their rendered ``line``.

    Some lines are broken on purpose: unreadable, with an impossible date, or with
    a protocol version the parser does not accept.
    """
    event_id, user_id = F.col("event_id"), F.col("user_id")
    fails = (F.col("event_type") == "error") & (
        (event_id % len(URLS) < RISKY_URLS) | (user_id % 10 == 0)
    )
    records = events.select(
        "event_id",
        _div(event_id, LINES_PER_BATCH).alias("batch_id"),
        F.timestamp_seconds(arrival_second(event_id)).alias("arrived"),
        F.concat(F.lit("192.168.10."), (user_id % 254 + 1).cast("string")).alias("ip"),
        _pick(METHODS, event_id).alias("method"),
        _pick(URLS, event_id).alias("url"),
        F.when(fails, _pick(ERROR_STATUS, event_id))
        .otherwise(_pick(GOOD_STATUS, event_id))
        .alias("status"),
        (F.lit(200) + event_id * 7919 % 4801).cast("int").alias("size"),
    ).withColumn("timestamp", log_time_text(F.col("arrived")))
    shown_time = F.when(
        event_id % 101 == 0, F.concat(F.lit("99"), F.substring("timestamp", 3, 64))
    ).otherwise(F.col("timestamp"))
    protocol = F.when(event_id % 89 == 0, F.lit("HTTP/2")).otherwise(F.lit("HTTP/1.1"))
    line = F.when(
        event_id % 97 == 0, F.concat(F.lit("malformed "), event_id.cast("string"))
    ).otherwise(
        log_line(
            F.col("ip"), shown_time, F.col("method"), F.col("url"), F.col("status"),
            F.col("size"), protocol,
        )
    )
    return records.withColumn("line", line)


def access_log_lines(events: DataFrame) -> DataFrame:
    """``event_id, batch_id, timestamp`` (arrival) and the line as ``value``."""
    return access_log_records(events).select(
        "event_id", "batch_id", F.col("arrived").alias("timestamp"), F.col("line").alias("value")
    )


def short_log_lines(events: DataFrame) -> DataFrame:
    """``event_id`` and ``value``: lines without size, any address, any status."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    octets = [(user_id * factor + event_id) % 256 for factor in (1, 3, 5, 7)]
    return events.select(
        "event_id",
        log_line(
            F.concat_ws(".", *[octet.cast("string") for octet in octets]),
            log_time_text(F.timestamp_seconds(arrival_second(event_id))),
            _pick(METHODS, event_id),
            F.concat(F.lit(SHORT_FORM_HOST), _pick(SHORT_FORM_URLS, event_id)),
            _pick(GOOD_STATUS + ERROR_STATUS, event_id),
        ).alias("value"),
    )


def log_messages(events: DataFrame, partitions: int = LOG_TOPIC_PARTITIONS) -> DataFrame:
    """Messages of the log topic and its monitoring twin.

    Event numbers run on from 0, so partition and offset follow from them.
    """
    records = access_log_records(events).select(
        F.col("event_id").alias("id"), "arrived", "ip", "timestamp", "method", "url", "status",
        "size", "line",
    )
    return fan_out(records, keep=["id", "arrived"]).select(
        "topic",
        (F.col("id") % partitions).cast("int").alias("partition"),
        _div(F.col("id"), partitions).alias("offset"),
        F.col("arrived").alias("timestamp"),
        "value",
    )


def with_exporters(rows: DataFrame) -> DataFrame:
    """Adds ``job`` and ``instance``: log topics are scraped by two exporters that share
    the partitions, alerts by a job of their own."""
    alerts = F.col("topic") == ALERT_TOPIC
    return rows.withColumn(
        "job", F.concat(F.lit("kafka-exporter"), F.when(alerts, F.lit("-alerts")).otherwise(F.lit("")))
    ).withColumn(
        "instance",
        F.concat(F.lit("kafka-exporter-"), (F.col("partition") % 2).cast("string"), F.lit(":9308")),
    )


def spread_lines(lines: DataFrame, files: int) -> DataFrame:
    """The lines in so many partitions, each with whole batches."""
    return lines.repartition(files, "batch_id")


def batch_end(batch_id: Column) -> Column:
    """Arrival time of the last line of a batch."""
    last_event = batch_id * LINES_PER_BATCH + (LINES_PER_BATCH - 1)
    return F.timestamp_seconds(arrival_second(last_event))


def batch_alerts(events: DataFrame) -> DataFrame:
    """Alerts of every batch of the log, raised at the batch's end."""
    parsed = parse_access_log(access_log_lines(events), keep=["batch_id"])
    batch_id = F.col("batch_id")
    return error_rate_alerts(parsed, batch_id, iso_text(batch_end(batch_id)), keys=["batch_id"])


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Messages of the alert topic: one partition, offsets in order of batch, then
    global, URL and client alerts.

    Numbering goes in two steps. Alerts are numbered inside blocks of batches, and
    each block starts where the blocks before it end; only the block sizes, one row
    per ten thousand batches, are ever in a single task. ``alerts`` is used twice.
    """
    rank = F.when(F.col("url").isNotNull(), 1).when(F.col("ip").isNotNull(), 2).otherwise(0)
    blocks = alerts_as_json(
        alerts, keep=["batch_id", rank.alias("rank"), "url", "ip"]
    ).withColumn("block", _div(F.col("batch_id"), BATCHES_PER_BLOCK))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.groupBy("block")
        .agg(F.count(F.lit(1)).alias("size"))
        .select("block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("block").orderBy("batch_id", "rank", "url", "ip")
    return (
        blocks.withColumn("number", F.row_number().over(inside) - 1)
        .join(starts, "block")
        .select(
            F.lit(ALERT_TOPIC).alias("topic"),
            F.lit(0).alias("partition"),
            (F.col("start") + F.col("number")).alias("offset"),
            batch_end(F.col("batch_id")).alias("timestamp"),
            "value",
        )
    )
