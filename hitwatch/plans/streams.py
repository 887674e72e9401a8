"""Streaming queries run to the end of the ``events`` table.

The table is read as a stream, and the output files of the query are the result. Checkpoints
and outputs go to a fresh folder below the session's shared one.

Queries with a watermark take the table in order of time, part after part, as described in
:mod:`hitwatch.plans.replay`; the others take its files as they are and stop by themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from hitwatch.operators.alerts import first_alerts
from hitwatch.operators.records import alerts_as_json, alerts_from_json
from hitwatch.operators.throughput import merged_steps, offset_steps
from hitwatch.operators.windows import flat_window
from hitwatch.plans import batch, replay
from hitwatch.plans.batch import Query, checked_counts, in_utc, plain
from hitwatch.schema import ALERT_SCHEMA, STEP_SCHEMA
from hitwatch.session import make_folder, work_dir
from hitwatch.sinks.ledger import read_ledger, to_ledger
from hitwatch.sinks.streams import parquet_files, text_files
from hitwatch.sources import derived
from hitwatch.sources.lines import table, table_stream
from hitwatch.streaming import queries
from hitwatch.streaming.lifecycle import until_done
from hitwatch.streaming.rates import CHANGES, live_increases, rates_of
from hitwatch.streaming.state import open_windows

TO_THE_END = {"availableNow": True}
#: Files of a table that make up a micro-batch.
FILES_PER_TRIGGER = 64
#: Files that the lines of the per-batch queries land in, and those of a micro-batch.
LANDED_FILES, LANDED_PER_TRIGGER = 8, 2
#: Batches whose alerts are delivered together, and then once more, an hour later.
BATCHES_PER_DELIVERY, REDELIVERED_AFTER = 10_000, "1 hour"
#: One line in so many is delivered so many seconds late; lines are delivered every so often.
LATE_ONE_IN, LATE_BY, DELIVERED_EVERY = 53, 150, 100
LATE_SCHEMA = "ip string, timestamp timestamp, method string, url string, status int, windows_missed int"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table_stream(spark, folder, "events", FILES_PER_TRIGGER)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return derived.access_log_lines(_events(spark, folder))


def _landed(spark: SparkSession, folder: str, at: str) -> DataFrame:
    """The lines as a stream of several micro-batches, with whole batches in each."""
    lines = derived.access_log_lines(table(spark, folder, "events"))
    derived.spread_lines(lines, LANDED_FILES).write.parquet(f"{at}/lines.parquet")
    return table_stream(spark, at, "lines", LANDED_PER_TRIGGER)


def _in_order(
    spark: SparkSession, folder: str, at: str, start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Runs a query over the lines in order of time."""
    lines = derived.access_log_lines(table(spark, folder, "events"))
    # the hash deals out the lines of one crowded moment
    replay.land_by_range(
        lines.select("value", "timestamp", "event_id"), at, replay.ROWS_PER_PART, "timestamp", F.xxhash64("event_id")
    )
    replay.feed(spark, at, "value string", start)


def _output(spark: SparkSession, at: str, schema: StructType | str) -> DataFrame:
    """What a query has written; nothing if it saw no rows at all."""
    make_folder(spark, at)
    read = spark.read.schema(schema).parquet(at)
    names = schema.names if isinstance(schema, StructType) else [part.split()[0] for part in schema.split(",")]
    return read.select(*names)


def _appended(
    spark: SparkSession, folder: str, at: str, rows: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Everything that ``rows`` of the lines emits in append mode."""
    def start(lines: DataFrame) -> StreamingQuery:
        return queries.start(parquet_files(rows(lines), f"{at}/out"), f"{at}/checkpoint", None)

    _in_order(spark, folder, at, start)
    return _output(spark, f"{at}/out", rows(_lines(spark, folder)).schema)


def _closed_windows(
    spark: SparkSession, folder: str, windows: Callable[[DataFrame], DataFrame], purpose: str
) -> DataFrame:
    at = work_dir(spark, purpose)
    return plain(_appended(spark, folder, at, lambda lines: flat_window(windows(lines))))


def _checked(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Windows of a stream, whose clients are counted by a sketch, held against exact counts."""
    return plain(checked_counts(rows, batch._errors(spark, folder)))


def stream_error_windows_append(spark: SparkSession, folder: str) -> DataFrame:
    """Closed windows; the approximate client count streams keep is held against the exact."""
    at = work_dir(spark, "windows")
    rows = _appended(spark, folder, at, lambda lines: flat_window(queries.window_metrics(lines)))
    return _checked(spark, folder, rows)


def stream_open_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows that append mode has not shown when the log ends, from the state of the query."""
    at = work_dir(spark, "open-windows")
    _appended(spark, folder, at, lambda lines: flat_window(queries.window_metrics(lines)))
    return plain(flat_window(open_windows(spark, f"{at}/checkpoint")))


def stream_window_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Closed windows with too many errors; the approximate column is left out."""
    alerts = _closed_windows(spark, folder, queries.window_metrics_alerts, "window-alerts")
    return alerts.drop("count_distinct_ip")


def stream_error_window_urls(spark: SparkSession, folder: str) -> DataFrame:
    return _closed_windows(spark, folder, queries.window_urls, "window-urls")


def stream_window_top_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent URLs of the closed windows."""
    return _closed_windows(spark, folder, queries.window_top_urls, "window-top-urls")


def stream_alerts_by_time(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of the closed spans of event time."""
    return _appended(spark, folder, work_dir(spark, "timed-alerts"), queries.timed_alerts)


def stream_window_alert_urls(spark: SparkSession, folder: str) -> DataFrame:
    """URLs of the closed windows with too many errors."""
    at = work_dir(spark, "window-alert-urls")
    _in_order(spark, folder, at, lambda lines: queries.start_alert_urls(
        lines, to_ledger(f"{at}/out"), f"{at}/checkpoint", None
    ))
    schema = flat_window(queries.window_urls(_lines(spark, folder))).schema
    return plain(read_ledger(spark, f"{at}/out", schema))


def stream_error_windows_update(spark: SparkSession, folder: str) -> DataFrame:
    """Newest counts of every window, in update mode, held against exact ones: open windows are
    included."""
    at = work_dir(spark, "window-updates")
    _in_order(spark, folder, at, lambda lines: queries.start_latest(
        flat_window(queries.window_metrics(lines)), to_ledger(f"{at}/out"), f"{at}/checkpoint", None
    ))
    schema = flat_window(queries.window_metrics(_lines(spark, folder))).schema.add("batch", LongType())
    updates = read_ledger(spark, f"{at}/out", schema)
    newest = updates.groupBy("window_start", "window_end", "status").agg(
        F.max_by(F.struct("count_error", "count_distinct_ip"), "batch").alias("newest")
    ).select("window_start", "window_end", "status", "newest.*")
    return _checked(spark, folder, newest)


def stream_late_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Errors that came too late for some of their windows, where one line in a number is
    delivered late. A micro-batch holds many deliveries, each with all of its lines."""
    at = work_dir(spark, "late-errors")
    lines = derived.access_log_lines(table(spark, folder, "events"))
    second = F.unix_seconds("timestamp") - derived.FIRST_SECOND
    late = F.when(F.col("event_id") % LATE_ONE_IN == 0, LATE_BY).otherwise(0)
    delivery = F.floor((second + late) / DELIVERED_EVERY).alias("delivery")
    # ranges do not part what has the same number
    replay.land_by_range(lines.select("value", delivery), at, replay.ROWS_PER_PART, "delivery")
    replay.feed(spark, at, "value string, delivery long", lambda stream: queries.start_windows_and_late(
        stream, to_ledger(f"{at}/windows"), to_ledger(f"{at}/late"), f"{at}/checkpoint", None, delivery="delivery"
    ))
    return plain(read_ledger(spark, f"{at}/late", LATE_SCHEMA))


def stream_errors_json(spark: SparkSession, folder: str) -> DataFrame:
    at = work_dir(spark, "errors")
    writer = text_files(queries.error_json(_lines(spark, folder)), f"{at}/out")
    until_done(queries.start(writer, f"{at}/checkpoint", TO_THE_END))
    return spark.read.schema("value string").text(f"{at}/out")


def stream_offset_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Offset steps of the log topics, kept up to date by a stream."""
    at = work_dir(spark, "offset-steps")
    messages = derived.log_messages(_events(spark, folder))
    until_done(queries.start_steps(messages, to_ledger(f"{at}/out"), f"{at}/checkpoint", TO_THE_END))
    return merged_steps(read_ledger(spark, f"{at}/out", STEP_SCHEMA)).drop("opened")


def stream_topic_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of the log topics at the ticks that the watermark has passed, kept up to date by
    a stream of their offset steps."""
    at = work_dir(spark, "topic-rate")
    steps = offset_steps(derived.log_messages(table(spark, folder, "events")))
    replay.land_by_range(steps, at, replay.ROWS_PER_PART, "tick", "topic", "partition")
    replay.feed(spark, at, STEP_SCHEMA, lambda stream: queries.start(
        parquet_files(live_increases(stream), f"{at}/out"), f"{at}/checkpoint", None
    ))
    return rates_of(_output(spark, f"{at}/out", CHANGES))


def stream_alerts_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts that are delivered twice, the second time an hour later, without the repeats."""
    at = work_dir(spark, "alerts-dedup")
    alerts = derived.batch_alerts(table(spark, folder, "events"))
    again = F.to_timestamp("timestamp") + F.expr(f"interval {REDELIVERED_AFTER}")
    times = F.array("timestamp", F.date_format(again, "yyyy-MM-dd'T'HH:mm:ss"))
    delivered = alerts.select("*", F.posexplode(times).alias("copy", "raised")).withColumn("timestamp", F.col("raised"))
    messages = alerts_as_json(delivered, keep=["batch_id", "copy"])
    turn = F.floor(F.col("batch_id") / BATCHES_PER_DELIVERY) * 2 + F.col("copy")
    replay.land_by_number(messages, at, turn)
    replay.feed(spark, at, "value string", lambda stream: queries.start(
        parquet_files(first_alerts(alerts_from_json(stream)), f"{at}/out"), f"{at}/checkpoint", None
    ))
    return _output(spark, f"{at}/out", ALERT_SCHEMA)


def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of each batch of lines, over several micro-batches, without the time they
    were raised."""
    at = work_dir(spark, "alerts")
    query = queries.start_alerts(
        _landed(spark, folder, at), to_ledger(f"{at}/out", "text"), f"{at}/checkpoint", trigger=TO_THE_END,
        key="batch_id",
    )
    until_done(query)
    messages = read_ledger(spark, f"{at}/out", "value string", "text")
    return alerts_from_json(messages).drop("timestamp")


def stream_report(spark: SparkSession, folder: str) -> DataFrame:
    """Report line of each batch of lines, over several micro-batches, without its clock."""
    at = work_dir(spark, "report")
    query = queries.start_report(
        _landed(spark, folder, at), to_ledger(f"{at}/out", "text", files=1), f"{at}/checkpoint",
        trigger=TO_THE_END, key="batch_id",
    )
    until_done(query)
    lines = read_ledger(spark, f"{at}/out", "value string", "text")
    return lines.select(F.substring_index("value", ", ", -3).alias("line"))


QUERIES: dict[str, Query] = {
    query.__name__: in_utc(query)
    for query in (
        stream_error_windows_append,
        stream_error_windows_update,
        stream_error_window_urls,
        stream_window_alerts,
        stream_window_alert_urls,
        stream_window_top_urls,
        stream_open_windows,
        stream_late_errors,
        stream_errors_json,
        stream_offset_steps,
        stream_topic_rate,
        stream_alerts,
        stream_alerts_dedup,
        stream_alerts_by_time,
        stream_report,
    )
}
