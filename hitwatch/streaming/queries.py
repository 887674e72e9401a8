"""The streaming queries.

Each takes an unbounded DataFrame of lines and a caller-supplied checkpoint folder
and starts one query. ``trigger`` holds the keywords of ``DataStreamWriter.trigger``;
none means batches follow each other without pause.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from hitwatch.functions.times import now_iso
from hitwatch.operators.alerts import alerts_by_time, error_rate_alerts
from hitwatch.operators.parse import error_requests, parse_access_log
from hitwatch.operators.records import alerts_as_json, rows_as_json
from hitwatch.operators.report import batch_report
from hitwatch.operators.throughput import offset_steps
from hitwatch.operators.windows import (
    counted_in_time,
    delivered_windows,
    delivery_watermarks,
    error_window_urls,
    error_windows,
    flat_window,
    late_errors,
    top_urls,
    watermarked,
    window_alert_urls,
    window_alerts,
)
from hitwatch.schema import CLIENT_SKETCH, ERROR_STATUS_FROM, WINDOW_SIZE, WINDOW_SLIDE, Thresholds
from hitwatch.sinks.batches import Deliver
from hitwatch.streaming.state import late_watermark, note_deliveries

EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}

Trigger = Mapping[str, object] | None


def start(writer: DataStreamWriter, checkpoint: str | None, trigger: Trigger) -> StreamingQuery:
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_alerts(
    lines: DataFrame,
    deliver: Deliver,
    checkpoint: str,
    thresholds: Thresholds = Thresholds(),
    trigger: Trigger = None,
    key: str | None = None,
) -> StreamingQuery:
    """Error-rate alerts of each micro-batch, as JSON messages.

    With ``key``, a column of the lines, there are alerts for each of its values in a
    micro-batch, which take it as batch number. One aggregation and one write per batch. Batch totals are observed on the way
    and appear as ``observedMetrics`` ``requests`` in the query's progress.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        number = F.col(key) if key else F.lit(batch_id)
        alerts = error_rate_alerts(batch, number, F.lit(now_iso()), thresholds, [key] if key else [])
        deliver(alerts_as_json(alerts), batch_id)

    parsed = parse_access_log(lines, keep=[key] if key else []).observe(
        "requests",
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") >= ERROR_STATUS_FROM).alias("errors"),
    )
    return start(parsed.writeStream.outputMode("append").foreachBatch(handle), checkpoint, trigger)


def errors_of(lines: DataFrame) -> DataFrame:
    return error_requests(parse_access_log(lines))


def error_json(lines: DataFrame) -> DataFrame:
    """Error requests as JSON texts; keeps no state."""
    return rows_as_json(errors_of(lines))


def window_metrics(lines: DataFrame) -> DataFrame:
    """Sliding error windows; state per window and status is a count and a fixed-size sketch."""
    return error_windows(errors_of(lines), CLIENT_SKETCH)


def window_metrics_alerts(lines: DataFrame) -> DataFrame:
    """Windows with too many errors; in append mode each is emitted once it is closed."""
    return window_alerts(window_metrics(lines))


def window_urls(lines: DataFrame) -> DataFrame:
    """URLs of the sliding windows; state is one count per window, status and URL."""
    return error_window_urls(errors_of(lines))


def window_top_urls(lines: DataFrame) -> DataFrame:
    """The most frequent URLs of the sliding windows; state is one sketch of fixed size per
    window and status, however many URLs there are."""
    return top_urls(errors_of(lines))


def timed_alerts(lines: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Alerts by spans of event time; in append mode those of a span come once it is closed."""
    return alerts_by_time(parse_access_log(lines), thresholds)


def start_windows_and_late(
    lines: DataFrame,
    deliver: Deliver,
    deliver_late: Deliver,
    checkpoint: str,
    trigger: Trigger = EVERY_TEN_SECONDS,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    delivery: str | None = None,
) -> StreamingQuery:
    """Closed windows to one place, and errors that some of them, or all, no longer counted to
    another.

    Spark drops late rows inside the aggregation. The errors themselves therefore run beside
    it through the same query, under the same watermark, and are held in each micro-batch
    against the watermark that the query noted for it. Lines are read for both.

    With ``delivery``, a column of the lines, a micro-batch stands for any number of whole
    deliveries that came in the order of their numbers: the watermark moves from one delivery to
    the next as if each were a micro-batch, which are then as large as suits. Windows are kept
    apart by delivery until they close and the late ones have been left out.
    """
    errors = error_requests(parse_access_log(lines, keep=[delivery] if delivery else []))
    if delivery:
        windows = flat_window(delivered_windows(errors, delivery, CLIENT_SKETCH, size, slide))
    else:
        windows = flat_window(error_windows(errors, CLIENT_SKETCH, size, slide))
    kinds = {"closed": windows.schema, "error": errors.schema}

    def as_kind(rows: DataFrame, kind: str) -> DataFrame:
        return rows.select(*(
            (F.struct(*rows.columns) if name == kind else F.lit(None).cast(schema)).alias(name)
            for name, schema in kinds.items()
        ))

    def handle(rows: DataFrame, batch_id: int) -> None:
        rows.persist()  # used twice; holds closed windows and the errors of a micro-batch
        try:
            found = {name: rows.filter(F.col(name).isNotNull()).select(f"{name}.*") for name in kinds}
            now = late_watermark(rows.sparkSession, checkpoint, batch_id)
            if delivery:
                own, known = note_deliveries(
                    rows.sparkSession, checkpoint, batch_id,
                    lambda reached: delivery_watermarks(found["error"], delivery, reached), now,
                )
                deliver(counted_in_time(found["closed"], known, delivery), batch_id)
                came = found["error"].join(F.broadcast(own), delivery)
                late = late_errors(came, F.col("watermark_ms"), size, slide).drop(delivery, *own.columns)
                deliver_late(late, batch_id)
            else:
                deliver(found["closed"], batch_id)
                deliver_late(late_errors(found["error"], now, size, slide), batch_id)
        finally:
            rows.unpersist()

    both = as_kind(windows, "closed").unionByName(as_kind(watermarked(errors), "error"))
    return start(both.writeStream.outputMode("append").foreachBatch(handle), checkpoint, trigger)


def start_alert_urls(
    lines: DataFrame, deliver: Deliver, checkpoint: str, trigger: Trigger = EVERY_TEN_SECONDS
) -> StreamingQuery:
    """URLs of the windows that raise an alert, once they are closed. All rows of a closed
    window arrive in one micro-batch, where they are counted and kept or left out."""

    def handle(urls: DataFrame, batch_id: int) -> None:
        urls.persist()  # used twice
        try:
            deliver(flat_window(window_alert_urls(urls)), batch_id)
        finally:
            urls.unpersist()

    return start(window_urls(lines).writeStream.outputMode("append").foreachBatch(handle), checkpoint, trigger)


def start_steps(
    messages: DataFrame, deliver: Deliver, checkpoint: str, trigger: Trigger = EVERY_TEN_SECONDS
) -> StreamingQuery:
    """Offset steps of each micro-batch. No state is kept and no message is too late: a
    tick may appear in several batches, and ``merged_steps`` puts them together."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        deliver(offset_steps(batch), batch_id)

    return start(messages.writeStream.foreachBatch(handle), checkpoint, trigger)


def start_latest(
    rows: DataFrame, deliver: Deliver, checkpoint: str, trigger: Trigger = EVERY_TEN_SECONDS
) -> StreamingQuery:
    """Changed rows of each batch (update mode) through ``deliver``."""
    return start(rows.writeStream.outputMode("update").foreachBatch(deliver), checkpoint, trigger)


def start_report(
    lines: DataFrame,
    deliver: Deliver,
    checkpoint: str,
    trigger: Trigger = EVERY_TEN_SECONDS,
    key: str | None = None,
) -> StreamingQuery:
    """A report line per trigger over the lines that arrived since the one before, or one
    for each value of the column ``key`` among them."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        report = batch_report(batch, F.current_timestamp(), [key] if key else [])
        deliver(report.select("line"), batch_id)

    return start(lines.writeStream.foreachBatch(handle), checkpoint, trigger)
