"""Batch queries. Each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitwatch.operators import alerts as alerting
from hitwatch.operators import parse, records, report, stats, throughput, windows
from hitwatch.schema import ALERT_TOPIC, CLIENT_RSD, CLIENT_SKETCH
from hitwatch.session import stored, utc, work_dir
from hitwatch.sources import derived
from hitwatch.sources.lines import table

Query = Callable[[SparkSession, str], DataFrame]

LATEST_ALERTS = 20
TIME_RANGE_SECONDS = 60
ARCHIVE_SECONDS = 600  # the log is dense: a day of it would be one folder


def plain(rows: DataFrame) -> DataFrame:
    """Timestamps without zone, so that clients in any zone see the same values."""
    names = [field.name for field in rows.schema if field.dataType.typeName() == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return derived.access_log_lines(_events(spark, folder))


def _parsed(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    return parse.parse_access_log(_lines(spark, folder), keep=keep)


def _errors(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    return parse.error_requests(_parsed(spark, folder, *keep))


# -- lines and records ---------------------------------------------------------------


def access_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder).select("event_id", "batch_id", "value")


def short_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    return derived.short_log_lines(_events(spark, folder))


def parse_access_log(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_parsed(spark, folder, "event_id"))


def parse_short_log(spark: SparkSession, folder: str) -> DataFrame:
    return plain(parse.parse_access_log(short_log_lines(spark, folder), keep=["event_id"]))


def error_requests(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_errors(spark, folder, "event_id"))


def errors_json(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["ip", "timestamp", "method", "url", "status"]
    return records.rows_as_json(_errors(spark, folder, "event_id"), columns, keep=["event_id"])


def monitoring_json(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["ip", "timestamp", "method", "url", "status", "size"]
    return records.rows_as_json(
        derived.access_log_records(_events(spark, folder)), columns, keep=["event_id"]
    )


def monitoring_records(spark: SparkSession, folder: str) -> DataFrame:
    return parse.parse_monitoring_json(monitoring_json(spark, folder), keep=["event_id"])


def monitoring_fanout(spark: SparkSession, folder: str) -> DataFrame:
    return records.fan_out(derived.access_log_records(_events(spark, folder)), keep=["event_id"])


# -- counts and alerts ---------------------------------------------------------------


def batch_summary(spark: SparkSession, folder: str) -> DataFrame:
    return stats.batch_summary(_parsed(spark, folder, "batch_id"), ["batch_id"])


def url_error_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.url_error_stats(_parsed(spark, folder, "batch_id"), ["batch_id"])


def ip_error_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.ip_error_stats(_parsed(spark, folder, "batch_id"), ["batch_id"])


def error_stats_grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    return stats.error_stats(_parsed(spark, folder, "batch_id"), ["batch_id"])


def alerts_all(spark: SparkSession, folder: str) -> DataFrame:
    return derived.batch_alerts(_events(spark, folder))


def alerts_by_time(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of every ten seconds of event time."""
    return alerting.alerts_by_time(_parsed(spark, folder))


def _alerts_of_type(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    return alerts_all(spark, folder).filter(F.col("type") == kind)


def global_error_rate_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts_of_type(spark, folder, "GLOBAL_ERROR_RATE").drop("url", "ip")


def url_error_rate_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts_of_type(spark, folder, "URL_ERROR_RATE").drop("ip")


def ip_error_rate_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts_of_type(spark, folder, "IP_ERROR_RATE").drop("url")


def alerts_json(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts as messages, read back; ``keys`` shows which fields a message carries."""
    messages = records.alerts_as_json(alerts_all(spark, folder))
    keyed = messages.withColumn("keys", F.array_join(F.json_object_keys("value"), ","))
    return records.alerts_from_json(keyed, keep=["keys"])


def alerts_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every batch delivered twice, the second time an hour later; the first one counts."""
    alerts = alerts_all(spark, folder)
    later = F.date_format(
        F.to_timestamp("timestamp") + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss"
    )
    delivered = alerts.withColumn(
        "timestamp", F.explode(F.array(F.col("timestamp"), later))
    )
    return alerting.first_deliveries(delivered)


# -- windows and report --------------------------------------------------------------


def error_windows(spark: SparkSession, folder: str) -> DataFrame:
    return plain(windows.flat_window(windows.error_windows(_errors(spark, folder))))


def checked_counts(approximate: DataFrame, errors: DataFrame) -> DataFrame:
    """Flat windows whose clients were counted by a sketch, with the exact numbers of clients in
    their place, and whether the approximate ones are near."""
    keys = ["window_start", "status"]
    exact = windows.flat_window(windows.error_windows(errors)).select(*keys, F.col("count_distinct_ip").alias("exact"))
    return approximate.join(exact, keys, "left").select(
        "window_start", "window_end", "status", "count_error",
        F.col("exact").alias("count_distinct_ip"),
        windows.within_bound(F.col("count_distinct_ip"), F.col("exact"), CLIENT_RSD).alias("within_bound"),
    )


def error_windows_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Windows whose clients are counted by a sketch, held against exact counts. Up to a few
    hundred clients, as in this log, a sketch gives their exact number; beyond that it is off by
    1.6 % or so."""
    errors = _errors(spark, folder)
    return plain(checked_counts(windows.flat_window(windows.error_windows(errors, CLIENT_SKETCH)), errors))


def error_windows_panes(spark: SparkSession, folder: str) -> DataFrame:
    """The same, with every error counted once, in a pane, and panes merged to windows."""
    return plain(windows.flat_window(windows.windows_of_panes(windows.error_panes(_errors(spark, folder)))))


def window_top_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent URLs of every window, from sketches of panes."""
    panes = windows.error_panes(_errors(spark, folder))
    return plain(windows.flat_window(windows.top_urls_of_panes(panes)))


def approx_clients_deviation(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the approximate client counts keep to the relative standard deviation they may
    have, taken over all windows; a window that only one side knows counts as one."""
    errors = _errors(spark, folder)
    keys = ["window", "status"]
    exact = windows.error_windows(errors).select(*keys, F.col("count_distinct_ip").alias("exact"))
    approximate = windows.error_windows(errors, CLIENT_SKETCH).select(*keys, F.col("count_distinct_ip").alias("approx"))
    both = exact.join(approximate, keys, "full")
    off = F.coalesce((F.col("approx") - F.col("exact")) / F.col("exact"), F.lit(1.0))
    return both.agg(
        F.count(F.lit(1)).alias("windows"),
        (F.sqrt(F.avg(off * off)) <= CLIENT_RSD).alias("within_rsd"),
    )


def error_window_urls(spark: SparkSession, folder: str) -> DataFrame:
    return plain(windows.flat_window(windows.error_window_urls(_errors(spark, folder))))


def window_alerts(spark: SparkSession, folder: str) -> DataFrame:
    alerts = windows.window_alerts(windows.error_windows(_errors(spark, folder)))
    return plain(windows.flat_window(alerts))


def window_alert_urls(spark: SparkSession, folder: str) -> DataFrame:
    urls = stored(spark, windows.error_window_urls(_errors(spark, folder)), "window-urls")
    return plain(windows.flat_window(windows.window_alert_urls(urls)))


def report_error_flag(spark: SparkSession, folder: str) -> DataFrame:
    return parse.flag_report_errors(_lines(spark, folder)).select("event_id", "is_error")


def error_rate_report(spark: SparkSession, folder: str) -> DataFrame:
    return plain(report.error_rate_report(_lines(spark, folder)))


# -- topic throughput ----------------------------------------------------------------


def _alert_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The alert topic; alerts are written once, as to the topic, and numbered from there."""
    alerts = derived.batch_alerts(_events(spark, folder))
    return derived.alert_messages(stored(spark, alerts, "alerts"))


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """All three topics."""
    logs = derived.log_messages(_events(spark, folder))
    return logs.unionByName(_alert_messages(spark, folder))


def _steps(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """Offset steps as a stored table, as a metrics store would keep them."""
    return stored(spark, throughput.offset_steps(messages), "offset-steps")


def _samples(spark: SparkSession, messages: DataFrame) -> DataFrame:
    steps = _steps(spark, messages)
    return throughput.offset_samples(steps, *throughput.covered_range(steps))


def topic_messages(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_messages(spark, folder).drop("value"))


def topic_offsets(spark: SparkSession, folder: str) -> DataFrame:
    return _samples(spark, _messages(spark, folder))


def topic_offsets_recent(spark: SparkSession, folder: str) -> DataFrame:
    """The last minute, counted back from the newest tick, as far as there are samples, from an
    archive of the messages."""
    at = work_dir(spark, "messages")
    throughput.archive(_messages(spark, folder).drop("value"), at, ARCHIVE_SECONDS)
    first, now = throughput.archived_range(spark, at)
    since = max(first, now - TIME_RANGE_SECONDS)
    steps = throughput.archived_steps(spark, at, since, ARCHIVE_SECONDS)
    return throughput.offset_samples(steps, since, now)


def alert_count_series(spark: SparkSession, folder: str) -> DataFrame:
    samples = _samples(spark, _alert_messages(spark, folder))
    return throughput.matching(samples, topic=ALERT_TOPIC)


def topic_rate_1m(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.rate_by_topic(_samples(spark, _messages(spark, folder)))


def topic_rate_selected(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of the series whose instance and topic match whole patterns."""
    labelled = derived.with_exporters(_samples(spark, _messages(spark, folder)))
    chosen = throughput.matching(labelled, instance="kafka-exporter-[0-9]:.*", topic="http-logs|alerts?")
    return throughput.rate_by_topic(chosen)


def topic_delta_5m(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.delta_by_topic(_samples(spark, _messages(spark, folder)))


def consumer_delta_5m(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.delta_by_consumer(_samples(spark, _messages(spark, folder)))


def _series(spark: SparkSession, folder: str) -> DataFrame:
    """Topic and partition of every message; alerts need no numbering for that."""
    alerts = derived.batch_alerts(_events(spark, folder)).select(
        F.lit(ALERT_TOPIC).alias("topic"), F.lit(0).alias("partition")
    )
    logs = derived.log_messages(_events(spark, folder)).select("topic", "partition")
    return derived.with_exporters(logs.unionByName(alerts))


def partitions_per_topic(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.partitions_per_topic(_series(spark, folder))


def topic_values(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.label_values(
        _series(spark, folder), "topic", without=throughput.INTERNAL_TOPICS
    )


def job_values(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.label_values(_series(spark, folder), "job")


def instance_values(spark: SparkSession, folder: str) -> DataFrame:
    chosen = throughput.matching(_series(spark, folder), job=throughput.SCRAPE_JOB)
    return throughput.label_values(chosen, "instance")


def topic_delta_legend(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.legend(topic_delta_5m(spark, folder))


def consumer_delta_legend(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.legend(consumer_delta_5m(spark, folder), ("consumergroup", "topic"))


def topic_rate_legend(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.legend(topic_rate_1m(spark, folder))


def new_alert_rule(spark: SparkSession, folder: str) -> DataFrame:
    return throughput.new_message_rule(_samples(spark, _alert_messages(spark, folder)))


def alert_rule_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of the alert rule's states, up to two minutes after the log has ended."""
    steps = _steps(spark, _alert_messages(spark, folder))
    first, last = throughput.covered_range(steps)
    samples = throughput.offset_samples(steps, first, last)
    return throughput.rule_spans(throughput.rule_states(samples, first, last + 2 * throughput.RULE_SECONDS))


def latest_alerts(spark: SparkSession, folder: str) -> DataFrame:
    messages = _alert_messages(spark, folder)
    latest = throughput.latest_messages(messages, LATEST_ALERTS, ALERT_TOPIC)
    return records.alerts_from_json(latest, keep=["offset"])


def in_utc(query: Query) -> Query:
    """The query, built under UTC."""
    @wraps(query)
    def build(spark: SparkSession, folder: str) -> DataFrame:
        with utc(spark):
            return query(spark, folder)

    return build


QUERIES: dict[str, Query] = {
    query.__name__: in_utc(query)
    for query in (
        access_log_lines,
        short_log_lines,
        parse_access_log,
        parse_short_log,
        error_requests,
        errors_json,
        monitoring_json,
        monitoring_records,
        monitoring_fanout,
        batch_summary,
        url_error_stats,
        ip_error_stats,
        error_stats_grouping_sets,
        alerts_all,
        global_error_rate_alerts,
        url_error_rate_alerts,
        ip_error_rate_alerts,
        alerts_json,
        alerts_dedup,
        alerts_by_time,
        error_windows,
        error_windows_approx,
        error_windows_panes,
        window_top_urls,
        approx_clients_deviation,
        error_window_urls,
        window_alerts,
        window_alert_urls,
        report_error_flag,
        error_rate_report,
        topic_messages,
        topic_offsets,
        topic_offsets_recent,
        alert_count_series,
        topic_rate_1m,
        topic_rate_selected,
        topic_delta_5m,
        consumer_delta_5m,
        partitions_per_topic,
        topic_values,
        job_values,
        instance_values,
        topic_rate_legend,
        topic_delta_legend,
        consumer_delta_legend,
        new_alert_rule,
        alert_rule_spans,
        latest_alerts,
    )
}
