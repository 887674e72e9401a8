"""Error-rate alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitwatch.functions.rates import error_rate, percent_text
from hitwatch.functions.times import iso_text
from hitwatch.operators.records import ALERT_COLUMNS
from hitwatch.operators.stats import error_stats
from hitwatch.operators.windows import watermarked
from hitwatch.schema import ALERT_REPEATS_WITHIN, ALERT_SPAN, Thresholds

# What identifies an alert when a batch is delivered again.
ALERT_KEY = ["batch_id", "type", "url", "ip"]


def alerts_of(
    stats: DataFrame, thresholds: Thresholds, batch_id: Column, raised_at: Column
) -> DataFrame:
    """Alert records from :func:`error_stats` rows: enough requests, rate above the limit."""
    scope, total, errors = F.col("scope"), F.col("total"), F.col("errors")

    def by_scope(everything: object, url: object, ip: object) -> Column:
        return F.when(scope == "GLOBAL", everything).when(scope == "URL", url).otherwise(ip)

    rated = (
        stats.filter(
            total >= by_scope(1, thresholds.min_url_requests, thresholds.min_ip_requests)
        )
        .withColumn("value", error_rate(errors, total))
        .withColumn("thresholds", by_scope(thresholds.everything, thresholds.url, thresholds.ip))
        .filter(F.col("value") > F.col("thresholds"))
    )
    # fixed values: the wording of the messages
    text = F.concat(
        by_scope(
            F.lit("Global error rate"),
            F.concat(F.lit("Error rate for URL "), F.col("url")),
            F.concat(F.lit("Error rate for IP "), F.col("ip")),
        ),
        F.lit(" too high: "),
        percent_text(F.col("value") * 100),
    )
    return rated.select(
        raised_at.alias("timestamp"),
        F.concat(scope, F.lit("_ERROR_RATE")).alias("type"),
        text.alias("message"),
        batch_id.cast("long").alias("batch_id"),
        "url",
        "ip",
        total.alias("total_requests"),
        errors.alias("error_requests"),
        "value",
        "thresholds",
    )


def error_rate_alerts(
    parsed: DataFrame,
    batch_id: Column,
    raised_at: Column,
    thresholds: Thresholds = Thresholds(),
    keys: Sequence[str] = (),
) -> DataFrame:
    """All alerts of a batch, or of every batch named by ``keys``, in one pass."""
    return alerts_of(error_stats(parsed, keys), thresholds, batch_id, raised_at)


def alerts_by_time(
    parsed: DataFrame, thresholds: Thresholds = Thresholds(), span: str = ALERT_SPAN
) -> DataFrame:
    """All alerts of every span of event time, on a table or, in append mode, on a stream.

    A span takes the place of a micro-batch: ``batch_id`` is its number since the epoch and
    ``timestamp`` its end. So alerts do not depend on how lines were cut into batches, a query
    that is run again raises the same ones, and no callback is needed. On a stream the state
    is a row of counts per span, and per URL and client in it. Lines without a readable time
    are in no span.
    """
    spans = watermarked(parsed).withColumn("window", F.window("timestamp", span))
    stats = error_stats(spans.filter(F.col("timestamp").isNotNull()), ["window"])
    start, end = F.unix_seconds(F.col("window.start")), F.unix_seconds(F.col("window.end"))
    return alerts_of(stats, thresholds, F.floor(start / (end - start)), iso_text(F.col("window.end")))


def first_alerts(alerts: DataFrame, within: str = ALERT_REPEATS_WITHIN) -> DataFrame:
    """The alerts of a stream without those that were there before.

    A repeat is dropped that is raised less than ``within`` after the first one; the key of an
    alert leaves the state when the watermark, as much behind the newest alert, has passed
    that. So the state holds the alerts of a bounded time, and not all there ever were.
    Alerts that come later than ``within`` behind the newest one do not count, nor do records
    without a readable time.
    """
    return (
        alerts.withColumn("_raised", F.try_to_timestamp("timestamp"))
        .filter(F.col("_raised").isNotNull())
        .withWatermark("_raised", within)
        .dropDuplicatesWithinWatermark(ALERT_KEY)
        .drop("_raised")
    )


def first_deliveries(alerts: DataFrame) -> DataFrame:
    """One record per alert, the earliest, when batches were delivered more than once."""
    payload = [name for name in ALERT_COLUMNS if name not in ALERT_KEY]
    first = F.min(F.struct(*payload)).alias("first")
    return alerts.groupBy(*ALERT_KEY).agg(first).select(
        *[f"first.{name}" if name in payload else name for name in ALERT_COLUMNS]
    )
