"""Sliding event-time windows over error requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitwatch.schema import (
    CLIENT_SKETCH,
    TOP_URLS,
    TRACKED_URLS,
    WATERMARK,
    WINDOW_ALERT_ABOVE,
    WINDOW_ALERT_TEXT,
    WINDOW_SIZE,
    WINDOW_SLIDE,
)


def watermarked(rows: DataFrame) -> DataFrame:
    # without effect on batch input
    return rows.withWatermark("timestamp", WATERMARK)


def error_windows(
    errors: DataFrame, sketch: int | None = None, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE
) -> DataFrame:
    """Errors and distinct clients per window and status.

    ``sketch``, the logarithm of its number of registers, selects the approximate distinct
    count, the only one of fixed size and so the one for streams; without it the count is
    exact. Exact counting shuffles on (window, status, client) first, so that one
    crowded window is spread over many tasks.
    """
    if sketch is None:
        clients = F.count_distinct("ip")
    else:
        clients = F.hll_sketch_estimate(F.hll_sketch_agg("ip", sketch))
    return (
        watermarked(errors)
        .groupBy(F.window("timestamp", size, slide), "status")
        .agg(F.count(F.lit(1)).alias("count_error"), clients.alias("count_distinct_ip"))
    )


def delivered_windows(
    errors: DataFrame, delivery: str, sketch: int, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE
) -> DataFrame:
    """As :func:`error_windows`, but apart by the number of the delivery that errors came with,
    and with the sketch of the clients itself; :func:`counted_in_time` puts the rows together."""
    return (
        watermarked(errors)
        .groupBy(F.window("timestamp", size, slide), "status", delivery)
        .agg(F.count(F.lit(1)).alias("count_error"), F.hll_sketch_agg("ip", sketch).alias("clients"))
    )


def counted_in_time(parts: DataFrame, watermarks: DataFrame, delivery: str) -> DataFrame:
    """Flat windows from flat :func:`delivered_windows`, without deliveries that came once the
    window was closed; ``watermarks`` as of :func:`delivery_watermarks`."""
    in_time = parts.join(F.broadcast(watermarks), delivery).filter(F.unix_millis("window_end") > F.col("watermark_ms"))
    return in_time.groupBy("window_start", "window_end", "status").agg(
        F.sum("count_error").alias("count_error"),
        F.hll_sketch_estimate(F.hll_union_agg("clients")).alias("count_distinct_ip"),
    )


def error_window_urls(errors: DataFrame) -> DataFrame:
    """The URLs of each window and status, with the number of times each occurs.

    This is the list of all URLs of a window, duplicates included, written as rows:
    a list in one cell would gather a crowded window in one task's memory.
    """
    return (
        watermarked(errors)
        .groupBy(F.window("timestamp", WINDOW_SIZE, WINDOW_SLIDE), "status", "url")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def window_alerts(windows: DataFrame) -> DataFrame:
    """Windows with too many errors."""
    return windows.filter(F.col("count_error") > WINDOW_ALERT_ABOVE).withColumn(
        "alert", F.lit(WINDOW_ALERT_TEXT)
    )


def window_alert_urls(urls: DataFrame) -> DataFrame:
    """URL rows, from :func:`error_window_urls`, of the windows that raise an alert.

    The error count is summed from the URL rows themselves, which are used twice and
    worth storing first. There is one alert row per key, so an inner join does; Spark
    broadcasts the alert rows if they measure small and splits crowded windows if not.
    """
    keys = ["window", "status"]
    alerts = window_alerts(urls.groupBy(*keys).agg(F.sum("occurrences").alias("count_error")))
    return urls.join(alerts.select(*keys), keys).select(urls.columns)


# -- panes and sketches ----------------------------------------------------------------


def error_panes(errors: DataFrame, sketch: int = CLIENT_SKETCH, tracked: int = TRACKED_URLS) -> DataFrame:
    """Errors per pane, the step windows slide by, and status: their number, and sketches of
    their clients and of their most frequent URLs. Sketches have a fixed greatest size and
    can be merged, so every error is counted once, whatever number of windows it is in."""
    urls = F.call_function("approx_top_k_accumulate", F.col("url"), F.lit(tracked))
    return (
        watermarked(errors)
        .groupBy(F.window("timestamp", WINDOW_SLIDE).alias("pane"), "status")
        .agg(
            F.count(F.lit(1)).alias("errors"),
            F.hll_sketch_agg("ip", sketch).alias("clients"),
            urls.alias("urls"),
        )
    )


def _merged(panes: DataFrame, **merged: Column) -> DataFrame:
    """Panes put together to the windows they are in, by one copy of a pane for each."""
    window = F.window(F.col("pane.start"), WINDOW_SIZE, WINDOW_SLIDE)
    return panes.groupBy(window, "status").agg(
        F.sum("errors").alias("count_error"), *(column.alias(name) for name, column in merged.items())
    )


def windows_of_panes(panes: DataFrame) -> DataFrame:
    """As :func:`error_windows` with a sketch, from panes."""
    return _merged(panes, count_distinct_ip=F.hll_sketch_estimate(F.hll_union_agg("clients")))


def _loudest(counted: DataFrame, k: int, tracked: int) -> DataFrame:
    least = F.coalesce(F.get("urls", F.lit(k - 1))["count"], F.lit(0))
    # fixed by the sketch: its table has the power of two of places that is above 4/3 of the
    # tracked items, and counts are off by at most 3.5 of all occurrences over its places
    places = 1 << (-(-tracked * 4 // 3) - 1).bit_length()
    off = F.floor(F.col("count_error") * 3.5 / places)
    loud = F.filter("urls", lambda item: item["count"] >= least)
    return counted.select("window", "status", F.explode(loud).alias("item"), off.alias("most_off")).select(
        "window", "status", F.col("item.item").alias("url"), F.col("item.count").alias("occurrences"), "most_off"
    )


def top_urls(errors: DataFrame, k: int = TOP_URLS, tracked: int = TRACKED_URLS) -> DataFrame:
    """The ``k`` most frequent URLs of each window and status, all of them at a tie, from a
    sketch of fixed size: ``occurrences`` may be off by ``most_off``, which is 0 in windows
    of few errors, and counts are exact as long as a window has no more URLs than are
    ``tracked``. State is a sketch per window and status, however many URLs there are."""
    urls = F.call_function("approx_top_k", F.col("url"), F.lit(tracked), F.lit(tracked))
    counted = (
        watermarked(errors)
        .groupBy(F.window("timestamp", WINDOW_SIZE, WINDOW_SLIDE), "status")
        .agg(F.count(F.lit(1)).alias("count_error"), urls.alias("urls"))
    )
    return _loudest(counted, k, tracked)


def top_urls_of_panes(panes: DataFrame, k: int = TOP_URLS, tracked: int = TRACKED_URLS) -> DataFrame:
    """As :func:`top_urls`, from panes with as many tracked URLs."""
    whole = F.call_function("approx_top_k_combine", F.col("urls"), F.lit(tracked))
    listed = F.call_function("approx_top_k_estimate", whole, F.lit(tracked))
    return _loudest(_merged(panes, urls=listed), k, tracked)


# -- late errors -----------------------------------------------------------------------


def _milliseconds(interval: str) -> int:
    amount, unit = interval.split()
    return int(amount) * {"second": 1_000, "minute": 60_000, "hour": 3_600_000}[unit.removesuffix("s")]


def delivery_watermarks(errors: DataFrame, delivery: str, reached_ms: int) -> DataFrame:
    """For each delivery among the errors the watermark, in milliseconds, as ``watermark_ms`` that
    it comes at, and as ``reached_ms`` the one that it leaves behind; ``reached_ms`` is where those
    before them left it. The deliveries of a micro-batch are few, and only they are ordered."""
    peak = F.unix_millis(F.max("timestamp")) - _milliseconds(WATERMARK)
    peaks = errors.filter(F.col(delivery).isNotNull()).groupBy(delivery).agg(peak.alias("peak"))
    in_turn = Window.orderBy(delivery)
    before = F.max("peak").over(in_turn.rowsBetween(Window.unboundedPreceding, -1))
    until = F.max("peak").over(in_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return peaks.select(
        delivery,
        F.greatest(F.lit(reached_ms), before).alias("watermark_ms"),
        F.greatest(F.lit(reached_ms), until).alias("reached_ms"),
    )


def late_errors(
    errors: DataFrame, watermark_ms: int | Column, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE
) -> DataFrame:
    """Errors that come too late for some of their windows, or all, at a watermark, with the
    number of these as ``windows_missed``; a window is closed once the watermark is at its end."""
    step, held = _milliseconds(slide), _milliseconds(size) // _milliseconds(slide)
    moment = F.unix_millis("timestamp")
    # the windows of an error end one, two, ... steps after the step it is in
    closed = F.floor((F.lit(watermark_ms) - (moment - F.pmod(moment, F.lit(step)))) / step)
    missed = F.least(F.lit(held), closed)
    dated = errors.filter(F.col("timestamp").isNotNull())  # the others are in no window
    return dated.withColumn("windows_missed", missed.cast("int")).filter("windows_missed > 0")


def within_bound(approximate: Column, exact: Column, rsd: float) -> Column:
    """Whether an approximate count lies within three relative deviations of the exact one,
    or one client."""
    return F.abs(approximate - exact) <= F.greatest(F.lit(1.0), exact * (3 * rsd))


def flat_window(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``window_start`` and ``window_end`` in place of the window struct."""
    rest = keep or [name for name in rows.columns if name != "window"]
    return rows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )
