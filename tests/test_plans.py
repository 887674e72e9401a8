"""What Spark makes of the queries."""

from __future__ import annotations

import re

import pytest

from hitwatch.plans import batch, streams
from hitwatch.schema import CLIENT_SKETCH


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(batch.QUERIES))
def test_no_python_and_no_product(spark, small, name):
    plan = physical(batch.QUERIES[name](spark, small))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name", ["alerts_all", "error_stats_grouping_sets", "batch_summary", "approximate windows",
             "error_window_urls", "error_rate_report", "url_error_stats", "ip_error_stats"]
)
def test_one_scan_and_one_shuffle_behind_partial_counts(spark, small, name):
    if name == "approximate windows":
        plan = physical(batch.windows.error_windows(batch._errors(spark, small), CLIENT_SKETCH))
    else:
        plan = physical(batch.QUERIES[name](spark, small))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    below = plan[plan.index("Exchange"):]
    assert "partial_count" in below


def test_exact_distinct_spreads_a_window_over_its_clients(spark, small):
    plan = physical(batch.error_windows(spark, small))
    first = plan[plan.rindex("Exchange"):].splitlines()[0]
    assert re.search(r"hashpartitioning\(window#\d+, status#\d+, ip#\d+", first)


def test_only_needed_columns_are_read(spark, small):
    plan = physical(batch.alerts_all(spark, small))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan


@pytest.mark.parametrize("name", ["alerts_all", "error_windows", "error_window_urls", "errors_json"])
def test_regex_runs_once_per_line(spark, small, name):
    plan = physical(batch.QUERIES[name](spark, small))
    assert plan.count("regexp_replace") == 1


@pytest.mark.parametrize(
    "name", ["parse_access_log", "alerts_all", "error_windows", "error_windows_approx",
             "error_window_urls", "errors_json", "error_rate_report", "monitoring_fanout"]
)
def test_generated_methods_are_small_enough_to_be_compiled(spark, small, name):
    """The JVM interprets methods of more than 8000 bytes for good."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = batch.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert all(int(size) < 8000 for size in sizes)


def test_messages_are_counted_before_the_shuffle(spark, small):
    frame = batch.throughput.offset_steps(batch._messages(spark, small))
    below = physical(frame)
    assert "partial_max(offset" in below[below.index("Exchange"):]


def test_latest_alerts_are_a_top_k(spark, small):
    plan = physical(batch.latest_alerts(spark, small))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_url_rows_of_loud_windows_are_not_repeated(spark, small, limit):
    """One join of the rows as they are, small or not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        plan = physical(batch.window_alert_urls(spark, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Join") == 1 and "Generate" not in plan
    assert ("BroadcastHashJoin" in plan) == (limit != "-1")


@pytest.mark.parametrize("name", ["topic_offsets", "topic_rate_1m", "topic_delta_5m", "new_alert_rule"])
def test_series_are_windowed_by_block(spark, small, name):
    plan = physical(batch.QUERIES[name](spark, small))
    windows = re.findall(r"Window \[.*?\], \[(topic#\d+, partition#\d+.*?)\], \[", plan)
    # but for the table of one row per series and block, which carries offsets on
    assert len(windows) >= 2 and sum("block" not in keys for keys in windows) <= 2


def test_range_is_pushed_into_the_scan_of_messages(spark, tmp_path):
    from hitwatch.operators.throughput import recent_steps
    from hitwatch.schema import MESSAGE_SCHEMA

    spark.createDataFrame([], MESSAGE_SCHEMA).write.parquet(f"{tmp_path}/m")
    messages = spark.read.schema(MESSAGE_SCHEMA).parquet(f"{tmp_path}/m")
    plan = physical(recent_steps(messages, 1704067200))
    assert plan.count("GreaterThan(timestamp,") == 1 and plan.count("LessThanOrEqual(timestamp,") == 1


@pytest.mark.parametrize("name", ["topic_values", "job_values", "instance_values", "partitions_per_topic"])
def test_label_queries_write_nothing(spark, small, name, monkeypatch):
    monkeypatch.setattr(batch, "stored", None)
    assert batch.QUERIES[name](spark, small).count() > 0


def test_stream_registry():
    assert set(streams.QUERIES).isdisjoint(batch.QUERIES)


@pytest.mark.parametrize("name", ["error_windows_panes", "window_top_urls"])
def test_panes_are_multiplied_after_counting(spark, small, name):
    """Windows take copies of panes; errors are counted once, before the first shuffle."""
    plan = physical(batch.QUERIES[name](spark, small))
    assert plan.count("Expand") == 1 and plan.count("Exchange") == 2 and plan.count("FileScan") == 1
    assert plan.index("Expand") < plan.rindex("Exchange")  # plans are printed from the top
    assert physical(batch.error_windows_approx(spark, small)).index("Exchange") < physical(
        batch.error_windows_approx(spark, small)).index("Expand")


def test_rule_spans_order_only_blocks_by_series(spark, small):
    plan = physical(batch.alert_rule_spans(spark, small))
    whole = re.findall(r"Window \[[^\n]*?\], \[topic#\d+, partition#\d+\], \[([^\n]*?)\]", plan)
    assert whole and all(order.startswith("block") for order in whole)
