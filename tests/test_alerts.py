from __future__ import annotations

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from hitwatch.operators.alerts import error_rate_alerts, first_deliveries
from hitwatch.operators.parse import parse_access_log
from hitwatch.operators.records import ALERT_COLUMNS, alerts_as_json, alerts_from_json
from hitwatch.operators.stats import batch_summary, error_stats, ip_error_stats, url_error_stats
from hitwatch.schema import Thresholds
from tests.logs import line

QUIET = dict(everything=9.0, url=9.0, ip=9.0)


def alerts(frame, batch_id=3, **limits):
    thresholds = Thresholds(**limits) if limits else Thresholds()
    return error_rate_alerts(
        parse_access_log(frame), F.lit(batch_id), F.lit("2024-01-01T00:00:00"), thresholds
    )


def kinds(frame, **limits):
    return Counter(row["type"] for row in alerts(frame, **limits).collect())


def requests(total, errors, url="/u", ip="10.0.0.1", vary=""):
    """``total`` lines; ``vary`` names the field that differs between them."""
    return [
        line(
            status=500 if i < errors else 200,
            url=f"{url}{i}" if vary == "url" else url,
            ip=f"{ip}{i}" if vary == "ip" else ip,
        )
        for i in range(total)
    ]


def test_global_threshold_is_exclusive(lines):
    only = {**QUIET, "everything": 0.025}
    assert kinds(lines(requests(40, 1)), **only) == {}
    assert kinds(lines(requests(40, 2)), **only) == {"GLOBAL_ERROR_RATE": 1}
    # no minimum: a single failed request is enough
    assert kinds(lines(requests(1, 1)), **only) == {"GLOBAL_ERROR_RATE": 1}


def test_url_threshold_and_minimum(lines):
    only = {**QUIET, "url": 0.3}
    assert kinds(lines(requests(10, 3, vary="ip")), **only) == {}
    assert kinds(lines(requests(10, 4, vary="ip")), **only) == {"URL_ERROR_RATE": 1}
    assert kinds(lines(requests(4, 4, vary="ip")), **only) == {}
    assert kinds(lines(requests(5, 5, vary="ip")), **only) == {"URL_ERROR_RATE": 1}


def test_ip_threshold_and_minimum(lines):
    only = {**QUIET, "ip": 0.4}
    assert kinds(lines(requests(5, 2, vary="url")), **only) == {}
    assert kinds(lines(requests(5, 3, vary="url")), **only) == {"IP_ERROR_RATE": 1}
    assert kinds(lines(requests(2, 2, vary="url")), **only) == {}
    assert kinds(lines(requests(3, 3, vary="url")), **only) == {"IP_ERROR_RATE": 1}


def test_empty_batch(lines):
    assert alerts(lines([])).count() == 0
    assert batch_summary(parse_access_log(lines([]))).count() == 0


def test_unparsed_lines_count_but_never_fail(lines):
    frame = lines(["junk"] * 37 + requests(3, 3))
    rows = {row["type"]: row for row in alerts(frame).collect()}
    assert rows["GLOBAL_ERROR_RATE"]["total_requests"] == 40
    assert rows["GLOBAL_ERROR_RATE"]["value"] == 3 / 40
    assert set(rows) == {"GLOBAL_ERROR_RATE", "IP_ERROR_RATE"}
    stats = error_stats(parse_access_log(frame)).filter("url = '' or ip = ''").collect()
    assert {(r["scope"], r["total"], r["errors"]) for r in stats} == {("URL", 37, 0), ("IP", 37, 0)}


def test_messages_and_json_keys(lines):
    rows = alerts_as_json(alerts(lines(requests(32, 13)), batch_id=5)).collect()
    texts = {json.loads(r["value"])["type"]: json.loads(r["value"]) for r in rows}
    common = ["timestamp", "type", "message", "batch_id"]
    counts = ["total_requests", "error_requests", "value", "thresholds"]
    assert list(texts["GLOBAL_ERROR_RATE"]) == common + counts
    assert list(texts["URL_ERROR_RATE"]) == [*common, "url", *counts]
    assert list(texts["IP_ERROR_RATE"]) == [*common, "ip", *counts]
    assert texts["GLOBAL_ERROR_RATE"]["message"] == "Global error rate too high: 40.62%"
    assert texts["URL_ERROR_RATE"]["message"] == "Error rate for URL /u too high: 40.62%"
    assert texts["IP_ERROR_RATE"]["message"] == "Error rate for IP 10.0.0.1 too high: 40.62%"
    assert texts["IP_ERROR_RATE"]["batch_id"] == 5
    assert texts["IP_ERROR_RATE"]["thresholds"] == 0.4


def test_json_round_trip(lines):
    raised = alerts(lines(requests(20, 20)))
    back = alerts_from_json(alerts_as_json(raised))
    assert back.columns == ALERT_COLUMNS == raised.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, raised.collect()))


def test_messages_that_are_no_alerts_give_empty_rows(lines):
    rows = alerts_from_json(lines(["not json", '{"type": "X"}']), keep=["value"]).collect()
    assert [(r["value"], r["type"]) for r in rows] == [("not json", None), ('{"type": "X"}', "X")]


def test_first_delivery_wins(lines):
    raised = alerts(lines(requests(20, 20)))
    again = raised.withColumn("timestamp", F.lit("2024-01-01T00:05:00"))
    kept = first_deliveries(again.unionByName(raised).unionByName(again))
    assert sorted(map(str, kept.collect())) == sorted(map(str, raised.collect()))


def test_one_pass_agrees_with_separate_counts(lines):
    """Random requests with one client and one URL in a third of all, per batch."""
    rng = random.Random(5)
    values = []
    for _ in range(3000):
        hot = rng.random() < 0.34
        values.append(line(
            status=rng.choice([200, 200, 404, 500]),
            url="/hot" if hot else f"/{rng.randrange(50)}",
            ip="10.9.9.9" if hot else f"10.0.0.{rng.randrange(200)}",
        ))
    values += ["junk"] * 100
    parsed = parse_access_log(lines(values))
    stats = error_stats(parsed)
    split = {scope: stats.filter(F.col("scope") == scope) for scope in ("GLOBAL", "URL", "IP")}

    def bag(frame, *names):
        return Counter(tuple(r) for r in frame.select(*names).collect())

    assert bag(split["GLOBAL"], "total", "errors") == bag(batch_summary(parsed), "total", "errors")
    by_url, by_ip = url_error_stats(parsed), ip_error_stats(parsed)
    assert bag(split["URL"], "url", "total", "errors") == bag(by_url, "url", "total", "errors")
    assert bag(split["IP"], "ip", "total", "errors") == bag(by_ip, "ip", "total", "errors")
    totals = {r["scope"]: (r["t"], r["e"]) for r in stats.groupBy("scope").agg(
        F.sum("total").alias("t"), F.sum("errors").alias("e")).collect()}
    assert len(set(totals.values())) == 1 and totals["URL"][0] == 3100
