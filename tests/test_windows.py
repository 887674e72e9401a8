from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from hitwatch.operators.parse import error_requests, parse_access_log
from hitwatch.operators.windows import (
    error_panes,
    error_window_urls,
    error_windows,
    flat_window,
    late_errors,
    top_urls,
    top_urls_of_panes,
    window_alert_urls,
    window_alerts,
    windows_of_panes,
)
from hitwatch.plans import batch
from tests.logs import START, line


def random_lines(n=1500, seed=1):
    """One second holds a third of the lines, one URL a third of those."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        second = 47 if rng.random() < 0.34 else rng.randrange(0, 120)
        url = "/hot" if rng.random() < 0.34 else f"/{rng.randrange(40)}"
        rows.append((second, rng.choice([200, 404, 404, 500]), url, f"10.0.0.{rng.randrange(30)}"))
    return rows


def windows_of(second):
    """Starts of the 30 s windows, one every 10 s, that hold ``second``."""
    return [start for start in range(-20, 130, 10) if start <= second < start + 30]


def expected(rows):
    found = defaultdict(list)
    for second, status, url, ip in rows:
        if status >= 400:
            for start in windows_of(second):
                found[start, status].append((url, ip))
    return found


def errors(lines, rows):
    return error_requests(parse_access_log(lines([line(*row) for row in rows])))


def start_second(frame):
    return (F.unix_timestamp("window_start") - F.lit(int(START.timestamp()))).alias("start")


def test_windows_against_brute_force(lines):
    rows = random_lines()
    found = expected(rows)
    got = flat_window(error_windows(errors(lines, rows)))
    assert Counter(
        (r["start"], r["status"], r["count_error"], r["count_distinct_ip"])
        for r in got.select(start_second(got), "status", "count_error", "count_distinct_ip").collect()
    ) == Counter(
        (start, status, len(hits), len({ip for _, ip in hits}))
        for (start, status), hits in found.items()
    )


def test_urls_are_the_whole_bag(lines):
    rows = random_lines(seed=2)
    found = expected(rows)
    got = flat_window(error_window_urls(errors(lines, rows)))
    bags = defaultdict(Counter)
    for r in got.select(start_second(got), "status", "url", "occurrences").collect():
        bags[r["start"], r["status"]][r["url"]] += r["occurrences"]
    assert bags == {key: Counter(url for url, _ in hits) for key, hits in found.items()}


def test_alert_needs_more_than_ten(lines):
    rows = [(5, 404, "/a", "10.0.0.1")] * 10 + [(65, 404, "/b", "10.0.0.1")] * 11
    raised = window_alerts(error_windows(errors(lines, rows))).collect()
    assert {r["count_error"] for r in raised} == {11} and len(raised) == 3
    assert {r["alert"] for r in raised} == {"Alerte: trop d'erreurs"}


def test_alert_urls_belong_to_alerts(lines):
    rows = random_lines(n=150, seed=4)
    found = expected(rows)
    got = flat_window(window_alert_urls(error_window_urls(errors(lines, rows))))
    bags = defaultdict(Counter)
    for r in got.select(start_second(got), "status", "url", "occurrences").collect():
        bags[r["start"], r["status"]][r["url"]] += r["occurrences"]
    loud = {key: Counter(url for url, _ in hits) for key, hits in found.items() if len(hits) > 10}
    assert bags == loud and 0 < len(loud) < len(found)


def test_bad_dates_fall_out(lines):
    bad = line(status=404).replace("01/Jan", "99/Jan")
    frame = error_requests(parse_access_log(lines([bad, line(status=404), "junk"])))
    assert frame.count() == 2
    assert error_windows(frame).agg(F.sum("count_error")).first()[0] == 3


def test_approximate_clients(lines):
    exact = error_windows(errors(lines, random_lines(seed=6)))
    approx = error_windows(errors(lines, random_lines(seed=6)), 9)
    both = exact.join(approx.withColumnRenamed("count_distinct_ip", "near"), ["window", "status"])
    off = (F.col("near") - F.col("count_distinct_ip")) / F.col("count_distinct_ip")
    row = both.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(off * off)).alias("rsd")).first()
    assert row["n"] == exact.count() and row["rsd"] <= 0.05


def test_panes_add_up_to_windows(lines):
    found = errors(lines, random_lines(seed=8) + [(3, 404, "/a", "10.9.9.9")] * 40)
    exact = flat_window(error_windows(found))
    assert Counter(map(tuple, flat_window(windows_of_panes(error_panes(found))).collect())) == Counter(
        map(tuple, exact.collect()))


def test_sketches_of_many_clients_stay_within_their_deviation(spark):
    """3000 clients of one window: panes merge to the same sketch as the whole."""
    found = spark.range(9000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 30).alias("timestamp"), F.lit(500).alias("status"),
        F.concat(F.lit("10.0."), (F.col("id") * 7919 % 3000).cast("string")).alias("ip"), F.lit("/").alias("url"),
    )
    whole = flat_window(error_windows(found, 12)).filter("second(window_start) = 0").first()
    panes = flat_window(windows_of_panes(error_panes(found))).filter("second(window_start) = 0").first()
    assert whole.count_error == panes.count_error == 9000
    for row in (whole, panes):
        assert abs(row.count_distinct_ip - 3000) <= 3 * 0.016 * 3000


def expected_top(rows, k=3):
    out = set()
    for (start, status), hits in expected(rows).items():
        counts = Counter(url for url, _ in hits)
        least = sorted(counts.values(), reverse=True)[:k][-1]
        off = len(hits) * 35 // 1280
        out |= {(start, status, url, n, off) for url, n in counts.items() if n >= least}
    return out


def test_top_urls_with_ties(lines):
    rows = random_lines(seed=9)
    found = errors(lines, rows)
    columns = ["status", "url", "occurrences", "most_off"]
    for got in (top_urls(found), top_urls_of_panes(error_panes(found))):
        flat = flat_window(got)
        listed = flat.select(start_second(flat), *columns).collect()
        assert len(listed) == len(set(listed)) and set(map(tuple, listed)) == expected_top(rows)


def test_late_by_how_many_windows(lines):
    rows = [(245, 500), (250, 500), (259, 404), (260, 500), (269, 500), (270, 500), (0, 500), (400, 500)]
    bad_date = line(status=404).replace("01/Jan", "99/Jan")
    found = error_requests(parse_access_log(lines([*(line(*row) for row in rows), bad_date])))
    got = late_errors(found, (int(START.timestamp()) + 270) * 1000)
    second = F.unix_seconds("timestamp") - int(START.timestamp())
    brute = {
        second: sum(start + 30 <= 270 for start in range(-20, 410, 10) if start <= second < start + 30)
        for second, _ in rows
    }
    assert {tuple(r) for r in got.select(second, "windows_missed").collect()} == {
        (second, missed) for second, missed in brute.items() if missed}
    assert late_errors(found, 0).count() == 0


def test_approximate_windows_are_held_against_exact_counts(spark, small):
    """A window whose sketch is far off keeps its exact count, and the flag says so."""
    second = F.timestamp_seconds(1704067200 + F.floor(F.col("id") / 3000) * 60)
    errors = spark.range(3010).select(
        second.alias("timestamp"), F.lit(500).alias("status"), F.concat(F.lit("c"), F.col("id")).alias("ip")
    )
    near = flat_window(error_windows(errors, 12))
    far = near.withColumn("count_distinct_ip", F.expr("if(count_error = 3000, 1500, count_distinct_ip)"))
    for rows, flag in ((near, True), (far, False)):
        got = batch.checked_counts(rows, errors).select("count_error", "count_distinct_ip", "within_bound")
        assert Counter(map(tuple, got.collect())) == {(3000, 3000, flag): 3, (10, 10, True): 3}
    checked = batch.error_windows_approx(spark, small)
    assert checked.columns[-2:] == ["count_distinct_ip", "within_bound"]
    assert checked.count() == checked.filter("within_bound").count() == batch.error_windows(spark, small).count() > 0
