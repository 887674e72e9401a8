"""Streams against the batch functions over the same lines."""

from __future__ import annotations

import json
import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hitwatch.operators.alerts import alerts_by_time, error_rate_alerts, first_alerts
from hitwatch.operators.parse import error_requests, parse_access_log
from hitwatch.operators.records import alerts_from_json
from hitwatch.operators.throughput import covered_range, increase, merged_steps, offset_samples, offset_steps
from hitwatch.operators.windows import (
    error_window_urls,
    error_windows,
    flat_window,
    top_urls,
    window_alert_urls,
    window_alerts,
)
from hitwatch.plans import replay, streams
from hitwatch.schema import ALERT_SCHEMA, CLIENT_SKETCH, STEP_SCHEMA, WATERMARK
from hitwatch.session import work_dir
from hitwatch.sinks.batches import to_parquet, to_text
from hitwatch.sinks.ledger import read_ledger, to_ledger
from hitwatch.sinks.streams import console, parquet_files, text_files
from hitwatch.sources import derived
from hitwatch.sources.lines import line_file_stream, table
from hitwatch.streaming import queries
from hitwatch.streaming.lifecycle import running, until_any_ends, until_done
from hitwatch.streaming.progress import BatchLog
from hitwatch.streaming.rates import CHANGES, live_increases
from hitwatch.streaming.state import late_watermark, open_windows
from tests.logs import line

TO_THE_END = {"availableNow": True}


def write_files(folder, batches):
    """One file per micro-batch, in order of modification time."""
    folder.mkdir(exist_ok=True)
    now = time.time() - 1000
    for i, values in enumerate(batches):
        path = folder / f"{i:03}.log"
        path.write_text("".join(f"{value}\n" for value in values))
        os.utime(path, (now + i, now + i))
    return str(folder)


@pytest.fixture(scope="module")
def landed(spark, small, tmp_path_factory):
    """The lines of the small table in five files, and as a batch table."""
    lines = derived.access_log_lines(table(spark, small, "events"))
    values = [r["value"] for r in lines.orderBy("event_id").collect()]
    folder = write_files(
        tmp_path_factory.mktemp("landing") / "lines",
        [values[i * 2000 : (i + 1) * 2000] for i in range(5)],
    )
    return folder, spark.createDataFrame([(v,) for v in values], "value string")


def stream_of(spark, folder):
    return line_file_stream(spark, folder, max_files_per_trigger=1)


def bag(frame):
    return Counter(tuple(map(str, row)) for row in frame.collect())


def finished(spark, rows):
    """Append output of the whole stream."""
    at = work_dir(spark, "test")
    flat = flat_window(rows)
    writer = parquet_files(flat, f"{at}/out")
    until_done(queries.start(writer, f"{at}/checkpoint", TO_THE_END))
    return spark.read.schema(flat.schema).parquet(f"{at}/out")


def closed(windows, errors):
    """Windows the watermark has passed at the end of the stream."""
    newest = errors.agg(F.max("timestamp")).first()[0]
    return flat_window(windows).filter(
        F.col("window_end") <= F.lit(newest) - F.expr(f"interval {WATERMARK}")
    )


def test_append_gives_the_closed_windows(spark, landed):
    folder, batch = landed
    errors = error_requests(parse_access_log(batch))
    want = closed(error_windows(errors, CLIENT_SKETCH), errors)
    got = finished(spark, queries.window_metrics(stream_of(spark, folder)))
    assert bag(got) == bag(want) and got.count() == 112
    alerts = finished(spark, queries.window_metrics_alerts(stream_of(spark, folder)))
    want = closed(window_alerts(error_windows(errors, CLIENT_SKETCH)), errors)
    assert bag(alerts) == bag(want) and alerts.count() == 44


def test_append_urls(spark, landed):
    folder, batch = landed
    errors = error_requests(parse_access_log(batch))
    got = finished(spark, queries.window_urls(stream_of(spark, folder)))
    assert bag(got) == bag(closed(error_window_urls(errors), errors)) and got.count() > 0


def test_urls_of_loud_windows(spark, landed):
    folder, batch = landed
    errors = error_requests(parse_access_log(batch))
    at = work_dir(spark, "test")
    until_done(queries.start_alert_urls(
        stream_of(spark, folder), to_parquet(f"{at}/out"), f"{at}/checkpoint", TO_THE_END
    ))
    got = spark.read.parquet(f"{at}/out").drop("batch")
    want = closed(window_alert_urls(error_window_urls(errors)), errors)
    assert bag(got.select(want.columns)) == bag(want) and got.count() > 0


def test_steps_lose_no_late_topic(spark, tmp_path):
    """One file per micro-batch; topic b lies an hour behind topic a."""
    rows = [("a", 0, k, 3600.0 + 9 * k) for k in range(20)], [("b", 0, k, 9.0 * k) for k in range(20)]
    files = [rows[0][:10], rows[1][:5], rows[0][10:], rows[1][5:15], rows[1][15:]]
    schema = "topic string, partition int, offset long, second double"
    now = time.time() - 1000
    for i, part in enumerate(files):
        frame = spark.createDataFrame(part, schema).withColumn("timestamp", F.timestamp_seconds("second"))
        frame.coalesce(1).write.parquet(f"{tmp_path}/{i}")
        name = next(n for n in os.listdir(tmp_path / str(i)) if n.endswith(".parquet"))
        os.makedirs(tmp_path / "in", exist_ok=True)
        os.link(tmp_path / str(i) / name, tmp_path / "in" / f"{i}.parquet")
        os.utime(tmp_path / "in" / f"{i}.parquet", (now + i, now + i))
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    at = work_dir(spark, "test")
    until_done(queries.start_steps(stream, to_parquet(f"{at}/out"), f"{at}/checkpoint", TO_THE_END))
    parts = spark.read.parquet(f"{at}/out")
    assert parts.select("batch").distinct().count() == 5
    want = offset_steps(spark.read.parquet(f"{tmp_path}/in"))
    columns = ["topic", "partition", "tick", "offset_after", "opened"]
    assert bag(merged_steps(parts).select(columns)) == bag(want.select(columns))


def test_update_ends_at_the_batch_result(spark, landed):
    folder, batch = landed
    at = work_dir(spark, "test")
    rows = flat_window(queries.window_metrics(stream_of(spark, folder)))
    until_done(queries.start_latest(rows, to_parquet(f"{at}/out"), f"{at}/checkpoint", TO_THE_END))
    updates = spark.read.parquet(f"{at}/out")
    keys = ["window_start", "window_end", "status"]
    last = updates.groupBy(*keys).agg(
        F.max_by(F.struct("count_error", "count_distinct_ip"), "batch").alias("last")
    ).select(*keys, "last.*")
    want = flat_window(error_windows(error_requests(parse_access_log(batch)), CLIENT_SKETCH))
    assert bag(last) == bag(want)
    assert updates.select("batch").distinct().count() >= 5
    assert updates.count() > last.count()


def test_errors_as_json_files(spark, landed):
    folder, batch = landed
    at = work_dir(spark, "test")
    writer = text_files(queries.error_json(stream_of(spark, folder)), f"{at}/out")
    until_done(queries.start(writer, f"{at}/checkpoint", TO_THE_END))
    got = Counter(r["value"] for r in spark.read.text(f"{at}/out").collect())
    assert got == Counter(r["value"] for r in queries.error_json(batch).collect())
    assert sum(got.values()) == 463 and all("status" in json.loads(text) for text in got)


def test_alerts_of_every_micro_batch(spark, landed):
    folder, batch = landed
    at = work_dir(spark, "test")
    query = queries.start_alerts(
        stream_of(spark, folder), to_text(f"{at}/out"), f"{at}/checkpoint", trigger=TO_THE_END
    )
    until_done(query)
    got = [json.loads(r["value"]) for r in spark.read.text(f"{at}/out").collect()]
    times = {}
    for alert in got:
        times.setdefault(alert["batch_id"], set()).add(alert.pop("timestamp"))
    assert times and all(len(seen) == 1 for seen in times.values())

    # the same alerts from a batch query over file number and line
    files = spark.read.text(folder).withColumn(
        "batch_id", F.regexp_extract(F.input_file_name(), r"(\d+)\.log$", 1).cast("long")
    )
    want = error_rate_alerts(
        parse_access_log(files, keep=["batch_id"]), F.col("batch_id"), F.lit("x"), keys=["batch_id"]
    )
    texts = [json.loads(r["value"]) for r in queries.alerts_as_json(want).collect()]
    for alert in texts:
        del alert["timestamp"]

    def order(alert):
        return json.dumps(alert, sort_keys=True)

    assert sorted(got, key=order) == sorted(texts, key=order)
    assert Counter(a["type"] for a in got)["GLOBAL_ERROR_RATE"] == 5
    metrics = [p.observedMetrics["requests"] for p in query.recentProgress if p.numInputRows]
    assert [m["total"] for m in metrics] == [2000] * 5
    assert sum(m["errors"] for m in metrics) == 463


def test_a_batch_delivered_twice_is_there_once(spark, lines):
    at = work_dir(spark, "test")
    for deliver in (to_text(f"{at}/text"), to_parquet(f"{at}/parquet")):
        deliver(lines(["a", "b"]), 0)
        deliver(lines(["c"]), 1)
        deliver(lines(["a", "b"]), 0)
    assert spark.read.text(f"{at}/text").count() == 3
    assert spark.read.parquet(f"{at}/parquet").count() == 3


def test_report_per_micro_batch(spark, landed):
    folder, _ = landed
    at = work_dir(spark, "test")
    until_done(queries.start_report(
        stream_of(spark, folder), to_text(f"{at}/out"), f"{at}/checkpoint", TO_THE_END
    ))
    got = [r["value"] for r in spark.read.text(f"{at}/out").collect()]
    assert len(got) == 5 and all(", total=2000, errors=" in text for text in got)


def test_a_resumed_query_goes_on_where_it_stopped(spark, landed, tmp_path):
    _, batch = landed
    values = [r["value"] for r in batch.limit(450).collect()]
    at = work_dir(spark, "test")
    folder = write_files(tmp_path / "in", [values[:300]])

    def run():
        query = queries.start_alerts(
            stream_of(spark, folder), to_text(f"{at}/out"), f"{at}/checkpoint", trigger=TO_THE_END
        )
        until_done(query)
        return sum(p.numInputRows for p in query.recentProgress)

    assert run() == 300
    (tmp_path / "in" / "900.log").write_text("\n".join(values[300:450]) + "\n")
    assert run() == 150
    got = {json.loads(r["value"])["batch_id"] for r in spark.read.text(f"{at}/out").collect()}
    assert got == {0, 1}


def test_window_state_survives_a_restart(spark, landed, tmp_path):
    folder, batch = landed
    names = sorted(os.listdir(folder))
    contents = [open(f"{folder}/{name}").read().splitlines() for name in names]
    landing = write_files(tmp_path / "in", contents[:3])
    at = work_dir(spark, "test")
    rows = flat_window(queries.window_metrics(stream_of(spark, landing)))

    def run():
        writer = parquet_files(rows, f"{at}/out")
        until_done(queries.start(writer, f"{at}/checkpoint", TO_THE_END))
        return spark.read.schema(rows.schema).parquet(f"{at}/out")

    first = run().count()
    for name, lines in zip(names[3:], contents[3:]):
        (tmp_path / "in" / f"later-{name}").write_text("\n".join(lines) + "\n")
    errors = error_requests(parse_access_log(batch))
    want = closed(error_windows(errors, CLIENT_SKETCH), errors)
    got = run()
    assert 0 < first < got.count() and bag(got) == bag(want)


SCRIPT = [
    [(5, 500), (6, 200)],
    [(600, 200)],   # no error: the watermark stays
    [(7, 500)],     # so this one still counts
    [(300, 500)],   # moves the watermark, from the next batch on
    [(301, 200)],
    [(8, 500)],     # too late
    [(540, 500)],   # closes the windows before
]


def test_late_errors_are_dropped(spark, tmp_path):
    folder = write_files(
        tmp_path / "in", [[line(second, status) for second, status in batch] for batch in SCRIPT]
    )
    at = work_dir(spark, "test")
    rows = flat_window(queries.window_metrics(stream_of(spark, folder)))
    query = queries.start(parquet_files(rows, f"{at}/out"), f"{at}/checkpoint", TO_THE_END)
    until_done(query)
    got = spark.read.schema(rows.schema).parquet(f"{at}/out")
    dropped = sum(
        state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in
        json.loads(p.json)["stateOperators"]
    )
    # the late line would have been in three windows
    assert dropped == 3
    second = F.unix_timestamp("window_start") - 1704067200
    assert Counter(
        (r["second"], r["count_error"]) for r in got.select(second.alias("second"), "count_error").collect()
    ) == {(-20, 2): 1, (-10, 2): 1, (0, 2): 1, (280, 1): 1, (290, 1): 1, (300, 1): 1}


def test_late_errors_come_out_beside_the_windows(spark, tmp_path):
    """The script once more, by windows that do not overlap: one line is late, and one is counted
    as dropped."""
    folder = write_files(
        tmp_path / "in", [[line(second, status) for second, status in batch] for batch in SCRIPT]
    )
    at = work_dir(spark, "test")
    logged = []
    listener = BatchLog(logged.append)
    spark.streams.addListener(listener)
    query = queries.start_windows_and_late(
        stream_of(spark, folder), to_parquet(f"{at}/windows"), to_parquet(f"{at}/late"), f"{at}/checkpoint",
        TO_THE_END, "30 seconds", "30 seconds",
    )
    until_done(query)
    deadline = time.time() + 30
    while not logged and time.time() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(listener)
    second = F.unix_timestamp("timestamp") - 1704067200
    late = spark.read.parquet(f"{at}/late").select(second.alias("s"), "status", "windows_missed", "batch").collect()
    assert [tuple(row) for row in late] == [(8, 500, 1, 5)]
    assert logged == ["batch 5: 1 late rows dropped"]
    windows = spark.read.parquet(f"{at}/windows")
    start = F.unix_timestamp("window_start") - 1704067200
    assert {tuple(r) for r in windows.select(start, "status", "count_error").collect()} == {(0, 500, 2), (300, 500, 1)}
    assert late_watermark(spark, f"{at}/checkpoint", 0) == 0
    assert late_watermark(spark, f"{at}/checkpoint", 5) == (1704067200 + 270) * 1000


def test_late_errors_with_overlapping_windows(spark, tmp_path):
    """At 00:04:30 an error of 00:04:25 has missed one of its windows, one of 00:04:15 two."""
    batches = [[(300, 500)], [(301, 200)], [(265, 500), (255, 404), (245, 500), (5, 500), (280, 500)], [(900, 500)]]
    folder = write_files(tmp_path / "in", [[line(*row) for row in batch] for batch in batches])
    at = work_dir(spark, "test")
    until_done(queries.start_windows_and_late(
        stream_of(spark, folder), to_parquet(f"{at}/windows"), to_parquet(f"{at}/late"), f"{at}/checkpoint", TO_THE_END
    ))
    second = F.unix_timestamp("timestamp") - 1704067200
    late = spark.read.parquet(f"{at}/late").select(second.alias("s"), "windows_missed").collect()
    assert {tuple(row) for row in late} == {(265, 1), (255, 2), (245, 3), (5, 3)}
    # what was not missed was counted
    windows = spark.read.parquet(f"{at}/windows")
    counted = windows.agg(F.sum("count_error")).first()[0]
    assert counted == 6 * 3 - sum(row.windows_missed for row in late)


def test_deliveries_in_one_micro_batch_are_late_as_one_by_one(spark, lines):
    """Late errors and closed windows do not depend on how many deliveries a micro-batch holds."""
    rng = random.Random(3)
    rows = [(second, rng.choice([200, 404, 500, 500])) for second in range(1200) for _ in range(2)]
    came = [(line(*row), (row[0] + rng.choice([0, 0, 0, 0, 45, 70, 200])) // 50) for row in rows]
    landed = spark.createDataFrame(came, "value string, delivery long")

    def run(delivery, land):
        at = work_dir(spark, "test")
        land(at)
        batches = sum(name.startswith("part=") for name in os.listdir(f"{at}/landing"))
        replay.feed(spark, at, "value string, delivery long", lambda stream: queries.start_windows_and_late(
            stream, to_ledger(f"{at}/windows"), to_ledger(f"{at}/late"), f"{at}/checkpoint", None, delivery=delivery
        ))
        schema = "window_start timestamp, window_end timestamp, status int, count_error long, count_distinct_ip long"
        late = read_ledger(spark, f"{at}/late", streams.LATE_SCHEMA)
        return batches, bag(read_ledger(spark, f"{at}/windows", schema)), bag(late)

    one, windows, late = run(None, lambda at: replay.land_by_number(landed, at, F.col("delivery")))
    assert one > 20 and windows and sum(late.values()) > 20
    for size, most in ((10_000, 1), (900, 3)):
        fewer, *got = run("delivery", lambda at: replay.land_by_range(landed, at, size, "delivery"))
        assert fewer <= most and got == [windows, late]


def test_late_errors_take_few_micro_batches(spark, small, monkeypatch):
    """Their number goes by rows, not by deliveries."""
    moved = []
    move = replay.move
    monkeypatch.setattr(replay, "move", lambda *args: (moved.append(args), move(*args)))
    assert streams.stream_late_errors(spark, small).count() > 0 and len(moved) == 1


def test_closed_and_open_windows_are_all_windows(spark, landed):
    folder, batch = landed
    at = work_dir(spark, "test")
    rows = flat_window(queries.window_metrics(stream_of(spark, folder)))
    assert open_windows(spark, f"{at}/checkpoint").count() == 0  # before the query has run
    until_done(queries.start(parquet_files(rows, f"{at}/out"), f"{at}/checkpoint", TO_THE_END))
    shown = spark.read.schema(rows.schema).parquet(f"{at}/out")
    waiting = flat_window(open_windows(spark, f"{at}/checkpoint"))
    errors = error_requests(parse_access_log(batch))
    assert bag(shown.unionByName(waiting)) == bag(flat_window(error_windows(errors)))
    assert (shown.count(), waiting.count()) == (112, 42)
    # after the first micro-batch nothing was closed yet, and two fifths of the log were to come
    early = flat_window(open_windows(spark, f"{at}/checkpoint", 0))
    first = error_windows(error_requests(parse_access_log(spark.read.text(f"{folder}/000.log"))))
    assert bag(early) == bag(flat_window(first))


def alert(batch, raised, url=None):
    return json.dumps({"timestamp": raised, "type": "URL_ERROR_RATE" if url else "GLOBAL_ERROR_RATE",
                       "message": "m", "batch_id": batch, "url": url, "total_requests": 5, "error_requests": 4,
                       "value": 0.8, "thresholds": 0.3})


def test_repeated_alerts_are_dropped_until_they_expire(spark, tmp_path):
    folder = write_files(tmp_path / "in", [
        [alert(1, "2024-01-01T00:00:00"), alert(1, "2024-01-01T00:00:00", "/a"), "no alert", alert(1, "not a time")],
        [alert(1, "2024-01-01T01:00:00.25"), alert(1, "2024-01-01T01:00:00", "/b")],  # one repeat
        [alert(2, "2024-01-01T01:30:00"), alert(2, "2024-01-01T01:30:00")],  # twice in a batch
        [alert(3, "2024-01-01T06:00:00")],  # the watermark goes to four o'clock
        [alert(4, "2024-01-01T06:00:01")],
        [alert(1, "2024-01-01T06:00:02"), alert(3, "2024-01-01T06:30:00")],  # forgotten; still known
    ])
    at = work_dir(spark, "test")
    rows = first_alerts(alerts_from_json(stream_of(spark, folder)))
    query = queries.start(parquet_files(rows, f"{at}/out"), f"{at}/checkpoint", TO_THE_END)
    until_done(query)
    got = spark.read.schema(ALERT_SCHEMA).parquet(f"{at}/out").select("batch_id", "url", "timestamp").collect()
    assert Counter(map(tuple, got)) == Counter([
        (1, None, "2024-01-01T00:00:00"), (1, "/a", "2024-01-01T00:00:00"), (1, "/b", "2024-01-01T01:00:00"),
        (2, None, "2024-01-01T01:30:00"), (3, None, "2024-01-01T06:00:00"), (4, None, "2024-01-01T06:00:01"),
        (1, None, "2024-01-01T06:00:02"),
    ])
    kept = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert kept[-1] == 3  # of seven


def test_alerts_by_time_on_a_stream(spark, landed):
    folder, batch = landed
    at = work_dir(spark, "test")
    rows = queries.timed_alerts(stream_of(spark, folder))
    until_done(queries.start(parquet_files(rows, f"{at}/out"), f"{at}/checkpoint", TO_THE_END))
    parsed = parse_access_log(batch)
    newest = parsed.agg(F.max(F.unix_seconds("timestamp"))).first()[0]
    want = alerts_by_time(parsed).filter((F.col("batch_id") + 1) * 10 <= newest - 30)
    got = spark.read.schema(ALERT_SCHEMA).parquet(f"{at}/out")
    assert bag(got) == bag(want) and 0 < got.count() < alerts_by_time(parsed).count()


def test_late_lines_raise_no_alert(spark, tmp_path):
    """Ten good requests of each span; errors that come after it is closed do not count."""
    good = [(second, 200) for second in range(10)]
    folder = write_files(tmp_path / "in", [
        [line(*row) for row in batch] for batch in
        (good + [(3, 500)], [(100, 200)], [(101, 200)], [(4, 500)] * 30, [(300, 200)])
    ])
    at = work_dir(spark, "test")
    rows = queries.timed_alerts(stream_of(spark, folder))
    until_done(queries.start(parquet_files(rows, f"{at}/out"), f"{at}/checkpoint", TO_THE_END))
    got = spark.read.schema(ALERT_SCHEMA).parquet(f"{at}/out").filter("type like 'GLOBAL%'").collect()
    assert [(r.total_requests, r.error_requests, r.timestamp) for r in got] == [(11, 1, "2024-01-01T00:00:10")]


def test_top_urls_keep_state_of_one_size(spark, tmp_path):
    """A window with 20 000 URLs takes no more state than one with 2 000, and counts are within
    their bound."""
    sizes = {}
    for urls in (2_000, 20_000):
        loud = [line(5, 404, f"/loud{k}") for k in range(4) for _ in range(urls // (4 + k))]
        quiet = [line(k % 9, 404, f"/quiet{k}") for k in range(urls)]
        folder = write_files(tmp_path / str(urls), [loud[::2] + quiet[::2], loud[1::2] + quiet[1::2]])
        at = work_dir(spark, "test")
        rows = flat_window(queries.window_top_urls(stream_of(spark, folder)))
        query = queries.start_latest(rows, to_parquet(f"{at}/out"), f"{at}/checkpoint", TO_THE_END)
        until_done(query)
        state = spark.read.format("statestore").load(f"{at}/checkpoint")
        sizes[urls] = state.agg(F.max(F.length(F.col("value.buf")))).first()[0]
        last = spark.read.parquet(f"{at}/out").filter("batch = 1")
        exact = flat_window(error_window_urls(error_requests(parse_access_log(spark.read.text(folder)))))
        keys = ["window_start", "window_end", "status", "url"]
        both = last.join(exact.withColumnRenamed("occurrences", "exact"), keys).collect()
        assert len(both) == last.count() > 0
        assert all(abs(r.occurrences - r.exact) <= r.most_off for r in both)
        loudest = {r.url for r in both if r.window_start.second == 0}
        assert {"/loud0", "/loud1", "/loud2"} <= loudest
    assert sizes[20_000] <= 1.2 * sizes[2_000] and sizes[20_000] < 128 * 40


def test_top_urls_on_a_stream(spark, landed):
    folder, batch = landed
    errors = error_requests(parse_access_log(batch))
    got = finished(spark, queries.window_top_urls(stream_of(spark, folder)))
    assert bag(got) == bag(closed(top_urls(errors), errors)) and got.count() > 0


def silent_series(seed):
    """Offsets of three partitions with long silences and one fresh start."""
    rng, rows = random.Random(seed), []
    for topic, partition, restart in (("a", 0, 900), ("a", 1, None), ("b", 0, None)):
        offset, second = 0, rng.randrange(40)
        while second < 1500:
            if restart and second > restart:
                offset, restart = 0, None
            rows.append((topic, partition, offset, float(second)))
            offset += 1
            second += rng.choice([0, 1, 1, 7, 60, 200])
    return sorted(rows, key=lambda row: row[3])


@pytest.mark.parametrize("parts, seconds", [(1, 60), (6, 300)])
def test_live_rates_are_those_of_the_closed_ticks(spark, parts, seconds):
    rows = silent_series(parts)
    frame = spark.createDataFrame(rows, "topic string, partition int, offset long, second double").withColumn(
        "timestamp", F.timestamp_seconds(F.col("second") + 1704067200)
    )
    at = work_dir(spark, "test")
    steps = offset_steps(frame)
    order = F.floor((F.col("tick") - 1704067200) * parts / 1530)
    replay.land_by_number(steps, at, order)
    query = replay.feed(spark, at, STEP_SCHEMA, lambda stream: queries.start(
        parquet_files(live_increases(stream, seconds), f"{at}/out"), f"{at}/checkpoint", None
    ))
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == steps.select(order).distinct().count()
    got = bag(spark.read.schema(CHANGES).parquet(f"{at}/out").select("topic", "partition", "sample_sec", "change"))
    # a series starts with its own first message
    last = covered_range(steps)[1] - 30
    want = Counter()
    for topic, partition in (("a", 0), ("a", 1), ("b", 0)):
        own = steps.filter((F.col("topic") == topic) & (F.col("partition") == partition))
        first, end = covered_range(own)
        samples = offset_samples(own, first, max(end, last))
        want += bag(increase(samples, seconds).filter(F.col("sample_sec") <= last).select(
            "topic", "partition", "sample_sec", "change"))
    assert got == want and len(got) > 250


def test_a_part_is_a_micro_batch_of_bounded_rows(spark, small):
    at = work_dir(spark, "test")
    lines = derived.access_log_lines(table(spark, small, "events"))
    replay.land_by_range(lines.select("value", "timestamp", "event_id"), at, 700, "timestamp", "event_id")
    seen = []
    query = replay.feed(spark, at, "value string, event_id long", lambda stream: queries.start(
        stream.writeStream.foreachBatch(lambda rows, _: seen.append(rows.agg(F.min("event_id"), F.max("event_id"), F.count("*")).first())),
        f"{at}/checkpoint", None,
    ))
    assert not query.isActive
    assert len(seen) == 15 and sum(row[2] for row in seen) == 10_000
    assert all(row[2] <= 1050 for row in seen)
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))  # in order of time


@pytest.fixture(scope="module")
def scattered(spark, small, tmp_path_factory):
    """The small events in more files than two micro-batches take, each with rows of all
    times; Spark drops late rows from the third micro-batch on."""
    folder = tmp_path_factory.mktemp("scattered")
    files = 3 * streams.FILES_PER_TRIGGER
    events = table(spark, small, "events").repartition(files, F.col("event_id") % 1000)
    events.write.parquet(f"{folder}/events.parquet")
    names = [name for name in os.listdir(folder / "events.parquet") if name.endswith(".parquet")]
    assert len(names) > 2 * streams.FILES_PER_TRIGGER
    return str(folder)


@pytest.mark.parametrize(
    "name", ["stream_error_windows_append", "stream_error_windows_update", "stream_error_window_urls",
             "stream_window_alerts", "stream_window_alert_urls"]
)
def test_windows_over_many_files_in_no_order(spark, small, scattered, monkeypatch, name):
    want = bag(streams.QUERIES[name](spark, small))
    monkeypatch.setattr(replay, "ROWS_PER_PART", 1500)
    assert bag(streams.QUERIES[name](spark, scattered)) == want and want


@pytest.mark.parametrize("name", ["stream_error_windows_append", "stream_error_windows_update"])
def test_stream_windows_are_held_against_exact_counts(spark, small, monkeypatch, name):
    """With sketches of 16 registers some windows are off by more than the bound; the counts are
    exact all the same."""
    rows = streams.QUERIES[name](spark, small)
    assert rows.columns[-2:] == ["count_distinct_ip", "within_bound"]
    assert rows.count() == rows.filter("within_bound").count() > 0
    monkeypatch.setattr(queries, "CLIENT_SKETCH", 4)
    rough = streams.QUERIES[name](spark, small)
    assert rough.filter("not within_bound").count() > 0
    assert bag(rough.drop("within_bound")) == bag(rows.drop("within_bound"))


def test_windows_of_no_events(spark, small, tmp_path):
    table(spark, small, "events").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("stream_error_windows_append", "stream_error_windows_update", "stream_window_alert_urls",
                 "stream_window_top_urls", "stream_open_windows", "stream_late_errors", "stream_topic_rate",
                 "stream_alerts_dedup", "stream_alerts_by_time"):
        assert streams.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_running_stops_what_is_left(spark, landed):
    folder, _ = landed
    with pytest.raises(RuntimeError):
        with running(
            queries.start(console(queries.error_json(stream_of(spark, folder)), "append"), None, None)
        ) as (query,):
            query.processAllAvailable()
            raise RuntimeError
    assert not query.isActive


def test_first_failure_is_raised_and_stops_the_others(spark, landed):
    folder, _ = landed

    def refuse(rows, batch_id):
        raise ValueError("no")

    good = queries.start(console(queries.error_json(stream_of(spark, folder)), "append"), None, None)
    bad = queries.start_alerts(stream_of(spark, folder), refuse, work_dir(spark, "test"))
    with pytest.raises(Exception, match="no"):
        until_any_ends(spark, good, bad)
    assert not good.isActive and not bad.isActive
