from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from hitwatch.operators import throughput as t

EPOCH = 1704067200


@pytest.fixture
def messages(spark):
    def make(rows):
        """rows of (topic, partition, offset, second)"""
        frame = spark.createDataFrame(
            [(*row[:3], float(row[3])) for row in rows],
            "topic string, partition int, offset long, second double",
        )
        return frame.withColumn(
            "timestamp", F.timestamp_millis(((F.col("second") + EPOCH) * 1000).cast("long"))
        ).drop("second")

    return make


def samples(frame, first=None, last=None):
    steps = t.offset_steps(frame)
    lo, hi = t.covered_range(steps)
    return t.offset_samples(
        steps, lo if first is None else EPOCH + first, hi if last is None else EPOCH + last
    )


def as_dict(frame, *keys, value="current_offset"):
    return {
        tuple(r[k] - EPOCH if k == "sample_sec" else r[k] for k in keys): r[value]
        for r in frame.collect()
    }


def test_grid_carries_on_and_starts_at_zero(messages):
    frame = messages([("a", 0, 0, 0), ("a", 0, 1, 15), ("a", 0, 2, 15.2), ("b", 0, 0, 50)])
    got = as_dict(samples(frame), "topic", "sample_sec")
    assert got == {
        ("a", 0): 1, ("a", 15): 2, ("a", 30): 3, ("a", 45): 3, ("a", 60): 3,
        ("b", 0): 0, ("b", 15): 0, ("b", 30): 0, ("b", 45): 0, ("b", 60): 1,
    }


def test_given_range_sees_what_came_before(messages):
    frame = messages([("a", 0, 0, 0), ("a", 0, 1, 20), ("a", 0, 9, 200)])
    got = as_dict(samples(frame, first=60, last=90), "sample_sec")
    assert got == {(60,): 2, (75,): 2, (90,): 2}
    assert as_dict(samples(frame, first=195, last=240), "sample_sec") == {
        (195,): 2, (210,): 10, (225,): 10, (240,): 10}
    assert as_dict(samples(frame, first=-30, last=0), "sample_sec") == {(-30,): 0, (-15,): 0, (0,): 1}


def test_nothing(messages):
    assert samples(messages([])).count() == 0


def brute(rows, seconds, resets, first, last):
    """change per (topic, partition, tick), straight from the definition"""
    series = {}
    for topic, partition, offset, second in rows:
        series.setdefault((topic, partition), []).append((second, offset))
    found = {}
    for key, points in series.items():
        def at(tick):
            cells = {}
            for second, offset in points:
                cell = -(-second // 15) * 15
                if cell <= tick:
                    cells[cell] = max(cells.get(cell, 0), offset + 1)
            return cells[max(cells)] if cells else 0

        ticks = range(first, last + 1, 15)
        values = [at(tick) for tick in ticks]
        for i, tick in enumerate(ticks):
            parts = []
            for j in range(1, i + 1):
                if tick - seconds < ticks[j] <= tick:
                    step = values[j] - values[j - 1]
                    parts.append(values[j] if resets and step < 0 else step)
            found[(*key, tick)] = sum(parts) if parts else None
    return found


def random_series(seed):
    """Three partitions; one topic is written anew from offset 0 on the way."""
    rng, rows = random.Random(seed), []
    for topic, partition, restart in (("a", 0, 300), ("a", 1, None), ("b", 0, None)):
        offset, second = 0, rng.randrange(40)
        while second < 700:
            if restart and second > restart:
                offset, restart = 0, None
            rows.append((topic, partition, offset, float(second)))
            offset += 1
            second += rng.choice([0, 1, 1, 2, 40])
    return rows


@pytest.mark.parametrize("block", [1024, 7, 3, 1])
@pytest.mark.parametrize("seconds, resets", [(60, True), (300, False)])
def test_range_sums_against_definition(messages, monkeypatch, seconds, resets, block):
    monkeypatch.setattr(t, "BLOCK_TICKS", block)
    rows = random_series(seconds)
    first = int(min(r[3] for r in rows) // 15 * 15)
    last = int(-(-max(r[3] for r in rows) // 15) * 15)
    range_of = t.increase if resets else t.delta
    got = as_dict(
        range_of(samples(messages(rows)), seconds), "topic", "partition", "sample_sec", value="change"
    )
    want = brute(rows, seconds, resets, first, last)
    assert got == want
    assert not resets or all(v is None or v >= 0 for v in got.values())


@pytest.mark.parametrize("block", [1024, 5, 2])
def test_grid_is_the_same_whatever_the_blocks(messages, monkeypatch, block):
    monkeypatch.setattr(t, "BLOCK_TICKS", block)
    test_grid_carries_on_and_starts_at_zero(messages)
    test_given_range_sees_what_came_before(messages)


def test_no_array_is_longer_than_a_block(spark, messages, monkeypatch):
    """Two messages a year apart."""
    lengths = []
    sequence = F.sequence

    def watched(*args):
        out = sequence(*args)
        lengths.append(out)
        return out

    monkeypatch.setattr(t.F, "sequence", watched)
    frame = messages([("a", 0, 0, 0), ("a", 0, 1, 365 * 86400)])
    steps = t.offset_steps(frame)
    got = t.offset_samples(steps, *t.covered_range(steps))
    assert got.count() == 365 * 86400 // 15 + 1
    assert {r["current_offset"] for r in got.select("current_offset").distinct().collect()} == {1, 2}
    # outer and inner sequences of both spreads, and the ticks of a block
    assert len(lengths) == 5 and all("sequence" in str(column) for column in lengths)
    by_block = got.groupBy((F.col("sample_sec") / (15 * t.BLOCK_TICKS)).cast("long")).count()
    assert by_block.agg(F.max("count")).first()[0] <= t.BLOCK_TICKS


def test_steps_of_parts_add_up(messages):
    """Also where a topic comes an hour late."""
    early = [("a", 0, k, 3600.0 + k) for k in range(40)]
    late = [("b", 0, k, float(k)) for k in range(40)]
    parts = [early[:15], early[15:], late[:7] + late[20:], late[7:20]]
    whole = {tuple(r) for r in t.offset_steps(messages(early + late)).collect()}
    merged = None
    for part in parts:
        steps = t.offset_steps(messages(part))
        merged = steps if merged is None else merged.unionByName(steps)
    assert {tuple(r) for r in t.merged_steps(merged).select("topic", "partition", "tick", "offset_after", "opened").collect()} == whole


def test_rate_settles(messages):
    rows = [("a", p, i, i / 25) for p in (0, 1) for i in range(25 * 120 + 1)]
    got = as_dict(t.rate_by_topic(samples(messages(rows))), "sample_sec", value="value")
    assert [got[(s,)] for s in (0, 15, 30, 45, 60, 120)] == [None, 12.5, 25.0, 37.5, 50.0, 50.0]


def test_delta_per_minute_and_consumer_shape(messages):
    rows = [("a", 0, i, float(i)) for i in range(601)]
    got = as_dict(t.delta_by_topic(samples(messages(rows))), "sample_sec", value="value")
    assert got[(600,)] == 60.0
    consumer = t.delta_by_consumer(samples(messages(rows)))
    assert consumer.columns == ["sample_sec", "consumergroup", "topic", "value"]
    assert {r["consumergroup"] for r in consumer.collect()} == {None}


def test_labels(messages):
    frame = messages([("b", 0, 0, 0), ("a", 0, 0, 0), ("a", 3, 0, 0), ("__consumer_offsets", 0, 0, 0)])
    names = t.label_values(frame, "topic", without=t.INTERNAL_TOPICS)
    assert [r["topic"] for r in names.collect()] == ["a", "b"]
    assert {tuple(r) for r in t.partitions_per_topic(frame).collect()} == {
        ("a", 2), ("b", 1), ("__consumer_offsets", 1)}
    labelled = t.with_scrape_labels(frame)
    assert t.matching(labelled, topic="a|b", instance="kafka.*").count() == 3
    # patterns cover the whole label
    assert t.matching(labelled, topic="consumer").count() == 0


def test_legend(spark):
    rows = [("a", 1, 5.0), ("a", 2, 3.0), ("a", 3, None), ("b", 1, None)]
    frame = spark.createDataFrame(rows, "topic string, sample_sec long, value double")
    assert {tuple(r) for r in t.legend(frame).collect()} == {("a", 3.0, 5.0), ("b", None, None)}


def test_legend_of_several_labels(spark):
    rows = [(None, "a", 1, 5.0), (None, "a", 2, 3.0), ("g", "a", 1, 4.0)]
    frame = spark.createDataFrame(rows, "consumergroup string, topic string, sample_sec long, value double")
    got = {tuple(r) for r in t.legend(frame, ("consumergroup", "topic")).collect()}
    assert got == {(None, "a", 3.0, 5.0), ("g", "a", 4.0, 4.0)}


def test_rule_fires_on_minutes_with_new_messages(messages):
    rows = [("alerts", 0, 0, 3.0), ("alerts", 0, 1, 59.0), ("alerts", 0, 2, 61.0), ("alerts", 0, 3, 290.0)]
    fired = t.new_message_rule(samples(messages(rows))).collect()
    assert {(r["sample_sec"] - EPOCH, r["increase"]) for r in fired} == {(60, 2), (120, 1), (300, 1)}
    assert {(r["summary"], r["severity"]) for r in fired} == {("New alert message detected", "critical")}


def test_latest(messages):
    frame = messages([("alerts", p, i, float(i)) for p in (0, 1) for i in range(10)])
    got = t.latest_messages(frame, 3, "alerts").collect()
    assert [(r["partition"], r["offset"]) for r in got] == [(0, 9), (0, 8), (0, 7)]


def brute_spans(states):
    """Stretches of equal states, evaluation by evaluation."""
    out = []
    for series in sorted({row[:2] for row in states}):
        own = sorted((second, state) for *key, second, state in states if tuple(key) == series)
        for second, state in own:
            if out and out[-1][:3] == [*series, state]:
                out[-1][4:] = [second, out[-1][5] + 1]
            else:
                out.append([*series, state, second, second, 1])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("block", [1024, 5, 2, 1])
def test_rule_spans_against_brute_force(spark, monkeypatch, block):
    """Stretches of up to thirty evaluations, over many borders of small blocks."""
    monkeypatch.setattr(t, "BLOCK_TICKS", block)
    rng, states = random.Random(block), []
    for series in (("alerts", 0), ("alerts", 1), ("b", 0)):
        second = EPOCH + 60 * rng.randrange(5)
        while second < EPOCH + 60 * 200:
            state = rng.choice([t.FIRING, t.NORMAL, t.NO_DATA])
            for _ in range(rng.choice([1, 2, 7, 30])):
                states.append((*series, second, state))
                second += 60
    frame = spark.createDataFrame(states, "topic string, partition int, sample_sec long, state string")
    columns = ["topic", "partition", "state", "since_sec", "until_sec", "evaluations"]
    got = sorted(map(tuple, t.rule_spans(frame.repartition(3)).select(columns).collect()))
    assert got == brute_spans(states)


def test_rule_has_no_data_without_samples(messages):
    rows = [("alerts", 0, 0, 3.0), ("alerts", 0, 1, 61.0), ("alerts", 0, 2, 290.0)]
    states = t.rule_states(samples(messages(rows)), EPOCH - 90, EPOCH + 420)
    got = {r["sample_sec"] - EPOCH: r["state"] for r in states.collect()}
    assert got == {-60: "NoData", 0: "NoData", 60: "Alerting", 120: "Alerting", 180: "Normal", 240: "Normal",
                   300: "Alerting", 360: "NoData", 420: "NoData"}
    spans = t.rule_spans(states).select("state", "since_sec", "evaluations").orderBy("since_sec").collect()
    assert [(r[0], r[1] - EPOCH, r[2]) for r in spans] == [
        ("NoData", -60, 2), ("Alerting", 60, 2), ("Normal", 180, 2), ("Alerting", 300, 1), ("NoData", 360, 2)]


def test_rule_of_no_series(messages):
    assert t.rule_spans(t.rule_states(samples(messages([])), EPOCH, EPOCH + 600)).count() == 0


def opened_files(frame):
    """Files that the scans of messages of an executed plan have opened."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(k) for k in range(leaves.size())]
    own = [scan for scan in scans if "FileScan" in scan.toString() and "PartitionFilters: [isnotnull(span" in scan.toString()]
    assert own
    return sum(scan.metrics().apply("numFiles").value() for scan in own)


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_of_an_archive_open_their_own_files(spark, messages, tmp_path, seed):
    rows = [row for row in random_series(seed) if row[0] != "a" or row[1] == 1]  # no fresh starts
    frame = messages(rows)
    path = f"{tmp_path}/archive"
    t.archive(frame, path, 100)
    whole = t.offset_steps(frame)
    assert t.archived_range(spark, path) == t.covered_range(whole)
    first, last = t.covered_range(whole)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # for plans whose scans can be asked
    try:
        files = {}
        for since in (first, first + 90, first + 405, last - 60):
            steps = t.archived_steps(spark, path, since, 100)
            got = as_dict(t.offset_samples(steps, since, last), "topic", "partition", "sample_sec")
            want = as_dict(t.offset_samples(whole, since, last), "topic", "partition", "sample_sec")
            assert got == want
            plan = steps._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [isnotnull(span" in plan
            files[since] = opened_files(steps)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    spans = {row.span for row in spark.read.parquet(f"{path}/messages").select("span").distinct().collect()}
    assert len(spans) >= 7
    assert files[last - 60] <= 2 * 2 * len([span for span in spans if span >= (last - 60) // 100])
    assert files[last - 60] < files[first + 405] < files[first]


def test_archive_of_nothing(spark, messages, tmp_path):
    t.archive(messages([]), f"{tmp_path}/archive", 100)
    assert t.archived_range(spark, f"{tmp_path}/archive") == (0, 0)
    assert t.archived_steps(spark, f"{tmp_path}/archive", 0, 100).count() == 0
