"""Readers of a table that is written micro-batch by micro-batch."""

from __future__ import annotations

import os

import pytest

from hitwatch.jobs import compact as compact_job
from hitwatch.sinks import ledger
from hitwatch.sinks.ledger import compact, counting, new_entry, read_ledger, to_ledger

DAY = 86_400
SCHEMA = "value string"


@pytest.fixture
def clock(monkeypatch):
    """The time at which attempts are made."""
    now = [1_704_067_200.0]
    monkeypatch.setattr(ledger, "_now", lambda: now[0])
    return now


def values(spark, root, kind="text"):
    return sorted(row.value for row in read_ledger(spark, root, SCHEMA, kind).collect())


def files_of(root):
    return [os.path.join(at, name) for at, _, names in os.walk(f"{root}/data") for name in names if name.startswith("part-")]


@pytest.mark.parametrize("kind", ["text", "parquet"])
def test_the_last_attempt_counts(spark, lines, tmp_path, clock, kind):
    root = str(tmp_path / "t")
    deliver = to_ledger(root, kind)
    assert values(spark, root, kind) == []
    deliver(lines(["a", "b"]), 0)
    deliver(lines(["c"]), 1)
    clock[0] += 1
    deliver(lines(["a", "b"]), 0)
    deliver(lines([]), 2)
    assert values(spark, root, kind) == ["a", "b", "c"]
    if kind == "parquet":
        got = read_ledger(spark, root, "value string, batch long").collect()
        assert sorted(map(tuple, got)) == [("a", 0), ("b", 0), ("c", 1)]


def test_a_rewrite_that_breaks_changes_nothing(spark, lines, tmp_path, clock, monkeypatch):
    """Readers have the old rows until the new ones are complete."""
    root = str(tmp_path / "t")
    deliver = to_ledger(root, "text")
    deliver(lines(["old 1", "old 2"]), 0)
    reader = read_ledger(spark, root, SCHEMA, "text")
    clock[0] += 1

    def broken(*args):
        raise OSError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "publish", broken)
        with pytest.raises(OSError, match="gone"):
            deliver(lines(["new 1", "new 2"]), 0)
    # the files are there, and do not count
    assert any("new 1" in open(name).read() for name in files_of(root))
    assert values(spark, root) == ["old 1", "old 2"]
    with pytest.raises(Exception, match="division|DIVIDE|by zero"):
        deliver(lines(["x"]).selectExpr("string(1 / (length(value) - 1)) as value"), 0)
    assert values(spark, root) == ["old 1", "old 2"]
    clock[0] += 1
    deliver(lines(["new 1", "new 2"]), 0)
    assert values(spark, root) == ["new 1", "new 2"]
    # a reader from before goes on with the files it knows
    assert sorted(row.value for row in reader.collect()) == ["old 1", "old 2"]


def test_files_are_bounded_by_days(spark, lines, tmp_path, clock):
    root = str(tmp_path / "t")
    deliver = to_ledger(root, "text", files=1)
    start, want = clock[0], []
    for batch in range(30):
        clock[0] = start + batch * DAY / 10
        deliver(lines([f"line {batch}"]), batch)
        want.append(f"line {batch}")
    clock[0] = start + 2.91 * DAY
    deliver(lines(["line 5"]), 5)  # once more, two days later
    assert len(files_of(root)) == 31
    reader = read_ledger(spark, root, SCHEMA, "text")
    assert compact(spark, root, SCHEMA, "text") == 2
    assert values(spark, root) == sorted(want)
    assert sorted(row.value for row in reader.collect()) == sorted(want)  # still has its files
    clock[0] += 2 * 3600
    assert compact(spark, root, SCHEMA, "text") == 0
    # two days in a file each, and ten micro-batches of today
    assert len(files_of(root)) == 12 and values(spark, root) == sorted(want)
    # a micro-batch that is run again after that changes nothing
    deliver(lines(["line 3 again"]), 3)
    assert values(spark, root) == sorted(want)
    clock[0] += DAY
    compact(spark, root, SCHEMA, "text", keep_seconds=0)
    assert len(files_of(root)) == 3 and values(spark, root) == sorted(want)
    assert len(os.listdir(f"{root}/data")) == 3


def test_compaction_that_breaks_loses_nothing(spark, lines, tmp_path, clock, monkeypatch):
    root = str(tmp_path / "t")
    deliver = to_ledger(root, "text", files=1)
    for batch in range(4):
        deliver(lines([f"line {batch}"]), batch)
    clock[0] += DAY

    def broken(*args):
        raise OSError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "publish", broken)
        with pytest.raises(OSError):
            compact(spark, root, SCHEMA, "text")
    assert values(spark, root) == [f"line {batch}" for batch in range(4)]
    clock[0] += DAY
    assert compact(spark, root, SCHEMA, "text", keep_seconds=60) == 1
    clock[0] += 61
    compact(spark, root, SCHEMA, "text", keep_seconds=60)
    assert values(spark, root) == [f"line {batch}" for batch in range(4)] and len(os.listdir(f"{root}/data")) == 1


def test_wider_and_newer_entries_count():
    def made(*ranges):
        return [new_entry(first, last, now) for now, (first, last) in enumerate(ranges)]

    def counted(*ranges):
        return [(e.first, e.last, e.second) for e in counting(made(*ranges))]

    assert counted() == []
    assert counted((0, 0), (1, 1), (0, 0)) == [(0, 0, 2), (1, 1, 1)]
    assert counted((0, 0), (1, 1), (2, 2), (0, 1), (1, 1)) == [(0, 1, 3), (2, 2, 2)]
    assert counted((0, 1), (2, 5), (0, 5), (6, 6)) == [(0, 5, 2), (6, 6, 3)]


def test_compaction_job(spark, tmp_path, clock, monkeypatch, capsys):
    root = str(tmp_path / "steps")
    deliver = to_ledger(root)
    steps = spark.createDataFrame([("a", 0, 15, 1, 0)], "topic string, partition int, tick long, offset_after long, opened long")
    for batch in range(3):
        deliver(steps, batch)
    clock[0] += DAY
    monkeypatch.setattr(compact_job, "build_session", lambda name: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    compact_job.main([root])
    assert capsys.readouterr().out == "1 days put together\n"
    got = read_ledger(spark, root, "tick long, batch long").collect()
    assert sorted(map(tuple, got)) == [(15, 0), (15, 1), (15, 2)]
