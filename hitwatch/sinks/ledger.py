"""Micro-batches as a table that readers never see half of.

Below the root of the table there are

* ``data/NAME``: the files of one attempt to deliver a micro-batch; they are never changed;
* ``ledger/NAME``: an empty file, made once the data is complete. Its name says all.

``NAME`` is ``FIRST-LAST.ATTEMPT``, the micro-batches it stands for and a text that sorts by
time. To deliver is to make one empty file, which is atomic on any file system, and to read
is to list one folder: of several attempts at a micro-batch the last one counts, and a wider
range stands for all those within it. So a reader has the rows of a micro-batch from before
it ran again or from after, and all or none.

:func:`compact` puts the micro-batches of each day that is over into one range of files of
good size, in the same way, and deletes what no reader can be at any more.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hitwatch.session import folder_bytes, make_file, make_folder, names_in, remove
from hitwatch.sinks.batches import Deliver

#: Bytes of a file after compaction, and seconds for which readers may work on a listing.
FILE_BYTES, KEEP_SECONDS = 128 << 20, 3600


def _now() -> float:
    return time.time()


@dataclass(frozen=True, order=True)
class Entry:
    """Micro-batches ``first`` to ``last`` in one folder, written at ``attempt``."""

    first: int
    last: int
    attempt: str

    @property
    def name(self) -> str:
        return f"{self.first:012}-{self.last:012}.{self.attempt}"

    @property
    def second(self) -> int:
        return int(self.attempt.split("-")[0]) // 1_000_000

    @property
    def day(self) -> str:
        return f"{datetime.fromtimestamp(self.second, UTC):%Y-%m-%d}"

    def within(self, other: Entry) -> bool:
        return other.first <= self.first and self.last <= other.last


def _entry(name: str) -> Entry | None:
    batches, _, attempt = name.partition(".")
    first, _, last = batches.partition("-")
    return Entry(int(first), int(last), attempt) if attempt and first.isdigit() and last.isdigit() else None


def new_entry(first: int, last: int, now: float | None = None) -> Entry:
    micros = int((_now() if now is None else now) * 1_000_000)
    return Entry(first, last, f"{micros:018}-{uuid.uuid4().hex[:8]}")


def counting(entries: list[Entry]) -> list[Entry]:
    """The entries whose data make up the table: the widest, and of equal ranges the newest."""
    out: list[Entry] = []
    newest_first = sorted(entries, key=lambda e: e.attempt, reverse=True)
    for entry in sorted(newest_first, key=lambda e: (e.first, -e.last)):
        if not out or not entry.within(out[-1]):
            out.append(entry)
    return out


def listed(spark: SparkSession, root: str) -> list[Entry]:
    return [entry for entry in map(_entry, names_in(spark, f"{root}/ledger")) if entry]


def publish(spark: SparkSession, root: str, entry: Entry) -> None:
    """From here on readers find the entry's data."""
    make_folder(spark, f"{root}/ledger")
    make_file(spark, f"{root}/ledger/{entry.name}")


def to_ledger(root: str, kind: str = "parquet", files: int | None = None) -> Deliver:
    """Delivers micro-batches as attempts at ``root``, in at most ``files`` files each. Parquet
    files have the number of the micro-batch in a column ``batch``; text files are lines."""

    def deliver(rows: DataFrame, batch_id: int) -> None:
        entry = new_entry(batch_id, batch_id)
        if kind == "parquet":
            rows = rows.withColumn("batch", F.lit(batch_id).cast("long"))
        (rows.coalesce(files) if files else rows).write.format(kind).save(f"{root}/data/{entry.name}")
        publish(rows.sparkSession, root, entry)

    return deliver


def read_ledger(spark: SparkSession, root: str, schema: str | StructType, kind: str = "parquet") -> DataFrame:
    """The table as of now; no rows if nothing has been delivered."""
    paths = [f"{root}/data/{entry.name}" for entry in counting(listed(spark, root))]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(kind).load(paths)


def compact(
    spark: SparkSession, root: str, schema: str, kind: str = "parquet",
    keep_seconds: float = KEEP_SECONDS, now: float | None = None,
) -> int:
    """Puts the micro-batches of every day that is over into one range each; returns how many
    ranges were made. What has not counted for ``keep_seconds`` is deleted: older attempts,
    ranges put into wider ones, and data that never got into the ledger.

    A micro-batch that runs again after that changes nothing. One call at a time, by whoever
    runs the query.
    """
    now = _now() if now is None else now
    today = f"{datetime.fromtimestamp(now, UTC):%Y-%m-%d}"
    # a micro-batch that ran again later belongs to the day of those after it, so that days are
    # ranges without gaps
    days: dict[str, list[Entry]] = {}
    day = today
    for entry in reversed([entry for entry in counting(listed(spark, root)) if entry.first == entry.last]):
        day = min(day, entry.day)
        if day < today:
            days.setdefault(day, []).insert(0, entry)
    made = 0
    for own in days.values():
        if len(own) == 1:
            continue
        paths = [f"{root}/data/{entry.name}" for entry in own]
        size = sum(folder_bytes(spark, path) for path in paths)
        whole = new_entry(own[0].first, own[-1].last, now)
        rows = spark.read.schema(schema).format(kind).load(paths)
        rows.coalesce(max(1, -(-size // FILE_BYTES))).write.format(kind).save(f"{root}/data/{whole.name}")
        publish(spark, root, whole)
        made += 1
    _clean(spark, root, now - keep_seconds)
    return made


def _clean(spark: SparkSession, root: str, before: float) -> None:
    """Deletes entries that something made before then stands for, and data made before then
    that is in no entry."""
    entries = listed(spark, root)
    counted = counting(entries)
    for entry in entries:
        if entry not in counted and any(entry.within(other) and other.second <= before for other in counted):
            remove(spark, f"{root}/ledger/{entry.name}")
    left = {entry.name for entry in listed(spark, root)}
    for name in names_in(spark, f"{root}/data"):
        entry = _entry(name)
        if entry and name not in left and entry.second <= before:
            remove(spark, f"{root}/data/{name}")
