"""Document fingerprints from prefix polynomial hashes.

For a text of code points c the prefix array holds the sum of ``(c[k] + 1) * B**k`` modulo
``2**31 - 1`` up to every place, for two bases. The hash of any span is the difference of
two entries, shifted to a common power; so spans of two texts are compared in constant
time, and the longest common extension from any two places is found by binary search.

A fingerprint is the hash of the whole text followed by the ``SAMPLE`` smallest mixed
hashes of its spans of ``SPAN`` code points, those at the beginning being shorter. Texts
that share a share of their spans share about as much of the sample, and equal texts have
equal fingerprints. The likeness of two fingerprints is the Jaccard similarity of the span
sets as the samples estimate it.

Edge cases: null and empty texts have no spans, and are all alike; every other column is
left out; a null id comes first in the order of documents; rows with equal ids are ordered
by their text and each has a next one; a single document is followed by itself; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitwatch.llm.common import mix, runs

MODULUS = np.uint64((1 << 31) - 1)
BASES = (np.uint64(1_103_515_245), np.uint64(1_664_525_017))
SPAN = 16
SAMPLE = 64
DIGITS = 10  # hexadecimal digits of each sampled hash
#: Rows of a range of documents that one task walks through, and the most ranges there
#: are; beyond, ranges get longer.
RANGE_ROWS, RANGES, STEP = 5_000, 4096, 64


def _reduce(values: np.ndarray) -> np.ndarray:
    """Values below 2^62 modulo 2^31 - 1, up to one full modulus."""
    values = (values & MODULUS) + (values >> np.uint64(31))
    values = (values & MODULUS) + (values >> np.uint64(31))
    return np.where(values >= MODULUS, values - MODULUS, values)


@cache
def _powers(which: int, size: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    done = 1
    while done < size:
        step = np.uint64(pow(int(BASES[which]), done, int(MODULUS)))
        more = min(done, size - done)
        out[done : done + more] = _reduce(out[:more] * step)
        done += more
    return out


def powers(which: int, n: int) -> np.ndarray:
    return _powers(which, 1 << max(12, int(n).bit_length()))[: n + 1]


class Prefix:
    """Prefix arrays of a text."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.size = len(points)
        values = points.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for which in range(len(BASES)):
            sums = np.zeros(self.size + 1, np.uint64)
            # terms are below 2^31, so their sum stays below 2^63 for any text that fits in memory
            np.cumsum(_reduce(values * powers(which, self.size)[: self.size]), out=sums[1:])
            self.sums.append(_reduce(sums))

    def _span(self, which: int, start: int, end: int, to: int) -> int:
        """Hash of a span, as if it began at place ``to``."""
        sums = self.sums[which]
        value = (int(sums[end]) - int(sums[start])) % int(MODULUS)
        return value * pow(int(BASES[which]), to - start, int(MODULUS)) % int(MODULUS)

    def same(self, start: int, other: Prefix, at: int, length: int) -> bool:
        """Whether spans of two texts are equal, by both hashes."""
        to = max(start, at)
        return all(
            self._span(k, start, start + length, to) == other._span(k, at, at + length, to)
            for k in range(len(BASES))
        )

    def extension(self, start: int, other: Prefix, at: int) -> int:
        """Length of the longest common extension from a place in either text."""
        low, high = 0, min(self.size - start, other.size - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(start, other, at, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def span_hashes(self, length: int = SPAN) -> np.ndarray:
        """Mixed hash of the span that ends at each place."""
        n = self.size
        starts = np.maximum(np.arange(1, n + 1) - length, 0)
        parts = []
        for which, sums in enumerate(self.sums):
            # shifted to the end of the text: the power for a span that ends at e is n - e
            span = sums[1:] + MODULUS - sums[starts]
            parts.append(_reduce(_reduce(span) * powers(which, n)[n - 1 :: -1][:n]) if n else span)
            # and back by n, so that texts of all lengths agree
            back = np.uint64(pow(int(BASES[which]), -n, int(MODULUS)))
            parts[-1] = _reduce(parts[-1] * back)
        return mix((parts[0] << np.uint64(32)) | parts[1])

    def whole(self) -> int:
        first, second = (int(sums[-1]) for sums in self.sums)
        return int(mix(np.array([(first << 32 | second) ^ (self.size << 1)], np.uint64))[0])


def sample(hashes: np.ndarray, size: int = SAMPLE) -> np.ndarray:
    """The smallest different hashes, ascending."""
    take = 4 * size
    while True:
        part = np.partition(hashes, take)[:take] if take < len(hashes) else hashes
        found = np.unique(part >> np.uint64(64 - 4 * DIGITS))
        if len(found) >= size or take >= len(hashes):
            return found[:size]
        take *= 4


def fingerprint(prefix: Prefix) -> str:
    return f"{prefix.whole():016x}" + "".join(f"{v:0{DIGITS}x}" for v in sample(prefix.span_hashes()).tolist())


def likeness(a: str, b: str, size: int = SAMPLE) -> float:
    """Similarity of two fingerprints, from 0 to 1."""
    if a == b:
        return 1.0
    sets = [{f[at : at + DIGITS] for at in range(16, len(f), DIGITS)} for f in (a, b)]
    union = sorted(sets[0] | sets[1])[:size]  # equally long, so text order is number order
    return sum(v in sets[0] and v in sets[1] for v in union) / len(union) if union else 0.0


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(docs: DataFrame) -> DataFrame:
    """The documents with ``_range``, the number of a range of ids with about ``RANGE_ROWS``
    rows."""
    ids = docs.select("doc_id")
    count = min(RANGES, max(1, -(-ids.count() // RANGE_ROWS)))
    bounds = []
    if count > 1:
        shares = [k / count for k in range(1, count)]
        bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10 * count)).first()[0] or []))
    number = F.lit(0)
    if bounds:
        # the bounds at or below the id: every STEP-th first, then those in between
        coarse = STEP * F.size(F.filter(F.lit(bounds[STEP - 1 :: STEP] or [None]), lambda x: x <= F.col("doc_id")))
        fine = F.size(F.filter(F.slice(F.lit(bounds), coarse + 1, F.lit(STEP)), lambda x: x <= F.col("doc_id")))
        number = F.when(F.col("doc_id").isNull(), 0).otherwise(coarse + fine)
    return docs.select("doc_id", "text").withColumn("_range", number)


SCHEMA = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix_next long, common_prefix_edited long"
)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, by :func:`edited` with the next
    document in order of ids (after the last, the first), and how alike they are.

    Ids are cut into ranges by counted bounds, and one shuffle brings the rows of a range
    together in order. The first row of every range also goes to the end of the range
    before it, so that every row meets its successor.
    """
    ranged = _ranges(docs)
    order = ["doc_id", F.xxhash64("text"), "text"]
    firsts = ranged.groupBy("_range").agg(F.min(F.struct(F.col("doc_id"))).alias("d")).select(
        "_range", F.col("d.doc_id").alias("_id")
    )
    # one row per range; texts are read for these ids only
    lowest = {row._range: row._id for row in firsts.collect()}
    numbers = sorted(lowest)
    before = {number: numbers[k - 1] for k, number in enumerate(numbers)}
    wanted = [value for value in lowest.values() if value is not None]
    heads = ranged.filter(F.col("doc_id").isin(wanted) if wanted else F.lit(False))
    if any(value is None for value in lowest.values()):
        heads = heads.unionByName(ranged.filter("doc_id is null"))
    heads = heads.groupBy("_range").agg(
        F.min(F.struct("doc_id", F.xxhash64("text").alias("h"), "text")).alias("d")
    ).select("d.doc_id", "d.text", F.col("_range").alias("_of"))
    to = F.element_at(F.create_map(*[F.lit(v) for pair in before.items() for v in pair]), F.col("_of")) if before else F.lit(0)
    guests = heads.select("doc_id", "text", to.alias("_range"), F.lit(1).alias("_guest"))
    rows = ranged.withColumn("_guest", F.lit(0)).unionByName(guests)
    # a task for each range, whatever its number hashes to
    parts = max(numbers, default=0) + 1
    sorted_rows = rows.repartitionById(parts, F.col("_range").cast("int")).sortWithinPartitions("_range", "_guest", *order)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its successor, with its range
        for batch, texts in runs(batches, "text"):
            ids, out = [], []
            number, guest = (batch.column(k).to_pylist() for k in (2, 3))
            for at, text in enumerate(texts):
                prefix = Prefix(text)
                mark = fingerprint(prefix)
                if held is not None and held[0] == number[at]:
                    ids.append(held[1])
                    out.append(_row(*held[2:], text, prefix, mark))
                held = None if guest[at] else (number[at], batch.column(0).slice(at, 1), text, prefix, mark)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(ids), *(pa.array(column) for column in zip(*out, strict=True))],
                    ["doc_id", *names],
                )

    names = [part.split()[0] for part in SCHEMA.split(", ")]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return sorted_rows.select("doc_id", "text", "_range", "_guest").mapInArrow(walk, f"doc_id {kind}, {SCHEMA}")


def _row(text: str, prefix: Prefix, mark: str, next_text: str, next_prefix: Prefix, next_mark: str) -> tuple:
    changed = edited(text, next_text)
    changed_prefix = Prefix(changed)
    changed_mark = fingerprint(changed_prefix)
    return (
        prefix.size,
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        mark,
        changed_mark,
        likeness(mark, changed_mark),
        likeness(mark, next_mark),
        prefix.extension(0, next_prefix, 0),
        prefix.extension(0, changed_prefix, 0),
    )
