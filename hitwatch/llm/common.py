"""What several operators share: tables, shared folders, hot-key joins, word arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from hitwatch import session
from hitwatch.session import work_dir

#: Keys that hold more than this share of all rows are joined by broadcast; there
#: can be no more than its inverse of them.
HOT_SHARE = 1 / 500
#: Sides of up to so many rows are broadcast, after counting, if their texts have no more than so
#: many bytes; larger ones are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
#: Texts are worked on in runs of about this many characters.
RUN_CHARS = 500_000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one; see :func:`hitwatch.session.work_dir`."""
    return work_dir(spark, purpose)


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and a lost
    executor costs no more than reading again."""
    return session.stored(rows.sparkSession, rows, purpose)


def sized(rows: DataFrame, count: int) -> DataFrame:
    """A side of a join with ``count`` narrow rows: broadcast if they are few and, where columns
    have no fixed width, measure few bytes."""
    if count > BROADCAST_ROWS:
        return rows
    loose = [field.name for field in rows.schema if isinstance(field.dataType, (StringType, BinaryType))]
    if loose:
        width = sum((F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) for name in loose), F.lit(0))
        if (rows.agg(F.sum(width)).first()[0] or 0) > BROADCAST_BYTES:
            return rows
    return F.broadcast(rows)


def join_hot(
    rows: DataFrame, keyed: DataFrame, key: str, total: int, how: str = "inner"
) -> DataFrame:
    """Joins ``rows`` to ``keyed``, which has one row per key and in ``n_rows`` the
    number of rows with it in ``rows``; ``total`` is their sum.

    Keys above a fixed share of all rows are joined by broadcast, so that none of them
    ends up in one task; by that share they are a few hundred at most, whatever the
    input. The others are joined as usual.
    """
    limit = max(1000, int(total * HOT_SHARE))
    hot = F.broadcast(keyed.filter(F.col("n_rows") > limit).drop("n_rows"))
    cold = keyed.filter(F.col("n_rows") <= limit).drop("n_rows")
    rest = rows.join(hot.select(key), key, "left_anti").join(cold, key, how)
    return rows.join(hot, key).unionByName(rest)


def join_hot_keys(rows: DataFrame, keyed: DataFrame, keys: list[str], total: int) -> DataFrame:
    """As :func:`join_hot` for several keys, which may be null: ``keyed`` has them under
    ``k_`` and their names, and in ``n`` the number of rows."""
    limit = max(1000, int(total * HOT_SHARE))
    hot = F.broadcast(keyed.filter(F.col("n") > limit))

    def same(a: DataFrame, b: DataFrame) -> Column:
        out = F.lit(True)
        for key in keys:
            out = out & a[key].eqNullSafe(b[f"k_{key}"])
        return out

    cold = keyed.filter(F.col("n") <= limit)
    rest = rows.join(hot, same(rows, hot), "left_anti")
    return rows.join(hot, same(rows, hot)).unionByName(rest.join(cold, same(rest, cold)))


def runs(batches: Iterator[pa.RecordBatch], text: str, limit: int = RUN_CHARS) -> Iterator:
    """``(batch, texts)`` over pieces of the batches of about ``limit`` bytes of text or
    a single row; null texts are empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not batch.num_rows:
            continue
        size = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            piece = batch.slice(at, to - at)
            texts = piece.column(piece.schema.get_field_index(text)).to_pylist()
            yield piece, [value or "" for value in texts]
            at = to


# -- words of many texts as arrays -----------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@cache
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:  # doubling: base^(k + done) = base^k * base^done
        step = np.uint64(pow(base, done, 1 << 64))
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done *= 2
    return out


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 ... base ** (n - 1)`` modulo 2^64."""
    return _powers(int(base), 1 << max(10, int(n - 1).bit_length()))[:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (a fixed bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_arrays(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the lower-cased texts as ``(first, start, end, hash)``.

    A word is a run of letters and digits; every character outside ASCII counts as a
    letter. ``first`` has for each text the number of its first word, and one more
    entry at the end; ``start`` and ``end`` are byte positions in the joined texts. The
    hash of a word is the difference of two entries of a prefix array of powers,
    modulo 2^64, shifted to position 0, so no word is looked at twice.
    """
    encoded = [text.lower().encode("utf-8", "surrogatepass") for text in texts]
    joined = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
    inside = _WORD_BYTE[joined]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    prefix = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(joined)), out=prefix[1:])
    hashed = (prefix[end] - prefix[start]) * powers(_INVERSE, len(joined) + 1)[start]
    text_starts = np.cumsum([0, *(len(value) + 1 for value in encoded)])
    return np.searchsorted(start, text_starts), start, end, mix(hashed)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order; the words may span texts, so
    callers drop what crosses a border."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x100000001B3) + words[k : k + n]
    return mix(out)
