"""Stretches of text that repeat with a period, found by block convolution.

Words are numbered, and the texts of a run of rows stand behind each other in one array of
word numbers, with numbers that occur once at the borders. At scale ``B = 1, 2, 4, ...``
the array is cut into blocks of ``B`` words, and each block is laid over the ``2 B`` words
after it: the sums of squared differences at the distances ``B ... 2 B - 1`` come from
one product of polynomials, multiplied by number-theoretic transforms modulo primes, in
whole numbers. Where a sum is 0 the block occurs again. A run of period ``q`` with
``B <= q < 2 B`` and at least three periods holds such a block together with its
occurrence ``q`` words on, so distances seed all runs; seeds of neighbouring blocks at the
same distance are one stretch, which is then extended word by word to both sides.

Blocks are left out of the transform only where nothing can be lost: a block with a word
that does not occur again within ``2 B`` words has no occurrence, and a block whose whole
window lies in a run of a period up to ``B`` finds multiples of this period only, which are
no smallest periods.

Rows: nulls count as empty texts, and an empty text has no word and no run. Every row gets
a row, repeated rows and null ids too; a null id takes no planted repetition. Other columns
are not looked at, whatever their names. An empty table gives an empty result. Texts are
taken whole: memory follows the longest text of a task, and work is ``n log^2 n`` for ``n``
words, also where a text is one word over and over.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitwatch.llm.common import runs as text_runs

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4

#: Primes of the transforms, each with a generator of its units. Their orders hold 2^26 at
#: least; products of two residues stay below 2^63.
PRIMES = ((2_013_265_921, 31), (1_811_939_329, 13), (469_762_049, 3))

#: Numbers in one transform; more blocks are transformed in turn.
AT_ONCE = 1 << 20

SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, "
    "exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


# -- transforms ------------------------------------------------------------------------


def _modulo(values: np.ndarray, prime: int) -> np.ndarray:
    # numpy divides by a constant several times faster than it takes remainders
    values -= values // np.uint64(prime) * np.uint64(prime)
    return values


def _root_powers(prime: int, generator: int, size: int, inverse: bool) -> np.ndarray:
    """First half of the powers of a root of unity of order ``size``."""
    root = pow(generator, (prime - 1) // size, prime)
    if inverse:
        root = pow(root, -1, prime)
    out = np.ones(max(1, size // 2), np.uint64)
    done = 1
    while done < len(out):
        out[done : 2 * done] = _modulo(out[:done] * np.uint64(pow(root, done, prime)), prime)
        done *= 2
    return out


def _forward(values: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform along the first axis; the result is in bit-reversed order."""
    size = values.shape[0]
    powers = _root_powers(prime, generator, size, False)
    half = size // 2
    while half:
        pairs = values.reshape(size // (2 * half), 2, half, -1)
        low, high = pairs[:, 0], pairs[:, 1]
        out = np.empty_like(pairs)
        out[:, 0] = _modulo(low + high, prime)
        turn = powers[:: size // (2 * half)][:half].reshape(1, half, 1)
        out[:, 1] = _modulo((low + np.uint64(prime) - high) * turn, prime)
        values, half = out.reshape(size, -1), half // 2
    return values


def _backward(values: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Inverse of :func:`_forward`, from bit-reversed order."""
    size = values.shape[0]
    powers = _root_powers(prime, generator, size, True)
    half = 1
    while half < size:
        pairs = values.reshape(size // (2 * half), 2, half, -1)
        turn = powers[:: size // (2 * half)][:half].reshape(1, half, 1)
        low, high = pairs[:, 0], _modulo(pairs[:, 1] * turn, prime)
        out = np.empty_like(pairs)
        out[:, 0] = _modulo(low + high, prime)
        out[:, 1] = _modulo(low + np.uint64(prime) - high, prime)
        values, half = out.reshape(size, -1), half * 2
    return _modulo(values * np.uint64(pow(size, -1, prime)), prime)


def squared_differences(
    codes: np.ndarray, starts: np.ndarray, block: int, prime: int, generator: int
) -> np.ndarray:
    """Sums of ``(code[i + k] - code[i + d + k]) ** 2`` over ``k < block`` modulo ``prime``,
    in row ``d - block`` for ``block <= d < 2 * block``, a column for each start ``i``."""
    values = codes % np.uint64(prime)
    steps = np.arange(2 * block)
    near = values[starts[None, :] + steps[:block, None]]
    far = values[starts[None, :] + block + steps[:, None]]
    padded = np.zeros_like(far)
    padded[:block] = near[::-1]  # a reversed factor turns the product into a correlation
    product = _modulo(_forward(padded, prime, generator) * _forward(far, prime, generator), prime)
    # of the cyclic product only places below block - 1 are hit by both ends; none is used
    mixed = _backward(product, prime, generator)[block - 1 : 2 * block - 1]
    square = _modulo(far * far, prime)
    prefix = np.zeros((2 * block + 1, len(starts)), np.uint64)
    np.cumsum(square, axis=0, out=prefix[1:])  # below 2^31 * 2 * block
    moving = _modulo(prefix[block : 2 * block] - prefix[:block], prime)
    own = _modulo(_modulo(near * near, prime).sum(axis=0, dtype=np.uint64), prime)
    return _modulo(own + moving + np.uint64(2) * (np.uint64(prime) - mixed), prime)


def zero_mismatches(
    codes: np.ndarray, starts: np.ndarray, block: int, bound: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(start, distance)`` of all occurrences of the blocks at ``starts`` at the distances
    ``block ... 2 * block - 1``. ``bound`` is above all codes: as many primes are taken as it
    needs for a sum to be 0 modulo all of them only if it is 0."""
    found_start, found_distance = [], []
    width = max(1, AT_ONCE // (2 * block))
    for at in range(0, len(starts), width):
        part = starts[at : at + width]
        zero = np.ones((block, len(part)), bool)
        known, alive = 1, np.arange(len(part))
        for prime, generator in PRIMES:
            sums = squared_differences(codes, part[alive], block, prime, generator)
            zero[:, alive] &= sums == 0
            alive = alive[zero[:, alive].any(axis=0)]
            known *= prime
            if known > block * bound * bound or not len(alive):
                break
        column, row = np.nonzero(zero[:, alive].T)
        found_start.append(part[alive][column])
        found_distance.append(row + block)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found_start]), np.concatenate([empty, *found_distance])


# -- runs ------------------------------------------------------------------------------


def _next_same(codes: np.ndarray) -> np.ndarray:
    """Distance from every place to the next one with the same code; far above the length
    where there is none."""
    order = np.argsort(codes, kind="stable")
    out = np.full(len(codes), np.iinfo(np.int64).max // 2)
    same = codes[order[1:]] == codes[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _matching(codes: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many places in a row, from ``at`` on in direction ``step``, hold the same code as
    the place ``distance`` after them; chunks of growing width for all seeds at once."""
    out = np.zeros(len(at), np.int64)
    alive, width, last = np.arange(len(at)), 8, len(codes) - 1
    while len(alive):
        places = (at[alive] + step * out[alive])[:, None] + step * np.arange(width)
        other = places + distance[alive, None]
        inside = (places >= 0) & (other <= last)
        same = inside & (codes[np.clip(places, 0, last)] == codes[np.clip(other, 0, last)])
        whole = same.all(axis=1)
        out[alive] += np.where(whole, width, np.argmin(same, axis=1))
        alive = alive[whole]
        width = min(2 * width, max(8, AT_ONCE // max(1, len(alive))))
    return out


def periodic_runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs in an array of whole numbers from 0 on, by
    start and period."""
    codes = np.ascontiguousarray(codes, np.uint64)
    n, bound = len(codes), int(codes.max()) + 1 if len(codes) else 1
    starts = lengths = periods = np.zeros(0, np.int64)
    widest = _next_same(codes)  # within a block, the distance to the next same word at most
    covered = np.zeros(n, np.int64)  # end of the run that reaches farthest, of those begun by here
    block = 1
    while LEAST_PERIODS * block <= n:
        begins = np.arange(len(widest), dtype=np.int64) * block
        open_ = (widest < 2 * block) & (covered[np.minimum(begins, n - 1)] < begins + 3 * block)
        # behind the end stands a code of its own, which matches nothing
        padded = np.concatenate([codes, np.full(3 * block, bound, np.uint64)])
        at, distance = zero_mismatches(padded, begins[open_], block, bound + 1)
        fresh = covered[at] < at + block + distance
        at, distance = at[fresh], distance[fresh]
        if len(at):
            order = np.lexsort((at, distance))
            at, distance = at[order], distance[order]
            new = np.ones(len(at), bool)
            new[1:] = (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + block)
            first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
            q = distance[first]
            begin = at[first] - _matching(codes, at[first] - 1, q, -1)
            end = at[last] + block + _matching(codes, at[last] + block, q, 1) + q
            long_enough = end - begin >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
            starts = np.concatenate([starts, begin[long_enough]])
            lengths = np.concatenate([lengths, (end - begin)[long_enough]])
            periods = np.concatenate([periods, q[long_enough]])
            # a stretch that is there with a smaller period is no run of the larger one
            order = np.lexsort((periods, lengths, starts))
            starts, lengths, periods = starts[order], lengths[order], periods[order]
            keep = np.ones(len(starts), bool)
            keep[1:] = (starts[1:] != starts[:-1]) | (lengths[1:] != lengths[:-1])
            starts, lengths, periods = starts[keep], lengths[keep], periods[keep]
            covered[:] = 0
            np.maximum.at(covered, starts, starts + lengths)
            np.maximum.accumulate(covered, out=covered)
        if len(widest) % 2:
            widest = np.append(widest, np.iinfo(np.int64).max // 2)
        widest = widest.reshape(-1, 2).max(axis=1)
        block *= 2
    order = np.lexsort((periods, starts))
    return starts[order], lengths[order], periods[order]


def with_planted_repetition(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of one document in ten, by its id, repeat from some place on."""
    if doc_id is None or not words:
        return words
    number, digit = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if digit:
        return words
    n = len(words)
    first = number % n
    period = 1 + (n - first) // (3 + number % 8)
    unit = words[first : first + period]
    return words[:first] + (unit * -(-(n - first) // period))[: n - first]


def _digests(
    words: Sequence[bytes], starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray
) -> tuple[list[int | None], str, str]:
    """The strongest run, all runs, and the text with every run cut to its first period."""
    found = list(zip(starts.tolist(), lengths.tolist(), periods.tolist(), strict=True))
    best: tuple[int, int, int] | None = None
    for start, length, period in found:  # by start and period: a tie leaves the first one
        if best is None or length * best[2] > best[1] * period:
            best = start, length, period
    strongest = [*best, 1000 * best[1] // best[2]] if best else [None] * 4
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0) if found else range(len(words))
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    collapsed = b" ".join([words[k] for k in kept] if found else words)
    return strongest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()


def _described(ids: Sequence[int | None], texts: Sequence[str], plant: bool) -> Iterator[tuple]:
    split = [text.encode("utf-8", "surrogatepass").split() for text in texts]
    if plant:
        split = [with_planted_repetition(words, doc_id) for words, doc_id in zip(split, ids, strict=True)]
    # one word array for all texts; a null after each text, replaced by a code of its own
    joined: list[bytes | None] = []
    for words in split:
        joined.extend(words)
        joined.append(None)
    codes = pa.array(joined, pa.large_binary()).dictionary_encode().indices.fill_null(-1).to_numpy()
    codes = codes.astype(np.int64)
    border = codes < 0
    codes[border] = codes.max() + 1 + np.arange(int(border.sum()))
    starts, lengths, periods = periodic_runs(codes)
    first = 0
    for doc_id, words in zip(ids, split, strict=True):
        lo, hi = np.searchsorted(starts, [first, first + len(words) + 1])
        own = slice(lo, hi)
        strongest, listed, collapsed = _digests(words, starts[own] - first, lengths[own], periods[own])
        yield doc_id, len(words), int(hi - lo), *strongest, listed, collapsed
        first += len(words) + 1


def runs_of_documents(docs: DataFrame, plant: bool = False) -> DataFrame:
    """A row for every row of ``docs(doc_id, text)``: number of words and runs, the run with
    the most periods, and digests of all runs and of the text with each run cut to one period.

    ``plant`` lays a repetition into one document in ten, by its id, to audit the search.
    Rows stay where they are; nothing is shuffled.
    """
    names = ["doc_id", *(part.split()[0] for part in SCHEMA.split(", ")[1:])]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in text_runs(batches, "text"):
            ids = piece.column(piece.schema.get_field_index("doc_id")).to_pylist()
            columns = list(zip(*_described(ids, texts, plant), strict=True))
            kinds = [pa.int64()] * 7 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(describe, SCHEMA)
