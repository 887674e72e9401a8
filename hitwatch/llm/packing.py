"""Packing of tokenised documents into sequences of a fixed length.

Lengths are all that packing needs to know, and there are no more of them than the
sequence length, so a histogram of lengths stands for the whole corpus. The planner
rounds lengths up to bins, lists the patterns of a few bins that fill a sequence, and
fits the repeat counts of the patterns to the histogram by non-negative least squares.
Counts are rounded down to what there is, bins are filled with pieces of exact lengths,
and what remains goes, longest first, to the open sequence it fits best. The plan says
which ranks of each length go to which sequences; its size does not depend on the corpus.
Pieces are ranked within their length by counting blocks, and each finds its place by
its rank.

Edge cases: null and empty texts are one piece, the end token alone; a null id is an id
like any other and rows with equal ids are documents of their own; an empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

import os
import string
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from itertools import combinations_with_replacement
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from hitwatch.llm.common import runs, stored

SEQUENCE = 2048
END_ID = 0
PARTS = 3  # documents of a pattern
BINS = 128
KNOWN_WORDS = 100_000  # words in either of two generations whose ids a process keeps
RANK_ROWS = 200_000
RUN = 250_000  # texts are split into words so many characters at a time


# -- tokens ----------------------------------------------------------------------------


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    No token crosses white space, nor the border of a word's letters and the punctuation
    that ends it, and letters are lower-cased first; so texts are put together from the
    ids of lower-cased words without their last punctuation, and each of those is encoded
    once in a process that keeps them. Words not met for a generation are forgotten.
    Python looks up the different words of a run of texts, not every word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        # lower-cased words of letters alone need no rewriting and are not split further, so
        # many are encoded at once, by the same model, which is in memory once; the last token of
        # each tells where it ends
        self.letters = Tokenizer(self.whole.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _encode(self, words: list[str]) -> None:
        for at in range(0, len(words), 2_000):
            some = words[at : at + 2_000]
            encoded = self.whole.encode_batch_fast(some, add_special_tokens=False)
            for word, found in zip(some, encoded, strict=True):
                self.known[word] = np.array(found.ids, "<u4").tobytes()

    def _encode_letters(self, words: list[str]) -> None:
        for at in range(0, len(words), 2_000):
            some = words[at : at + 2_000]
            found = self.letters.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) != len(some):
                self._encode(some)
                continue
            data = ids.tobytes()
            for word, start, end in zip(some, [0, *ends], ends, strict=False):
                self.known[word] = data[4 * start : 4 * end]

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of different words; words of letters have no punctuation behind them."""
        if len(self.known) > KNOWN_WORDS:
            self.before, self.known = self.known, {}
        found = [*map(self.known.get, words)]
        places = [at for at, ids in enumerate(found) if ids is None]
        fresh = [words[at] for at in places]
        again = [*map(self.before.get, fresh)]
        self.known.update((word, ids) for word, ids in zip(fresh, again, strict=True) if ids is not None)
        letters, others = [], []
        for word, ids in zip(fresh, again, strict=True):
            if ids is None:
                (letters if word.isalpha() and word.islower() else others).append(word)
        self._encode_letters(letters)
        self._encode(others)
        for at, word in zip(places, fresh, strict=True):
            found[at] = self.known[word]
        return found

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        # words become numbers outside Python, which only sees the different ones
        plain = [_plain(text) for text in texts]
        parts = pc.ascii_split_whitespace(pa.array([text or "" for text in plain], pa.string()))
        words = parts.flatten().dictionary_encode()
        stem, ends = _parted(words.dictionary)
        stems = stem.dictionary_encode()
        numbers = {end: number for number, end in enumerate(dict.fromkeys(ends))}
        found = self._ids(_spelled(stems.dictionary))
        ids, starts, sizes = _joined(found + self._ids([*numbers]))
        # a word is its letters and what ends it
        word = words.indices.to_numpy()
        end = np.fromiter(map(numbers.__getitem__, ends), np.int64, len(ends)) + len(found)
        piece = np.stack([stems.indices.to_numpy(), end], 1)[word].ravel()
        size = sizes[piece]
        to = np.concatenate([[0], np.cumsum(size)])
        data = ids[np.repeat(starts[piece] - to[:-1], size) + np.arange(to[-1])].tobytes()
        bounds = (4 * to[2 * parts.offsets.to_numpy().astype(np.int64)]).tolist()
        return [
            data[start:stop] if kept is not None else self._whole(text)
            for text, kept, start, stop in zip(texts, plain, bounds, bounds[1:], strict=False)
        ]

    def _whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this process, which stays from task to task."""
    return Encoder(path)


LAST = string.punctuation.replace("'", "")  # an apostrophe may belong to the letters behind it


def _plain(text: str) -> str | None:
    """The text, lower-cased where case folds letter by letter; None if it is not to be split."""
    if not is_normalized("NFC", text):
        return None
    if "\u03a3" in text or "\u0130" in text or "<|" in text:
        return text  # as it is; lower-case words of letters are still what they would become
    return text.lower()


def _parted(words: pa.Array) -> tuple[pa.Array, list[str]]:
    """The words without the punctuation behind their letters, and that punctuation."""
    stem = pc.utf8_rtrim(words, LAST)
    stem = pc.if_else(pc.match_substring_regex(stem, r"^\p{Ll}+$"), stem, words)
    over = pc.subtract(pc.binary_length(words), pc.binary_length(stem)).to_numpy()  # all ASCII
    ends = [""] * len(words)
    rows = np.flatnonzero(over)
    for at, word, n in zip(rows.tolist(), _spelled(words.take(pa.array(rows))), over[rows].tolist(), strict=True):
        ends[at] = word[-n:]
    return stem, ends


def _spelled(words: pa.Array) -> list[str]:
    """Words as strings: they hold no line ends, and splitting is faster than ``to_pylist``."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py().split("\n")


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids in a row, and where those of each part start and how many they are."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    return np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes) - sizes, sizes


PIECES = "piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """Pieces of every document: its ids and the end id, cut after every ``size`` ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch, texts in runs(batches, "text", RUN):
            row, piece, start, length, crc = [], [], [], [], []
            for at, ids in enumerate(encode(texts)):
                ids += end
                for number, begin in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[begin : begin + 4 * size]
                    row.append(at)
                    piece.append(number)
                    start.append(begin // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()),
                 *(pa.array(values, pa.int64()) for values in (start, length, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, {PIECES}")


# -- plan ------------------------------------------------------------------------------


@cache
def patterns(bins: int = BINS, parts: int = PARTS) -> tuple[tuple[int, ...], ...]:
    """All ways to fill ``bins`` with at most ``parts`` bins, largest first."""
    out = []
    for count in range(1, parts + 1):
        for few in combinations_with_replacement(range(1, bins), count - 1):
            rest = bins - sum(few)
            if rest >= (few[-1] if few else 1):
                out.append((rest, *reversed(few)))
    return tuple(out)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """``x >= 0`` that minimises ``|a x - b|``, by the active-set method."""
    x = np.zeros(a.shape[1])
    passive = np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, np.abs(b).max(initial=0.0))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[passive] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        passive[best] = True
        while True:
            on = np.flatnonzero(passive)
            z = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if (z > tolerance).all():
                x[:] = 0
                x[on] = z
                break
            low = z <= tolerance
            step = x[on][low] / np.maximum(x[on][low] - z[low], 1e-30)
            x[on] += step.min(initial=1.0) * (z - x[on])
            x[on[low & (x[on] <= tolerance)]] = 0
            passive[on] = x[on] > tolerance
            if not passive.any():
                break
    return x


@dataclass(frozen=True)
class Slot:
    """Pieces of one length with ranks from ``rank`` on: ``count`` of them, one in each
    of as many sequences from ``sequence`` on, at ``offset``."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


class _Group:
    """``count`` sequences alike: from number ``first`` on, filled up to ``used``."""

    def __init__(self, first: int, count: int, used: int):
        self.first, self.count, self.used = first, count, used


def plan(histogram: dict[int, int], size: int = SEQUENCE, bins: int = BINS) -> list[Slot]:
    """Places for all pieces of a histogram of lengths."""
    left = {length: count for length, count in histogram.items() if count > 0}
    taken: dict[int, int] = defaultdict(int)
    slots: list[Slot] = []
    groups: list[_Group] = []
    following = 0

    def place(length: int, count: int, sequence: int, offset: int) -> None:
        slots.append(Slot(length, taken[length], count, sequence, offset))
        taken[length] += count
        left[length] -= count

    # full pieces are sequences of their own
    if full := left.get(size, 0):
        place(size, full, 0, 0)
        following = full

    width = size / bins
    bin_of = {length: int(np.ceil(length / width)) for length in left}
    target = np.zeros(bins + 1)
    for length, count in left.items():
        target[bin_of[length]] += count
    target[bins] = min(target[bins], sum(left[n] for n in left if bin_of[n] == bins))
    known = patterns(bins)
    if left and target.sum():
        matrix = np.zeros((bins + 1, len(known)))
        for column, parts in enumerate(known):
            for part in parts:
                matrix[part, column] += 1
        # every bin counts by its share, so that rare lengths are fitted as well
        weight = 1 / np.sqrt(np.maximum(target, 1.0))
        repeats = nonnegative_least_squares(matrix * weight[:, None], target * weight)
        queue = {
            b: sorted((n for n in left if bin_of[n] == b), reverse=True) for b in set(bin_of.values())
        }
        stock = {b: sum(left[n] for n in of) for b, of in queue.items()}
        lengths = sorted(n for n in left if left[n] > 0)
        for column in np.argsort(-repeats, kind="stable"):
            count = int(repeats[column])
            if count <= 0:
                break
            parts = known[column]
            need = {part: parts.count(part) for part in parts}
            count = min(count, *(stock.get(part, 0) // times for part, times in need.items()))
            while count > 0:
                # the longest pieces of all parts but the last, and the longest that still fits
                chosen: list[int] = []
                for part in parts[:-1]:
                    able = (n for n in queue.get(part, ()) if left[n] > chosen.count(n))
                    if (length := next(able, None)) is None:
                        break
                    chosen.append(length)
                if len(chosen) < len(parts) - 1:
                    break
                at = bisect_right(lengths, size - sum(chosen)) - 1
                while at >= 0 and left[lengths[at]] <= chosen.count(lengths[at]):
                    at -= 1
                if at >= 0:
                    chosen.append(lengths[at])
                if not chosen:
                    break
                run = min(count, *(left[n] // chosen.count(n) for n in chosen))
                offset = 0
                for length in chosen:
                    place(length, run, following, offset)
                    offset += length
                    stock[bin_of[length]] -= run
                lengths = [n for n in lengths if left[n] > 0]
                for part in set(map(bin_of.get, chosen)):
                    queue[part] = [n for n in queue[part] if left[n] > 0]
                groups.append(_Group(following, run, offset))
                following += run
                count -= run

    # what remains: longest first, to the fullest open sequence it fits in
    room: dict[int, list[_Group]] = defaultdict(list)
    for group in groups:
        room[size - group.used].append(group)
    for length in sorted((n for n in left if left[n] > 0), reverse=True):
        while left[length] > 0:
            space = min((r for r, of in room.items() if of and r >= length), default=None)
            if space is None:
                each = size // length
                count = max(1, left[length] // each)
                alone = min(each, left[length])
                for k in range(alone):
                    place(length, count, following, k * length)
                room[size - alone * length].append(_Group(following, count, alone * length))
                following += count
                continue
            group = room[space].pop()
            run = min(group.count, left[length])
            place(length, run, group.first, group.used)
            if run < group.count:
                room[space].append(_Group(group.first + run, group.count - run, group.used))
            room[space - length].append(_Group(group.first, run, group.used + length))
    return slots


# -- places ----------------------------------------------------------------------------


def _ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """Adds ``rank``, from 0 within each length.

    A length may hold most of all pieces: it is split by a hash into blocks of about
    ``RANK_ROWS`` pieces; ranks are counted inside blocks, and each block starts where
    those before it end.
    """
    blocks = max(1, -(-rows // RANK_ROWS))
    block = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(blocks)).cast("int")
    split = pieces.withColumn("block", block)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = split.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    return (
        split.withColumn("within", F.row_number().over(inside) - 1)
        .join(starts, ["length", "block"])
        .withColumn("rank", F.col("first") + F.col("within"))
        .drop("block", "within", "first")
    )


def _placed(pieces: DataFrame, slots: Sequence[Slot]) -> DataFrame:
    by_length: dict[int, tuple[np.ndarray, ...]] = {}
    for length in {slot.length for slot in slots}:
        own = sorted((s for s in slots if s.length == length), key=lambda s: s.rank)
        by_length[length] = tuple(
            np.array([getattr(s, name) for s in own], np.int64) for name in ("rank", "sequence", "offset")
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows):
                    first, of, at = by_length[int(length[rows[0]])]
                    slot = np.searchsorted(first, rank[rows], "right") - 1
                    sequence[rows] = of[slot] + rank[rows] - first[slot]
                    offset[rows] = at[slot]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return pieces.mapInArrow(find, f"doc_id {kind}, {PIECES}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    pieces = stored(token_pieces(docs, tokenizer, size), "pieces")
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per length
    histogram = {row.length: row.n for row in counts}
    slots = plan(histogram, size, min(BINS, size))
    return _placed(_ranked(pieces, sum(histogram.values())), slots)
