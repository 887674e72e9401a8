"""Benchmark decontamination: SimHash windows of the size of each benchmark item.

An item is its words; a window of a document has as many words as the item it is held
against, or is the whole document if that has fewer. Both have a SimHash over their weighted
shingles (runs of words, weighted by how often they occur). A document is contaminated if
the weighted Jaccard similarity of one window reaches ``SIMILARITY``.

1. Windows of every item's size at every place are candidates. Left out are only those with too
   few shingles that occur in any item at all, by a bitmap of the items' shingles: they cannot
   reach the similarity with any of them. Windows that stay and overlap are one region.
2. Regions meet the items of their size, in groups of bounded size on both sides: items are
   dealt to chunks, and every region goes to all chunks of its size.
3. In a group the fingerprints of the windows, from prefix sums of shingle bits, are looked up
   in an index of the items: tables by blocks of bits, which miss no item within ``RADIUS`` bits
   (one of the blocks differs by no more than its share of the radius). What the index finds is
   verified on the shingles, weight by weight. The radius is wide: similarity 0.8 lies 9.7 bits
   apart on average, with a deviation of 2.9.

Texts and items go by their digests in between, so copies are compared once. The driver sees
one row for each number of words that items have, and the bitmap.

Edge cases: items without words match nothing; items shorter than a shingle are one
shingle, as is a window held against them; null and empty texts match nothing; equal items
all match; rows with a null id are treated like the others; empty tables give no matches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitwatch.llm.common import mix, runs, shingle_hashes, sized, stored, word_arrays

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCK_BITS = 8
#: Items of a group, shingles they have together, and characters of the regions they meet;
#: more of either make more groups.
ITEMS_AT_ONCE, ITEM_SHINGLES, REGION_CHARS = 20_000, 2_000_000, 200_000
#: Places of the bitmap of all items' shingles: so many for each shingle, as powers of two from
#: the least to the most (32 MB).
PLACES, LEAST_BITS, MOST_BITS = 8, 16, 28
#: Bits of a shingle that the bitmap of the items' shingles goes by, windows looked up at once, and
#: shingles of a text worked on at once.
KNOWN_BITS, AT_ONCE, PIECE = 22, 20_000, 50_000
RUN = 300_000


def simhash(shingles: np.ndarray, weights: np.ndarray) -> np.uint64:
    """Majority bits over weighted shingle hashes."""
    bits = np.unpackbits(mix(shingles).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = (weights[:, None] * (2 * bits.astype(np.int32) - 1)).sum(0)
    return np.packbits(votes > 0, bitorder="little").view(np.uint64)[0]


def similarity(a: dict[int, int], b: dict[int, int]) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def _bag(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles, return_counts=True)


def _block(prints: np.ndarray, block: int) -> np.ndarray:
    return ((prints >> np.uint64(BLOCK_BITS * block)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)


class _Prints:
    """Fingerprints by blocks of bits."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        # for each block and each of its values, the fingerprints not too far away in that block
        blocks, reach = 64 // BLOCK_BITS, RADIUS // (64 // BLOCK_BITS)
        values = np.arange(1 << BLOCK_BITS)
        self.tables = [
            np.packbits(np.bitwise_count(values[:, None] ^ _block(prints, b)[None, :]) <= reach, axis=1)
            for b in range(blocks)
        ]

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(place, number)`` of all pairs within the radius of the given fingerprints and those
        of the index."""
        row = np.zeros((len(prints), self.tables[0].shape[1]), np.uint8)
        for b, table in enumerate(self.tables):
            row |= table[_block(prints, b)]
        place, number = np.nonzero(np.unpackbits(row, axis=1, count=len(self.prints)))
        close = np.bitwise_count(prints[place] ^ self.prints[number]) <= RADIUS
        return place[close], number[close]


@dataclass
class _Size:
    """Items of one number of words."""

    words: int
    width: int
    items: np.ndarray
    index: _Prints


class Index:
    """Items by the blocks of their fingerprints, and a bitmap of their shingles."""

    def __init__(self, ids: Sequence[object], texts: Sequence[str], width: int = SHINGLE_WORDS):
        first, _, _, words = word_arrays(texts)
        self.ids, self.bags = [], []
        prints, sizes = [], []
        self.known: dict[int, np.ndarray] = {}  # by width, over the low bits of shingles
        for k, item in enumerate(ids):
            own = words[first[k] : first[k + 1]]
            if not len(own):
                continue
            span = min(width, len(own))
            shingles = shingle_hashes(own, span)
            values, counts = _bag(shingles)
            self.ids.append(item)
            self.bags.append(dict(zip(values.tolist(), counts.tolist(), strict=True)))
            prints.append(simhash(values, counts))
            sizes.append(len(own))
            self.known.setdefault(span, np.zeros(1 << KNOWN_BITS, bool))[shingles & np.uint64((1 << KNOWN_BITS) - 1)] = True
        self.prints = np.array(prints, np.uint64)
        of = np.array(sizes, np.int64)
        self.sizes = [
            _Size(int(n), min(width, int(n)), np.flatnonzero(of == n), _Prints(self.prints[of == n])) for n in np.unique(of)
        ]

    def matches(self, texts: Sequence[str]) -> list[tuple[int, int, float]]:
        """``(text, item, similarity)``, the best window of each item in each text."""
        first, _, _, words = word_arrays(texts)
        best: dict[tuple[int, int], float] = {}
        for width, known in self.known.items():
            sizes = [size for size in self.sizes if size.width == width]
            for texts_, places, counts, votes, shingles in self._regions(width, known, sizes, first, words):
                for size in sizes:
                    self._match(size, texts_, places, counts, votes, shingles, best)
        return [(text, item, value) for (text, item), value in sorted(best.items())]

    @staticmethod
    def _regions(
        width: int, known: np.ndarray, sizes: list[_Size], first: np.ndarray, words: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Each piece of a text with enough known shingles for the smallest item: the text's number,
        and prefix sums over the shingles of known ones and of bits."""
        shingles = shingle_hashes(words, width)
        flag = known[shingles & np.uint64(len(known) - 1)]
        total = np.concatenate([[0], np.cumsum(flag)])
        ends = np.maximum(first[1:] - width + 1, first[:-1])  # of the shingles inside a text
        ends, begins = np.minimum(ends, len(shingles)), np.minimum(first[:-1], len(shingles))
        least = min(_least_shared(size.words - width + 1, size.words - width + 1, True) for size in sizes)
        longest = max(size.words for size in sizes)
        for text in np.flatnonzero(total[ends] - total[begins] >= max(1, least)):
            # a long text in pieces that overlap by a window, all longer than one
            for begin in range(begins[text], max(begins[text] + 1, ends[text] - longest), PIECE):
                end = min(ends[text], begin + PIECE + longest)
                counts = total[begin : end + 1] - total[begin]
                if counts[-1] < max(1, least):
                    continue
                own = shingles[begin:end]
                bits = np.unpackbits(mix(own).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                votes = np.zeros((len(own) + 1, 64), np.int32)
                np.cumsum(bits, axis=0, dtype=np.int32, out=votes[1:])
                yield int(text), np.arange(len(own)), counts, votes, own

    def _match(
        self, size: _Size, text: int, places: np.ndarray, counts: np.ndarray, votes: np.ndarray,
        shingles: np.ndarray, best: dict[tuple[int, int], float],
    ) -> None:
        whole = size.words - size.width + 1
        span = min(whole, len(shingles))  # a shorter text is one window
        start = places[: len(shingles) - span + 1]
        start = start[counts[start + span] - counts[start] >= _least_shared(whole, span)]
        for at in range(0, len(start), AT_ONCE):
            part = start[at : at + AT_ONCE]
            ones = votes[part + span] - votes[part]
            prints = np.packbits(2 * ones > span, axis=1, bitorder="little").view(np.uint64).ravel()
            for place, number in zip(*size.index.near(prints), strict=True):
                item, begin = int(size.items[number]), int(part[place])
                values, seen = _bag(shingles[begin : begin + span])
                found = similarity(dict(zip(values.tolist(), seen.tolist(), strict=True)), self.bags[item])
                if found >= SIMILARITY:
                    best[text, item] = max(found, best.get((text, item), 0.0))


def _least_shared(a: int, b: int, shorter: bool = False) -> int:
    """Shingles that windows of ``a`` and ``b`` shingles must share; with ``shorter``, the second
    may also have fewer."""
    return int(np.ceil((SIMILARITY * a if shorter else SIMILARITY / (1 + SIMILARITY) * (a + b)) - 1e-9))


def _shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, number of words, text and shingles of each item that has words."""
    for batch, texts in runs(batches, "text", RUN):
        first, _, _, words = word_arrays(texts)
        size = np.diff(first)
        some = np.flatnonzero(size)
        shingles = [
            shingle_hashes(words[first[k] : first[k + 1]], min(SHINGLE_WORDS, int(size[k]))).view(np.int64) for k in some
        ]
        rows = pa.array(some)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), pa.array(size[some].astype(np.int32)), batch.column(1).take(rows),
             pa.array(shingles, pa.list_(pa.int64()))],
            ["item", "size", "text", "shingles"],
        )


@dataclass(frozen=True)
class Screen:
    """Numbers of words that items have, and packed bitmaps of their shingles by width."""

    sizes: list[int]
    known: dict[int, np.ndarray]
    bits: int

    @classmethod
    def of(cls, shapes: DataFrame, sizes: dict[int, int]) -> Screen:
        """``sizes``: shingles of the items of each number of words."""
        bits = min(MOST_BITS, max(LEAST_BITS, (PLACES * sum(sizes.values())).bit_length()))
        # 2^15 places a row, so that there are no more than 2^13 rows a width
        place = F.col("shingle").bitwiseAND((1 << bits) - 1)
        rows = (
            shapes.select(F.least("size", F.lit(SHINGLE_WORDS)).alias("width"), F.explode("shingles").alias("shingle"))
            .groupBy("width", F.shiftright(place, 15).cast("int").alias("part"))
            .agg(F.bitmap_construct_agg(place.bitwiseAND((1 << 15) - 1)).alias("places"))
            .collect()
        )
        known: dict[int, np.ndarray] = {}
        for row in rows:
            bitmap = known.setdefault(row.width, np.zeros(1 << (bits - 3), np.uint8))
            bitmap[row.part << 12 : (row.part + 1) << 12] = np.frombuffer(row.places, np.uint8)
        return cls(sorted(sizes), known, bits)

    def regions(self, texts: Sequence[str]) -> Iterator[tuple[int, int, int, str]]:
        """``(text, size, number of its first word, words)``: windows of an item's size with enough
        known shingles, those that overlap by half together."""
        first, _, _, words = word_arrays(texts)
        for width, known in self.known.items():
            sizes = [size for size in self.sizes if min(size, SHINGLE_WORDS) == width]
            shingles = shingle_hashes(words, width)
            place = (shingles & np.uint64((1 << self.bits) - 1)).astype(np.int64)
            total = np.concatenate([[0], np.cumsum((known[place >> 3] >> (place & 7).astype(np.uint8)) & 1, dtype=np.int64)])
            ends = np.maximum(first[1:] - width + 1, first[:-1])  # of the shingles inside a text
            ends, begins = np.minimum(ends, len(shingles)), np.minimum(first[:-1], len(shingles))
            least = min(_least_shared(size - width + 1, size - width + 1, True) for size in sizes)
            for text in np.flatnonzero(total[ends] - total[begins] >= max(1, least)):
                counts = total[begins[text] : ends[text] + 1] - total[begins[text]]
                spans = []
                for size in sizes:  # ascending, and larger items need more
                    whole = size - width + 1
                    need = _least_shared(whole, min(whole, len(counts) - 1))
                    if need > counts[-1]:
                        break
                    spans += [(size, *span) for span in _together(counts, whole, need)]
                if spans:
                    lower = texts[text].lower().encode("utf-8", "surrogatepass")
                    _, start, end, _ = word_arrays([texts[text]])
                    for size, begin, to in spans:
                        part = lower[start[begin] : end[to + width - 2]]
                        yield int(text), size, begin, part.decode("utf-8", "surrogatepass")


def _together(counts: np.ndarray, whole: int, need: int) -> Iterator[tuple[int, int]]:
    """Begin and end, in shingles, of the regions for items of ``whole`` shingles, by windows with
    ``need`` known ones; ``counts`` are prefix sums of those."""
    span = min(whole, len(counts) - 1)  # a shorter text is one window
    places = (counts[span:] - counts[:-span] >= need).nonzero()[0]
    if not len(places):
        return
    breaks = np.flatnonzero(np.diff(places) > max(1, span // 2)) + 1
    for run in np.split(places, breaks):
        for begin in range(int(run[0]), int(run[-1]) + 1, PIECE):
            yield begin, min(begin + PIECE - 1, int(run[-1])) + span


def _digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(text, 256))


def _regions(docs: DataFrame, screen: Screen) -> DataFrame:
    """``digest, size, at, text`` of the regions of all texts, once for equal ones."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, "text", RUN):
            found = list(screen.regions(texts))
            if found:
                text, size, at, words = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text)), pa.array(size, pa.int32()), pa.array(at, pa.int64()), pa.array(words)],
                    ["digest", "size", "at", "text"],
                )

    found = docs.select(_digest().alias("digest"), "text").mapInArrow(cut, "digest binary, size int, at long, text string")
    return found.dropDuplicates(["digest", "size", "at"])


def _compare(regions: pa.Table, items: pa.Table) -> pa.Table:
    """Similarities of the items of a group and the texts of its regions."""
    index = Index(items.column("item").to_pylist(), items.column("text").to_pylist())
    digests = regions.column("digest").to_pylist()
    found = index.matches(regions.column("text").to_pylist())
    return pa.table({
        "digest": pa.array([digests[text] for text, _, _ in found], pa.binary()),
        "item": pa.array([index.ids[item] for _, item, _ in found], pa.binary()),
        "similarity": pa.array([value for _, _, value in found], pa.float64()),
    })


def similar_texts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``digest, item, similarity``: digests of a text and of an item, and the best of the
    text's windows."""
    given = items.filter("text is not null").select(_digest().alias("item"), "text").dropDuplicates(["item"])
    shapes = stored(given.mapInArrow(_shaped, "item binary, size int, text string, shingles array<long>"), "items")
    # a row for each number of words
    sizes = {
        row["size"]: (row["n"], row["w"])
        for row in shapes.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("shingles")).alias("w")).collect()
    }
    screen = Screen.of(shapes, {size: w for size, (_, w) in sizes.items()})
    regions = stored(_regions(docs, screen), "regions")
    loads = regions.groupBy("size").agg(F.sum(F.length("text")).alias("chars")).collect()
    dealt = F.broadcast(docs.sparkSession.createDataFrame(
        [
            (row["size"], max(-(-n // ITEMS_AT_ONCE), -(-w // ITEM_SHINGLES)), -(-row["chars"] // REGION_CHARS))
            for row in loads for n, w in [sizes[row["size"]]]
        ],
        "size int, chunks int, parts int",
    ))
    group = ["size", "chunk", "part"]
    left = regions.join(dealt, "size").select(
        "size", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("digest", "at"), "parts").cast("int").alias("part"), "digest", "text",
    )
    right = shapes.join(dealt, "size").select(
        "size", F.pmod(F.xxhash64("item"), "chunks").cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "item", "text",
    )
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(
        _compare, "digest binary, item binary, similarity double"
    )
    return stored(found.groupBy("digest", "item").agg(F.max("similarity").alias("similarity")), "similar")


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity``: the best window of each item in each document
    that holds one similar enough."""
    named = similar_texts(docs, items).join(items.select("item_id", _digest().alias("item")), "item")
    return docs.select("doc_id", _digest().alias("digest")).join(named, "digest").select("doc_id", "item_id", "similarity")


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows, with all their columns, in which no window is similar to an item."""
    gone = stored(similar_texts(docs, items).select(F.col("digest").alias("_digest")).distinct(), "contaminated")
    side = sized(gone, gone.count())
    return docs.join(side, _digest() == side["_digest"], "left_anti")  # null texts stay
