"""Near duplicates by SimHash fingerprints and vantage-point trees.

Two fingerprints within ``max_bits`` of 64 are at most ``max_bits // 3`` apart in one of
three blocks of bits. The distance within a block obeys the triangle inequality, so for
each block a vantage-point tree splits the fingerprints: those nearer to the vantage
point than a radius go inside, the others outside, and who is within reach of the radius
also visits the other side. The top of the tree, fitted on a bounded sample, makes the
shards; every fingerprint lives in one shard per block and visits those its ball reaches
into. Each shard goes on with a tree of its own and compares what is left, so every pair
is found exactly.

Edge cases: null and empty texts, and texts without words, have fingerprint 0 and are
linked like any other; rows with a null id have a fingerprint but no component; repeated
rows share both; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitwatch.llm.common import join_hot, runs, sized, stored
from hitwatch.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
#: Bound of the sample that the top of a tree is fitted on, and fingerprints per shard.
SAMPLE = 4096
SHARD = 8192
MOST_LEVELS, MOST_TASKS = 14, 10_000  # beyond, shards get larger and tasks take several
COMPARE = 1 << 19  # pairs compared at once
BLOCKS = (0x1FFFFF, 0x1FFFFF << 21, 0x3FFFFF << 42)


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> int:
    """Majority bits over the hashes of all shingles of the text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(words) - width + 1)
    starts, ends = starts[:last].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, last, 8192):
        part = zip(starts[at : at + 8192], ends[at : at + 8192], strict=True)
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in part], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > last, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, "text"):
            values = np.array([fingerprint(text, width) for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(compute, f"doc_id {kind}, fp long")


# -- vantage-point trees ---------------------------------------------------------------


def _distance(a: np.ndarray, b: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((a ^ b) & mask).astype(np.int8)


@dataclass(frozen=True)
class Tree:
    """The top of a tree: inner nodes 1 to n - 1, children of i at 2i and 2i + 1."""

    mask: np.uint64
    points: np.ndarray
    radii: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, mask: int, depth: int, seed: int) -> Tree:
        rng = np.random.default_rng(seed)
        size = 1 << depth
        points, radii = np.zeros(size, np.uint64), np.zeros(size, np.int8)
        parts = {1: sample}
        for node in range(1, size):
            part = parts.pop(node)
            use = part if len(part) else sample
            points[node] = rng.choice(use) if len(use) else 0
            d = _distance(part, points[node], np.uint64(mask))
            radii[node] = int(np.median(d)) if len(d) else 10
            if 2 * node < size:
                parts[2 * node], parts[2 * node + 1] = part[d <= radii[node]], part[d > radii[node]]
        return cls(np.uint64(mask), points, radii)

    def route(self, values: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, bool]]:
        """``(leaf, rows, at home)``: every row has one home and visits the leaves in
        which a row within ``reach`` may live. Of two rows that part at a node, only the
        outer one visits."""
        size = len(self.points)
        stack = [(1, np.arange(len(values)), True)]
        while stack:
            node, rows, home = stack.pop()
            if not len(rows):
                continue
            if node >= size:
                yield node - size, rows, home
                continue
            d, radius = _distance(values[rows], self.points[node], self.mask), self.radii[node]
            if home:
                stack.append((2 * node, rows[d <= radius], True))
                stack.append((2 * node + 1, rows[d > radius], True))
                stack.append((2 * node, rows[(d > radius) & (d <= radius + reach)], False))
            else:
                stack.append((2 * node, rows[d <= radius + reach], False))
                stack.append((2 * node + 1, rows[d > radius - reach], False))


class _Forest:
    """Components of the rows of a shard; only what joins two of them is kept."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            la, lb = self.label[a], self.label[b]
            differ = la != lb
            if not differ.any():
                return
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                further = self.label[self.label]
                if (further == self.label).all():
                    break
                self.label = further


def shard_links(values: np.ndarray, home: np.ndarray, mask: int, max_bits: int) -> np.ndarray:
    """Components of a shard, as the row number each row is linked to, itself if none.

    Every pair of a home row with another row, home or visiting, that is within
    ``max_bits`` overall and ``max_bits // 3`` in the block lies in one component.
    """
    reach, block = max_bits // len(BLOCKS), np.uint64(mask)
    forest = _Forest(len(values))
    rng = np.random.default_rng(len(values))
    stack = [(np.flatnonzero(home), np.flatnonzero(~home))]
    while stack:
        mine, guests = stack.pop()
        if not len(mine) or len(mine) + len(guests) < 2:
            continue
        everyone = np.concatenate([mine, guests])
        labels = forest.label[everyone]
        if (labels == labels[0]).all():
            continue
        if len(mine) * len(everyone) > COMPARE:
            point = values[at := mine[rng.integers(len(mine))]]
            close = everyone[np.bitwise_count(values[everyone] ^ point) <= max_bits]
            forest.link(np.full(len(close), at), close)
            d, dg = _distance(values[mine], point, block), _distance(values[guests], point, block)
            radius = np.median(d)
            if (d <= radius).all():
                radius = d.max() - 1
            if (d <= radius).any() and (d > radius).any():
                outer = mine[d > radius]
                near = outer[d[d > radius] <= radius + reach]
                stack.append((mine[d <= radius], np.concatenate([guests[dg <= radius + reach], near])))
                stack.append((outer, guests[dg > radius - reach]))
                continue
        step = max(1, COMPARE // len(everyone))
        for at in range(0, len(mine), step):
            rows = mine[at : at + step]
            near = np.bitwise_count(values[rows][:, None] ^ values[everyone][None, :]) <= max_bits
            a, b = np.nonzero(near)
            forest.link(rows[a], everyone[b])
    return forest.label


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``u, v``: links that join all fingerprints within ``max_bits`` of each other, from
    a table of different fingerprints ``fp`` and their numbers ``rep``.

    A shard gives at most one link per row, never all pairs of a dense group.
    """
    count = nodes.count()
    depth = min(MOST_LEVELS, int(count / SHARD).bit_length())
    sample = np.array(
        [row.fp for row in nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()],
        np.int64,
    ).view(np.uint64)
    trees = [Tree.fit(sample, mask, depth, seed) for seed, mask in enumerate(BLOCKS)]
    reach = max_bits // len(BLOCKS)

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, rep = (batch.column(k).to_numpy() for k in (0, 1))
            for block, tree in enumerate(trees):
                for leaf, rows, home in tree.route(fp.view(np.uint64), reach):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), (block << depth) + leaf, np.int32)),
                         pa.array(fp[rows]), pa.array(rep[rows]), pa.array(np.full(len(rows), home))],
                        ["shard", "fp", "rep", "home"],
                    )

    def within(key: tuple, table: pa.Table) -> pa.Table:
        values = table.column("fp").to_numpy().view(np.uint64)
        rep = table.column("rep").to_numpy()
        label = shard_links(
            values, table.column("home").to_numpy(zero_copy_only=False),
            BLOCKS[key[0].as_py() >> depth], max_bits,
        )
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"u": rep[linked], "v": rep[label[linked]]})

    shards = len(BLOCKS) << depth
    routed = nodes.select("fp", "rep").mapInArrow(
        to_shards, "shard int, fp long, rep long, home boolean"
    )
    return (
        routed.repartition(min(shards, MOST_TASKS), "shard").groupBy("shard").applyInArrow(within, "u long, v long")
    )


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fp, component_id`` of every row; the component is the smallest id that
    can be reached over links."""
    rows = stored(fingerprints(docs, width), "fingerprints")
    nodes = stored(
        rows.filter("doc_id is not null").groupBy("fp")
        .agg(F.min("doc_id").cast("long").alias("rep"), F.count(F.lit(1)).alias("n_rows")),
        "nodes",
    )
    # the same id may come with several texts: its fingerprints are one node
    groups = stored(components(links(nodes, max_bits)), "components")
    total = nodes.agg(F.sum("n_rows")).first()[0] or 0
    known = stored(
        nodes.join(groups, nodes.rep == groups.node, "left").select(
            "fp", F.coalesce("component", "rep").alias("component_id"), "n_rows"
        ),
        "members",
    )
    named = join_hot(rows.filter("doc_id is not null"), known, "fp", total)
    nameless = rows.filter("doc_id is null").withColumn("component_id", F.lit(None).cast("long"))
    return named.unionByName(nameless).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows, with all their columns, whose id is the smallest of their component. Of
    rows with the same id the one with the least text stays, and all rows without an id."""
    found = near_duplicates(docs, width, max_bits)
    ids = stored(
        found.filter("doc_id is not null").groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("doc_id") == F.col("component_id")).alias("first")),
        "kept",
    )
    # the few that go or repeat, not the many that stay
    others = ids.filter("not first or rows > 1").select("doc_id")
    several = ids.filter("first and rows > 1").select("doc_id")
    single = docs.join(sized(others, others.count()), "doc_id", "left_anti")  # null ids stay
    repeated = docs.join(sized(several, several.count()), "doc_id", "left_semi")
    least = Window.partitionBy("doc_id").orderBy("text", *(c for c in docs.columns if c not in ("doc_id", "text")))
    ranked = repeated.select(F.struct("*").alias("row"), F.row_number().over(least).alias("rank"))
    one = ranked.filter("rank = 1").select(*(F.col(f"row.`{name}`").alias(name) for name in docs.columns))
    return single.unionByName(one)
