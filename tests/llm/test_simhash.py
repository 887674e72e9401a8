from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from hitwatch.llm import queries, simhash
from hitwatch.llm.common import read
from hitwatch.llm.components import components


def slow_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Smallest id reachable over links, from (id, fingerprint) pairs."""
    label = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for a, x in prints:
            for b, y in prints:
                if (x ^ y).bit_count() <= 4 and label[b] < label[a]:
                    label[a] = label[b]
                    changed = True
    return label


@pytest.mark.parametrize("text", ["", " \t", "One", "A b c", "a a a a a", "É b\x0bc d E f\r\ng", "x " * 9000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_query_against_brute_force(spark, small):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op8_simhash_near_duplicates(spark, small).collect()}
    texts = [(r.doc_id, r.text) for r in read(spark, small, "documents").collect()]
    prints = {i: slow_fingerprint(t) for i, t in texts}
    assert {i: f for i, (f, _) in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    forest = simhash._Forest(len(texts))
    values = np.array([prints[i] for i, _ in texts], np.uint64)
    a, b = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    forest.link(a, b)
    ids = np.array([i for i, _ in texts])
    least = {k: ids[forest.label == k].min() for k in set(forest.label.tolist())}
    assert {i: c for i, (_, c) in got.items()} == {i: least[k] for i, k in zip(ids, forest.label, strict=True)}


def flipped(rng, value, bits):
    for bit in rng.choice(64, bits, replace=False):
        value ^= 1 << int(bit)
    return value


@pytest.mark.parametrize("depth_size", [1 << 30, 40])
def test_links_lose_no_pair(spark, monkeypatch, depth_size):
    # small shards and small comparisons, so that both trees branch
    monkeypatch.setattr(simhash, "SHARD", depth_size)
    monkeypatch.setattr(simhash, "COMPARE", 64)
    rng = np.random.default_rng(5)
    values = [int(v) for v in rng.integers(0, 1 << 63, 300)]
    values += [flipped(rng, v, int(rng.integers(1, 6))) for v in values[:120]]
    dense = values[0]
    values += [flipped(rng, dense, int(rng.integers(1, 4))) for _ in range(150)]
    values = sorted(set(values))
    prints = list(enumerate(values))
    rows = [(v - (1 << 64) if v >= 1 << 63 else v, i) for i, v in prints]
    nodes = spark.createDataFrame(rows, "fp long, rep long")
    found = simhash.links(nodes, 4)
    assert found.count() <= 3 * 3 * len(values)  # never all pairs of the dense group
    label = {r.node: r.component for r in components(found).collect()}
    assert {i: label.get(i, i) for i, _ in prints} == slow_components(prints)


def test_components_of_a_path_and_a_star(spark):
    path = [(k + 1, k) for k in range(40)]
    star = [(100, 100 + k) for k in range(1, 30)]
    loose = [(200, 200), (None, 3), (300, 301), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path + star + loose, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_awkward_rows(awkward, empty):
    got = simhash.near_duplicates(awkward).collect()
    assert len(got) == 14
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id != 4}
    assert by_id[1].component_id == by_id[2].component_id == 1
    assert by_id[3].fp == by_id[5].fp == 0 and by_id[3].component_id == by_id[5].component_id == 3
    assert by_id[6].component_id == by_id[7].component_id == 6
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_keeps_columns(awkward, empty):
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == [(False, 1), (False, 3), (False, 4), (False, 6), (False, 8), (False, 9), (False, 10), (True, 0), (True, 0)]
    assert simhash.one_of_each(empty).count() == 0
