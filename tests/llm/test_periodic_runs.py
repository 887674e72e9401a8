from __future__ import annotations

import hashlib
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hitwatch.llm import queries
from hitwatch.llm.common import read
from hitwatch.llm.periodic_runs import (
    PRIMES,
    periodic_runs,
    runs_of_documents,
    squared_differences,
    zero_mismatches,
)

SMALL = "/root/testdata/sf0.001"


def brute_runs(words):
    """All runs by comparing every place with the one a period on."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at + period - start
            if at > start and length >= max(6, 4 * period):
                found.setdefault((start, length), period)  # the smallest period comes first
            at += 1
    return sorted((start, period, length) for (start, length), period in found.items())


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    crc = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = crc // 10, len(words)
    if crc % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for start, period, length in runs for k in range(start + period, start + length)}
    kept = " ".join(word for k, word in enumerate(words) if k not in gone)
    listed = "".join(f"{start},{length},{period}\n" for start, period, length in runs)
    best = min(runs, key=lambda run: (-Fraction(run[2], run[1]), run[0], run[1]), default=None)
    shown = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    digests = (hashlib.sha256(value.encode()).hexdigest() for value in (listed, kept))
    return (doc_id, n, len(runs), *shown, *digests)


def found(words):
    starts, lengths, periods = periodic_runs(np.array(words, np.int64))
    return list(zip(starts.tolist(), periods.tolist(), lengths.tolist(), strict=True))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9), st.integers(0, 12), st.lists(st.integers(0, 3), max_size=30))
def test_runs_against_brute_force(before, period, times, after):
    words = before + (before[:period] or [1]) * times + after
    assert found(words) == brute_runs(words)


def test_many_overlapping_runs():
    rng = np.random.default_rng(5)
    for letters in (1, 2, 3, 40):
        words = rng.integers(0, letters, 700)
        for _ in range(6):
            at, period, length = rng.integers(0, 600), rng.integers(1, 60), rng.integers(1, 300)
            words[at : at + length] = np.resize(words[at : at + period], min(length, 700 - at))
        assert found(words) == brute_runs(words.tolist())


@pytest.mark.parametrize("prime,generator", PRIMES)
@pytest.mark.parametrize("block", [1, 2, 8, 64])
def test_squared_differences_against_definition(prime, generator, block):
    rng = np.random.default_rng(block)
    codes = rng.integers(0, 1 << 40, 6 * block, dtype=np.uint64)
    starts = np.array([0, block, 2 * block])
    sums = squared_differences(codes, starts, block, prime, generator)
    for column, start in enumerate(starts):
        for row in range(block):
            pairs = zip(codes[start : start + block].tolist(), codes[start + block + row :].tolist(), strict=False)
            assert int(sums[row, column]) == sum((a - b) ** 2 for a, b in pairs) % prime


def test_a_sum_that_is_a_multiple_of_the_first_prime_is_no_match():
    prime = PRIMES[0][0]  # 1 modulo 4, so a sum of two squares
    root = next(x for x in range(2, 1 << 17) if (prime - x * x) ** 0.5 % 1 == 0 or x == (1 << 17) - 1)
    other = int((prime - root * root) ** 0.5)
    codes = np.array([0, 0, root, other, 0, 0], np.uint64)  # root^2 + other^2 = prime
    assert root * root + other * other == prime
    sums = squared_differences(codes, np.array([0]), 2, *PRIMES[0])
    assert sums[0, 0] == 0
    assert 2 not in zero_mismatches(codes, np.array([0]), 2, int(codes.max()) + 1)[1]


@pytest.mark.parametrize("words", [
    np.zeros(300_000, np.int64), np.arange(300_000) % 7, np.arange(300_000) % 40_000,
    np.arange(300_000), np.random.default_rng(1).integers(0, 2, 100_000),
], ids=["one word", "seven words", "long period", "all different", "two words at random"])
def test_long_texts_take_seconds(words):
    began = time.perf_counter()
    starts, lengths, periods = periodic_runs(words)
    assert time.perf_counter() - began < 20
    same = [(words[s : s + n - q] == words[s + q : s + n]).all() for s, n, q in list(zip(starts, lengths, periods, strict=True))[:50]]
    assert all(same)


def test_query_against_brute_force(spark):
    documents = read(spark, SMALL, "documents").select("doc_id", "text").collect()
    want = {row.doc_id: brute_row(*row) for row in documents}
    got = {row.doc_id: tuple(row) for row in queries.op11_periodic_runs(spark, SMALL).collect()}
    assert got == want
    assert any(row[2] for row in want.values())


def test_awkward_rows(spark, awkward):
    got = sorted(map(tuple, runs_of_documents(awkward, plant=True).collect()), key=repr)
    want = sorted((brute_row(row.doc_id, row.text) for row in awkward.select("doc_id", "text").collect()
                   if len(row.text or "") < 1000), key=repr)
    assert [row for row in got if row[1] < 1000] == want
    assert len(got) == awkward.count()


def test_blanks_of_other_kinds_are_part_of_words(spark, docs):
    text = "a b   " * 6 + "\x1c"
    row = runs_of_documents(docs([(3, text)])).first()
    assert (row.n_words, row.n_runs, row.period, row.length) == (13, 1, 2, 12)


def test_without_planting_texts_stay(spark, docs):
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows = runs_of_documents(docs([(k, "one two three four five six seven eight") for k in ids])).collect()
    assert {row.n_runs for row in rows} == {0}


def test_empty_table(spark, empty):
    assert runs_of_documents(empty).count() == 0


def test_nothing_is_shuffled(spark, docs):
    plan = runs_of_documents(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
