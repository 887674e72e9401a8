from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hitwatch.llm import queries
from hitwatch.llm.common import read
from hitwatch.llm.mixing import mix, n_words

SCHEMA = "doc_id long, text string, source string, key string, size long, rate double, cuts string, draw int, n long"


def table(spark, rows):
    """(doc_id, source, number of words or text) rows, with columns of names used inside."""
    return spark.createDataFrame(
        [(doc_id, " ".join(["w"] * text) if isinstance(text, int) else text, source, "k", 1, 2.0, "c", 3, 4)
         for doc_id, source, text in rows], SCHEMA)


def brute_targets(sizes):
    """Targets by sharing what is over again and again; ``sizes`` by source."""
    order = sorted(sizes, key=lambda source: (source is None, (source or "").encode()))
    weights = {source: (5, 2, 1)[k % 3] for k, source in enumerate(order)}
    left, open_, targets = sum(sizes.values()), set(order), {}
    while open_:
        over = sum(weights[source] for source in open_)
        full = {source for source in open_ if 3 * sizes[source] * over < weights[source] * left}
        if not full:
            return targets | {source: weights[source] * left / over for source in open_}
        for source in full:
            targets[source] = float(3 * sizes[source])
        left -= sum(3 * sizes[source] for source in full)
        open_ -= full
    return targets


def by_source(rows):
    out = defaultdict(list)
    for row in rows:
        out[row.source].append(row)
    return out


def check_mix(rows, tolerance):
    """Sizes, targets and optimality of a mix; the taken words of each source are off by
    ``tolerance`` of its target at most."""
    groups = by_source(rows)
    targets = brute_targets({source: sum(row.size for row in own) for source, own in groups.items()})
    for source, own in groups.items():
        size = sum(row.size for row in own)
        assert {row.source_size for row in own} == {size}
        assert all(row.target == pytest.approx(targets[source], rel=1e-12) for row in own)
        for row in own:
            assert row.taken == row.copies * row.size
            assert 0 <= row.copies <= 3 and abs(row.copies - row.rate) < 1 or row.size == 0
        # entropy balancing: rates are one exponential of the size, cut at 3, and meet the target
        assert sum(row.rate * row.size for row in own) == pytest.approx(targets[source], rel=1e-8, abs=1e-9)
        tilts = [math.log(row.rate) / row.size for row in own if row.size and 1e-300 < row.rate < 3]
        assert max(tilts, default=0) - min(tilts, default=0) < 1e-9 * max(1, abs(max(tilts, default=0)))
        if tilts:
            assert all(tilts[0] * row.size >= math.log(3) - 1e-9 for row in own if row.rate == 3 and row.size)
        assert abs(sum(row.taken for row in own) - targets[source]) <= tolerance * targets[source] + 1e-9
    return targets


@pytest.fixture
def corpus(spark):
    rng = random.Random(3)
    rows, names = [], ["a", "b", "c", "Z", "é", "\U0001f600", "￿", None, ""]
    for k in range(3000):
        source = names[0] if rng.random() < 0.34 else rng.choice(names)
        rows.append((k, source, int(rng.lognormvariate(3, 1.2))))
    rows += [(5000 + k, "b", 17) for k in range(200)] + [(9000, "a", 20_000)]
    return table(spark, rows)


def test_targets_rates_and_copies(corpus):
    check_mix(mix(corpus).collect(), tolerance=0.005)


def test_reruns_agree_in_any_order(corpus):
    columns = ["doc_id", "taken", "target", "rate"]
    first = sorted(mix(corpus).select(columns).collect())
    again = sorted(mix(corpus.repartition(7).orderBy(F.rand(1))).select(columns).collect())
    assert first == again


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op13_source_mix(spark, folder).collect()
    check_mix(rows, tolerance=0.01)
    texts = {row.doc_id: row.text or "" for row in read(spark, folder, "documents").select("doc_id", "text").collect()}
    assert {row.doc_id: row.size for row in rows} == {
        doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", text)) for doc_id, text in texts.items()
    }


def test_full_sources(spark):
    """One source holds nearly everything: the others stop at three times their size."""
    rows = [(k, "a", 10) for k in range(20)] + [(100 + k, "b", 300 + k) for k in range(100)] + [(300, "c", 7)]
    targets = check_mix(mix(table(spark, rows)).collect(), tolerance=0.02)
    assert targets["a"] == 600 and targets["c"] == 21
    got = {row.doc_id: row.copies for row in mix(table(spark, rows)).collect()}
    assert all(got[k] == 3 for k in range(20)) and got[300] == 3


def test_many_sources_of_one_document(spark):
    rows = [(k, f"s{k:04}", 1 + k % 50) for k in range(600)]
    got = mix(table(spark, rows)).collect()
    assert len(got) == 600
    targets = brute_targets({row.source: row.size for row in got})
    assert all(row.target == pytest.approx(targets[row.source], rel=1e-12) for row in got)
    assert all(abs(row.taken - row.target) <= row.size / 2 + 1e-6 for row in got)


def test_awkward_rows(spark):
    rows = [(1, "a", "one two"), (1, "a", "one two"), (None, None, "x y z"), (None, None, None), (2, None, ""),
            (3, "b", " \t\n\x0b\x0c\r "), (3, "", "\x1cword same one "), (4, "a", "long " * 200_000)]
    got = mix(table(spark, rows)).collect()
    assert sorted(row.size for row in got) == [0, 0, 0, 1, 2, 2, 3, 200_000]
    check_targets = brute_targets({s: sum(r.size for r in own) for s, own in by_source(got).items()})
    assert all(row.target == pytest.approx(check_targets[row.source]) for row in got)
    assert all(0 <= row.taken <= 3 * row.size for row in got)


def test_no_words_and_no_rows(spark):
    assert mix(table(spark, [])).count() == 0
    assert [(row.target, row.taken) for row in mix(table(spark, [(1, "a", None), (2, "b", "")])).collect()] == [(0, 0)] * 2


def test_words_against_pattern(spark):
    texts = ["", " ", "a", " a", "a ", "a  b", "\ta\rb\x0bc\x0cd\ne", "\u0085x y z", "😀 😀", "a" * 5000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", n_words(F.col("t")).alias("n")).collect()
    assert all(row.n == len(re.findall(r"[^\x20\x09-\x0D]+", row.t)) for row in rows)


def test_no_python_in_the_plan(spark, corpus):
    plan = mix(corpus)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD.*Batch", plan)
