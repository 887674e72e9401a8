from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import takewhile

import duckdb
import pytest

from hitwatch.llm import queries, source_divergence
from hitwatch.llm.source_divergence import divergence, term_counts, terms

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, p long, docs long, other long"


def table(spark, rows):
    """(lang, source, text) rows, with columns of names the operator uses itself."""
    return spark.createDataFrame([(1, text, lang, source, "t", 2, 3, 4, 5) for lang, source, text in rows], SCHEMA)


def brute(rows):
    rows = [(lang or "", source or "", [
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
        for word in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    ]) for lang, source, text in rows]
    documents, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in rows:
        documents[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang in documents:
        kept = {term for term, n in documents[lang].items() if n >= 30}
        own = {source: counter for (of, source), counter in counts.items() if of == lang}
        whole = sum(own.values(), Counter())

        def shares(counter, kept=kept):
            total = sum(counter[term] for term in kept)
            return {term: 1 + 10**9 * (counter[term] + 5) // (total + 5 * len(kept)) for term in kept}

        p, q = {source: shares(counter) for source, counter in own.items()}, shares(whole)
        for source, counter in own.items():
            pairs = [(sum(abs(p[source][t] - p[other][t]) for t in kept), other) for other in own if other != source]
            above = [(p[source][t] - q[t], t) for t in kept if counter[t] and p[source][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", above, 50)):
                ranked = sorted(items, key=lambda item: (-item[0], item[1].encode()))[:most]
                out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(row) for row in frame.collect())


@pytest.fixture
def some_rows():
    words = ["Alpha", "beta", "gamma-ray", "ÄÖ", "漢字", "\U0001f600x", "it's", "B2B", "ﬁn", "İ"]
    rows = []
    for k in range(400):
        text = " ".join(words[(k * step) % (3 + k % 8)] for step in range(1, 4 + k % 9))
        rows.append(("en" if k % 3 else None, f"s{k % 7}" if k % 11 else None, text))
    rows += [("en", "quiet", ""), ("en", "quiet", None), ("en", "digits", "1 2 3"), ("de", "alone", "Wort " * 40)]
    rows += [("fr", "a", "mot"), ("fr", "b", "mot"), ("", "s1", "alpha"), ("en", "", "alpha beta")]
    return rows


def test_against_brute_force(spark, some_rows):
    assert rows_of(divergence(table(spark, some_rows))) == brute(some_rows)


@pytest.mark.parametrize("tile,slice_", [(2, 3), (1, 1), (64, 2)])
def test_tiles_do_not_matter(spark, some_rows, monkeypatch, tile, slice_):
    want = brute(some_rows)
    monkeypatch.setattr(source_divergence, "SLICE", slice_)
    # tasks read the size of a tile from the module they import; the function takes it along here
    monkeypatch.setattr(source_divergence, "TILE", tile)
    pair_sums = source_divergence._pair_sums

    def with_tile(key, rows):
        source_divergence.TILE = tile
        return pair_sums(key, rows)

    monkeypatch.setattr(source_divergence, "_pair_sums", with_tile)
    assert rows_of(divergence(table(spark, some_rows))) == want


def test_sql_over_awkward_rows(spark, some_rows):
    connection = duckdb.connect()
    connection.sql("create table documents (lang varchar, source varchar, text varchar)")
    connection.executemany("insert into documents values (?, ?, ?)", some_rows)
    want = connection.sql(source_divergence.oracle()).fetchall()
    assert sorted(want) == brute(some_rows)


def test_terms():
    assert terms("Don't MIX Ärger_und 2Wörter".encode()) == [
        value.encode() for value in ("don", "t", "mix", "Ärger", "und", "wörter")
    ]
    assert terms(b"") == terms(b" 1234\x7f\x00") == []


def test_counts_of_a_long_text_and_repeated_rows(spark):
    rows = [("en", "s", "word " * 300_000)] * 2 + [("en", "s", "other")]
    got = {(row.term, row.n, row.docs) for row in term_counts(table(spark, rows)).collect()}
    assert got == {("word", 600_000, 2), ("other", 1, 1), ("", 0, 3)}


def test_no_term_kept(spark):
    rows = [("en", source, "few words") for source in ("b", "a", "c")]
    got = rows_of(divergence(table(spark, rows)))
    assert got == brute(rows)
    assert {row[4] for row in got} == {0}


def test_empty_table(spark):
    assert divergence(table(spark, [])).count() == 0


def test_shares_beyond_long(spark):
    n = 10**12  # times a billion, more than a long holds
    row = spark.range(1).select(source_divergence.share(*(source_divergence.F.lit(v).cast("long") for v in (n, 3 * n, 7)))).first()
    assert row[0] == 1 + 10**9 * (n + 5) // (3 * n + 35)


def test_query_runs_on_the_given_table(spark):
    got = queries.op12_source_divergence(spark, "/root/testdata/sf0.001")
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert got.filter("part = 'term'").count() and got.filter("part = 'pair'").count()


def broadcast_sides(frame):
    """What stands below each broadcast of a plan, as text."""
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    sides = []
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = line.index("BroadcastExchange")
            below = takewhile(lambda later: re.search(r"\w", later).start() > depth, lines[k + 1:])
            sides.append("\n".join(below))
    return sides


@pytest.mark.parametrize("most", [16 << 20, 0])
def test_only_measured_sources_are_broadcast(spark, some_rows, monkeypatch, most):
    """The files of these tables are small enough for Spark to broadcast any of them."""
    plans = {}

    def seen(rows, purpose):
        plans[purpose] = rows
        return stored(rows, purpose)

    stored = source_divergence.stored
    monkeypatch.setattr(source_divergence, "stored", seen)
    monkeypatch.setattr(source_divergence, "BROADCAST_BYTES", most, raising=False)
    found = divergence(table(spark, some_rows))
    assert [len(broadcast_sides(plan)) for plan in plans.values()] == [0] * len(plans)
    sides = broadcast_sides(found)
    assert bool(sides) == (most > 0)
    for side in sides:
        assert "source:string" in side and "term" not in side
    assert rows_of(found) == brute(some_rows)
