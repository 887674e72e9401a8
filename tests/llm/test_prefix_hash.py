from __future__ import annotations

import hashlib
import random

import pytest

from hitwatch.llm import prefix_hash, queries
from hitwatch.llm.common import read


def test_spans_and_extensions_against_slices():
    rng = random.Random(4)
    for _ in range(60):
        a = "".join(rng.choice("abé\U0001f600") for _ in range(rng.randrange(1, 60)))
        b = "".join(rng.choice("abé\U0001f600") for _ in range(rng.randrange(1, 20))) + a[rng.randrange(len(a)) :]
        x, y = prefix_hash.Prefix(a), prefix_hash.Prefix(b)
        for _ in range(30):
            i, j = rng.randrange(len(a)), rng.randrange(len(b))
            n = rng.randrange(0, min(len(a) - i, len(b) - j) + 1)
            assert x.same(i, y, j, n) == (a[i : i + n] == b[j : j + n])
            longest = 0
            while i + longest < len(a) and j + longest < len(b) and a[i + longest] == b[j + longest]:
                longest += 1
            assert x.extension(i, y, j) == longest


def test_span_hashes_tell_spans_apart():
    text = "the same words and the same words again, and something else"
    seen = {}
    for end, value in enumerate(prefix_hash.Prefix(text).span_hashes(5).tolist(), 1):
        seen.setdefault(value, set()).add(text[max(0, end - 5) : end])
    assert all(len(spans) == 1 for spans in seen.values())
    # and do not depend on where a span lies or how long the text is
    assert set(prefix_hash.Prefix(text[4:30]).span_hashes(5).tolist()[4:]) <= set(seen)


def test_likeness():
    a = " ".join(f"word{k}" for k in range(400))
    mark = [prefix_hash.fingerprint(prefix_hash.Prefix(t)) for t in (a, a[:-9] + "different", a[::-1], "", "x")]
    assert prefix_hash.likeness(mark[0], mark[0]) == 1 and prefix_hash.likeness(mark[3], mark[3]) == 1
    assert prefix_hash.likeness(mark[0], mark[1]) > 0.9 > 0.1 > prefix_hash.likeness(mark[0], mark[2])
    assert prefix_hash.likeness(mark[3], mark[4]) == 0 and mark[0][:16] != mark[1][:16]


@pytest.mark.parametrize("rows, step", [(5000, 64), (40, 3)])
def test_query_against_definition(spark, small, monkeypatch, rows, step):
    monkeypatch.setattr(prefix_hash, "RANGE_ROWS", rows)
    monkeypatch.setattr(prefix_hash, "STEP", step)
    got = {r.doc_id: r for r in queries.op1_prefix_fingerprints(spark, small).collect()}
    texts = sorted((r.doc_id, r.text) for r in read(spark, small, "documents").collect())
    assert len(got) == len(texts)
    for k, (doc_id, text) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = got[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    by_text = {}
    for doc_id, text in texts:
        by_text.setdefault(text, set()).add(got[doc_id].fingerprint)
    assert all(len(marks) == 1 for marks in by_text.values())
    assert len(set.union(*by_text.values())) == len(by_text)
    mean = [sum(getattr(r, c) for r in got.values()) / len(got) for c in ("near_edited", "near_next")]
    assert mean[0] > 0.3 and mean[1] < 0.05


def test_awkward_rows(awkward, empty, docs):
    rows = prefix_hash.fingerprints(awkward).collect()
    assert len(rows) == 14
    assert sorted(r.n_chars for r in rows if r.doc_id in (3, 4)) == [0, 0, 27]
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert prefix_hash.fingerprints(empty).count() == 0
    alone = prefix_hash.fingerprints(docs([(5, "abcdef")])).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and alone[0].near_next == 1
    # equal ids: each row has a next one, around the circle of all rows
    ties = prefix_hash.fingerprints(docs([(1, "aa"), (1, "bb"), (1, "cc")])).collect()
    assert len({r.edited_sha256 for r in ties}) == 3
