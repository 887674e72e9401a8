from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np

from hitwatch.llm import pii, queries
from hitwatch.llm.common import read

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow_base(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_against_the_patterns():
    rng = random.Random(1)
    for alphabet, longest in (("ab1.2@9+- ()3%4_5٣", 60), ("4111 -1", 44), ("0.25 6", 30), ("a@.b-", 25), ("+1 (2)3.", 30)):
        for _ in range(5000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(longest)))
            assert pii.base_spans(text) == slow_base(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "+" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + " " * 300_000):
        pii.candidates(text)


def slow_candidates(text):
    """Spans that overlap nothing taken so far, one by one."""
    base = pii.base_spans(text)
    loose = []
    for kind in ("email", "ip", "card", "phone"):
        if kind != "email" or "@" in text or re.search(r"\bdot\b|[(\[{]at[)\]}]", text, re.I):
            loose += [(kind, *m.span()) for m in pii.LOOSE[kind].finditer(text)]
    taken = [span[1:] for span in base]
    for span in loose:
        if not any(start < span[2] and span[1] < end for start, end in taken):
            taken.append(span[1:])
            base.append(span)
    return base


def test_candidates_against_all_pairs():
    rng = random.Random(2)
    for alphabet in ("12 345.678-()+90", "a1.@ (at)dot.com 2", "+1 (202) 555-0123 4111 1111 1.2.3.4 "):
        pieces = [alphabet, "4111 1111 1111 1111", "+1 (202) 555-0123", "10.0.0.1", "a at b dot com", "x@y.org", "202-555-0123"]
        for _ in range(2000):
            text = "".join(rng.choice(pieces) if rng.random() < 0.3 else rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert [c.span for c in pii.candidates(text)] == slow_candidates(text), text


def test_many_candidates_in_one_text_take_seconds():
    text = " ".join(f"{k % 90 + 10}.0.0.{k % 200}, 202-555-{k % 10_000:04}; 4111-1111-1111-{k % 10_000:04}" for k in range(50_000))
    began = time.perf_counter()
    found = pii.candidates(text)
    assert len(found) >= 100_000 and time.perf_counter() - began < 20


def test_estimated_reliabilities():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.9, 0.6, 0.85])
    votes = np.where((rng.random((20_000, 4)) < right) == truth[:, None], 1, -1) * (rng.random((20_000, 4)) < 0.8)
    unique, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = pii.estimate(unique, np.full(len(unique), "email"), counts.astype(float))
    assert ((p[inverse.ravel()] > 0.5) == truth).mean() > 0.93


def test_spelled_out_spans_are_added(spark, docs):
    rows = [(k, f"mail user{k}@host{k}.com or call +1 (202) 555-01{k:02} now") for k in range(60)]
    rows += [(100 + k, f"write to user{k} (at) host{k} (dot) com or call +1 (202) 555-01{k:02} 4111111111111111 now") for k in range(20)]
    rows += [(200, "look at it. Then go at once. Be at home."), (201, "sha 12345678901234567890123")]
    table = docs(rows)
    sure = pii.learn(pii.profile_counts(table))
    got = {r.doc_id: r for r in pii.personal_data(table, sure).collect()}
    assert all(got[k].n_added == 0 and got[k].n_email == got[k].n_phone == 1 for k in range(60))
    text = dict(rows)[103]
    kinds = {s.split(":")[0]: text[slice(*map(int, s.split(":")[1:]))] for s in got[103].spans.split(",")}
    assert kinds == {"email": "user3 (at) host3 (dot) com", "phone": "+1 (202) 555-0103", "card": "4111111111111111"}
    assert got[200].spans == got[201].spans == ""
    assert pii.redacted(text, got[103].spans) == "write to <email> or call <phone> <card> now"


def test_query_keeps_all_base_spans(spark, small):
    got = {r.doc_id: r for r in queries.op7_pii(spark, small).collect()}
    documents = read(spark, small, "documents").collect()
    assert len(got) == len(documents)
    for doc in documents:
        base = slow_base(doc.text)
        r = got[doc.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        texts = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(texts).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(texts) <= set(spans) and len(spans) == len(texts) + r.n_added


def test_awkward_rows(awkward, empty):
    rows = pii.personal_data(awkward, pii.learn(pii.profile_counts(awkward))).collect()
    assert len(rows) == 14 and {r.spans for r in rows} == {""}
    assert pii.personal_data(empty, pii.learn(pii.profile_counts(empty))).count() == 0
