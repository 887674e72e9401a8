from __future__ import annotations

import pytest

from hitwatch.llm import licenses, queries
from tests.compare import database, difference


def test_query_against_sql(spark, small):
    sql = queries.ORACLE_SQL["op6_license_scan"]
    assert difference(queries.op6_license_scan(spark, small), database(small), sql) == ""


def slow_matches(text):
    """Best containment in any window, straight from the definition."""
    words = [w for w in licenses.plain_words(text or "") if w]
    out = {}
    for name, notice in licenses.TEMPLATES.items():
        own = licenses.plain_words(notice)
        shingles = {tuple(own[k : k + 3]) for k in range(len(own) - 2)}
        size = licenses.window_size(len(own))
        for start in range(0, max(1, len(words)), size // 4):
            part = words[start : start + size]
            found = {tuple(part[k : k + 3]) for k in range(len(part) - 2)}
            share = len(shingles & found) / len(shingles)
            if share >= 0.8:
                best, first = out.get(name, (0, start))
                out[name] = (max(best, share), first)
    return out


@pytest.mark.parametrize("before", [0, 1, 2, 3, 5, 9, 14])
def test_notices_at_any_place(docs, before):
    texts = []
    for notice in licenses.TEMPLATES.values():
        lead = " ".join(f"lead{k}" for k in range(before))
        texts.append(f"{lead} ({notice.upper()})! and then some more words of another kind")
        words = notice.split()
        texts.append(f"{lead} " + " ".join(words[: len(words) // 2] + ["changed"] + words[len(words) // 2 + 1 :]))
    rows = list(enumerate(texts))
    got = {}
    for r in licenses.licenses(docs(rows)).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.containment, r.start)
    assert got == {k: found for k, text in rows if (found := slow_matches(text))}
    assert all(2 * k in got for k in range(len(licenses.TEMPLATES)))


def test_whole_texts_and_pieces_of_them(docs):
    whole = licenses.WHOLE_TEXTS
    disclaimer = whole["bsd-3-text"][whole["bsd-3-text"].index("THIS SOFTWARE IS"):]
    conditions = whole["mit-text"][whole["mit-text"].index("The above copyright"):]
    rows = [(k, "some words before it " * 30 + text + " and after it") for k, text in enumerate(whole.values())]
    rows += [(10, f"/* {disclaimer} */"), (11, conditions.lower()), (12, " ".join(disclaimer.split()[:20]))]
    rows += [(13, "as is without warranty of any kind is what everybody says about software and its fitness")]
    counts = {}
    for name, *_ in licenses.parts(whole):
        counts[name] = counts.get(name, 0) + 1
    got = {}
    for r in licenses.licenses(docs(rows)).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.parts
    for k, name in enumerate(whole):
        assert got[k][name] == counts[name] > 1
        assert not (got[k].keys() & whole.keys()) - {name}
    assert 0 < got[10]["bsd-3-text"] < counts["bsd-3-text"] and set(got[10]) == {"bsd-3-text"}
    assert 0 < got[11]["mit-text"] < counts["mit-text"] and set(got[11]) == {"mit-text"}
    assert 12 not in got and 13 not in got


def test_parts_overlap_and_cover_a_text():
    words = [f"w{k}" for k in range(200)]
    found = licenses.parts({"long": " ".join(words), "short": "one two three"})
    own = [set(shingles) for name, _, _, shingles in found if name == "long"]
    assert [size for _, _, size, _ in found] == [64] * len(own) + [4]
    assert set().union(*own) == {" ".join(words[k : k + 3]) for k in range(198)}
    assert all(a & b for a, b in zip(own, own[1:])) and all(len(shingles) == 46 for shingles in own)


def test_whole_texts_against_sql(spark, docs, tmp_path):
    whole = list(licenses.WHOLE_TEXTS.values())
    rows = [(k, " ".join(["x"] * k) + " " + text[k * 3 :]) for k, text in enumerate(whole * 6)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb
    connection = duckdb.connect()
    connection.execute(f"create view documents as from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert difference(licenses.licenses(table), connection, licenses.oracle()) == ""


def test_awkward_rows(awkward, empty, docs):
    assert licenses.licenses(awkward).count() == 0 and licenses.licenses(empty).count() == 0
    same = docs([(1, "All rights reserved."), (1, "all rights reserved"), (None, "All Rights Reserved"), (2, "All rights")])
    assert sorted((r.doc_id or 0, r.license) for r in licenses.licenses(same).collect()) == [(0, "reserved"), (1, "reserved")]


def test_a_notice_that_fits_no_window_is_refused():
    with pytest.raises(ValueError):
        licenses.window_size(49)


def test_plan_has_no_python(spark, small):
    plan = queries.op6_license_scan(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "") and "Arrow" not in plan and "Cartesian" not in plan
