from __future__ import annotations

import random
import re

import pytest

from hitwatch.llm import common, line_dedup, queries
from hitwatch.llm.common import read


def words_of(line):
    return {word for word in re.split(r"[ \t\r\x0b\x0c]", line.lower()) if word}


def slow_repeated(texts):
    """(id, line) of every line similar to an earlier one, from (id, text) in order."""
    seen, index, out = [], {}, set()
    for doc, text in texts:
        for number, line in enumerate((text or "").split("\n")):
            own = words_of(line)
            if not own:
                continue
            near = {k for word in own for k in index.get(word, ())}
            if any(len(own & seen[k]) >= 0.8 * len(own | seen[k]) - 1e-12 for k in near):
                out.add((doc, number))
            for word in own:
                index.setdefault(word, []).append(len(seen))
            seen.append(own)
    return out


def found(docs):
    return {(r.doc, r.line) for r in line_dedup.repeated_lines(docs).collect()}


def test_against_brute_force_on_documents(spark, small):
    docs = read(spark, small, "documents").filter("doc_id < 250")
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    assert found(docs) == slow_repeated(texts)


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_against_brute_force_on_copies(spark, docs, monkeypatch, broadcast):
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    rng = random.Random(3)
    frequent = [f"w{k}" for k in range(25)]
    lines = []
    for size in (1, 2, 4, 5, 9, 10, 30, 90, 160):
        base = [f"r{rng.randrange(400)}" for _ in range(size // 2)] + [rng.choice(frequent) for _ in range(size - size // 2)]
        for _ in range(14):
            near = list(base)
            for _ in range(rng.randrange(0, max(1, size // 4) + 1)):
                near[rng.randrange(len(near))] = f"x{rng.randrange(60)}"
            rng.shuffle(near)
            lines.append(" ".join(near).upper() if rng.random() < 0.3 else " ".join(near))
    rng.shuffle(lines)
    texts = [(k, "\n".join(lines[3 * k : 3 * k + 3])) for k in range(len(lines) // 3)]
    assert found(docs(texts)) == slow_repeated(texts)


@pytest.mark.parametrize("size", [20, 100, 250])
def test_pairs_of_near_copies_in_proportion_to_lines(docs, monkeypatch, size):
    """Clusters of documents with 20 lines each, of which every copy changes some words."""
    rng = random.Random(size)
    texts = []
    for cluster in range(4):
        base = [[f"c{cluster}w{rng.randrange(300)}" for _ in range(rng.randint(8, 40))] for _ in range(20)]
        for _ in range(size):
            near = [list(words) for words in base]
            for words in near:
                for _ in range(rng.choice([0, 1, 1, 2, 3])):
                    words[rng.randrange(len(words))] = f"x{rng.randrange(4000)}"
            texts.append((len(texts), "\n".join(" ".join(words) for words in near)))
    counts = {}
    keep = line_dedup.stored

    def watched(rows, purpose):
        out = keep(rows, purpose)
        counts[purpose] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "stored", watched)
    got = found(docs(texts))
    n = sum(len(text.split("\n")) for _, text in texts)
    assert counts["likely"] <= n and counts["likely"] + counts["pairs"] <= 3 * n
    if size == 20:
        assert got == slow_repeated(texts)
    assert len(got) > 0.7 * n


def test_ids_with_several_texts_are_looked_for_once(docs, monkeypatch):
    purposes = []
    keep = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda rows, purpose: purposes.append(purpose) or keep(rows, purpose))
    table = docs([(1, "a b c"), (2, "a b c\nd e"), (3, None), (3, None)])
    got = {(r.doc_id, r.n_removed, r.text) for r in line_dedup.edited_lines(table).collect()}
    assert got == {(1, 0, "a b c"), (2, 1, "d e"), (3, 0, None)}
    assert purposes.count("several-texts") == 1


def test_word_set_puts_rare_words_first(spark):
    rows = spark.createDataFrame([(0, 0, k, "the cat") for k in range(9)] + [(1, 0, 0, "the the rare")], "doc long, version long, line int, value string")
    classes = line_dedup.rarity(rows)
    first = rows.filter("doc = 1").select(line_dedup.word_set(rows.value, classes).alias("w")).first().w
    mask = (1 << line_dedup.HASH_BITS) - 1
    hashed = spark.sql("select xxhash64('rare') as r, xxhash64('the') as t").first()
    assert [v & mask for v in first] == [(h & (1 << 64) - 1) >> 7 for h in hashed]


def test_awkward_rows(awkward, empty):
    kept = line_dedup.without_repeated_lines(awkward)
    assert kept.columns == awkward.columns
    rows = [(r.doc_id, r.text, r.n_chars) for r in kept.collect()]
    assert len(rows) == 14
    by_id = {}
    for doc_id, text, n_chars in rows:
        by_id.setdefault(doc_id, []).append(text)
        assert n_chars == (None if text is None else len(text))
    assert by_id[1] == ["", ""] and by_id[2] == [""] and by_id[7] == [""]  # later than null, 1 and 6
    assert by_id[3] == [None] and sorted(by_id[4]) == ["", "another text under the id 4"]
    assert by_id[5] == ["\n\n \t"] and len(by_id[6][0]) > 100_000
    assert line_dedup.without_repeated_lines(empty).count() == 0


def test_lines_without_words_stay(docs):
    text = "one two\r\n\r\n\r\n\t\n\t\n \t\x0b\n\x0c\r\none two\r\n"
    table = docs([(1, text), (2, text)])
    assert found(table) == slow_repeated([(1, text), (2, text)]) == {(1, 7), (2, 0), (2, 7)}


def colliding_lines():
    """Two lines of 16 bytes with other words but one xxhash64 with Spark's seed."""
    rng, mask = random.Random(1), (1 << 64) - 1
    p1, p2, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5

    def turn(x, by):
        return ((x << by) | (x >> (64 - by))) & mask

    def spread(word):
        return turn(int.from_bytes(word, "little") * p2 & mask, 31) * p1 & mask

    def unspread(x):
        return (turn(x * pow(p1, -1, 1 << 64) & mask, 33) * pow(p2, -1, 1 << 64) & mask).to_bytes(8, "little")

    def state(word):
        return (turn((42 + p5 + 16) & mask ^ spread(word), 27) * p1 + p4) & mask

    head, tail = b"ab cd ef", b"ghijklmn"
    while True:
        other = bytes(rng.choice(b"opqrstuvwxyz0123456789") for _ in range(8))
        end = unspread(state(head) ^ spread(tail) ^ state(other))
        if re.fullmatch(rb"[!-@\[-~]{8}", end):
            return (head + tail).decode(), (other + end).decode()


def test_one_equal_hash_is_not_an_equal_line(spark, docs):
    one, two = colliding_lines()
    rows = spark.createDataFrame([(one,), (two,)], "line string")
    assert rows.selectExpr("count(distinct xxhash64(line)) as n").first().n == 1
    assert found(docs([(1, one), (2, two), (3, one)])) == {(3, 0)}


def test_query_removes_what_is_found(spark, small):
    docs = read(spark, small, "documents").filter("doc_id < 60")
    gone = found(docs)
    got = {r.doc_id: (r.n_removed, r.text) for r in line_dedup.edited_lines(docs).collect()}
    for r in docs.collect():
        parts = r.text.split("\n")
        kept = [line for k, line in enumerate(parts) if (r.doc_id, k) not in gone]
        assert got[r.doc_id] == (len(parts) - len(kept), "\n".join(kept))


def test_plan_has_no_python(spark, small):
    plan = queries.op2_line_dedup(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
