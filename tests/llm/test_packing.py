from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from hitwatch.llm import packing, queries
from hitwatch.llm.common import read


def check_places(rows, size):
    """Every sequence is filled without gaps or overlaps, from 0 to at most ``size``."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence)


def test_encoder_equals_the_tokenizer():
    plain = Tokenizer.from_file(queries.TOKENIZER)
    encode = packing.Encoder(queries.TOKENIZER)
    rng = random.Random(5)
    alphabet = "aZ bÉé .,!'sStT<|>\n\t\x1c\x85\xa01２3_-ΣİßǅÅá   漢"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["", "isn't it. It's!", "éa Å", "<|endoftext|> x", "don't,don't", "ends here..."]
    for text in texts:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == want, repr(text)


def test_a_process_loads_the_tokenizer_once_and_keeps_few_words(monkeypatch):
    """Several workers of an executor have an encoder each."""
    loaded = []

    class Counted:
        def __new__(cls, model):
            return Tokenizer(model)

        @staticmethod
        def from_file(path):
            loaded.append(path)
            return Tokenizer.from_file(path)

    monkeypatch.setattr(packing, "Tokenizer", Counted)
    encode = packing.Encoder(queries.TOKENIZER)
    assert len(loaded) == 1
    monkeypatch.setattr(packing, "KNOWN_WORDS", 100)
    for number in range(50):
        encode([" ".join(f"w{number}x{k}" for k in range(50))])
        assert len(encode.known) <= 150 and len(encode.before) <= 150
    assert packing.RUN <= 250_000  # characters whose words are apart at a time


def test_words_are_looked_up_once_a_run_and_kept_without_punctuation():
    """Every word of every text was looked up, and each word kept with each end it had."""

    class Counted(dict):
        seen = 0

        def __getitem__(self, word):
            self.seen += 1
            return super().__getitem__(word)

        def get(self, word, other=None):
            self.seen += 1
            return super().get(word, other)

    encode = packing.Encoder(queries.TOKENIZER)
    encode.known = Counted()
    text = "cat dog, cat. x2, bird! dog\x0bbird " * 500
    want = encode.whole.encode(text, add_special_tokens=False).ids
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encode([text, "", "dog"])] == [want, [], encode.whole.encode("dog").ids]
    assert encode.known.seen < 50
    assert set(encode.known) == {"cat", "dog", "bird", "x2,", "", ",", ".", "!"}


def test_least_squares_against_projected_gradient():
    rng = np.random.default_rng(2)
    for _ in range(5):
        a, b = rng.random((8, 12)), rng.normal(size=8)
        x = packing.nonnegative_least_squares(a, b)
        y = np.zeros(12)
        for _ in range(60_000):
            y = np.maximum(0, y - 0.02 * a.T @ (a @ y - b))
        assert (x >= 0).all() and np.linalg.norm(a @ x - b) <= np.linalg.norm(a @ y - b) + 1e-6


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    size = [64, 256, 2048][seed % 3]
    lengths = np.concatenate([
        rng.integers(1, size + 1, 3000), np.full(500, size), np.full(rng.integers(0, 900), size // 3), rng.integers(1, 6, 400)
    ])
    histogram = Counter(lengths.tolist())
    slots = packing.plan(histogram, size, min(packing.BINS, size))
    filled, ranks = defaultdict(list), defaultdict(list)
    for s in slots:
        ranks[s.length].append((s.rank, s.count))
        for k in range(s.count):
            filled[s.sequence + k].append((s.offset, s.length))
    for length, count in histogram.items():
        at = 0
        for rank, n in sorted(ranks[length]):
            assert rank == at
            at += n
        assert at == count
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert len(filled) <= 1.05 * -(-int(lengths.sum()) // size) + 3


def test_plan_of_nothing_and_of_one():
    assert packing.plan({}) == []
    assert packing.plan({5: 1}) == [packing.Slot(5, 0, 1, 0, 0)]


def test_query_against_the_tokenizer(spark, small):
    rows = queries.op5_best_fit_packing(spark, small).collect()
    plain = Tokenizer.from_file(queries.TOKENIZER)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    documents = read(spark, small, "documents").collect()
    assert len(by_doc) == len(documents)
    total = 0
    for doc in documents:
        ids = np.array(plain.encode(doc.text, add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        pieces = sorted(by_doc[doc.doc_id], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in pieces] == [
            (k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()))
            for k, at in enumerate(range(0, len(ids), 2048))
        ]
    assert check_places(rows, 2048) <= 1.005 * -(-total // 2048) + 1


@pytest.mark.parametrize("rank_rows", [200_000, 2])
def test_awkward_rows(awkward, empty, monkeypatch, rank_rows):
    monkeypatch.setattr(packing, "RANK_ROWS", rank_rows)
    rows = packing.pack(awkward, queries.TOKENIZER, 64).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in awkward.collect()}
    check_places(rows, 64)
    single = [r for r in rows if r.doc_id == 3]
    assert [(r.piece, r.start, r.length, r.ids_crc32) for r in single] == [(0, 0, 1, zlib.crc32(b"\0\0\0\0"))]
    assert packing.pack(empty, queries.TOKENIZER).count() == 0
