from __future__ import annotations

import pytest

# names that operators might use for columns of their own
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "fp long, n long, word string, line int, _gone string, _version long, held_out string, path string"
)


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs, with columns of awkward names."""

    def make(pairs):
        rows = [
            (doc_id, text, "en", "src", None if text is None else len(text), 1, 2, "w", 3, "g", 4, "h", "p")
            for doc_id, text in pairs
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make


LONG = " ".join(f"word{k % 977} other{k % 31}" for k in range(40_000))


@pytest.fixture
def awkward(docs):
    """Null ids and texts, empty and very long texts, repeated rows, ties."""
    same = "the quick brown fox jumps over the lazy dog again and again today"
    return docs([
        (1, same), (1, same), (2, same), (3, None), (None, None), (None, same), (4, ""), (5, "\n\n \t"),
        (6, LONG), (7, LONG), (8, "é ü ß 漢字 \U0001f600"), (9, "one"), (10, "two words"), (4, "another text under the id 4"),
    ])


@pytest.fixture
def empty(docs):
    return docs([])
