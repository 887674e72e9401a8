from __future__ import annotations

import pytest

from hitwatch.llm import common


def _hinted(rows):
    return "ResolvedHint" in rows._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("ids, small, large", [("id", 0, 0), ("cast(id as string)", 10, 9), ("encode(cast(id as string), 'utf-8')", 10, 9)])
def test_sides_are_broadcast_by_rows_and_bytes(spark, monkeypatch, ids, small, large):
    """Ten ids of one digit; those of fixed width go by rows alone."""
    rows = spark.range(10).selectExpr(f"{ids} as `a.b`", "id as other")
    assert _hinted(common.sized(rows, 10))
    monkeypatch.setattr(common, "BROADCAST_BYTES", small)
    assert _hinted(common.sized(rows, 10))
    monkeypatch.setattr(common, "BROADCAST_BYTES", large)
    assert _hinted(common.sized(rows, 10)) == (ids == "id")
    monkeypatch.setattr(common, "BROADCAST_ROWS", 9)
    assert not _hinted(common.sized(rows, 10))


def test_nulls_and_empty_sides(spark):
    nothing = spark.createDataFrame([(None,), (None,)], "a string")
    assert _hinted(common.sized(nothing, 2)) and _hinted(common.sized(nothing.limit(0), 0))
