"""Labelled documents to learn from, and those held out."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Model = TypeVar("Model")

#: Bounds of the training sample: documents of each class, and their length.
SAMPLE_DOCUMENTS = 600
SAMPLE_CHARS = 20_000


def training_part(doc_id: str = "doc_id") -> Column:
    """Rows that may be learned from; the others are held out."""
    return ~held_out(doc_id)


def held_out(doc_id: str = "doc_id") -> Column:
    """``crc32`` of the id as text, modulo 3, is 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: int = SAMPLE_DOCUMENTS,
    max_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """``positive`` and ``text`` of labelled documents of either class, at most ``per_class``
    ids of each and ``max_chars`` long, chosen by a hash of their id. An id with several
    labels has the largest."""
    marked = (
        labels.filter(training_part()).groupBy("doc_id").agg(F.max(label).alias("_label"))
        .filter(F.col("_label").isNotNull())
    )
    # ids alone are joined and ordered; texts are read for the chosen few
    short = docs.select("doc_id", "text").filter(F.length("text").between(1, max_chars))
    able = short.select("doc_id").distinct().join(marked, "doc_id")
    parts = [
        able.filter(F.col("_label") == value).orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(per_class).select("doc_id", F.lit(value == 1).alias("positive"))
        for value in (1, 0)
    ]
    return short.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").select("positive", "text")


def fitted(sample: DataFrame, train: Callable[[list[str], list[str]], Model]) -> Model | None:
    """What ``train`` makes of the different texts of either class, in one task: the sample
    is bounded, and the driver sees the model only. None for an empty sample."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: tuple[set[str], set[str]] = (set(), set())
        for batch in batches:
            for positive, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                texts[positive].add(text)
        model = pickle.dumps(train(sorted(texts[True]), sorted(texts[False])))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    rows = sample.repartition(1).mapInArrow(fit, "model binary").collect()
    return pickle.loads(rows[0].model) if rows else None
