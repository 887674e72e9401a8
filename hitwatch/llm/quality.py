"""Quality by hierarchical empirical Bayes: a document's text, its path and its host.

A logistic classifier turns features of the text into a probability. Over all documents
the probabilities are summed by host and by path within the host. The rate of a host is
shrunk towards that of the corpus, and the rate of a path towards that of its host, by the
strength that the variance between groups tells: where groups differ little, or have few
documents, their parent's rate counts. A document's score takes the rate of its path,
without its own share in it, as the prior for the evidence of its text.

Edge cases: null and empty texts have features of their own and get a score; a null host or
path is a group like any other; a document alone in its host has the corpus as its prior;
repeated rows are documents of their own; without labelled rows of both kinds the evidence
is one half everywhere; an empty table gives no rows; columns beside ``doc_id``, ``text``,
``host`` and ``path`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitwatch.llm.common import join_hot_keys, runs, stored
from hitwatch.llm.labelled import held_out

THRESHOLD = 0.5
FLOOR = 1e-3  # no probability is surer than that before groups are summed
MOST_STRENGTH = 1e6
FARTHEST = 8  # deviations from the mean that a feature counts for at most

_CLASS = np.full(256, 4, np.int64)  # lower-case and other letters, capitals, digits, space, marks
_CLASS[[*range(97, 123), *range(128, 256)]] = 0
_CLASS[range(65, 91)] = 1
_CLASS[range(48, 58)] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3


def features(text: str) -> list[float]:
    """Shares of kinds of characters, variety and length of words, repetition of lines."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    shares = np.bincount(_CLASS[data], minlength=5) / max(1, len(data))
    words = text.split()
    count = max(1, len(words))
    lines = [line for line in text.split("\n") if line]
    return [
        *(float(np.log(x + 0.01)) for x in shares),
        float(np.log1p(len(words))),
        len(set(words)) / count,
        float(np.log(len(set(words)) / count + 0.02)),
        sum(not any(map(str.isalnum, word)) for word in set(words)) / max(1, len(set(words))),
        len(data) / count if words else 0.0,
        len(set(lines)) / max(1, len(lines)),
    ]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probability(self, texts: Sequence[str]) -> np.ndarray:
        x = _inputs(np.array([features(text) for text in texts]), self.mean, self.scale)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _inputs(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features and their squares, at most ``FARTHEST`` deviations from the mean, in training and
    in use: an odd text does not run away with the squares."""
    x = np.clip((x - mean) / scale, -FARTHEST, FARTHEST)
    return np.column_stack([x, x * x, np.ones(len(x))])


def train(good: Sequence[str], bad: Sequence[str], penalty: float = 1.0) -> Model | None:
    """A classifier of texts of both kinds; none if one of them is missing."""
    if not good or not bad:
        return None
    x = np.array([features(text) for text in [*good, *bad]])
    y = np.r_[np.ones(len(good)), np.zeros(len(bad))]
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x = _inputs(x, mean, scale)
    weight = np.where(y == 1, len(y) / (2 * len(good)), len(y) / (2 * len(bad)))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (weight * (p - y)) + penalty * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return Model(mean, scale, w)


def evidence(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, host, path, held_out`` and ``p``, what the text alone says."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches, "text"):
            p = np.full(len(texts), 0.5) if model is None else model.probability(texts)
            columns = [batch.column(batch.schema.get_field_index(name)) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.clip(p, FLOOR, 1 - FLOOR))], [*kept, "p"])

    rows = docs.select("doc_id", "host", "path", held_out().alias("held_out"), "text")
    kept = ["doc_id", "host", "path", "held_out"]
    schema = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in kept)
    return rows.mapInArrow(score, f"{schema}, p double")


def strength(groups: DataFrame, parent: str) -> float:
    """How many documents the parent's rate weighs, by the method of moments: the variance
    of the groups' rates beyond what documents of one rate would show. ``groups`` has sums
    ``n``, ``s`` of a group, ``q`` of squares, and the parent's rate."""
    rate = F.col("s") / F.col("n")
    inside, outside, count, size = groups.agg(
        F.sum(F.col("q") - F.col("s") * rate),
        F.sum(F.col("n") * F.pow(rate - F.col(parent), F.lit(2))),
        F.count(F.lit(1)),
        F.sum("n"),
    ).first()
    if not size or count < 2 or size <= count:
        return MOST_STRENGTH
    within = inside / (size - count)
    between = (outside - (count - 1) * within) / size
    return float(min(MOST_STRENGTH, within / between)) if between > 0 else MOST_STRENGTH


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def quality(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, evidence, host_rate, path_rate, score, keep`` of every document
    of a table with ``doc_id, text, host`` and ``path``."""
    rows = stored(evidence(docs, model), "evidence")
    sums = [F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")]
    paths = stored(rows.groupBy("host", "path").agg(*sums), "paths")
    total = [F.sum(name).alias(name) for name in ("n", "s", "q")]
    n, s, _ = paths.agg(*total).first()
    overall = s / n if n else 0.5
    hosts = paths.groupBy("host").agg(*total).withColumn("parent", F.lit(overall))
    k_host = strength(hosts, "parent")
    hosts = stored(
        hosts.select(
            F.col("host").alias("h"), F.col("n").alias("n_host"), F.col("s").alias("s_host"),
            ((F.col("s") + k_host * overall) / (F.col("n") + k_host)).alias("host_rate"),
        ),
        "hosts",
    )
    known = stored(paths.join(hosts, paths["host"].eqNullSafe(hosts["h"])), "sites")
    k_path = strength(known, "host_rate")
    keyed = known.select(
        F.col("host").alias("k_host"), F.col("path").alias("k_path"), "n",
        F.col("s").alias("s_path"), "n_host", "s_host",
    ).withColumn("n_path", F.col("n"))
    joined = join_hot_keys(rows, keyed, ["host", "path"], n or 0)
    # a document's own share is taken out of both levels
    host_rate = (F.col("s_host") - F.col("p") + k_host * overall) / (F.col("n_host") - 1 + k_host)
    path_rate = (F.col("s_path") - F.col("p") + k_path * F.col("host_rate")) / (F.col("n_path") - 1 + k_path)
    score = 1 / (1 + F.exp(-(_logit(F.col("p")) + _logit(F.col("path_rate")))))
    return (
        joined.withColumn("host_rate", _inside(host_rate))
        .withColumn("path_rate", _inside(path_rate))
        .withColumn("score", score)
        .select(
            "doc_id", "held_out", F.col("p").alias("evidence"), "host_rate", "path_rate", "score",
            (F.col("score") >= threshold).alias("keep"),
        )
    )


def _inside(rate: Column) -> Column:
    return F.least(F.greatest(rate, F.lit(FLOOR)), F.lit(1 - FLOOR))
