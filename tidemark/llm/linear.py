"""A sparse logistic regression trained with follow-the-regularised-leader updates, and its scoring by sparse dot products.

Cases. A null or empty text has the intercept only. Null labels and ids don't count; ids that are labelled more than once count once, with the
larger label; documents that repeat an id are each a row of the sample. Without rows all weights are 0. Ties in the order of training are
broken by label and features, so that equal tables give equal weights. Columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import small_batches

#: A part of a column of texts to each row's slots and values: (slots, values, index of each row's first one).
Features = Callable[[pa.Array], Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """Per-coordinate FTRL-proximal; slot 0 is the intercept and is not regularised."""

    def __init__(self, slots: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros(slots), np.zeros(slots)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.equal(at, 0), 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, value: np.ndarray, target: float, weight: float) -> None:
        """``at`` has no repeats."""
        w = self.weights(at)
        g = (sigmoid(w @ value) - target) * weight * value
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def featurised(rows: DataFrame, features: Features, target: str, order: str) -> DataFrame:
    """rows(text, target, order) to (order, target, slots, values), in parallel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, slots, values, first in features(batch.column("text")):
                cut = [(slots[a:b].astype("<i4").tobytes(), values[a:b].astype("<f4").tobytes()) for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(order).slice(lo, hi - lo), batch.column(target).slice(lo, hi - lo), pa.array([c[0] for c in cut], pa.binary()), pa.array([c[1] for c in cut], pa.binary())], names=["place", "target", "slots", "values"])

    return rows.select("text", F.col(target).cast("double").alias(target), F.col(order).cast("long").alias(order)).mapInArrow(run, "place long, target double, slots binary, values binary")


def train(rows: DataFrame, slots: int, epochs: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, balance: float = 0.5) -> np.ndarray:
    """Weights from featurised rows, a bounded sample, passed over ``epochs`` times in the order of ``place`` by one task.
    The rarer class counts as ``balance`` of the whole at most. ``rows`` must be a kept table, so that the one task reads the sample
    only: the scan that draws it and the featurising come before and are spread over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(p, t, np.frombuffer(s, "<i4"), np.frombuffer(v, "<f4")) for b in batches for p, t, s, v in zip(*(b.column(i).to_pylist() for i in range(4)))]
        held.sort(key=lambda x: (x[0], x[1], x[2].tobytes()))
        model = Ftrl(slots, alpha, beta, l1, l2)
        share = min(max(sum(x[1] for x in held) / max(1, len(held)), 1e-3), 1 - 1e-3)
        up = max(1.0, balance * (1 - share) / share), max(1.0, balance * share / (1 - share))  # of class 1, of class 0
        for _ in range(epochs):
            for _, target, at, value in held:
                model.update(at, value.astype(float), target, target * up[0] + (1 - target) * up[1])
        yield pa.record_batch({"w": pa.array([model.weights(np.arange(slots)).astype("<f4").tobytes()], pa.binary())})

    with small_batches(rows.sparkSession):
        out = rows.coalesce(1).mapInArrow(run, "w binary").collect()
    return np.frombuffer(out[0]["w"], "<f4") if out else np.zeros(slots, np.float32)


def scored(docs: DataFrame, features: Features, weights: np.ndarray, keep: list[str], name: str = "score") -> DataFrame:
    """docs(text, ...) to its columns ``keep`` and a score of each whole text, in column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(float)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for lo, hi, slots, values, first in features(batch.column("text")):
                sums = np.concatenate(([0.0], np.cumsum(w[slots] * values)))
                scores[lo:hi] = sigmoid(sums[first[1:]] - sums[first[:-1]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores)], names=[*keep, name])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{types}, `{name}` double")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, trainable, most: int) -> DataFrame:
    """(text, label, place) of about ``most`` labelled documents, drawn by the id's hash among those where ``trainable`` holds.

    Rows of ``labels`` that repeat an id count once, with the larger label; null labels and ids don't count.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & trainable).groupBy("doc_id").agg(F.max(label).alias(label))
    drawn = _drawn(known, most)
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", label, "place")


def _drawn(rows: DataFrame, most: int) -> DataFrame:
    share = min(1.0, most / max(1, rows.count()))
    placed = rows.withColumn("place", F.xxhash64("doc_id", F.lit(17)))
    return placed.where(F.pmod("place", F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else placed
