"""Bounded labelled samples, and the optimiser the numpy models share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket(doc_id: str | Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; null for a null id."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % buckets


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, buckets: int, held: int, rows: int, longest: int = 1 << 18) -> list[tuple[str, object]]:
    """At most ``rows`` (text, label) pairs of documents outside bucket ``held``, in an order that only the ids decide.

    ``rows`` bounds what is broadcast; with ``longest``, the most bytes of a sampled text, it bounds what the driver gets.
    Of rows that share an id the smallest text and label stand. Null ids, texts and labels are left out.
    """
    some = labels.select(F.col("doc_id").cast("long"), F.col(label).alias("label")).dropna().where(bucket("doc_id", buckets) != held)
    some = some.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long"), "text").dropna().where(F.octet_length("text") <= longest)
    # the hint holds for `rows` rows of two numbers; one text an id, so no more than `rows` texts leave the executors
    found = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return [(r["text"], r["label"]) for r in sorted(found.toArrow().to_pylist(), key=lambda r: r["doc_id"])]


class Adam:
    """Adam over a dict of arrays, changed in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
