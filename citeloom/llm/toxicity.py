"""Toxicity by a factorization machine over hashed terms.

A document's terms are its distinct words and their beginnings, hashed. The machine adds to a linear score the inner
products of the factors of every pair of present terms, in time linear in the terms; pairs such as an insult beside a
group's name can so weigh more, or less, than their sum.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from citeloom.llm.learn import Adam, bucket, labelled_sample, sigmoid
from citeloom.llm.textops import lean, small_batches, unused

BUCKETS, HELD = 5, 0
PREFIXES = (4, 5, 6, 7)
_STRIP = ".,;:!?\"'()[]{}«»„“”…*#$%&|-"


def words_of(text: str | None) -> set[str]:
    return {w for w in (p.strip(_STRIP) for p in set((text or "").lower().split())) if w}


def terms_of(word: str, bits: int) -> list[int]:
    """Hashed terms of a word: itself and its longer proper beginnings."""
    mask = (1 << bits) - 1
    return [zlib.crc32(b"w:" + word.encode()) & mask] + [zlib.crc32(f"p{n}:{word[:n]}".encode()) & mask for n in PREFIXES if len(word) > n]


@dataclass
class FactorizationMachine:
    bits: int
    bias: float
    index: dict[int, int]  # hashed term to row
    weight: np.ndarray
    factor: np.ndarray

    def rows(self, text: str | None, cache: dict[str, tuple[int, ...]]) -> list[int]:
        """Rows of the model's terms that the whole text has, each once."""
        found: set[int] = set()
        for w in words_of(text):
            if (r := cache.get(w)) is None:
                r = tuple(self.index[t] for t in terms_of(w, self.bits) if t in self.index)
                if len(cache) >= 300_000:
                    cache.clear()
                cache[w] = r
            if r:
                found.update(r)
        return sorted(found)

    def score(self, rows: list[int]) -> float:
        v = self.factor[rows]
        total = v.sum(0)
        return float(sigmoid(np.float64(self.bias + self.weight[rows].sum() + 0.5 * (total @ total - (v * v).sum()))))


def _jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two sorted arrays of distinct values; 1 for two empty ones."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0


def fit(sample: list[tuple[str, int]], bits: int = 22, most_terms: int = 800, factors: int = 8, epochs: int = 100, seed: int = 7) -> FactorizationMachine:
    """Train on (text, 0/1) pairs. The ``most_terms`` terms that tell the labels apart best (by chi-square) are kept.

    Of texts with one label whose term sets are similar by 0.8 or more (Jaccard) and share their smallest hashes, one counts.

    Without both labels in the sample the score is the labels' mean, or 0.5 for an empty sample.
    """
    docs, labels, kept_by = [], [], {}
    for text, label in sample:
        terms = np.unique(np.fromiter((t for w in words_of(text) for t in terms_of(w, bits)), np.int32))
        # a near copy would count its terms' chance company again: those of one beginning are compared whole
        alike = kept_by.setdefault((label, terms[:6].tobytes()), [])
        if not any(_jaccard(t, terms) >= 0.8 for t in alike):
            alike.append(terms)
            docs.append(terms)
            labels.append(label)
    y, n, pos = np.array(labels, float), len(labels), float(sum(labels))
    if not n or y.min() == y.max():
        return FactorizationMachine(bits, float(np.log((pos + 0.5) / (n - pos + 0.5))) if n else 0.0, {}, np.zeros(0), np.zeros((0, factors)))
    seen, hits = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
    for terms, label in zip(docs, labels):
        seen[terms] += 1
        if label:
            hits[terms] += 1
    often = np.flatnonzero(seen >= 4)
    a, b = hits[often].astype(float), (seen - hits)[often].astype(float)
    c, d = pos - a, n - pos - b
    chi = n * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1e-9)
    best = np.lexsort((often, -chi))
    kept = often[best[chi[best] > 20][:most_terms]]
    index = {t: i for i, t in enumerate(kept.tolist())}
    x = np.zeros((n, len(index)), np.float32)
    for i, terms in enumerate(docs):
        x[i, [index[t] for t in terms.tolist() if t in index]] = 1
    rng = np.random.default_rng(seed)
    rare = min(3.0, max(1.0, (n - pos) / pos))  # a missed toxic document counts more than a clean one
    p = {"b": np.array([np.log(pos / (n - pos))]), "w": np.zeros(len(index)), "v": rng.normal(0, 0.02, (len(index), factors))}
    opt = Adam(p, 0.03)
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, 256):
            s = order[a : a + 256]
            xs = x[s].astype(float)
            xv = xs @ p["v"]
            z = p["b"][0] + xs @ p["w"] + 0.5 * ((xv**2).sum(1) - (xs**2) @ (p["v"] ** 2).sum(1))
            g = (sigmoid(z) - y[s]) * np.where(y[s] > 0, rare, 1.0) / len(s)
            gx = xs.T @ g
            opt.step({"b": np.array([g.sum()]), "w": gx + 1e-4 * p["w"], "v": xs.T @ (g[:, None] * xv) - gx[:, None] * p["v"] + 5e-4 * p["v"]})
    return FactorizationMachine(bits, float(p["b"][0]), index, p["w"], p["v"])


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = 6000) -> FactorizationMachine:
    """Fit on at most ``rows`` labelled documents outside the held-out bucket."""
    return fit(labelled_sample(docs, labels, "toxic", BUCKETS, HELD, rows))


def _scores(model, name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, cache = model.value, {}
        for b in small_batches(batches):
            found = [machine.score(machine.rows(t, cache)) for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], [*b.schema.names, name])

    return run


def scored(docs: DataFrame, model: FactorizationMachine, name: str = "_score") -> DataFrame:
    """The rows of ``docs`` with a column ``name``, 0 to 1; a null or empty text has no terms and gets the bias alone.

    ``docs`` must have no column of that name; ``clean`` takes any columns.
    """
    return docs.mapInArrow(lean(_scores(docs.sparkSession.sparkContext.broadcast(model), name)), StructType([*docs.schema, StructField(name, DoubleType())]))


def clean(docs: DataFrame, model: FactorizationMachine, cut: float = 0.5) -> DataFrame:
    """The rows and columns of ``docs`` that score below ``cut``. Null and empty texts get the bias alone, equal texts the same score."""
    name = unused(docs, "score")
    return scored(docs, model, name).where(F.col(name) < cut).select(*[F.col(f"`{c}`") for c in docs.columns])


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; learned from ``labels`` outside the held-out bucket.

    Repeated rows are scored alike; a null id has a null held_out. Extra columns are ignored.
    """
    out = scored(docs.select(F.col("doc_id").cast("long"), "text"), fit_on(docs, labels, rows))
    return out.select("doc_id", (bucket("doc_id", BUCKETS) == HELD).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
