"""Language identification by a bidirectional gated recurrent network over bytes.

Two GRUs read each word's bytes forwards and backwards (the state starts anew at white space, long words go on in
parts); a softmax over both states labels every byte position, and a document's probabilities are the pooled position
probabilities of its whole text. Trained in numpy by backpropagation through time. As a word's labels do not depend on
its neighbours, each worker labels a word once and keeps its pooled sums.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.learn import Adam, bucket, labelled_sample, sigmoid
from citeloom.llm.textops import small_batches

BUCKETS, HELD = 4, 2
PART = 32
UNKNOWN = "und"


def byte_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words, 1-based with 0 for padding, one row each; and their lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    x = np.zeros((len(words), int(size.max(initial=1))), np.int64)
    flat = np.frombuffer(b"".join(words), np.uint8)
    x[np.arange(x.shape[1])[None, :] < size[:, None]] = flat.astype(np.int64) + 1
    return x, size


@dataclass
class ByteGRU:
    """p: for each direction d, input rows e (257, 3h), recurrence u (h, 3h), and the output o (2h, languages) with bias c."""

    languages: list[str]
    p: dict[str, np.ndarray]

    def states(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states, (positions, words, h). Padding leaves the state as it was."""
        e, u = self.p["e" + d], self.p["u" + d]
        h = np.zeros((len(x), u.shape[0]), u.dtype)
        n = u.shape[0]
        out = np.zeros((x.shape[1], *h.shape), u.dtype)
        for t in range(x.shape[1]) if d == "f" else reversed(range(x.shape[1])):
            a, r = e[x[:, t]], h @ u
            z, g = sigmoid(a[:, :n] + r[:, :n]), sigmoid(a[:, n : 2 * n] + r[:, n : 2 * n])
            c = np.tanh(a[:, 2 * n :] + g * r[:, 2 * n :])
            on = (x[:, t] > 0)[:, None]
            new = np.where(on, h + z * (c - h), h)
            if keep is not None:
                keep.append((t, h, z, g, c, r[:, 2 * n :], on))
            h = out[t] = new
        return out

    def labels(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of every position, (positions, words, languages)."""
        s = np.concatenate([self.states(x, "f"), self.states(x, "b")], 2) @ self.p["o"] + self.p["c"]
        s = np.exp(s - s.max(2, keepdims=True))
        return s / s.sum(2, keepdims=True)

    def pooled(self, words: list[bytes]) -> np.ndarray:
        """Sum of each word's position log-probabilities, its number of positions last."""
        out = np.zeros((len(words), len(self.languages) + 1))
        parts = [(i, w[a : a + PART]) for i, w in enumerate(words) for a in range(0, len(w), PART)]
        parts.sort(key=lambda p: len(p[1]))
        for a in range(0, len(parts), 4096):
            x, size = byte_rows([w for _, w in parts[a : a + 4096]])
            logs = np.log(self.labels(x) + 1e-6) * (x.T > 0)[:, :, None]
            who = [i for i, _ in parts[a : a + 4096]]
            np.add.at(out, who, np.concatenate([logs.sum(0), size[:, None]], 1))
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean cross entropy over all positions, by backpropagation through time."""
        kept = {"f": [], "b": []}
        s = np.concatenate([self.states(x, d, kept[d]) for d in "fb"], 2)
        prob = s @ self.p["o"] + self.p["c"]
        prob = np.exp(prob - prob.max(2, keepdims=True))
        prob /= prob.sum(2, keepdims=True)
        prob[:, np.arange(len(x)), y] -= 1
        mask = (x.T > 0) * weight[None, :]
        ds = prob * (mask / mask.sum())[:, :, None]
        n = self.p["uf"].shape[0]
        grads = {"o": np.einsum("twh,twl->hl", s, ds), "c": ds.sum((0, 1))}
        back = ds @ self.p["o"].T
        for d, part in (("f", back[:, :, :n]), ("b", back[:, :, n:])):
            e, u = np.zeros_like(self.p["e" + d]), np.zeros_like(self.p["u" + d])
            dh = np.zeros_like(part[0])
            for t, h, z, g, c, rc, on in reversed(kept[d]):
                dh = dh + part[t]
                dc = np.where(on, dh * z, 0) * (1 - c * c)
                dz = np.where(on, dh * (c - h), 0) * z * (1 - z)
                dg = dc * rc * g * (1 - g)
                da = np.concatenate([dz, dg, dc], 1)
                dr = np.concatenate([dz, dg, dc * g], 1)
                np.add.at(e, x[:, t], da)
                u += h.T @ dr
                dh = np.where(on, dh * (1 - z), dh) + dr @ self.p["u" + d].T
            grads["e" + d], grads["u" + d] = e, u
        return grads


def fit(sample: list[tuple[str, str]], hidden: int = 12, words: int = 12_000, epochs: int = 6, seed: int = 5) -> ByteGRU:
    """Train on (text, language) pairs, on the ``words`` most frequent parts of words of each language.

    An empty sample gives a model without languages.
    """
    counts: dict[str, Counter] = defaultdict(Counter)
    for text, lang in sample:
        counts[lang].update(w[a : a + PART] for w in text.encode().split() for a in range(0, len(w), PART))
    langs = sorted(counts)
    items, y, weight = [], [], []
    for i, lang in enumerate(langs):
        top = sorted(counts[lang].items(), key=lambda c: (-c[1], c[0]))[:words]
        total = sum(np.sqrt(n) for _, n in top)
        for w, n in top:
            items.append(w)
            y.append(i)
            weight.append(np.sqrt(n) / total)
    rng = np.random.default_rng(seed)
    p = {"o": rng.normal(0, 0.3, (2 * hidden, len(langs))), "c": np.zeros(len(langs))}
    for d in "fb":
        p["e" + d], p["u" + d] = rng.normal(0, 0.3, (257, 3 * hidden)), rng.normal(0, 0.3, (hidden, 3 * hidden))
    model = ByteGRU(langs, p)
    if len(langs) > 1:
        size = np.fromiter(map(len, items), np.int64, len(items))
        y, weight = np.array(y), np.array(weight) * len(items)
        opt = Adam(p, 0.01)
        epochs = max(epochs, -(-400 // -(-len(items) // 512)))  # a small vocabulary needs more rounds
        for epoch in range(epochs):
            opt.rate = 0.01 * (1 - epoch / epochs) + 0.001
            noise = np.argsort(size + rng.random(len(items)) * 4)  # words of like length share a batch
            batches = [noise[a : a + 512] for a in range(0, len(noise), 512)]
            for b in rng.permutation(len(batches)):
                x, _ = byte_rows([items[i] for i in batches[b]])
                opt.step(model.gradients(x, y[batches[b]], weight[batches[b]]))
    model.p = {k: v.astype(np.float32) for k, v in p.items()}
    return model


class WordTable:
    """Pooled sums of the words a worker has met; kept between its tasks, emptied when ``most`` words are in it."""

    kept: dict[str, WordTable] = {}

    def __init__(self, model: ByteGRU, most: int = 400_000):
        self.model, self.most, self.row = model, most, {}
        self.sums = np.zeros((1 << 12, len(model.languages) + 1), np.float32)
        self.letter = np.zeros(1 << 12, bool)

    @classmethod
    def of(cls, model: ByteGRU) -> WordTable:
        mark = hashlib.md5(b"".join(model.p[k].tobytes() for k in sorted(model.p)) + repr(model.languages).encode()).hexdigest()
        if mark not in cls.kept:
            cls.kept.clear()
            cls.kept[mark] = cls(model)
        return cls.kept[mark]

    def add(self, words: set[bytes]) -> None:
        new = list(words - self.row.keys())
        if len(self.row) + len(new) > self.most:
            self.row.clear()
            new = list(words)
        at, to = len(self.row), len(self.row) + len(new)
        self.row.update(zip(new, range(at, to)))
        while len(self.sums) < to:
            self.sums, self.letter = np.concatenate([self.sums, np.zeros_like(self.sums)]), np.concatenate([self.letter, np.zeros_like(self.letter)])
        if new:
            self.letter[at:to] = [w.isalpha() or any(map(str.isalpha, w.decode())) for w in new]
            self.sums[at:to] = self.model.pooled(new) * self.letter[at:to, None]

    def label(self, words: list[bytes]) -> tuple[str, float]:
        who = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
        if not self.model.languages or not self.letter[who].any():
            return UNKNOWN, 0.0
        total = self.sums[who].sum(0, dtype=np.float64)
        mean = np.exp(total[:-1] / total[-1])  # geometric mean over the positions
        return self.model.languages[int(mean.argmax())], float(mean.max() / mean.sum())


def _predict(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable.of(shared.value)
        for b in small_batches(batches):
            texts = [(t or "").encode().split() for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            table.add({w for ws in texts for w in ws})
            pred, score = zip(*map(table.label, texts))
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, rows: int = 1500) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``.

    Learns from text and lang of at most ``rows`` documents outside the held-out bucket. A null text, or one without a
    letter, gives ``und`` and 0; repeated rows are labelled alike; a null id has a null held_out. Extra columns are ignored.
    """
    model = fit(labelled_sample(docs, docs, "lang", BUCKETS, HELD, rows))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (bucket("doc_id", BUCKETS) == HELD).alias("held_out"), "lang_pred", "score")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
