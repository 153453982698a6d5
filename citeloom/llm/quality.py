"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's evidence is its own features and those of its neighbours; the chain adds how
likely a good or bad line follows another. The forward-backward marginals, weighted by the lines' lengths, give the
document's share of good text, which a logistic curve turns into the score. Lines take their document's label for
training, as a weak label: lines found in both kinds of document learn to tell nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.learn import Adam, bucket, labelled_sample, sigmoid
from citeloom.llm.textops import bytes_of, small_batches, word_hashes, word_spans

BUCKETS, HELD = 4, 2
CUT = 0.7

#: Classes of bytes that are counted in a line.
_CLASSES = {name: np.isin(np.arange(256), [ord(c) for c in chars]) for name, chars in {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": "abcdefghijklmnopqrstuvwxyz", "digit": "0123456789", "stop": ".,;:",
    "mark": "!?", "bar": "|", "symbol": "#$%&*@^~=+<>{}[]\\/_", "quote": "\"'()-", "space": " \t\r\x0b\x0c",
}.items()} | {"high": np.arange(256) >= 128}


def line_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) bytes of the non-empty lines, and the index of each document's first line (one more at the end)."""
    full = data != 10
    before, after = np.r_[False, full[:-1]], np.r_[full[1:], False]
    inner = off[(off > 0) & (off < len(data))]
    before[inner] = False
    after[inner - 1] = False
    start = np.flatnonzero(full & ~before)
    return start, np.flatnonzero(full & ~after) + 1, np.searchsorted(start, off)


def _shares(values: np.ndarray, size: np.ndarray, edges: list[float]) -> list[np.ndarray]:
    share = values / np.maximum(size, 1)
    return [share > e for e in edges]


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own features and both neighbours', line lengths, first line of each document) of a batch of texts."""
    data, off = bytes_of(col)
    start, end, first = line_spans(data, off)
    n, size = len(start), (end - start).astype(float)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    cols: list[np.ndarray] = []
    if n:
        count = {}
        for name, of in _CLASSES.items():
            run = np.r_[0, np.cumsum(of[data])]
            count[name] = run[end] - run[start]
        ws, we, wfirst = word_spans(data, np.r_[off])
        word = np.r_[0, np.cumsum(np.bincount(ws, minlength=len(data) + 1)[: len(data)] > 0)]
        words = np.maximum(word[end] - word[start], 0)
        letters = count["upper"] + count["lower"] + count["high"]
        cols += _shares(count["upper"], letters, [0.1, 0.3, 0.6])
        cols += _shares(count["digit"], size, [0.02, 0.2]) + _shares(count["symbol"], size, [0.01, 0.05, 0.15])
        cols += _shares(count["mark"], np.maximum(words, 1), [0.2, 0.5]) + _shares(count["bar"], np.maximum(words, 1), [0.1, 0.3])
        cols += _shares(count["stop"], np.maximum(words, 1), [0.02, 0.1, 0.3]) + _shares(letters, size, [0.5, 0.7, 0.8])
        cols += [words <= 1, words <= 3, words <= 8, words > 30, words > 100, size / np.maximum(words, 1) > 9, size / np.maximum(words, 1) > 13]
        # repeats: of the line within the document, and of a word next to itself or within its line
        def again(h: np.ndarray, of: np.ndarray) -> np.ndarray:
            order = np.lexsort((h, of))
            same = (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1])
            out = np.zeros(len(h), bool)
            out[order[1:][same]] = True
            return out

        lines = word_hashes(data, start, end)
        twice = again(lines, doc)
        h = word_hashes(data, ws, we)
        line = np.searchsorted(start, ws, side="right") - 1
        near = np.r_[False, (h[1:] == h[:-1]) & (line[1:] == line[:-1])]
        cols += [twice] + _shares(np.bincount(line, near, n), words, [0.05, 0.2]) + _shares(np.bincount(line, again(h, line), n), words, [0.1, 0.25, 0.5])
        lone = np.diff(first)[doc] == 1
        cols += [lone, np.r_[True, doc[1:] != doc[:-1]], np.r_[doc[1:] != doc[:-1], True]]
    own = np.stack(cols, 1).astype(np.float32) if n else np.zeros((0, 0), np.float32)
    if not n:
        return own, size, first
    # the two lines before and after, zero beyond the document
    parts = [own]
    for step in (1, 2):
        prev, nxt = np.zeros_like(own), np.zeros_like(own)
        if n > step:
            same = (doc[step:] == doc[:-step])[:, None]
            prev[step:], nxt[:-step] = own[:-step] * same, own[step:] * same
        parts += [prev, nxt]
    return np.concatenate([*parts, np.ones((n, 1), np.float32)], 1), size, first


def forward_backward(node: np.ndarray, first: np.ndarray, trans: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of (good) per line, summed pair marginals (2, 2), and log partition per document.

    node: (lines, 2) scores; all chains go forward together, longest first, so the work is in proportion to the lines.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    size, at = size[order], first[:-1][order]
    live = np.searchsorted(-size, -np.arange(1, size.max(initial=0) + 1), side="right")  # chains of at least t+1 lines
    a, b = np.zeros_like(node), np.zeros_like(node)
    lse = lambda x, axis: np.logaddexp.reduce(x, axis)
    for t, m in enumerate(live):
        i = at[:m] + t
        a[i] = node[i] + (begin if t == 0 else lse(a[i - 1][:, :, None] + trans[None], 1))
    for t in range(len(live) - 2, -1, -1):
        m = live[t + 1]
        i = at[:m] + t
        b[i] = lse(trans[None] + (node[i + 1] + b[i + 1])[:, None, :], 2)
    z = np.zeros(len(size))
    some = size > 0
    z[some] = lse(a[at[some] + size[some] - 1], 1)
    by_line = np.zeros(len(node))
    by_line[np.concatenate([np.arange(s, s + n) for s, n in zip(at, size)]).astype(int) if len(node) else []] = np.repeat(z, size)
    marg = np.exp(a + b - by_line[:, None])
    pairs = np.zeros((2, 2))
    inner = np.ones(len(node), bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    j = np.flatnonzero(inner)
    if len(j):
        pairs = np.exp(a[j - 1][:, :, None] + trans[None] + (node[j] + b[j])[:, None, :] - by_line[j][:, None, None]).sum(0)
    back = np.zeros(len(size))
    back[order] = z
    return marg[:, 1], pairs, back


@dataclass
class LineCRF:
    weight: np.ndarray  # (features, 2)
    trans: np.ndarray
    begin: np.ndarray
    curve: np.ndarray  # of the logistic: slope, constant, for texts without lines

    def shares(self, x: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of good of each document; 0.5 without lines."""
        out = np.full(len(first) - 1, 0.5)
        if len(size):
            good, _, _ = forward_backward((x @ self.weight).astype(float), first, self.trans, self.begin)
            some = np.diff(first) > 0
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            out[some] = (np.bincount(doc, good * size, len(out)) / np.maximum(np.bincount(doc, size, len(out)), 1))[some]
        return out

    def scores(self, x: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        share = self.shares(x, size, first)
        s = sigmoid(self.curve[0] * share + self.curve[1])
        return np.where(np.diff(first) > 0, s, self.curve[2])


def fit(sample: list[tuple[str, int]], epochs: int = 40, seed: int = 3) -> LineCRF | None:
    """Train on (text, 0/1) pairs; None for an empty sample or one of a single label."""
    labels = np.array([y for _, y in sample], int)
    if not len(labels) or labels.min() == labels.max():
        return None
    x, size, first = features(pa.array([t for t, _ in sample], pa.large_string()))
    n = np.diff(first)
    p = {"w": np.zeros((x.shape[1], 2)), "t": np.zeros((2, 2)), "s": np.zeros(2)}
    opt = Adam(p, 0.05)
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        opt.rate = 0.05 * (1 - epoch / epochs) + 0.002
        order = rng.permutation(np.flatnonzero(n > 0))
        for c in range(0, len(order), 500):
            docs = order[c : c + 500]
            rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            f = np.r_[0, np.cumsum(n[docs])]
            y = np.repeat(labels[docs], n[docs])
            good, pairs, _ = forward_backward((x[rows] @ p["w"]).astype(float), f, p["t"], p["s"])
            g = (good - y) / len(rows)
            seen = np.zeros((2, 2))
            start = np.zeros(2)
            for label in (0, 1):
                own = labels[docs] == label
                seen[label, label] = (n[docs] - 1)[own].sum()
                start[label] = own.sum() - np.where(label, good[f[:-1]], 1 - good[f[:-1]]).sum()
            gw = x[rows].T @ g
            opt.step({"w": np.stack([-gw, gw], 1) + 1e-4 * p["w"], "t": (pairs - seen) / len(rows) + 1e-3 * p["t"], "s": -start / len(rows)})
    model = LineCRF(p["w"], p["t"], p["s"], np.array([8.0, -4.0, labels.mean()]))
    share = model.shares(x, size, first)
    _calibrate(model, share[n > 0], labels[n > 0])
    return model


def _calibrate(model: LineCRF, share: np.ndarray, y: np.ndarray) -> None:
    """Slope and constant of the logistic curve, by Newton's method; both labels weigh alike, and 0.7 is the even point."""
    w = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum())) * len(y)
    d, beta = np.stack([share, np.ones_like(share)], 1), np.zeros(2)
    for _ in range(50):
        q = sigmoid(d @ beta)
        h = (d * (w * q * (1 - q))[:, None]).T @ d + 1e-2 * np.eye(2)
        beta += np.linalg.solve(h, d.T @ (w * (y - q)) - 1e-2 * beta)
    model.curve[0], model.curve[1] = beta[0], beta[1] + np.log(CUT / (1 - CUT))


def _scores(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: LineCRF | None = shared.value
        for b in small_batches(batches):
            found = np.full(b.num_rows, 0.5) if model is None else model.scores(*features(b.column(b.schema.get_field_index("text"))))
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(found, pa.float64())], ["doc_id", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, rows: int = 4000) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Learns from at most ``rows`` labelled documents outside the held-out bucket. Null and empty texts get the labels'
    mean (0.5 without labels); repeated rows are scored alike; a null id has a null held_out. Extra columns are ignored.
    """
    model = fit(labelled_sample(docs, labels, "quality", BUCKETS, HELD, rows))
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")
    return out.select("doc_id", (bucket("doc_id", BUCKETS) == HELD).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op7_quality(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
