"""Vectorised word and window hashing over Arrow string batches, and small Spark helpers.

Words are hashed straight from the UTF-8 buffer of an Arrow column, so no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from citeloom.operators.stages import materialise, shared_dir, written  # noqa: F401

U = np.uint64
#: ASCII white space: the word separators of ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=U)
_P = U(0x9E3779B97F4A7C15 | 1)


#: What this worker process keeps from one task to the next.
KEPT: dict[object, object] = {}
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """From now on this session's Arrow batches end at ``limit`` bytes (or one row, if that is longer), not at 10,000 rows.

    An executor holds a batch several times, in the JVM and in the worker, for each of its cores. A lower setting stays.
    """
    now = spark.conf.get(_BATCH)
    if not re.fullmatch(r"\d+b?", now) or int(now.removesuffix("b")) > limit:
        spark.conf.set(_BATCH, str(limit))


def release() -> None:
    """Give freed memory back to the system, which Arrow's pool and the C library would hold for this worker's next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)


def _drop_kept() -> None:
    if KEPT:
        KEPT.clear()
        release()


def lean(run: Callable) -> Callable:
    """``run`` (batches to batches) as a task that leaves the executor its memory: what tasks of other operators keep in
    the worker is dropped before it, and what it has freed itself is released after it."""

    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _drop_kept()
        yield from run(batches)
        release()

    return lean_run


class Scratch:
    """Tables in the shared folder that cut lineage. ``drop`` removes those that no later step reads."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        out, self.paths[name] = written(df, name)
        return out

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as make it no column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes of ``column`` (or one row, if that is longer)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if batch.num_rows == 0:
            continue
        off = offsets_of(col)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
            yield batch.slice(at, min(to, batch.num_rows) - at)
            at = min(to, batch.num_rows)


def offsets_of(col: pa.Array) -> np.ndarray:
    """Byte offsets of a string column's values; a null spans no bytes of its own."""
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if len(col) == 0 or col.buffers()[1] is None:
        return np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(col.buffers()[1], kind, len(col) + 1, col.offset * kind().itemsize).astype(np.int64)


def bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string column; nulls become empty."""
    if col.null_count:
        col = col.fill_null("")
    off = offsets_of(col)
    buf = col.buffers()[2] if len(col) else None
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    data = data[off[0] : off[-1]]
    return data, off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) bytes of each word, and for each document the index of its first word (one more entry at the end)."""
    full = ~SPACE[data]
    before = np.zeros_like(full)
    before[1:] = full[:-1]
    after = np.zeros_like(full)
    after[:-1] = full[1:]
    inner = off[(off > 0) & (off < len(data))]
    before[inner] = False
    after[inner - 1] = False
    start = np.flatnonzero(full & ~before)
    end = np.flatnonzero(full & ~after) + 1
    return start, end, np.searchsorted(start, off)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0xA0761D6478BD642F)
    return h ^ (h >> U(32))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes at a time."""
    h = mix((end - start).astype(U) + U(seed * 0x51ED27 + 0x1B873593))
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    view = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    at, left, who = start, end - start, None
    while len(at):
        block = view[at] & _MASKS[np.minimum(left, 8)]
        if who is None:
            h = mix(h ^ block)
        else:
            h[who] = mix(h[who] ^ block)
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        who = more if who is None else who[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def run_hashes(h: np.ndarray, k: int, p: U = _P) -> np.ndarray:
    """Polynomial hash of every ``k`` consecutive values, by doubling (len - k + 1 values)."""
    if len(h) < k:
        return np.zeros(0, U)
    out, width, power = None, 0, U(1)
    level, size, pw = h, 1, p
    rest = k
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                # what is built so far covers the last `width` values; put this level before it
                out = level.copy() if out is None else level[: len(level) - width] * power + out[size:][: len(level) - width]
                width, power = width + size, power * pw
            rest >>= 1
            if rest:
                level = level[: len(level) - size] * pw + level[size:]
                size, pw = size * 2, pw * pw
    return out[: len(h) - k + 1]


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    size, level = 1, h
    while size * 2 <= w:
        level = np.minimum(level[: len(level) - size], level[size:])
        size *= 2
    n = len(h) - w + 1
    return np.minimum(level[:n], level[w - size :][:n]) if n > 0 else h[:0]


def windows_in(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, document index) of each window of ``k`` words that lies within one document."""
    n = np.diff(first)
    count = np.maximum(n - k + 1, 0)
    doc = np.repeat(np.arange(len(n)), count)
    base = np.cumsum(count) - count
    return np.arange(count.sum()) - base[doc] + first[:-1][doc], doc
