"""Cost-balanced packing of documents into training sequences.

A sequence's cost is estimated as ``linear * tokens + quadratic * sum(piece length squared)``: matrix products grow with
the tokens, attention with each piece's square. A document's whole multiples of the sequence length become sequences
of their own; the rest are taken longest first, each to the cheapest open sequence with room. A rest that fits nowhere
is cut over the emptiest ones, so a group of documents leaves fewer than one sequence of padding in all.

Each task packs its own documents in groups of bounded size: nothing is shuffled, and a rerun task packs alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.textops import release, small_batches
from citeloom.llm.tokens import END_ID, PieceEncoder, tokenizer_path

#: Half of the pieces a worker may hold; packing shares its executor with what earlier stages have left in memory.
PIECES = 200_000
SCHEMA = "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def balance(sizes: list[int], limit: int, linear: float = 1.0, quadratic: float = 1.0 / 1024) -> list[tuple[int, int, int, int, int]]:
    """Pieces (item, start, length, sequence, offset) of items of the given sizes; sequences are numbered from 0."""
    pieces, rest, used = [], [], 0
    for i, n in enumerate(sizes):
        whole = n // limit
        pieces += [(i, j * limit, limit, used + j, 0) for j in range(whole)]
        used += whole
        if n % limit:
            rest.append((n % limit, i, whole * limit))
    count = -(-sum(r[0] for r in rest) // limit)
    room, cost = np.full(count, limit), np.zeros(count)
    for n, i, start in sorted(rest, key=lambda r: (-r[0], r[1])):
        while n:
            fits = np.flatnonzero(room >= n)
            to = int(fits[np.argmin(cost[fits])]) if len(fits) else int(np.argmax(room))
            size = min(n, int(room[to]))
            pieces.append((i, start, size, used + to, limit - int(room[to])))
            room[to] -= size
            cost[to] += linear * size + quadratic * size * size
            n, start = n - size, start + size
    return pieces


def _pack(path: str, limit: int, group: int) -> Callable:
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, at = PieceEncoder.get_one(path, PIECES), TaskContext.get().partitionId() << 36
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal at, size
            sizes = [len(x) // 4 for _, x in held]
            pieces = balance(sizes, limit)
            raw = [held[i][1][4 * s : 4 * (s + n)] for i, s, n, _, _ in pieces]
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([p[2] for p in pieces])].astype(np.int32)), pa.array(np.frombuffer(b"".join(raw), "<i4")))
            kind = lambda x: pa.array(x, pa.int64())
            out = pa.RecordBatch.from_arrays([
                kind([held[p[0]][0] for p in pieces]), kind([p[1] for p in pieces]), kind([p[2] for p in pieces]), ids, kind(list(map(zlib.crc32, raw))),
                kind([sizes[p[0]] for p in pieces]), kind([at + p[3] for p in pieces]), kind([p[4] for p in pieces]),
            ], ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            at += 1 + max(p[3] for p in pieces)
            held.clear()
            size = 0
            return out

        for b in small_batches(batches):
            ids, off = coder.encode_column(b.column(b.schema.get_field_index("text")), end)
            for i, s, to in zip(b.column(b.schema.get_field_index("doc_id")).to_pylist(), off[:-1].tolist(), off[1:].tolist()):
                held.append((i, ids[s:to].tobytes()))
                size += to - s
                if size >= group:
                    yield flush()
        if held:
            yield flush()
        release()

    return run


def pack(docs: DataFrame, limit: int = 1024, tokenizer: str | None = None, group: int = 1 << 20) -> DataFrame:
    """Pieces of all ``docs`` in sequences of at most ``limit`` ids; each id, the end id 0 included, lies in one piece.

    doc_id, start (ids of the document before the piece), length, ids, ids_crc32, doc_tokens, sequence_id, offset
    (gapless from 0). ``group`` is the number of ids packed together. A null text counts as empty: its end id alone.
    Rows of equal or null id are documents of their own. Extra columns are ignored; an empty table gives no pieces.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pack(tokenizer or tokenizer_path(), limit, group), SCHEMA)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("ids")
