"""Token ids as ORC: integer run-length encoded id lists, row indexes, and Bloom filters on document ids.

Documents are range-partitioned by id before they are encoded, so each file holds one id range in order, and a reader
can skip files and stripes by their statistics or Bloom filters and read stripes in parallel. A row keeps its document's
start within its file; the starts of the files themselves come from one sum per file.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.textops import shared_dir, small_batches
from citeloom.llm.tokens import END_ID, PieceEncoder, tokenizer_path

SCHEMA = "doc_id long, ids array<int>, n_tokens long, part long, start_in_part long"
ORC_OPTIONS = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20), "compression": "zstd"}


def _encode(path: str) -> Callable:
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, at = PieceEncoder.get_one(path), TaskContext.get().partitionId(), 0
        for b in small_batches(batches):
            ids, off = coder.encode_column(b.column(b.schema.get_field_index("text")), end)
            n = np.diff(off)
            ids = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), ids, pa.array(n), pa.array(np.full(len(n), part, np.int64)), pa.array(at + off[:-1])], ["doc_id", "ids", "n_tokens", "part", "start_in_part"])
            at += int(off[-1])

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, partitions: int | None = None) -> None:
    """Encode every text of ``docs`` (null: empty), end it with id 0, and write ORC files under ``path`` in ascending doc_id order.

    Null ids come first; rows of equal id stay next to each other, in the order of their texts' hashes. Extra columns are not written.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Spark samples the sort keys to the driver: a hash stands for the text there, and splits an id with very many rows
    docs = docs.withColumn("_h", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_h").asc()]
    ordered = docs.repartitionByRange(n, *order).sortWithinPartitions(*order, "text").drop("_h")
    writer = ordered.mapInArrow(_encode(tokenizer or tokenizer_path()), SCHEMA).write
    for k, v in ORC_OPTIONS.items():
        writer = writer.option(k, v)
    writer.orc(path)


def read_token_files(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids. A filter on doc_id prunes stripes."""
    rows = spark.read.schema(SCHEMA).orc(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))  # a row per file
    before = sums.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    # a row per file, as many as the writer had partitions: broadcasting keeps the id lists where they are
    return rows.join(F.broadcast(before), "part").select("doc_id", (F.col("start_in_part") + F.col("_before")).alias("start"), "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column(b.schema.get_field_index("ids"))
        off = col.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(col.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
        crc = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(off[:-1].tolist(), off[1:].tolist())]
        yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in ("doc_id", "start", "n_tokens")] + [pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def with_checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows from ``read_token_files``."""
    return rows.mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "tokens")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return with_checksums(read_token_files(spark, path))
