"""Exact top-k by inner product: a Voronoi kNN join.

Data vectors fall into the cells of their nearest pivots. A cell's summary (pivot, radius) bounds the inner product of a
query with all its members: ``q.x <= q.p + |q| * radius``. Each query is solved in its own cell first; its k-th score
there then rules out the cells whose bound is lower, and only the rest get the query. Cells are dealt into chunks and
queries into blocks of bounded size, so one task never holds a large cell (such as copies of one vector) whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.textops import materialise

SCALE = 1024
CHUNK = 4096


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond 64 bits they stay at the limit."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    most = float(np.abs(q.astype(float)).max()) * float(np.abs(x.astype(float)).max()) * q.shape[1]
    if most < 2**53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    if most < 2**62:
        return q @ x.T
    limit = 2**63 - 1
    return np.array([[max(-limit - 1, min(limit, int(s))) for s in row] for row in q.astype(object) @ x.astype(object).T], np.int64)


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v: floor(scale * component). Rows with a null id or vector, or a null or non-finite component, are left out."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long"), x.alias("embedding")).where("vec_id is not null and embedding is not null").where(sound).select("vec_id", F.transform("embedding", lambda c: F.floor(c * scale)).alias("v"))


def least_copies(data: DataFrame, k: int) -> DataFrame:
    """Of rows with equal vectors those that can be among a query's ``k`` best: the k + 1 smallest ids, one of which may be
    the query's own, and k rows of each. The rest tie with k kept rows of smaller or equal id. Spark limits each
    partition's copies before the shuffle.
    """
    ids = data.withColumn("_id", F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("_id") <= k + 1)
    rows = ids.withColumn("_row", F.row_number().over(Window.partitionBy("v", "vec_id").orderBy("_id"))).where(F.col("_row") <= k)
    return rows.select("vec_id", "v")


def _assign(pivots: np.ndarray, width: int):
    square = (pivots**2).sum(1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = _matrix(f["v"], width).astype(float)
            cell = (square - 2 * x @ pivots.T).argmin(1) if len(f) else np.zeros(0, np.int64)
            far = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
            yield f.assign(cell=cell.astype(np.int32), far=far)

    return run


def _solve(k: int, width: int):
    def run(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
        if not len(q) or not len(x):
            return out
        x = x.sort_values("vec_id", kind="stable")
        ids = x["vec_id"].to_numpy()
        score = _products(_matrix(q["v"], width), _matrix(x["v"], width))
        parts = []
        for i, own in enumerate(q["query_id"].to_numpy()):
            s = score[i]
            other = np.flatnonzero(ids != own)
            if len(other) > k:  # the k highest and all that tie with the last of them, then by id
                least = np.partition(s[other], len(other) - k)[len(other) - k]
                other = other[s[other] >= least]
            best = other[np.argsort(-s[other], kind="stable")][:k]
            parts.append(pd.DataFrame({"query_id": own, "vec_id": ids[best], "score": s[best]}))
        return pd.concat([out, *parts])

    return run


def _needed(pivots: np.ndarray, radius: np.ndarray, width: int):
    """Cells other than its own that may hold a better vector for a query than its k-th so far."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # ids alone, for a thousand queries at once: with its vector in each of its cells' rows a batch outgrew the worker
        for f in (frame[at : at + 1024] for frame in frames for at in range(0, len(frame), 1024)):
            q = _matrix(f["v"], width).astype(float)
            bound = q @ pivots.T + np.sqrt((q**2).sum(1))[:, None] * radius[None, :]
            bound += 1e-9 * (np.abs(bound) + np.sqrt((q**2).sum(1))[:, None] * np.sqrt((pivots**2).sum(1))) + 1
            least = f["least"].fillna(-np.inf).to_numpy(float)
            take = (bound >= least[:, None]) & (radius >= 0)[None, :]
            take[np.arange(len(f)), f["cell"].to_numpy()] = False
            i, c = np.nonzero(take)
            yield pd.DataFrame({"query_id": f["query_id"].to_numpy()[i], "cell": c.astype(np.int32)})

    return run


def _join(asked: DataFrame, data: DataFrame, k: int, width: int) -> DataFrame:
    """asked: query_id, v, qblock, cell. The best k of each asked cell's chunk, per query."""
    pairs = asked.select("cell", "qblock").distinct()
    near = data.join(pairs, "cell").select("cell", "chunk", "qblock", "vec_id", "v")
    chunks = near.select("cell", "chunk", "qblock").distinct()
    far = asked.join(chunks, ["cell", "qblock"]).select("cell", "chunk", "qblock", "query_id", "v")
    far, near = far.toDF("c1", "k1", "b1", "query_id", "v"), near.toDF("c2", "k2", "b2", "vec_id", "v")
    solve = _solve(k, width)
    return far.groupBy("c1", "k1", "b1").cogroup(near.groupBy("c2", "k2", "b2")).applyInPandas(lambda q, x: solve(q, x), "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "_copy")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = 128, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of each query with every row of another id.

    ``vectors`` and ``queries`` have vec_id and embedding; components become floor(scale * component). Ties go to the
    smaller id. Shorter vectors count as padded with zeros. Rows of repeated ids are candidates each; a query's id is
    asked once. At most ``pivots`` pivots are taken, by a hash of their ids. Without sound vectors the result is empty.
    """
    data = quantised(vectors, scale)
    some = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).toPandas()
    width = data.agg(F.max(F.size("v"))).first()[0] or 0
    spark = vectors.sparkSession
    if not len(some):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centre = np.unique(_matrix(some["v"], width), axis=0).astype(float)
    kinds = "vec_id long, v array<long>, cell int, far double"
    cells = materialise(least_copies(data, k).mapInPandas(_assign(centre, width), kinds), "cells")
    summary = cells.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n"))  # a row per pivot
    radius = np.full(len(centre), -1.0)
    for r in summary.collect():
        radius[r["cell"]] = r["far"]
    chunk = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.ceil(F.col("n") / CHUNK)).cast("int")
    dealt = materialise(cells.join(F.broadcast(summary.select("cell", "n")), "cell").select("cell", chunk.alias("chunk"), "vec_id", "v"), "chunks")

    asked = quantised(queries, scale).dropDuplicates(["vec_id"])
    blocks = max(1, -(-asked.count() // CHUNK))
    asked = asked.mapInPandas(_assign(centre, width), kinds).select(F.col("vec_id").alias("query_id"), "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("qblock"), "cell")
    asked = materialise(asked, "queries")
    first = materialise(_join(asked, dealt, k, width), "own-cell")
    tagged = first.withColumn("_copy", F.monotonically_increasing_id())
    least = _best(tagged, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    further = asked.join(least, "query_id", "left").mapInPandas(_needed(centre, radius, width), "query_id long, cell int")
    more = _join(materialise(further, "asked").join(asked.drop("cell"), "query_id"), dealt, k, width)
    out = _best(first.unionByName(more).withColumn("_copy", F.monotonically_increasing_id()), k)
    return out.select("query_id", "rank", "vec_id", "score")


def op10_exact_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


OP10_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM (SELECT * FROM e WHERE vec_id % 100 = 0) q JOIN e c ON c.vec_id <> q.vec_id
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s)
WHERE r <= 10
"""
