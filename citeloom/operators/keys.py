"""One row per key, and counts per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key. Spark limits each partition's groups before the shuffle, so hot keys stay small."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest(df: DataFrame, key: str, time: str, *ties: str) -> DataFrame:
    """The row of each key with the latest time (nulls last); ``ties`` decide among equals."""
    return first_n(df, [key], [F.desc_nulls_last(time), *[F.asc_nulls_last(t) for t in ties]])


def richest(df: DataFrame, key: str, texts: list[str], *ties: str) -> DataFrame:
    """The row of each key whose texts, compared in turn, are longest (nulls last)."""
    return first_n(df, [key], [*[F.length(t).desc_nulls_last() for t in texts], *[F.asc_nulls_last(t) for t in ties]])


def with_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows with the number of rows of their key. A count joined back, not a window: it combines before the shuffle."""
    return df.join(df.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key, "left")


def latest_of(key: str, time: str, *sources: DataFrame) -> DataFrame:
    """The latest non-null time of each key over several tables."""
    parts = [s.select(key, time).where(F.col(time).isNotNull() & F.col(key).isNotNull()) for s in sources]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy(key).agg(F.max(time).alias(time))
