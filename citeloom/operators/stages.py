"""Tables in the shared folder that cut lineage: what several steps read is made once."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Shuffle files of a finished write are removed at once, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir (or the context's checkpoint folder).

    Where neither is set, a local master gets one in /tmp, as in tests; a cluster raises, as its machines share no /tmp.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set, and {master} needs a shared folder")
        base = "file:///tmp/checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a Parquet table in the shared folder, which the caller's result goes on reading."""
    return written(df, name)[0]
