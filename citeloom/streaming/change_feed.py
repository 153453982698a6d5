"""The change feed as a stream: each micro-batch of hashed works is one release of the history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeloom.operators import changes


def upserts_only(history: DataFrame, works: DataFrame, release: str) -> DataFrame:
    """A batch is a part of the works: what it leaves out is not missing, so nothing is deleted."""
    return changes.changes(history, works, release).where("state = 'UPSERT'")


def start(works: DataFrame, folder: str, checkpoint: str, day: Callable[[int], str], most: int = 3, complete: bool = False, **trigger) -> StreamingQuery:
    """Write a history version per micro-batch of ``works`` (streaming: doi, hash) under ``folder``/batch=N.

    A batch that is run again overwrites its own version and reads the one before, so a restart changes nothing.
    ``complete``: each batch holds all works, and missing ones are deleted.
    """

    def version(spark: SparkSession, batch: int) -> DataFrame:
        path = f"{folder}/batch={batch}"
        fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        if batch < 0 or not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
            return changes.no_states(spark)
        return spark.read.schema(changes.STATE).parquet(path)

    def step(batch: DataFrame, number: int) -> None:
        history = version(batch.sparkSession, number - 1)
        diff = (changes.changes if complete else upserts_only)(history, batch, day(number))
        changes.trimmed(history.unionByName(diff), most).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return works.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def latest_events(events: DataFrame, key: str, time: str, late: str = "10 minutes") -> DataFrame:
    """Events once each under a watermark: repeats within ``late`` are dropped with bounded state."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    counted = events.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("start"), kind, "n")
