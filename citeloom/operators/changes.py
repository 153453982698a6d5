"""Change tracking: what a release upserts and deletes, the history it leaves, and its application to an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.operators.keys import first_n

STATE = T.StructType([T.StructField("doi", T.StringType()), T.StructField("hash", T.StringType()), T.StructField("state", T.StringType()), T.StructField("updated_date", T.DateType())])


def no_states(spark) -> DataFrame:
    """The history before the first release."""
    return spark.createDataFrame([], STATE)


def _newest_first():
    # a release that runs twice on a day meets its own rows: the order of the rest makes the result certain
    return [F.desc_nulls_last("updated_date"), F.asc("state"), F.asc("hash")]


def changes(history: DataFrame, works: DataFrame, release: str) -> DataFrame:
    """The release's rows: UPSERT for new, changed and returned works, DELETE for missing ones.

    history: doi, hash, state, updated_date. works: doi, hash. Both sides meet in one full outer join on doi.
    """
    now = works.select("doi", F.col("hash").alias("_now")).distinct()
    last = first_n(history, ["doi"], _newest_first()).select("doi", "hash", "state", F.lit(True).alias("_known"))
    both = now.withColumn("_here", F.lit(True)).join(last, "doi", "full_outer")
    upsert = F.col("_here").isNotNull() & (F.col("_known").isNull() | (F.col("hash") != F.col("_now")) | (F.col("state") == "DELETE"))
    delete = F.col("_here").isNull() & (F.col("state") == "UPSERT")
    state = F.when(upsert, "UPSERT").when(delete, "DELETE")
    rows = both.select("doi", F.when(upsert, F.col("_now")).otherwise(F.col("hash")).alias("hash"), state.alias("state"), F.lit(release).cast("date").alias("updated_date"))
    return rows.where("state IS NOT NULL")


def trimmed(history: DataFrame, most: int = 3) -> DataFrame:
    """The last ``most`` states of each doi."""
    return first_n(history, ["doi"], _newest_first(), most)


def next_history(history: DataFrame, works: DataFrame, release: str, most: int = 3) -> DataFrame:
    return trimmed(history.select("doi", "hash", "state", "updated_date").unionByName(changes(history, works, release)), most)


def of_release(history: DataFrame, state: str, release: str) -> DataFrame:
    return history.where((F.col("state") == state) & (F.col("updated_date") == F.lit(release).cast("date")))


def release_export(history: DataFrame, release: str, *indexes: DataFrame) -> DataFrame:
    """The index rows, by column name, of the dois that the release upserts, with their hash."""
    wanted = of_release(history, "UPSERT", release).select("doi", "hash")
    parts = [i.join(wanted, "doi") for i in indexes]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows


def applied(index: DataFrame, upserts: DataFrame, deletes: DataFrame, key: str = "doi") -> DataFrame:
    """The index after its rows were replaced or added by ``upserts`` and then ``deletes`` removed: a keyed merge."""
    kept = index.join(upserts.select(key), key, "left_anti").unionByName(upserts, allowMissingColumns=True)
    return kept.join(deletes.select(key), key, "left_anti")


def inserted(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-ignore on a unique key: of equal new rows one is taken, rows already there stay."""
    new = rows.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti")
    return table.unionByName(new, allowMissingColumns=True)
