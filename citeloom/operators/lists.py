"""Lists built per key: in their first order, or distinct and sorted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_lookup(df: DataFrame, key: str, array: str, on: str, lookup: DataFrame, lookup_key: str, item: list[Column], name: str) -> DataFrame:
    """Each key's array with every element looked up, in the array's order.

    ``item`` sees the element as ``e`` and the lookup's columns. An identifier with several matches gives several items;
    keys with a null or empty array have no row. AQE broadcasts the lookup where it is small.
    """
    each = df.select(F.col(key), F.posexplode(array).alias("_at", "e"))
    found = each.join(lookup, F.col(f"e.{on}") == F.col(lookup_key), "left")
    packed = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_at", F.struct(*item).alias("item")))).alias("_l"))
    return packed.select(key, F.transform("_l", lambda x: x["item"]).alias(name))


def distinct_list(key: str, value: str, name: str, field: str, *sources: DataFrame) -> DataFrame:
    """Per key the distinct non-null values of several (key, value) tables as structs, by lower case, then as written."""
    rows = sources[0].select(key, value)
    for s in sources[1:]:
        rows = rows.unionByName(s.select(key, value))
    rows = rows.where(F.col(value).isNotNull()).distinct()
    packed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.lower(value).alias("low"), F.col(value).alias("v")))).alias("_l"))
    return packed.select(key, F.transform("_l", lambda x: F.struct(x["v"].alias(field))).alias(name))


def as_structs(array: str | Column, field: str) -> Column:
    return F.transform(array, lambda x: F.struct(x.alias(field)))
