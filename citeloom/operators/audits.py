"""Data-quality checks: each gives (audit, column, failures); one pass counts all row-wise ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.operators.keys import first_n


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    fails: Column
    blocking: bool = True


def not_empty(column: str, blocking: bool = False) -> Check:
    return Check("not_empty_string", column, F.col(column) == "", blocking)


def accepted(column: str, values: list[str], blocking: bool = True) -> Check:
    return Check("accepted_values", column, ~F.col(column).isin(values), blocking)


def not_longer(column: str, most: int, blocking: bool = True) -> Check:
    return Check("max_array_length", column, F.size(column) > most, blocking)


def run(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Failing rows of every row-wise check, from a single scan."""
    counts = df.agg(*[F.count_if(c.fails).alias(f"_{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("audit"), F.lit(c.column).alias("column"), F.col(f"_{i}").alias("failures")) for i, c in enumerate(checks)])
    return counts.select(F.inline(rows))


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """unique_values: keys that occur more than once."""
    many = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return many.agg(F.count(F.lit(1)).alias("failures")).select(F.lit("unique_values").alias("audit"), F.lit(", ".join(columns)).alias("column"), "failures")


def fewer_rows(df: DataFrame, least: int) -> DataFrame:
    """number_of_rows: how many rows are missing to ``least``."""
    short = F.greatest(F.lit(0).cast("long"), F.lit(least).cast("long") - F.count(F.lit(1)))
    return df.agg(short.alias("failures")).select(F.lit("number_of_rows").alias("audit"), F.lit("*").alias("column"), "failures")


def enforce(df: DataFrame, checks: list[Check]) -> None:
    failed = {(r["audit"], r["column"]): r["failures"] for r in run(df, checks).collect() if r["failures"]}  # a row per check
    bad = {(c.name, c.column): failed[c.name, c.column] for c in checks if c.blocking and (c.name, c.column) in failed}
    if bad:
        raise ValueError(f"audits failed: {bad}")


def error_summary(errors: DataFrame, kind: str, sample: str, most: int = 5) -> DataFrame:
    """Per kind of error its number and the first ``most`` distinct samples; samples are limited before they are gathered."""
    total = errors.groupBy(kind).agg(F.count(F.lit(1)).alias("errors"))
    some = first_n(errors.where(F.col(sample).isNotNull()).select(kind, sample).distinct(), [kind], [F.asc(sample)], most)
    return total.join(some.groupBy(kind).agg(F.array_sort(F.collect_list(sample)).alias("samples")), kind, "left")


def step_statistics(steps: DataFrame, seconds: str, *by: str) -> DataFrame:
    """Number, mean and sample deviation of step times."""
    return steps.groupBy(*by).agg(F.count(seconds).alias("steps"), F.avg(seconds).alias("mean"), F.stddev_samp(seconds).alias("stdev"))
