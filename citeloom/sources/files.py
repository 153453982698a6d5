"""Readers and writers of raw and result files. Every reader takes its schema; nothing is inferred in production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_corrupt"


def json_lines(spark: SparkSession, paths: str | list[str], schema: str | T.StructType, spread: int | None = None) -> DataFrame:
    """JSON objects, one a line, plain or gzip. Blank and unreadable lines are skipped.

    ``spread`` deals the rows out anew: a gzip file is one task, however large.
    """
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    with_bad = T.StructType([*kind.fields, T.StructField(BAD, T.StringType())])
    # the parse is kept whole: a filter on the marker alone would let Spark read no other column
    rows = spark.read.text(paths).where("trim(value) <> ''").select(F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("r"))
    rows = rows.where(F.col("r").isNotNull() & F.col(f"r.{BAD}").isNull()).select("r.*").drop(BAD)
    return rows.repartition(spread) if spread else rows


def json_documents(spark: SparkSession, paths: str | list[str], schema: str | T.StructType) -> DataFrame:
    """Files that hold one JSON array or object each."""
    return spark.read.schema(schema).option("multiLine", True).json(paths)


def parquet(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files, globs or folders; ``columns`` prunes the scan."""
    paths = [paths] if isinstance(paths, str) else paths
    df = (spark.read.schema(schema) if schema else spark.read).parquet(*paths)
    return df.select(*columns) if columns else df


def csv_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, rows_per_file: int = 0, row_group: int = 128 << 20) -> None:
    """Snappy Parquet, files of at most ``rows_per_file`` rows (0: no bound)."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("parquet.block.size", row_group).option("compression", "snappy").parquet(path)


def write_json_lines(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Gzip JSON lines. An empty table still leaves a file."""
    out = df.coalesce(1) if df.isEmpty() else df
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("compression", "gzip").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def sorted_json(*columns: str):
    """A JSON object with its keys in order, as the result tables store it."""
    return F.to_json(F.struct(*sorted(columns)))


def jdbc_query(spark: SparkSession, url: str, query: str, column: str | None = None, bounds: tuple[int, int] = (0, 1), parts: int = 1, **options: str) -> DataFrame:
    """Rows of a database query; with ``column`` in ``parts`` ranges between ``bounds``, read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", 10_000).options(**options)
    if not column:
        return reader.option("query", query).load()
    return reader.option("dbtable", f"({query}) q").option("partitionColumn", column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts).load()
