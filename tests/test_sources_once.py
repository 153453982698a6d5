"""What larger tables need of the raw records: one parse a row, one look at a DOI, every source parsed once."""

from pyspark.sql import functions as F

from citeloom import queries
from citeloom.functions.identifiers import WHITE, doi_in, has_doi, stripped
from citeloom.sources import records

D = "/root/testdata/sf0.001"


def _parses(df, schema_word: str) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count(f"from_json(StructField({schema_word}")


def test_record_is_parsed_once_or_twice(spark):
    """A filter on a field of the record had it parsed again, a dozen times a row."""
    assert _parses(records.openalex(queries._orders_raw(spark, D, queries._OPENALEX, records.OPENALEX)), "id") == 1
    assert _parses(records.datacite(queries._orders_raw(spark, D, queries._DATACITE, records.DATACITE)), "id") <= 2
    assert _parses(records.crossref(queries._orders_raw(spark, D, queries._CROSSREF, records.CROSSREF)), "DOI") <= 2


def test_indexes_read_written_sources(spark):
    for name in ("datacite_index", "openalex_index"):
        assert _parses(queries.QUERIES[name](spark, D), "id") == 0


def test_has_doi_and_stripped_as_before(spark):
    texts = [None, "", " ", "doi:10.1/AB c", "10.1/", "10.a/b", "x10.1.2/é y", " a b　\n", "​z", "a\x85", "᠎a", "10./ "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    for r in df.select("t", has_doi("t").alias("h"), doi_in("t").alias("d"), stripped("t").alias("s"), F.when(old != "", old).alias("o")).collect():
        assert bool(r["h"]) == (r["d"] is not None) and r["s"] == r["o"], r
    every = spark.range(1, 0xD800).select(F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c")).where(r"c rlike '(?U)^\\s$'")
    assert sorted(r["c"] for r in every.collect()) == sorted(WHITE)
