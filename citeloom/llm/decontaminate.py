"""Benchmark decontamination with a broadcast hash set of the benchmark's word windows.

The windows of the items form a hash table held in one array column: bucket b holds the windows whose hash is b modulo
the number of buckets, or null. Each document looks its own windows up in it within the row, so documents are neither
exploded nor shuffled; a window that meets a filled bucket is compared word by word. Everything is a DataFrame
expression. A table holds at most ``block`` windows of at most ``size`` words, and no item ids, so its size is bounded;
``most`` tables are looked up at a time, and between such passes the documents are written with their hits. Items are
joined to the few distinct lists of windows that documents hold.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.textops import Scratch, materialise

#: Between the words: what is neither a digit, a-z, nor beyond ASCII (after lower-casing).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for a text whose case was kept, and the words and gaps in turn.
PIECES = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[^0-9A-Za-z\x{80}-\x{10FFFF}]+"


def normal_words(text: str | Column) -> Column:
    """Words of the text with A-Z (only) in lower case; none for null."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # lower() is quick, and right for ASCII alone
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(low, GAP), "")


def _starts(words: Column, size: int | Column) -> Column:
    n = F.size(words) - F.lit(size) + 1
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """words array<string>, item string of each item's distinct windows; rows with a null id or text have none."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), normal_words("text").alias("w")).where("item is not null and size(w) > 0")
    span = F.least(F.size("w"), F.lit(size))
    each = items.withColumn("span", span).select("item", "w", "span", F.explode(_starts(F.col("w"), F.col("span"))).alias("at"))
    return each.select(F.slice("w", F.col("at"), F.col("span")).alias("words"), "item").distinct()


def _table(windows: DataFrame, buckets: int, name: str) -> DataFrame:
    """One row: an array whose entry b+1 holds the windows of bucket b, or null."""
    full = windows.groupBy(F.pmod("hash", F.lit(buckets)).alias("b")).agg(F.collect_list("words").alias("held"))
    dense = windows.sparkSession.range(buckets).withColumnRenamed("id", "b").join(full, "b", "left")
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "held"))), lambda x: x["held"]).alias(name))


def find_hits(docs: DataFrame, windows: DataFrame, block: int = 200_000, most: int = 4) -> DataFrame:
    """The rows of ``docs`` (with a column text, none named _words, _hits, _set0, ...) with _words (normalised) and _hits.

    A hit is (at, span) of words, counted from 1, that are one of the ``windows`` (words array<string>).
    """
    step = Scratch(docs.sparkSession)
    windows = step.keep(windows.select("words").distinct().withColumn("hash", F.xxhash64("words")), "windows")
    counts = {r["span"]: r["n"] for r in windows.groupBy(F.size("words").alias("span")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a span
    count = sum(counts.values())
    tables = -(-count // block)
    docs = docs.withColumn("_words", normal_words("text")).withColumn("_hits", F.array().cast("array<struct<at:int,span:int>>"))
    for t in range(tables):
        if t and t % most == 0:
            docs = step.keep(docs, f"hits{t}")
        buckets = 1 << (16 * min(count, block) - 1).bit_length()
        part = windows.where(F.pmod(F.col("hash"), F.lit(tables)) == t)
        # about ``block`` windows of a few words each: a bounded broadcast
        one = F.broadcast(_table(part.withColumn("hash", F.shiftright("hash", 20)), buckets, f"_set{t}"))
        docs = docs.join(one)
        found = [_lookup(F.col(f"_set{t}"), buckets, span) for span in sorted(counts)]
        docs = docs.withColumn("_hits", F.concat("_hits", *found)).drop(f"_set{t}")
    return docs


def _lookup(table: Column, buckets: int, span: int) -> Column:
    """Hits of the windows of ``span`` words. (The lambdas take one argument: a second would be the index.)"""
    window = lambda at: F.slice("_words", at, span)
    bucket = lambda at: F.element_at(table, (F.pmod(F.shiftright(F.xxhash64(window(at)), 20), F.lit(buckets)) + 1).cast("int"))
    near = F.filter(_starts(F.col("_words"), span), lambda at: bucket(at).isNotNull())
    return F.transform(F.filter(near, lambda at: F.array_contains(bucket(at), window(at))), lambda at: F.struct(at.alias("at"), F.lit(span).alias("span")))


def _covered() -> Column:
    """The hit words as intervals (a, z) that neither touch nor overlap, in order; counted from 1."""
    each = F.array_sort(F.transform("_hits", lambda h: F.struct(h["at"].alias("a"), (h["at"] + h["span"] - 1).alias("z"))))
    last = lambda got: F.element_at(got, -1)
    joined = lambda got, x: F.concat(F.slice(got, 1, F.size(got) - 1), F.array(F.struct(last(got)["a"].alias("a"), F.greatest(last(got)["z"], x["z"]).alias("z"))))

    def add(got: Column, x: Column) -> Column:
        return F.when((F.size(got) > 0) & (F.try_element_at(got, F.lit(-1))["z"] >= x["a"] - 1), joined(got, x)).otherwise(F.concat(got, F.array(x)))

    return F.when(F.size("_hits") == 0, F.array().cast("array<struct<a:int,z:int>>")).otherwise(F.aggregate(each, F.array().cast("array<struct<a:int,z:int>>"), add))


def _dealt(out: DataFrame, found: DataFrame, most: int = 256, salts: int = 64) -> DataFrame:
    """``out`` (id, n_words, n_hit, held) with the items of ``found`` (held, items); a list held by many rows is dealt over ``salts`` tasks.

    Such lists have more than one in ``most`` of the rows, so there are fewer than ``most``, and their hashes are broadcast.
    """
    hash_, rows = F.xxhash64("held").alias("hash"), out.count()
    hot = F.broadcast(out.groupBy(hash_).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * most > rows).select("hash", F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "n_words", "n_hit"), F.lit(salts))).otherwise(F.lit(0).cast("long"))
    left = out.withColumn("hash", hash_).join(hot, "hash", "left").withColumn("salt", salt).drop("hash", "hot")
    every = F.when(F.col("hot"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    right = found.withColumn("hash", hash_).join(hot, "hash", "left").withColumn("salt", F.explode(every)).drop("hash", "hot")
    return left.join(right, ["held", "salt"]).drop("salt")


def report(docs: DataFrame, benchmark: DataFrame, size: int = 10, block: int = 200_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (ids as sorted strings), contaminated, one row per row of ``docs``.

    A null or empty text has no words and no hits; repeated rows are reported each; an empty benchmark hits nothing, an
    empty table gives no rows. Null items and texts of the benchmark have no windows. Extra columns are ignored.
    """
    windows = benchmark_windows(benchmark, size)
    hits = find_hits(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), windows, block)
    held = F.array_sort(F.array_distinct(F.transform("_hits", lambda h: F.slice("_words", h["at"], h["span"]))))
    n_hit = F.aggregate(_covered(), F.lit(0).cast("long"), lambda n, x: n + x["z"] - x["a"] + 1)
    out = materialise(hits.select("id", F.size("_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), held.alias("held")), "hits")
    # the items of each distinct list of windows
    lists = out.where("size(held) > 0").select("held").distinct()
    found = lists.select("held", F.explode("held").alias("words")).join(windows, "words").groupBy("held").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hit = _dealt(out.where("size(held) > 0"), found)
    out = hit.unionByName(out.where("size(held) = 0").withColumn("items", F.array().cast("array<string>")))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))


def without_spans(docs: DataFrame, benchmark: DataFrame, size: int = 10, block: int = 200_000) -> DataFrame:
    """The rows and columns of ``docs``, the hit words and the gaps after them cut from text. Texts without hits, null and empty ones stay as they are."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    hits = find_hits(docs.select(whole, "text"), benchmark_windows(benchmark, size), block).withColumn("_gone", _covered())
    pieces = F.regexp_extract_all("text", F.lit(PIECES), 0)
    lead = F.col("text").rlike(r"\A[0-9A-Za-z\x{80}-\x{10FFFF}]").cast("int")  # 1: pieces 0, 2, 4 ... are words
    word = lambda i: F.shiftright(i + lead + 1, 1)
    kept = F.filter(pieces, lambda p, i: ~F.exists("_gone", lambda g: word(i).between(g["a"], g["z"])))
    text = F.when(F.size("_gone") > 0, F.array_join(kept, "")).otherwise(F.col("text"))
    return hits.withColumn("text", text).select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    out = report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
