"""Matching plans to works: exact and name signals make candidates and scores, text adds, filters and ranks decide.

A *must* signal (funded DOI, author, award, three kinds of relation) makes a candidate; a *should* signal (institution,
funder, text) only adds to a candidate's score, so the common keys of institutions and funders are never joined on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.identifiers import folded


@dataclass(frozen=True)
class Weights:
    """Scores of the signals, and what to leave out (0)."""

    funded: float = 15.0
    award: float = 10.0
    same_work: float = 10.0
    same_project: float = 5.0
    dataset: float = 2.5
    author: float = 1.0
    institution: float = 1.0
    funder: float = 1.0
    content: float = 1.0
    #: how the scores of several matching items of a work are joined: avg or sum
    mode: str = "avg"


def tokens(text: str | Column) -> Column:
    """Words of a text: lower case, accents folded."""
    x = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.array_remove(F.split(F.lower(folded(x)), r"[^\p{L}\p{N}]+"), "")


def _pairs(dmps: DataFrame, ids: Column, works: DataFrame, other: Column, name: str, weight: float) -> DataFrame:
    """(dmp_doi, doi, score): weight times the number of a plan's distinct ids that the work has."""
    left = dmps.select(F.col("doi").alias("dmp_doi"), F.explode(F.array_distinct(ids)).alias("_k"))
    right = works.select("doi", F.explode(F.array_distinct(other)).alias("_k"))
    return left.join(right, "_k").groupBy("dmp_doi", "doi").agg((F.count(F.lit(1)) * weight).alias("score")).withColumn("signal", F.lit(name))


def _authors(dmps: DataFrame, works: DataFrame, w: Weights) -> DataFrame:
    """Same ORCID 2, else the surname as a phrase of the full name 1; summed per author of the work, then joined over them."""
    mine = dmps.select(F.col("doi").alias("dmp_doi"), F.posexplode("authors").alias("_i", "a")).select("dmp_doi", "_i", "a.orcid", F.array_join(tokens("a.surname"), " ").alias("surname"))
    theirs = works.select("doi", F.posexplode("authors").alias("_j", "b")).select("doi", "_j", F.col("b.orcid").alias("their_orcid"), tokens("b.full").alias("words"))
    by_id = mine.where("orcid IS NOT NULL").join(theirs.where("their_orcid IS NOT NULL"), F.col("orcid") == F.col("their_orcid")).select("dmp_doi", "doi", "_i", "_j", F.lit(2.0).alias("s"))
    word = theirs.select("doi", "_j", F.array_join("words", " ").alias("full"), F.explode(F.array_distinct("words")).alias("_k"))
    phrase = F.concat(F.lit(" "), F.col("full"), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("surname"), F.lit(" ")))
    by_name = mine.where("surname <> ''").withColumn("_k", F.substring_index("surname", " ", 1)).join(word, "_k").where(phrase).select("dmp_doi", "doi", "_i", "_j", F.lit(1.0).alias("s"))
    best = by_id.unionByName(by_name).groupBy("dmp_doi", "doi", "_j", "_i").agg(F.max("s").alias("s"))
    each = best.groupBy("dmp_doi", "doi", "_j").agg(F.sum("s").alias("s"))
    joined = F.avg("s") if w.mode == "avg" else F.sum("s")
    return each.groupBy("dmp_doi", "doi").agg((joined * w.author).alias("score")).withColumn("signal", F.lit("author"))


def _award_pairs(dmps: DataFrame, works: DataFrame, w: Weights) -> DataFrame:
    """The best variant of each award once: weight per award of the plan that the work acknowledges in any spelling."""
    mine = dmps.select(F.col("doi").alias("dmp_doi"), F.posexplode("awards").alias("_i", "a")).select("dmp_doi", "_i", F.explode("a.variants").alias("_v"))
    mine = mine.select("dmp_doi", "_i", F.lower("_v").alias("_k")).distinct()
    theirs = works.select("doi", F.explode("awards.award_id").alias("_v")).select("doi", F.lower("_v").alias("_k")).distinct()
    hit = mine.join(theirs, "_k").select("dmp_doi", "doi", "_i").distinct()
    return hit.groupBy("dmp_doi", "doi").agg((F.count(F.lit(1)) * w.award).alias("score")).withColumn("signal", F.lit("award"))


def must_signals(dmps: DataFrame, works: DataFrame, w: Weights) -> DataFrame:
    """(dmp_doi, doi, signal, score) of every must signal that holds."""
    parts = []
    if w.funded:
        parts.append(_pairs(dmps, F.col("funded_dois"), works, F.array("doi"), "funded", w.funded))
    if w.author:
        parts.append(_authors(dmps, works, w))
    if w.award:
        parts.append(_award_pairs(dmps, works, w))
    outputs = F.col("published_outputs.doi")
    for name, field, weight in (("same_work", "intra_work_dois", w.same_work), ("same_project", "possible_shared_project_dois", w.same_project), ("dataset", "dataset_citation_dois", w.dataset)):
        if weight:
            parts.append(_pairs(dmps, outputs, works, F.col(f"relations.{field}.doi"), name, weight))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


def _loose_phrase(text: Column, name: Column, slop: int = 3) -> Column:
    """Whether the name's words stand in the text in order, at most ``slop`` other words between two of them."""
    pattern = F.concat(F.lit(r"(?:^| )"), F.array_join(name, rf"(?: \S+){{0,{slop}}} "), F.lit(r"(?: |$)"))
    return (F.size(name) > 0) & F.rlike(F.array_join(text, " "), pattern)


def _items(mine: Column, theirs: Column, mode: str) -> Column:
    """Score of two lists of (ror, words): same id 2, else name 1; summed per item of the work, joined over those that match."""
    one = lambda a, b: F.when(a["ror"] == b["ror"], 2.0).when(_loose_phrase(b["words"], a["words"]), 1.0).otherwise(0.0)
    per = F.transform(theirs, lambda b: F.aggregate(F.transform(mine, lambda a: one(a, b)), F.lit(0.0), lambda x, y: x + y))
    hit = F.filter(per, lambda s: s > 0)
    total = F.aggregate(hit, F.lit(0.0), lambda x, y: x + y)
    return F.when(F.size(hit) > 0, total / F.size(hit) if mode == "avg" else total).otherwise(0.0)


def text_statistics(works: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, n: works that have it) and one row (works, average length), over all works."""
    words = works.select("doi", tokens(F.concat_ws(" ", "title", "abstract_text")).alias("words"))
    terms = words.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return terms, words.agg(F.count(F.lit(1)).alias("works"), F.avg(F.size("words")).alias("length"))


def query_terms(dmps: DataFrame, works: DataFrame, most: int = 25, least_works: int = 5) -> DataFrame:
    """dmp_doi, terms[(term, idf)]: each plan's ``most`` terms by tf * idf among those that ``least_works`` works have."""
    terms, size = text_statistics(works)
    total = size.first()  # one row
    words = dmps.select(F.col("doi").alias("dmp_doi"), F.explode(tokens(F.concat_ws(" ", "title", "abstract_text"))).alias("term"))
    counted = words.groupBy("dmp_doi", "term").agg(F.count(F.lit(1)).alias("tf")).join(terms.where(F.col("n") >= least_works), "term")
    idf = F.log(1 + (F.lit(float(total["works"])) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    order = Window.partitionBy("dmp_doi").orderBy((F.col("tf") * F.col("idf")).desc(), "term")
    top = counted.withColumn("idf", idf).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most)
    return top.groupBy("dmp_doi").agg(F.array_sort(F.collect_list(F.struct("term", "idf"))).alias("terms")).withColumn("length", F.lit(float(total["length"] or 1.0)))


def bm25(terms: Column, words: Column, length: Column, k1: float = 1.2, b: float = 0.75) -> Column:
    tf = lambda t: F.size(F.filter(words, lambda x: x == t["term"])).cast("double")
    norm = k1 * (1 - b + b * F.size(words) / length)
    return F.aggregate(F.transform(terms, lambda t: t["idf"] * tf(t) * (k1 + 1) / (tf(t) + norm)), F.lit(0.0), lambda x, y: x + y)


def content_scores(dmps: DataFrame, works: DataFrame) -> DataFrame:
    """(dmp_doi, doi, score): BM25 of each plan and every work that has any of the plan's query terms.

    The plans' terms (25 a plan) are broadcast, so a call takes the plans of one search; the works are dealt once, by doi,
    and a work's terms are counted, scored and summed where it lies. Terms add as multiples of 2^-40, whatever their order.
    """
    terms = query_terms(dmps, works).select("dmp_doi", "length", F.explode("terms").alias("t")).select("dmp_doi", "length", "t.term", "t.idf")
    words = works.select("doi", "title", "abstract_text").repartition("doi").select("doi", tokens(F.concat_ws(" ", "title", "abstract_text")).alias("words"))
    found = words.select("doi", F.size("words").alias("n"), F.explode("words").alias("term")).join(F.broadcast(terms.select("term").distinct()), "term", "left_semi")
    counted = found.groupBy("doi", "n", "term").agg(F.count(F.lit(1)).cast("double").alias("tf")).join(F.broadcast(terms), "term")
    part = bm25_term(F.col("idf"), F.col("tf"), F.col("n"), F.col("length"))
    return counted.groupBy("dmp_doi", "doi").agg((F.sum(F.round(part * 2.0**40).cast("long")) / 2.0**40).alias("score"))


def bm25_term(idf: Column, tf: Column, words: Column, length: Column, k1: float = 1.2, b: float = 0.75) -> Column:
    """What one term, ``tf`` times in a text of ``words`` words, adds to the text's score."""
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * words / length))


def _named(items: Column, name: str) -> Column:
    return F.transform(items, lambda i: F.struct(i["ror"].alias("ror"), F.array_remove(F.split(F.lower(F.coalesce(i[name], F.lit(""))), r"[^\p{L}\p{N}]+"), "").alias("words")))


def in_period(years_after: int = 3, earliest: str = "1990-01-01") -> Column:
    """Published from the project's start (or ``earliest``) to ``years_after`` years after its end."""
    start = F.coalesce("project_start", F.lit(earliest).cast("date"))
    late = F.col("project_end").isNotNull() & (F.col("publication_date") > F.add_months("project_end", 12 * years_after))
    return (F.col("publication_date") >= start) & ~F.coalesce(late, F.lit(False))


def match(dmps: DataFrame, works: DataFrame, weights: Weights | None = None, k: int = 100, years_after: int = 3) -> DataFrame:
    """dmp_doi, doi, score, score_max, rank, signals of each plan's ``k`` best works.

    dmps: doi, title, abstract_text, project_start, project_end, authors, institutions[{name,ror}], funders[{name,ror}],
    awards[{variants[]}], funded_dois[], published_outputs[{doi}]. works: rows of the index. Ties go to the smaller doi.
    """
    w = weights or Weights()
    works = works.where("work_type <> 'OUTPUT_MANAGEMENT_PLAN'")
    signals = must_signals(dmps, works, w).groupBy("dmp_doi", "doi").agg(F.sum("score").alias("must"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("signal", "score")))).alias("signals"))
    plan = dmps.select(F.col("doi").alias("dmp_doi"), "project_start", "project_end", _named(F.col("institutions"), "name").alias("_pi"), _named(F.col("funders"), "name").alias("_pf"))
    work = works.select("doi", "publication_date", _named(F.col("institutions"), "name").alias("_wi"), _named(F.col("funders"), "name").alias("_wf"), tokens(F.concat_ws(" ", "title", "abstract_text")).alias("_words"))
    rows = signals.join(plan, "dmp_doi").join(work, "doi").where(in_period(years_after))
    score = F.col("must")
    if w.institution:
        score = score + w.institution * F.coalesce(_items(F.col("_pi"), F.col("_wi"), w.mode), F.lit(0.0))
    if w.funder:
        score = score + w.funder * F.coalesce(_items(F.col("_pf"), F.col("_wf"), w.mode), F.lit(0.0))
    if w.content:
        rows = rows.join(query_terms(dmps, works), "dmp_doi", "left").withColumn("content", F.coalesce(bm25(F.col("terms"), F.col("_words"), F.col("length")), F.lit(0.0)))
        score = score + w.content * F.col("content")
    return ranked(rows.select("dmp_doi", "doi", score.alias("score"), "signals"), k)


def ranked(scores: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("dmp_doi")
    best = scores.withColumn("rank", F.row_number().over(by.orderBy(F.desc("score"), F.asc("doi")))).where(F.col("rank") <= k)
    return best.withColumn("score_max", F.max("score").over(by))


def explain(matches: DataFrame, dmps: DataFrame, works: DataFrame, most: int = 50) -> DataFrame:
    """The matches with, per list, the work's items that met the plan: index, score, fields; at most ``most`` of each."""
    plan = dmps.select(F.col("doi").alias("dmp_doi"), F.col("institutions").alias("_pi"), F.col("funders").alias("_pf"), F.col("authors").alias("_pa"), F.flatten("awards.variants").alias("_pv"), "funded_dois", F.col("published_outputs.doi").alias("_po"))
    both = matches.join(plan, "dmp_doi").join(works.select("doi", "institutions", "funders", "authors", "awards", "relations"), "doi")

    def hits(items: str, tests: dict[str, tuple]) -> Column:
        def one(x: Column, i: Column) -> Column:
            held = F.array_compact(F.array(*[F.when(test(x), F.lit(name)) for name, (test, _) in tests.items()]))
            score = F.greatest(*[F.when(test(x), F.lit(s)).otherwise(F.lit(0.0)) for test, s in tests.values()], F.lit(0.0))
            return F.struct(i.alias("index"), score.alias("score"), F.array_sort(held).alias("fields"))

        found = F.filter(F.transform(items, one), lambda m: m["score"] > 0)
        return F.slice(F.array_sort(found, lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).otherwise(a["index"] - b["index"])), 1, most)

    has = lambda array, value: F.coalesce(F.array_contains(array, value), F.lit(False))
    low = lambda array: F.transform(array, lambda x: F.lower(x))
    named = lambda mine: {"ror": (lambda x: has(F.col(f"{mine}.ror"), x["ror"]), 2.0), "name": (lambda x: has(low(F.col(f"{mine}.name")), F.lower(x["name"])), 1.0)}
    related = lambda name, score: hits(f"relations.{name}", {"doi": (lambda x: has(F.col("_po"), x["doi"]), score)})
    return both.select(
        *matches.columns, F.struct(has(F.col("funded_dois"), F.col("doi")).alias("found"), F.when(has(F.col("funded_dois"), F.col("doi")), 15.0).otherwise(0.0).alias("score")).alias("doi_match"),
        hits("authors", {"orcid": (lambda x: has(F.col("_pa.orcid"), x["orcid"]), 2.0), "surname": (lambda x: has(low(F.col("_pa.surname")), F.lower(x["surname"])), 1.0)}).alias("author_matches"),
        hits("institutions", named("_pi")).alias("institution_matches"), hits("funders", named("_pf")).alias("funder_matches"),
        hits("awards", {"award_id": (lambda x: has(low(F.col("_pv")), F.lower(x["award_id"])), 10.0)}).alias("award_matches"),
        related("intra_work_dois", 10.0).alias("intra_work_doi_matches"), related("possible_shared_project_dois", 5.0).alias("possible_shared_project_doi_matches"), related("dataset_citation_dois", 2.5).alias("dataset_citation_doi_matches"),
    )


def highlighted(text: str | Column, terms: Column) -> Column:
    """The text with the given words in <mark>; words are matched whole and without regard to case."""
    x = F.col(text) if isinstance(text, str) else text
    pattern = F.concat(F.lit(r"(?iU)\b("), F.array_join(F.transform(terms, lambda t: F.regexp_replace(t, r"([\\.^$|()\[\]{}*+?])", r"\\$1")), "|"), F.lit(r")\b"))
    return F.when(F.size(terms) > 0, F.regexp_replace(x, pattern, F.lit("<mark>$1</mark>"))).otherwise(x)


def by_plan(matches: DataFrame) -> DataFrame:
    """One row per plan: its matches in rank order."""
    rest = [c for c in matches.columns if c not in ("dmp_doi", "rank")]
    packed = matches.groupBy("dmp_doi").agg(F.array_sort(F.collect_list(F.struct("rank", F.struct(*rest).alias("work"))), lambda a, b: a["rank"] - b["rank"]).alias("_w"))
    return packed.select("dmp_doi", F.transform("_w", lambda x: x["work"]).alias("works"))
