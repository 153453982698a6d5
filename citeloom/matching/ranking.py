"""Learning to rank: feature rows, RankLib text, z-scores, linear re-ranking; and ranking metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.identifiers import without_newlines
from citeloom.matching import signals

# The features and their order in the training file.
FEATURES = [
    "mlt_content", "funded_doi_matched", "dmp_award_count", "award_match_count", "dmp_author_count", "author_orcid_match_count",
    "author_surname_match_count", "dmp_institution_count", "institution_ror_match_count", "institution_name_match_count",
    "dmp_funder_count", "funder_ror_match_count", "funder_name_match_count", "intra_work_doi_count",
    "possible_shared_project_doi_count", "dataset_citation_doi_count",
]


def _overlap(a: Column, b: Column) -> Column:
    """How many of a's distinct values b has; 0 for a null list."""
    return F.coalesce(F.size(F.array_intersect(F.array_compact(a), F.array_compact(b))), F.lit(0)).cast("long")


def _count(a: Column) -> Column:
    return F.coalesce(F.size(F.array_distinct(a)), F.lit(0)).cast("long")


def _lower(a: Column) -> Column:
    return F.transform(a, lambda x: F.lower(x))


def features(candidates: DataFrame, dmps: DataFrame, works: DataFrame) -> DataFrame:
    """dmp_doi, work_doi, work_title and the features of each candidate (dmp_doi, doi)."""
    terms = signals.query_terms(dmps, works)
    plan = dmps.select(F.col("doi").alias("dmp_doi"), F.col("authors").alias("_pa"), F.col("institutions").alias("_pi"), F.col("funders").alias("_pf"), F.col("awards").alias("_pw"), "funded_dois", F.col("published_outputs.doi").alias("_po"))
    work = works.select("doi", F.col("title").alias("work_title"), "authors", "institutions", "funders", "awards", "relations", signals.tokens(F.concat_ws(" ", "title", "abstract_text")).alias("_words"))
    rows = candidates.select("dmp_doi", "doi").join(plan, "dmp_doi").join(work, "doi").join(terms, "dmp_doi", "left")
    met = F.filter("_pw", lambda a: F.arrays_overlap(_lower(a["variants"]), _lower(F.col("awards.award_id"))))
    value = {
        "mlt_content": F.coalesce(signals.bm25(F.col("terms"), F.col("_words"), F.col("length")), F.lit(0.0)),
        "funded_doi_matched": F.coalesce(F.array_contains("funded_dois", F.col("doi")), F.lit(False)).cast("long"),
        "dmp_award_count": _count(F.col("_pw")), "award_match_count": F.coalesce(F.size(met), F.lit(0)).cast("long"), "dmp_author_count": _count(F.col("_pa")),
        "author_orcid_match_count": _overlap(F.col("_pa.orcid"), F.col("authors.orcid")), "author_surname_match_count": _overlap(_lower(F.col("_pa.surname")), _lower(F.col("authors.surname"))),
        "dmp_institution_count": _count(F.col("_pi")), "institution_ror_match_count": _overlap(F.col("_pi.ror"), F.col("institutions.ror")), "institution_name_match_count": _overlap(_lower(F.col("_pi.name")), _lower(F.col("institutions.name"))),
        "dmp_funder_count": _count(F.col("_pf")), "funder_ror_match_count": _overlap(F.col("_pf.ror"), F.col("funders.ror")), "funder_name_match_count": _overlap(_lower(F.col("_pf.name")), _lower(F.col("funders.name"))),
        "intra_work_doi_count": _overlap(F.col("_po"), F.col("relations.intra_work_dois.doi")), "possible_shared_project_doi_count": _overlap(F.col("_po"), F.col("relations.possible_shared_project_dois.doi")),
        "dataset_citation_doi_count": _overlap(F.col("_po"), F.col("relations.dataset_citation_dois.doi")),
    }
    return rows.select("dmp_doi", F.col("doi").alias("work_doi"), "work_title", *[value[f].alias(f) for f in FEATURES])


def with_judgements(rows: DataFrame, accepted: DataFrame) -> DataFrame:
    """judgement 1 where (dmp_doi, work_doi) is accepted, else 0."""
    known = accepted.select("dmp_doi", "work_doi").distinct().withColumn("judgement", F.lit(1))
    return rows.join(known, ["dmp_doi", "work_doi"], "left").withColumn("judgement", F.coalesce("judgement", F.lit(0)))


def ranklib_line(names: list[str] | None = None, query: str = "dmp_doi", work: str = "work_doi", title: str = "work_title") -> Column:
    """judgement qid:plan 1:f1 2:f2 ... # doi  title"""
    values = [F.concat(F.lit(f"{i}:"), F.col(f).cast("string")) for i, f in enumerate(names or FEATURES, 1)]
    tail = F.concat(F.lit(" "), without_newlines(title))  # concat_ws leaves a null title out
    return F.concat_ws(" ", F.col("judgement").cast("string"), F.concat(F.lit("qid:"), query), *values, F.concat(F.lit("# "), work), tail)


def read_ranklib(spark, path: str, width: int) -> DataFrame:
    """judgement, qid, values (array of ``width`` doubles, 0 where missing), comment."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    head = F.regexp_replace(F.substring_index("value", "#", 1), r"qid:\S+", "").alias("head")
    kept = lines.select(F.regexp_extract("value", r"^\s*(\d+)", 1).cast("int").alias("judgement"), F.regexp_extract("value", r"qid:(\S+)", 1).alias("qid"), head, F.trim(F.regexp_extract("value", "#(.*)$", 1)).alias("comment"))
    return kept.select("judgement", "qid", _values_of("head", width).alias("values"), "comment")


def _values_of(c: str, width: int) -> Column:
    found = F.regexp_extract_all(c, F.lit(r"(\d+):([-+.\dEe]+)"), 0)
    pairs = F.map_from_entries(F.transform(found, lambda p: F.struct(F.substring_index(p, ":", 1).cast("int"), F.substring_index(p, ":", -1).cast("double"))))
    return F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: F.coalesce(F.try_element_at(pairs, i), F.lit(0.0)))


def normalisers(rows: DataFrame, names: list[str], least: float = 1e-7, digits: int = 7) -> DataFrame:
    """feature, mean, stdev (population, at least ``least``), in one pass."""
    stats = rows.agg(*[x for n in names for x in (F.avg(n).alias(f"m_{n}"), F.stddev_pop(n).alias(f"s_{n}"))])
    each = F.array(*[F.struct(F.lit(n).alias("feature"), F.round(f"m_{n}", digits).alias("mean"), F.round(F.greatest(F.col(f"s_{n}"), F.lit(least)), digits).alias("stdev")) for n in names])
    return stats.select(F.inline(each))


def z_scored(rows: DataFrame, names: list[str]) -> DataFrame:
    stats = {r["feature"]: r for r in normalisers(rows, names).collect()}  # a row per feature
    return rows.withColumns({n: (F.col(n) - stats[n]["mean"]) / stats[n]["stdev"] for n in names})


def reranked(rows: DataFrame, weights: dict[str, float], window: int = 100, base: float = 0.001, model: float = 1.0) -> DataFrame:
    """The top ``window`` of each plan by score, ordered anew by base * score + model * linear score."""
    top = signals.ranked(rows, window).drop("score_max")
    linear = sum((F.lit(w) * F.col(f) for f, w in weights.items()), F.lit(0.0))
    return signals.ranked(top.withColumn("score", base * F.col("score") + model * linear).drop("rank"), window)


def metrics(run: DataFrame, accepted: DataFrame, ks: list[int]) -> DataFrame:
    """dmp_doi (and 'all', the mean over plans), k, map, ndcg, precision, recall.

    run: dmp_doi, doi, score. accepted: dmp_doi, doi. Every plan with an accepted work counts, with 0 where it has no run.
    """
    accepted = accepted.select("dmp_doi", "doi").distinct()
    rank = F.row_number().over(Window.partitionBy("dmp_doi").orderBy(F.desc("score"), F.asc("doi")))
    top = run.withColumn("rank", rank).where(F.col("rank") <= max(ks)).join(accepted.withColumn("rel", F.lit(1)), ["dmp_doi", "doi"], "left").withColumn("rel", F.coalesce("rel", F.lit(0)))
    so_far = F.sum("rel").over(Window.partitionBy("dmp_doi").orderBy("rank"))
    top = top.withColumns({"hit": F.col("rel") * so_far / F.col("rank"), "gain": F.col("rel") / F.log2(F.col("rank") + 1.0)})
    sums = [x for k in ks for x in (F.sum(F.when(F.col("rank") <= k, F.col("hit"))).alias(f"hit{k}"), F.sum(F.when(F.col("rank") <= k, F.col("gain"))).alias(f"gain{k}"), F.sum(F.when(F.col("rank") <= k, F.col("rel"))).alias(f"rel{k}"))]
    known = accepted.groupBy("dmp_doi").agg(F.count(F.lit(1)).alias("n"))
    rows = known.join(top.groupBy("dmp_doi").agg(*sums), "dmp_doi", "left").na.fill(0)
    ideal = lambda k: F.aggregate(F.sequence(F.lit(1), F.least(F.lit(k).cast("long"), F.col("n")).cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1.0))
    each = F.array(*[F.struct(F.lit(k).alias("k"), (F.col(f"hit{k}") / F.col("n")).alias("map"), (F.col(f"gain{k}") / ideal(k)).alias("ndcg"), (F.col(f"rel{k}") / k).alias("precision"), (F.col(f"rel{k}") / F.col("n")).alias("recall")) for k in ks])
    per = rows.select("dmp_doi", F.inline(each))
    mean = per.groupBy("k").agg(*[F.avg(m).alias(m) for m in ("map", "ndcg", "precision", "recall")]).select(F.lit("all").alias("dmp_doi"), "k", "map", "ndcg", "precision", "recall")
    return per.unionByName(mean)


def true_positives(run: DataFrame, accepted: DataFrame, k: int = 100) -> DataFrame:
    """dmp_doi, doi, rank, share of the plan's best score: the accepted works among each plan's first k."""
    top = signals.ranked(run, k).join(accepted.select("dmp_doi", "doi").distinct(), ["dmp_doi", "doi"], "left_semi")
    return top.select("dmp_doi", "doi", "rank", (F.col("score") / F.col("score_max")).alias("share"))
