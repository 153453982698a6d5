"""Enrichment of plans, and the rows that results are stored as."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.awards import awards_in, identifier, variants
from citeloom.functions.identifiers import ascii_words
from citeloom.functions.text import similarity
from citeloom.operators.changes import inserted
from citeloom.operators.keys import first_n


def enriched(dmps: DataFrame, award_dois: DataFrame) -> DataFrame:
    """Plans with awards (funder, award, variants, funded_dois) from their funding's ids, and all funded_dois.

    award_dois: award (canonical id), doi; it stands for the funders' services. A funding entry's three id fields are
    parsed by its funder's format; equal awards count once. Unparsed ids stay as awards of their own spelling.
    """
    funding = dmps.select("doi", F.explode("funding").alias("f"))
    fields = F.array_compact(F.array("f.funding_opportunity_id", "f.award_id", "f.funder_project_number"))
    each = funding.select("doi", F.col("f.funder").alias("funder"), F.explode(fields).alias("text"))
    found = each.withColumn("_a", awards_in("text", "funder.ror"))
    known = found.select("doi", "funder", F.explode("_a").alias("_a")).select("doi", "funder", identifier(F.col("_a")).alias("award"), variants(F.col("_a")).alias("variants"))
    other = found.where("size(_a) = 0").select("doi", "funder", F.col("text").alias("award"), F.array("text").alias("variants"))
    rows = known.unionByName(other).dropDuplicates(["doi", "award"])
    dois = award_dois.groupBy("award").agg(F.array_sort(F.collect_set("doi")).alias("funded_dois"))
    rows = rows.join(dois, "award", "left").withColumn("funded_dois", F.coalesce("funded_dois", F.array().cast("array<string>")))
    packed = rows.groupBy("doi").agg(F.array_sort(F.collect_list(F.struct("award", "funder", "variants", "funded_dois"))).alias("awards"))
    out = dmps.join(packed, "doi", "left")
    out = out.withColumn("awards", F.coalesce("awards", F.array().cast(packed.schema["awards"].dataType)))
    funders = F.array_distinct(F.transform("funding", lambda f: f["funder"]))
    return out.withColumns({"funded_dois": F.array_distinct(F.flatten("awards.funded_dois")), "funders": funders})


def work_versions(matches: DataFrame, works: DataFrame) -> DataFrame:
    """One row per matched work and hash: its lists as JSON with sorted keys, the hash as bytes."""
    used = works.join(matches.select("doi").distinct(), "doi", "left_semi").dropDuplicates(["doi", "hash"])
    json = lambda c: F.to_json(c).alias(c)
    return used.select("doi", F.unhex("hash").alias("hash"), "work_type", "publication_date", "title", "abstract_text", json("authors"), json("institutions"), json("funders"), json("awards"), "publication_venue", F.col("source.name").alias("source_name"), F.col("source.url").alias("source_url"))


def related_works(explained: DataFrame, status: str = "PENDING") -> DataFrame:
    """One row per plan and work: score, greatest score, and the explanation as JSON."""
    parts = [c for c in explained.columns if c.endswith("_match") or c.endswith("_matches")]
    return explained.select("dmp_doi", F.col("doi").alias("work_doi"), "score", "score_max", F.lit(status).alias("status"), *[F.to_json(c).alias(c) for c in parts]).dropDuplicates(["dmp_doi", "work_doi"])


def merge_related(stored: DataFrame, new: DataFrame, plans: DataFrame) -> DataFrame:
    """New rows of known plans added; what a user has decided on stays; pending rows that are no longer found go."""
    ours = new.join(plans.select("dmp_doi").distinct(), "dmp_doi", "left_semi")
    held = stored.join(ours.select("dmp_doi", "work_doi"), ["dmp_doi", "work_doi"], "left_semi").unionByName(stored.where("status <> 'PENDING'")).dropDuplicates(["dmp_doi", "work_doi"])
    return inserted(held, ours, ["dmp_doi", "work_doi"])


def ground_truth(pairs: DataFrame, status: str = "ACCEPTED") -> DataFrame:
    """(dmp_doi, work_doi, status) rows to score-1 related works of that status, distinct."""
    return pairs.where(F.col("status") == status).select("dmp_doi", "work_doi", F.lit(1.0).alias("score"), F.lit(1.0).alias("score_max"), "status").distinct()


def latest_plans(plans: DataFrame, key: str = "dmp_id") -> DataFrame:
    """The plan made last of each id, by creation and then id."""
    return first_n(plans, [key], [F.desc_nulls_last("created"), F.desc_nulls_last("id")])


def last_modified(plans: DataFrame, related: DataFrame) -> DataFrame:
    """Plans with modified raised to the last decision on one of their related works."""
    decided = related.where(F.col("status").isin("ACCEPTED", "REJECTED")).groupBy("plan_id").agg(F.max("modified").alias("_m"))
    return plans.join(decided, plans["id"] == decided["plan_id"], "left").drop("plan_id").withColumn("modified", F.greatest("modified", F.coalesce("_m", "modified"))).drop("_m")


def select_dmps(dmps: DataFrame, dois: list[str] | None = None, rors: list[str] | None = None, names: list[str] | None = None, start: tuple[str, str] | None = None, modified_since: str | None = None) -> DataFrame:
    """Plans by (doi, or institution by id or name), project start and modification, ordered by doi; all without conditions."""
    who: Column | None = None
    for part in (
        F.col("doi").isin(dois) if dois else None, F.exists("institutions", lambda i: i["ror"].isin(rors)) if rors else None,
        F.exists("institutions", lambda i: F.lower(i["name"]).isin([n.lower() for n in names])) if names else None,
    ):
        if part is not None:
            who = part if who is None else who | part
    out = dmps if who is None else dmps.where(who)
    if start:
        out = out.where(F.col("project_start").between(*[F.lit(d).cast("date") for d in start]))
    if modified_since:
        out = out.where(F.col("modified") >= F.lit(modified_since).cast("timestamp_ntz"))
    return out.orderBy("doi")


def without_orphans(versions: DataFrame, related: DataFrame) -> DataFrame:
    """Work versions that a related work still refers to."""
    return versions.join(related.select(F.col("work_doi").alias("doi")).distinct(), "doi", "left_semi")


def title_matches(references: DataFrame, works: DataFrame, least: float = 95.0, keys: int = 3) -> DataFrame:
    """id, doi, similarity: the work whose folded title is most similar to a reference's, at least by ``least``.

    references: id, title. works: doi, title. Similarity is taken for pairs that share one of their ``keys`` longest words.
    """
    by_length = lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)

    def keyed(df: DataFrame, key: str, name: str) -> DataFrame:
        folded = df.select(key, ascii_words("title").alias(name)).where(F.col(name) != "")
        longest = F.slice(F.array_sort(F.array_distinct(F.split(name, " ")), by_length), 1, keys)
        return folded.select(key, name, F.explode(longest).alias("_k"))

    both = keyed(references, "id", "_a").join(keyed(works, "doi", "_b"), "_k").drop("_k").distinct()
    scored = both.withColumn("similarity", similarity("_a", "_b")).where(F.col("similarity") >= least)
    return first_n(scored, ["id"], [F.desc("similarity"), F.asc("doi")]).select("id", "doi", "similarity")
