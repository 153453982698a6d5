"""Relations between works: degrees, caps, symmetric neighbour lists, and their merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.identifiers import or_empty

# Relation types that tie versions of one work, and works of possibly one project, by source.
CROSSREF_SAME_WORK = [
    "is-expression-of", "has-expression", "is-format-of", "has-format", "is-identical-to", "is-manifestation-of",
    "has-manifestation", "is-manuscript-of", "has-manuscript", "is-preprint-of", "has-preprint", "is-replaced-by",
    "replaces", "is-translation-of", "has-translation", "is-variant-form-of", "is-original-form-of", "is-version-of",
]
CROSSREF_SAME_PROJECT = [
    "is-derived-from", "has-derivation", "is-basis-for", "is-based-on", "is-supplement-to", "is-supplemented-by",
    "documents", "is-documented-by", "has-part", "is-part-of", "continues", "is-continued-by", "compiles",
    "is-compiled-by", "is-related-material", "has-related-material",
]
DATACITE_SAME_WORK = [
    "IsIdenticalTo", "IsObsoletedBy", "Obsoletes", "IsPartOf", "HasPart", "IsPublishedIn", "IsTranslationOf",
    "HasTranslation", "IsVariantFormOf", "IsOriginalFormOf", "HasVersion", "IsVersionOf", "IsNewVersionOf",
    "IsPreviousVersionOf",
]
DATACITE_SAME_PROJECT = [
    "Compiles", "IsCompiledBy", "Continues", "IsContinuedBy", "IsDerivedFrom", "IsSourceOf", "Describes",
    "IsDescribedBy", "Documents", "IsDocumentedBy", "IsSupplementTo", "IsSupplementedBy",
]


def with_degrees(edges: DataFrame, start: str, end: str, *kind: str) -> DataFrame:
    """Distinct edges with out_degree (ends per start and kind) and in_degree (starts per end and kind).

    Degrees are pre-aggregated counts joined back, so a hub is summed on the map side and AQE can split its join;
    a window would gather the hub in one task.
    """
    edges = edges.select(start, end, *kind).distinct()
    out = edges.groupBy(start, *kind).agg(F.count(F.lit(1)).alias("out_degree"))
    into = edges.groupBy(end, *kind).agg(F.count(F.lit(1)).alias("in_degree"))
    on = lambda end_of: [F.col(f"e.{c}").eqNullSafe(F.col(f"d.{c}")) for c in (end_of, *kind)]
    edges = edges.alias("e").join(out.alias("d"), on(start)).select("e.*", "out_degree")
    return edges.alias("e").join(into.alias("d"), on(end)).select("e.*", "in_degree")


def within(edges: DataFrame, most: int) -> DataFrame:
    return edges.where((F.col("out_degree") <= most) & (F.col("in_degree") <= most))


def both_ways(edges: DataFrame, start: str, end: str, *rest: str) -> DataFrame:
    """Each edge and its reverse as (doi, related_doi, rest), from one scan."""
    ways = F.array(F.struct(F.col(start).alias("doi"), F.col(end).alias("related_doi")), F.struct(F.col(end).alias("doi"), F.col(start).alias("related_doi")))
    sound = edges.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) != F.col(end)))
    return sound.select(F.inline(ways), *rest)


def typed_neighbours(edges: DataFrame, same_work: list[str], same_project: list[str], most: int) -> DataFrame:
    """doi, intra_work_dois, possible_shared_project_dois (sorted) from degree-counted edges work_doi, related_doi, relation_type."""
    kind = F.coalesce(F.col("relation_type"), F.lit(""))
    flagged = within(edges, most).withColumns({"work": kind.isin(same_work), "project": kind.isin(same_project)}).where("work OR project")
    pairs = both_ways(flagged, "work_doi", "related_doi", "work", "project").groupBy("doi", "related_doi")
    pairs = pairs.agg(F.bool_or("work").alias("work"), F.bool_or("project").alias("project"))
    one = lambda flag: F.array_sort(F.collect_list(F.when(F.col(flag), F.col("related_doi"))))
    return pairs.groupBy("doi").agg(one("work").alias("intra_work_dois"), one("project").alias("possible_shared_project_dois"))


def citations(pairs: DataFrame, start: str, end: str, most: int, name: str = "dataset_citation_dois") -> DataFrame:
    """doi and the sorted distinct neighbours over capped, untyped pairs."""
    sound = pairs.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) != F.col(end)))
    capped = within(with_degrees(sound, start, end), most)
    return both_ways(capped, start, end).groupBy("doi").agg(F.array_sort(F.collect_set("related_doi")).alias(name))


def merged(typed: list[DataFrame], cited: DataFrame) -> DataFrame:
    """Every doi of any source with its three neighbour lists, each merged, distinct, sorted, as structs.

    The lists are unioned and grouped once, rather than joined source by source.
    """
    none = F.array().cast("array<string>")
    rows = [t.select("doi", "intra_work_dois", "possible_shared_project_dois", none.alias("dataset_citation_dois")) for t in typed]
    rows.append(cited.select("doi", none.alias("intra_work_dois"), none.alias("possible_shared_project_dois"), "dataset_citation_dois"))
    both = rows[0]
    for r in rows[1:]:
        both = both.unionByName(r)
    lists = ["intra_work_dois", "possible_shared_project_dois", "dataset_citation_dois"]
    joined = both.groupBy("doi").agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(or_empty(c, "string"))))).alias(c) for c in lists])
    return joined.select("doi", *[F.transform(c, lambda x: F.struct(x.alias("doi"))).alias(c) for c in lists])
