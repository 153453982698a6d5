"""The unified works index: one function per model, DataFrames in and out.

Inputs are the ingested tables (``citeloom.sources``): openalex, datacite, crossref, ror, citations. Wide columns
(texts, author lists) are joined only where a model needs them; everything before moves keys and lengths.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.identifiers import content_hash, distinct_count, doi_in_sql, isni, or_empty, without_hosts_sql
from citeloom.operators import changes, keys, lists, relations

# DataCite work types and the index's own.
WORK_TYPES = {
    "Audiovisual": "AUDIO_VISUAL", "Award": "OTHER", "Book": "BOOK", "BookChapter": "BOOK_CHAPTER", "Collection": "OTHER",
    "ComputationalNotebook": "SOFTWARE", "ConferencePaper": "ARTICLE", "ConferenceProceeding": "OTHER", "DataPaper": "ARTICLE",
    "Dataset": "DATASET", "Dissertation": "DISSERTATION", "Event": "EVENT", "Film": "AUDIO_VISUAL", "Image": "IMAGE",
    "Instrument": "PHYSICAL_OBJECT", "InteractiveResource": "INTERACTIVE_RESOURCE", "Journal": "OTHER", "JournalArticle": "ARTICLE",
    "List of nomenclatural and taxonomic changes for the New Zealand flora.": "OTHER", "Model": "DATASET", "Other": "OTHER",
    "OutputManagementPlan": "OUTPUT_MANAGEMENT_PLAN", "PeerReview": "PEER_REVIEW", "PhysicalObject": "PHYSICAL_OBJECT",
    "Preprint": "PREPRINT", "Project": "OTHER", "Report": "REPORT", "Service": "OTHER", "Software": "SOFTWARE", "Sound": "SOUND",
    "Standard": "STANDARD", "StudyRegistration": "OTHER", "Text": "ARTICLE", "Workflow": "OTHER",
}

ITEM = "struct<name:string,ror:string>"
AWARD = "struct<award_id:string>"
DOI = "struct<doi:string>"


# ---- registry of organisations -----------------------------------------------------------------------------------


def ror_identifiers(ror: DataFrame) -> DataFrame:
    """ror_id, type, identifier of each organisation's own and other ids. ror: id, external_ids[{type, all_ids[]}]."""
    own = without_hosts_sql("id")
    itself = ror.select(own.alias("ror_id"), F.lit("ror").alias("type"), own.alias("identifier")).distinct()
    each = ror.select(own.alias("ror_id"), F.explode("external_ids").alias("x")).select("ror_id", F.col("x.type").alias("type"), F.explode("x.all_ids").alias("raw"))
    plain = F.lower(F.trim("raw"))
    named = F.when(F.col("type") == "isni", isni("raw")).when(F.col("type") == "fundref", F.concat(F.lit("10.13039/"), plain)).otherwise(plain)
    return itself.unionByName(each.where("type IS NOT NULL OR raw IS NOT NULL").select("ror_id", "type", named.alias("identifier")))


# ---- relations ---------------------------------------------------------------------------------------------------


def crossref_edges(crossref: DataFrame) -> DataFrame:
    each = crossref.select(F.col("doi").alias("work_doi"), F.explode("relations").alias("r")).where("r.id_type = 'doi' AND r.relation_id IS NOT NULL AND work_doi <> r.relation_id")
    return relations.with_degrees(each.select("work_doi", F.col("r.relation_id").alias("related_doi"), F.col("r.relation_type").alias("relation_type")), "work_doi", "related_doi", "relation_type")


def datacite_edges(datacite: DataFrame) -> DataFrame:
    each = datacite.select(F.col("doi").alias("work_doi"), F.explode("relations").alias("r")).where("r.related_identifier_type = 'DOI' AND r.related_identifier IS NOT NULL AND work_doi <> r.related_identifier")
    return relations.with_degrees(each.select("work_doi", F.col("r.related_identifier").alias("related_doi"), F.col("r.relation_type").alias("relation_type")), "work_doi", "related_doi", "relation_type")


def dataset_citations(corpus: DataFrame, most: int) -> DataFrame:
    pairs = corpus.select(doi_in_sql("publication").alias("work_doi"), doi_in_sql("dataset").alias("dataset_doi"))
    return relations.citations(pairs, "work_doi", "dataset_doi", most)


def relation_index(crossref: DataFrame, datacite: DataFrame, corpus: DataFrame, most: int = 100) -> DataFrame:
    typed = [
        relations.typed_neighbours(crossref_edges(crossref), relations.CROSSREF_SAME_WORK, relations.CROSSREF_SAME_PROJECT, most),
        relations.typed_neighbours(datacite_edges(datacite), relations.DATACITE_SAME_WORK, relations.DATACITE_SAME_PROJECT, most),
    ]
    return relations.merged(typed, dataset_citations(corpus, most))


# ---- Crossref and DataCite ---------------------------------------------------------------------------------------


def crossref_works(crossref: DataFrame) -> DataFrame:
    """doi, title, abstract, title_length, abstract_length of the row with the longest abstract, then title, of each doi."""
    best = keys.richest(crossref.select("doi", "title", "abstract"), "doi", ["abstract", "title"], "title", "abstract")
    return best.select("doi", "title", "abstract", F.length("title").cast("long").alias("title_length"), F.length("abstract").cast("long").alias("abstract_length"))


def datacite_works(datacite: DataFrame) -> DataFrame:
    return keys.latest(datacite, "doi", "updated_date", "title", "abstract")


def work_type(column: str = "work_type") -> Column:
    """The index's work type of a DataCite one, null if unknown: a constant map instead of a join."""
    pairs = F.create_map(*[F.lit(x) for p in WORK_TYPES.items() for x in p])
    return F.try_element_at(pairs, F.col(column))


def work_types(works: DataFrame) -> DataFrame:
    return works.select("doi", work_type().alias("work_type")).where("work_type IS NOT NULL")


def datacite_updated(works: DataFrame, openalex: DataFrame) -> DataFrame:
    return keys.latest_of("doi", "updated_date", works, openalex.join(works.select("doi"), "doi", "left_semi"))


def datacite_institutions(works: DataFrame, ror: DataFrame) -> DataFrame:
    return lists.ordered_lookup(works, "doi", "institutions", "affiliation_identifier", ror, "identifier", [F.col("e.name").alias("name"), F.col("ror_id").alias("ror")], "institutions")


def datacite_funders(works: DataFrame, ror: DataFrame) -> DataFrame:
    return lists.ordered_lookup(works, "doi", "funders", "funder_identifier", ror, "identifier", [F.col("e.funder_name").alias("name"), F.col("ror_id").alias("ror")], "funders")


def datacite_awards(works: DataFrame, openalex: DataFrame) -> DataFrame:
    own = works.select("doi", F.explode("funders.award_number").alias("award_id"))
    other = openalex.join(works.select("doi"), "doi", "left_semi").select("doi", F.explode("awards.funder_award_id").alias("award_id"))
    return lists.distinct_list("doi", "award_id", "awards", "award_id", own, other)


def _relations() -> Column:
    return F.struct(*[or_empty(c, DOI).alias(c) for c in ("intra_work_dois", "possible_shared_project_dois", "dataset_citation_dois")])


def datacite_index(datacite: DataFrame, openalex: DataFrame, ror: DataFrame, related: DataFrame) -> DataFrame:
    works = datacite_works(datacite)
    out = works.drop("institutions", "funders", "updated_date", "relations")
    for part in (datacite_updated(works, openalex), datacite_institutions(works, ror), datacite_funders(works, ror), datacite_awards(works, openalex), related):
        out = out.join(part, "doi", "left")
    return out.select(
        "doi", "title", F.col("abstract").alias("abstract_text"), F.coalesce(work_type(), F.lit("OTHER")).alias("work_type"), "publication_date", "updated_date", "publication_venue",
        or_empty("institutions", ITEM).alias("institutions"), "authors", or_empty("funders", ITEM).alias("funders"), or_empty("awards", AWARD).alias("awards"), _relations().alias("relations"),
        F.struct(F.lit("DataCite").alias("name"), F.concat(F.lit("https://commons.datacite.org/doi.org/"), F.col("doi")).alias("url")).alias("source"),
    )


# ---- OpenAlex ----------------------------------------------------------------------------------------------------


def openalex_works(openalex: DataFrame, datacite: DataFrame) -> DataFrame:
    """Id and metadata counts of works with a doi that DataCite lacks, ranked within their doi."""
    count = {
        "id_count": sum((F.col(f"ids.{c}").isNotNull().cast("long") for c in ("mag", "pmid", "pmcid")), F.lit(0).cast("long")),
        "orcid_count": distinct_count("authors.orcid"),
        "funder_id_count": distinct_count("funders.id"),
        "award_id_count": distinct_count("awards.funder_award_id"),
        "inst_id_count": distinct_count("institutions.ror"),
    }
    base = openalex.where("doi IS NOT NULL").join(datacite.select("doi"), "doi", "left_anti")
    slim = base.select("id", "doi", F.length("title").cast("long").alias("title_length"), F.length("abstract").cast("long").alias("abstract_length"), *[c.cast("long").alias(n) for n, c in count.items()])
    return ranked_copies(slim.withColumn("total_count", sum((F.col(n) for n in count), F.lit(0).cast("long"))), "doi", "total_count", "id")


def ranked_copies(df: DataFrame, key: str, weight: str, tie: str) -> DataFrame:
    """doi_count, doi_rank, is_duplicate and is_primary_doi within each key: most weight first, then the smaller tie value."""
    by = Window.partitionBy(key)
    ranked = df.withColumns({"doi_count": F.count(F.lit(1)).over(by), "doi_rank": F.row_number().over(by.orderBy(F.desc(weight), F.asc(tie)))})
    return ranked.withColumns({"is_duplicate": F.col("doi_count") > 1, "is_primary_doi": F.col("doi_rank") == 1})


def length_stats(works: DataFrame, crossref: DataFrame, length: str) -> DataFrame:
    """id, doi and the greatest length of each doi that has a text in either source; without one the smallest id.

    Equal lengths go to the smallest id.
    """
    both = works.join(crossref.select("doi", F.col(length).alias("_other")), "doi", "left").where((F.col(length) > 0) | (F.col("_other") > 0))
    some = F.when(F.col(length).isNotNull(), F.struct((-F.col(length)).alias("l"), F.col("id")))
    many = both.where("is_duplicate").groupBy("doi").agg(F.coalesce(F.min(some)["id"], F.min("id")).alias("id"), F.max(length).alias(length))
    return many.select("id", "doi", length).unionByName(both.where("NOT is_duplicate").select("id", "doi", length))


def longest_text(stats: DataFrame, openalex: DataFrame, crossref: DataFrame, text: str, length: str) -> DataFrame:
    """doi and the longer of the two sources' texts; on a tie, or without the other, this source's."""
    own = openalex.select("id", F.col(text).alias("_own"))
    other = crossref.select("doi", F.col(text).alias("_other"), F.col(length).alias("_length"))
    both = stats.join(own, "id", "left").join(other, "doi", "left")
    longer = F.col("_length").isNotNull() & (F.col(length).isNull() | (F.col("_length") > F.col(length)))
    return both.select("doi", F.when(longer, F.col("_other")).otherwise(F.col("_own")).alias(text))


def publication_dates(works: DataFrame, openalex: DataFrame) -> DataFrame:
    return works.select("id", "doi").join(openalex.select("id", "publication_date"), "id").groupBy("doi").agg(F.max("publication_date").alias("publication_date"))


def openalex_updated(works: DataFrame, openalex: DataFrame, crossref: DataFrame) -> DataFrame:
    own = works.select("id", "doi").join(openalex.select("id", "updated_date"), "id")
    return keys.latest_of("doi", "updated_date", own, crossref.join(works.select("doi"), "doi", "left_semi"))


def openalex_awards(works: DataFrame, openalex: DataFrame, crossref: DataFrame) -> DataFrame:
    own = works.select("id", "doi").join(openalex.select("id", "awards"), "id").select("doi", F.explode("awards.funder_award_id").alias("award_id"))
    other = crossref.join(works.select("doi"), "doi", "left_semi").select("doi", F.explode("funders.award").alias("award_id"))
    return lists.distinct_list("doi", "award_id", "awards", "award_id", own, other)


def openalex_funders(works: DataFrame, openalex: DataFrame) -> DataFrame:
    listed = openalex.where("size(funders) > 0").select("id", F.transform("funders", lambda f: F.struct(f["display_name"].alias("name"), f["ror"].alias("ror"))).alias("funders"))
    return works.where("is_primary_doi").select("id", "doi").join(listed, "id")


def openalex_index(openalex: DataFrame, datacite: DataFrame, crossref: DataFrame, related: DataFrame) -> DataFrame:
    works = openalex_works(openalex, datacite)
    other = crossref_works(crossref)
    text = lambda name: longest_text(length_stats(works, other, f"{name}_length"), openalex, other, name, f"{name}_length")
    out = works.where("is_primary_doi").select("id", "doi").join(openalex.drop("doi", "title", "abstract", "updated_date", "funders", "awards"), "id")
    for part in (text("title"), text("abstract"), openalex_updated(works, openalex, crossref), openalex_awards(works, openalex, crossref), related):
        out = out.join(part, "doi", "left")
    out = out.join(openalex_funders(works, openalex).drop("doi"), "id", "left")
    return out.select(
        "doi", "title", F.col("abstract").alias("abstract_text"), F.coalesce(F.upper(F.replace("work_type", F.lit("-"), F.lit("_"))), F.lit("OTHER")).alias("work_type"), "publication_date", "updated_date",
        "publication_venue", "institutions", "authors", or_empty("funders", ITEM).alias("funders"), or_empty("awards", AWARD).alias("awards"), _relations().alias("relations"),
        F.struct(F.lit("OpenAlex").alias("name"), F.concat(F.lit("https://openalex.org/works/"), F.col("id")).alias("url")).alias("source"),
    )


#: What a work's hash covers, in this order. Without updated_date: a touched but equal work is no change.
HASHED = ["title", "abstract_text", "work_type", "publication_date", "publication_venue", "institutions", "authors", "funders", "awards", "relations", "source"]


def hashes(index: DataFrame) -> DataFrame:
    return index.select("doi", content_hash(*HASHED).alias("hash"))


# ---- the whole ---------------------------------------------------------------------------------------------------


@dataclass
class Release:
    """A release's inputs and its results; every result is a lazy DataFrame."""

    openalex: DataFrame
    datacite: DataFrame
    crossref: DataFrame
    ror: DataFrame
    citations: DataFrame
    date: str
    history: DataFrame | None = None
    most_degrees: int = 100
    most_states: int = 3
    keep: dict[str, DataFrame] = field(default_factory=dict)

    def build(self, store=None) -> dict[str, DataFrame]:
        """relations, both indexes, the next history and the export. ``store(name, df)`` may write a stage and return the table."""
        store = store or (lambda name, df: df)
        related = store("relations", relation_index(self.crossref, self.datacite, self.citations, self.most_degrees))
        ids = store("ror", ror_identifiers(self.ror))
        one = store("datacite_index", datacite_index(self.datacite, self.openalex, ids, related))
        two = store("openalex_index", openalex_index(self.openalex, self.datacite, self.crossref, related))
        history = self.history if self.history is not None else changes.no_states(self.openalex.sparkSession)
        nxt = store("history", changes.next_history(history, hashes(one).unionByName(hashes(two)), self.date, self.most_states))
        export = changes.release_export(nxt, self.date, one, two)
        self.keep = {"relations": related, "ror": ids, "datacite_index": one, "openalex_index": two, "history": nxt, "export": export}
        return self.keep
