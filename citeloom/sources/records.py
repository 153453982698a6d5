"""Raw metadata records to typed rows. Column expressions; Arrow-batched functions only for names, markup and NFC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.identifiers import any_filled, clean, doi_in, doi_with_prefix, first_present, has_doi, iso_date, iso_timestamp, null_if_listed, orcid_in, ror_in, split_list, without_hosts
from citeloom.functions.text import MISSING_ABSTRACT, MISSING_DEPOSIT_ABSTRACT, names_in, nfc_in, revert_inverted_index, strip_markup

OPENALEX = """id string, doi string, is_xpac boolean, ids struct<mag:string,openalex:string,pmid:string,pmcid:string,doi:string>, title string,
abstract_inverted_index string, type string, publication_date string, updated_date string,
primary_location struct<source:struct<display_name:string>>,
authorships array<struct<author:struct<display_name:string,orcid:string>,institutions:array<struct<display_name:string,ror:string>>>>,
funders array<struct<id:string,display_name:string,ror:string>>,
awards array<struct<id:string,display_name:string,funder_award_id:string,funder_id:string,funder_display_name:string,doi:string>>"""
#: nameIdentifiers and affiliation are an object or an array of them: kept as JSON text and read as an array.
DATACITE = """id string, attributes struct<titles:array<struct<title:string>>, descriptions:array<struct<description:string>>,
types:struct<resourceTypeGeneral:string>, created:string, updated:string, publisher:struct<name:string>,
creators:array<struct<name:string,nameType:string,givenName:string,familyName:string,nameIdentifiers:string,affiliation:string>>,
fundingReferences:array<struct<funderName:string,funderIdentifier:string,funderIdentifierType:string,award_number:string,awardNumber:string,awardUri:string>>,
relatedIdentifiers:array<struct<relationType:string,relatedIdentifier:string,relatedIdentifierType:string>>>"""
CROSSREF = """DOI string, title array<string>, abstract string, deposited struct<`date-time`:string>,
funder array<struct<DOI:string,name:string,award:array<string>>>, relation map<string,array<struct<id:string,`id-type`:string,`asserted-by`:string>>>"""
ROR = "id string, external_ids array<struct<type:string,`all`:array<string>>>"
CITATIONS = "publication string, dataset string, source string"
DMPS = """doi string, created timestamp_ntz, registered timestamp_ntz, modified timestamp_ntz, title string, abstract_text string, project_start string, project_end string,
institutions string, authors string, funding string, published_outputs string"""

AUTHOR = ["orcid", "first_initial", "given_name", "middle_initials", "middle_names", "surname", "full"]

# Award ids that say there is none.
NO_AWARD = [
    "", "-", "0", "0000", "001", "1", "12", "123", "1234", "12345", "123456", "12345678", "123456789", "123457", "None", "abc123", "abcdef",
    "em elaboração", "independent departmental funds", "internally funded", "n/a", "na", "na.com", "nil", "no aplica", "no grat numbered yet",
    "no numbered yet", "not applicable", "not assigned", "not yet assigned", "pending", "sem numero", "sem numeros", "tbd", "unspecified", "xxxxxxxxxxxxxxxxx",
]


def _list(a: Column, kind: str) -> Column:
    return F.coalesce(a, F.array().cast(kind))


def _each(a: Column, make) -> Column:
    """make(element) of every non-null element, first occurrences only."""
    return F.array_distinct(F.transform(F.filter(a, lambda x: x.isNotNull()), make))


def _dois_in(a: Column) -> Column:
    """DOIs of an array of strings, place by place."""
    plain = F.transform(a, lambda x: F.lower(clean(F.regexp_extract(x, r"(?U)10\.[\d.]+/[^\s]+", 0))))
    return nfc_in(plain)


def _object_or_array(c: Column, item: str) -> Column:
    return _list(F.from_json(c, f"array<{item}>"), f"array<{item}>")


def _authors(df: DataFrame, people: Column, ids: Column) -> DataFrame:
    """Column authors from parallel arrays of names (given, surname, full) and ORCIDs; without the nameless and the repeated."""
    df = df.withColumn("_names", names_in(people)).withColumn("_orcids", ids)
    both = F.transform("_names", lambda n, i: F.struct(F.get("_orcids", i).alias("orcid"), *[n[c].alias(c) for c in AUTHOR[1:]]))
    return df.withColumn("authors", F.array_distinct(F.filter(both, lambda a: any_filled(a["orcid"], a["full"])))).drop("_names", "_orcids")


def openalex(raw: DataFrame, with_xpac: bool = False) -> DataFrame:
    """Rows with a DOI; works of the extended corpus only on demand."""
    df = raw.where(has_doi("doi")).withColumn("_doi", doi_in("doi"))
    if not with_xpac:
        df = df.where("NOT coalesce(is_xpac, false)")
    people = F.transform(_list(F.col("authorships"), "array<struct<author:struct<display_name:string,orcid:string>,institutions:array<struct<display_name:string,ror:string>>>>"), lambda a: a["author"])
    df = _authors(df, F.transform(people, lambda p: F.struct(F.lit(None).cast("string").alias("given"), F.lit(None).cast("string").alias("surname"), p["display_name"].alias("full"))), F.transform(people, lambda p: orcid_in(p["orcid"])))
    places = F.flatten(F.transform("authorships", lambda a: _list(a["institutions"], "array<struct<display_name:string,ror:string>>")))
    institutions = F.filter(_each(places, lambda i: F.struct(clean(i["display_name"]).alias("name"), without_hosts(i["ror"]).alias("ror"))), lambda i: any_filled(i["name"], i["ror"]))
    funders = F.filter(_each(F.col("funders"), lambda f: F.struct(without_hosts(f["id"]).alias("id"), clean(f["display_name"]).alias("display_name"), without_hosts(f["ror"]).alias("ror"))), lambda f: any_filled(f["id"], f["display_name"], f["ror"]))

    def award(a: Column, number: Column) -> Column:
        return F.struct(
            without_hosts(a["id"]).alias("id"), clean(a["display_name"]).alias("display_name"), number.alias("funder_award_id"), without_hosts(a["funder_id"]).alias("funder_id"),
            clean(a["funder_display_name"]).alias("funder_display_name"), F.lower(clean(F.regexp_extract(a["doi"], r"(?U)10\.[\d.]+/[^\s]+", 0))).alias("doi"),
        )

    awards = F.flatten(F.transform(F.filter("awards", lambda a: a["funder_award_id"].isNotNull()), lambda a: F.transform(split_list(a["funder_award_id"]), lambda n: award(a, n))))
    text = strip_markup("title")
    return df.select(
        without_hosts("id").alias("id"), F.col("_doi").alias("doi"), F.coalesce("is_xpac", F.lit(False)).alias("is_xpac"),
        F.struct(doi_in("ids.doi").alias("doi"), *[without_hosts(f"ids.{c}").alias(c) for c in ("mag", "openalex", "pmid", "pmcid")]).alias("ids"),
        text.alias("title"), revert_inverted_index("abstract_inverted_index", MISSING_ABSTRACT).alias("abstract"), F.col("type").alias("work_type"), iso_date("publication_date").alias("publication_date"),
        iso_timestamp("updated_date").alias("updated_date"), F.col("primary_location.source.display_name").alias("publication_venue"), "authors",
        _list(institutions, "array<struct<name:string,ror:string>>").alias("institutions"), _list(funders, "array<struct<id:string,display_name:string,ror:string>>").alias("funders"),
        _list(awards, "array<struct<id:string,display_name:string,funder_award_id:string,funder_id:string,funder_display_name:string,doi:string>>").alias("awards"),
    )


def datacite(raw: DataFrame) -> DataFrame:
    """Rows with a DOI. Authors and institutions come from personal creators; a funder counts once per award number."""
    df = raw.where(has_doi("id")).withColumn("_doi", doi_in("id"))
    people = F.filter("attributes.creators", lambda c: c["nameType"] == "Personal")
    df = df.withColumn("_people", _list(people, "array<struct<name:string,nameType:string,givenName:string,familyName:string,nameIdentifiers:string,affiliation:string>>"))
    ids = F.transform("_people", lambda p: F.get(F.filter(F.transform(_object_or_array(p["nameIdentifiers"], "struct<nameIdentifier:string>"), lambda n: orcid_in(n["nameIdentifier"])), lambda x: x.isNotNull()), 0))
    df = _authors(df, F.transform("_people", lambda p: F.struct(p["givenName"].alias("given"), p["familyName"].alias("surname"), p["name"].alias("full"))), ids)
    places = F.flatten(F.transform("_people", lambda p: _object_or_array(p["affiliation"], "struct<name:string,affiliationIdentifier:string,affiliationIdentifierScheme:string,schemeUri:string>")))
    place = lambda a: F.struct(without_hosts(a["affiliationIdentifier"]).alias("affiliation_identifier"), a["affiliationIdentifierScheme"].alias("affiliation_identifier_scheme"), a["name"].alias("name"), a["schemeUri"].alias("scheme_uri"))
    institutions = F.filter(_each(places, place), lambda i: any_filled(i["affiliation_identifier"], i["name"]))

    def funder(f: Column, number: Column) -> Column:
        return F.struct(without_hosts(f["funderIdentifier"]).alias("funder_identifier"), f["funderIdentifierType"].alias("funder_identifier_type"), f["funderName"].alias("funder_name"), number.alias("award_number"), f["awardUri"].alias("award_uri"))

    funded = F.filter("attributes.fundingReferences", lambda f: F.coalesce(f["award_number"], f["awardNumber"]).isNotNull())
    funders = F.flatten(F.transform(funded, lambda f: F.transform(split_list(F.coalesce(f["award_number"], f["awardNumber"])), lambda n: funder(f, n))))
    df = df.withColumn("_related", _dois_in(F.transform("attributes.relatedIdentifiers", lambda r: r["relatedIdentifier"])))
    relations = F.transform("attributes.relatedIdentifiers", lambda r, i: F.struct(
        r["relationType"].alias("relation_type"), F.coalesce(F.get("_related", i), r["relatedIdentifier"]).alias("related_identifier"),
        F.when(F.get("_related", i).isNotNull(), "DOI").otherwise(F.when(r["relatedIdentifierType"] != "DOI", r["relatedIdentifierType"])).alias("related_identifier_type"),
    ))
    described = F.transform("attributes.descriptions", lambda d: d["description"])
    return df.select(
        F.col("_doi").alias("doi"), strip_markup(first_present(F.transform("attributes.titles", lambda t: t["title"]))).alias("title"), strip_markup(first_present(described), MISSING_DEPOSIT_ABSTRACT).alias("abstract"),
        F.col("attributes.types.resourceTypeGeneral").alias("work_type"), iso_date("attributes.created").alias("publication_date"), iso_timestamp("attributes.updated").alias("updated_date"),
        F.col("attributes.publisher.name").alias("publication_venue"), "authors", _list(institutions, "array<struct<affiliation_identifier:string,affiliation_identifier_scheme:string,name:string,scheme_uri:string>>").alias("institutions"),
        _list(funders, "array<struct<funder_identifier:string,funder_identifier_type:string,funder_name:string,award_number:string,award_uri:string>>").alias("funders"),
        _list(relations, "array<struct<relation_type:string,related_identifier:string,related_identifier_type:string>>").alias("relations"),
    )


def crossref(raw: DataFrame) -> DataFrame:
    """Rows with a DOI. A funder counts once per award; a relation's id_type is 'doi' exactly if a DOI was found in it."""
    df = raw.where(has_doi("DOI")).withColumn("_doi", doi_in("DOI"))
    df = df.withColumn("_f", F.filter("funder", lambda f: f["award"].isNotNull()))
    df = df.withColumn("_fd", _dois_in(F.transform("_f", lambda f: f["DOI"])))
    numbers = lambda f: F.flatten(F.transform(F.array_compact(f["award"]), lambda a: split_list(a)))
    funders = F.flatten(F.transform("_f", lambda f, i: F.transform(numbers(f), lambda n: F.struct(f["name"].alias("name"), F.get("_fd", i).alias("funder_doi"), n.alias("award")))))
    flat = F.flatten(F.transform(F.map_entries("relation"), lambda e: F.transform(e["value"], lambda r: F.struct(e["key"].alias("kind"), r.alias("r")))))
    df = df.withColumn("_r", flat).withColumn("_rd", _dois_in(F.transform("_r", lambda x: x["r"]["id"])))
    relations = F.transform("_r", lambda x, i: F.struct(
        x["kind"].alias("relation_type"), F.coalesce(F.get("_rd", i), x["r"]["id"]).alias("relation_id"),
        F.when(F.get("_rd", i).isNotNull(), "doi").otherwise(F.when(x["r"]["id-type"] != "doi", x["r"]["id-type"])).alias("id_type"), x["r"]["asserted-by"].alias("asserted_by"),
    ))
    return df.select(
        F.col("_doi").alias("doi"), strip_markup(first_present("title")).alias("title"), strip_markup("abstract").alias("abstract"), iso_timestamp("deposited.date-time").alias("updated_date"),
        _list(funders, "array<struct<name:string,funder_doi:string,award:string>>").alias("funders"),
        _list(relations, "array<struct<relation_type:string,relation_id:string,id_type:string,asserted_by:string>>").alias("relations"),
    )


def ror(raw: DataFrame) -> DataFrame:
    return raw.select("id", F.transform("external_ids", lambda e: F.struct(e["type"].alias("type"), e["all"].alias("all_ids"))).alias("external_ids"))


def dmps(raw: DataFrame, prefix: str = "10.48321") -> DataFrame:
    """Plans from rows whose lists are JSON text, each list in its fixed order and without repeats."""
    institutions = F.array_sort(F.from_json("institutions", "array<struct<name:string,affiliation_id:string>>"), lambda a, b: _by(a, b, "name"))
    authors = F.array_sort(F.from_json("authors", "array<struct<orcid:string,given_name:string,surname:string,is_primary_contact:boolean,created:string>>"), lambda a, b: F.when(F.coalesce(a["is_primary_contact"], F.lit(False)) != F.coalesce(b["is_primary_contact"], F.lit(False)), F.when(a["is_primary_contact"], -1).otherwise(1)).otherwise(_by(a, b, "created")))
    funding = F.array_sort(F.from_json("funding", "array<struct<funder_name:string,funder_id:string,status:string,funder_opportunity_id:string,grant_id:string,funder_project_number:string,created:string>>"), lambda a, b: _by(a, b, "created"))
    df = raw.withColumn("_doi", doi_with_prefix("doi", prefix)).where("_doi IS NOT NULL")
    df = _authors(df.withColumn("_a", authors), F.transform("_a", lambda a: F.struct(a["given_name"].alias("given"), a["surname"].alias("surname"), F.concat_ws(" ", clean(a["given_name"]), clean(a["surname"])).alias("full"))), F.transform("_a", lambda a: orcid_in(a["orcid"])))
    fund = lambda f: F.struct(F.struct(clean(f["funder_name"]).alias("name"), ror_in(f["funder_id"]).alias("ror")).alias("funder"), null_if_listed(f["funder_opportunity_id"], NO_AWARD).alias("funding_opportunity_id"), f["status"].alias("status"), null_if_listed(f["grant_id"], NO_AWARD).alias("award_id"), null_if_listed(f["funder_project_number"], NO_AWARD).alias("funder_project_number"))
    outputs = _dois_in(F.transform(F.from_json("published_outputs", "array<struct<doi:string>>"), lambda o: o["doi"]))
    return df.select(
        F.col("_doi").alias("doi"), "created", "registered", "modified", strip_markup("title").alias("title"), strip_markup("abstract_text").alias("abstract_text"), iso_date("project_start").alias("project_start"), iso_date("project_end").alias("project_end"),
        F.filter(_each(institutions, lambda i: F.struct(clean(i["name"]).alias("name"), ror_in(i["affiliation_id"]).alias("ror"))), lambda i: any_filled(i["name"], i["ror"])).alias("institutions"), "authors",
        _each(funding, fund).alias("funding"), F.transform(F.array_sort(F.array_distinct(F.array_compact(outputs))), lambda d: F.struct(d.alias("doi"))).alias("published_outputs"),
    )


def _by(a: Column, b: Column, field: str) -> Column:
    """Comparison by a field, nulls last."""
    x, y = a[field], b[field]
    return F.when(x.isNull() & y.isNull(), 0).when(x.isNull(), 1).when(y.isNull(), -1).when(x < y, -1).when(x > y, 1).otherwise(0)


def subset(df: DataFrame, doi: str, institutions: str | None, dois: DataFrame | None = None, rors: DataFrame | None = None) -> DataFrame:
    """Rows whose doi is listed or one of whose institutions (array of ids) is. Without lists, nothing is kept.

    dois: doi. rors: ror. The lists are joined as semi joins, so their size is not bounded by the driver.
    """
    kept = []
    if dois is not None:
        kept.append(df.join(dois.select(F.col("doi").alias("_k")).distinct(), F.col(doi) == F.col("_k"), "left_semi").select(doi))
    if rors is not None and institutions:
        each = df.select(doi, F.explode(institutions).alias("_r"))
        kept.append(each.join(rors.select(F.col("ror").alias("_k")).distinct(), F.col("_r") == F.col("_k"), "left_semi").select(doi))
    if not kept:
        return df.limit(0)
    keys = kept[0] if len(kept) == 1 else kept[0].unionByName(kept[1])
    return df.join(keys.distinct(), doi, "left_semi")


def drop_invalid_dmps(dmps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound, rejected): a plan needs a doi and, if it has one, a project start after 1900-01-01."""
    sound = F.col("doi").isNotNull() & (F.col("project_start").isNull() | (F.col("project_start") > F.lit("1900-01-01").cast("date")))
    return dmps.where(sound), dmps.where(~sound)


def stale(enriched: str = "external_updated", modified: str = "modified") -> Column:
    """Whether a plan must be enriched (again): never was, or was modified at or after that."""
    return F.col(enriched).isNull() | (F.col(modified).isNotNull() & (F.col(modified) >= F.col(enriched)))


