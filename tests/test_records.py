import datetime as dt
import gzip
import json

from citeloom.plans import outputs
from citeloom.sources import files, records


def raw(spark, tmp_path, schema, *objects):
    path = tmp_path / "raw.jsonl.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join([*map(json.dumps, objects), "", "{broken"]) + "\n")
    return files.json_lines(spark, str(path), schema)


def test_openalex(spark, tmp_path):
    work = {
        "id": "https://openalex.org/W1", "doi": "https://doi.org/10.1/ABC", "ids": {"mag": 7, "pmid": "https://pubmed.ncbi.nlm.nih.gov/9", "doi": "https://doi.org/10.1/ABC"}, "title": "<i>A</i> title",
        "abstract_inverted_index": {"Hello": [0], "world": [1]}, "type": "article", "publication_date": "2024-02-03", "updated_date": "2024-02-03T01:02:03", "primary_location": {"source": {"display_name": "Venue"}},
        "authorships": [{"author": {"display_name": "Jane Roe", "orcid": "https://orcid.org/0000-0001-2345-678X"}, "institutions": [{"display_name": "U", "ror": "https://ror.org/01AB"}, {"display_name": "U", "ror": "https://ror.org/01ab"}]}, {"author": {}, "institutions": []}],
        "funders": [{"id": "https://openalex.org/F1", "display_name": "Fund", "ror": None}], "awards": [{"id": "https://openalex.org/G1", "funder_award_id": "A1, B2", "doi": "10.9/x"}, {"id": "https://openalex.org/G2"}],
    }
    df = records.openalex(raw(spark, tmp_path, records.OPENALEX, work, {"id": "x", "title": "no doi"}, work | {"is_xpac": True, "doi": "10.1/xp"}))
    got = df.collect()
    assert [r["doi"] for r in got] == ["10.1/abc"]
    r = got[0]
    assert (r["id"], r["title"], r["abstract"], r["work_type"], r["publication_venue"]) == ("w1", "A title", "Hello world", "article", "Venue")
    assert r["publication_date"] == dt.date(2024, 2, 3) and r["updated_date"] == dt.datetime(2024, 2, 3, 1, 2, 3)
    assert [(a["orcid"], a["first_initial"], a["surname"], a["full"]) for a in r["authors"]] == [("0000-0001-2345-678x", "J", "Roe", "Jane Roe")]
    assert [tuple(i) for i in r["institutions"]] == [("U", "01ab")] and [a["funder_award_id"] for a in r["awards"]] == ["A1", "B2"] and r["ids"]["pmid"] == "9"


def test_datacite(spark, tmp_path):
    person = {"name": "Roe, Jane", "nameType": "Personal", "nameIdentifiers": {"nameIdentifier": "https://orcid.org/0000-0001-2345-6789"}, "affiliation": [{"name": "U", "affiliationIdentifier": "https://ror.org/01AB"}]}
    work = {"id": "10.2/DS", "attributes": {
        "titles": [{"title": " "}, {"title": "T"}], "descriptions": [{"description": ":unav"}], "types": {"resourceTypeGeneral": "Dataset"}, "created": "2024-01-02T00:00:00Z", "updated": "2024-01-03T00:00:00Z", "publisher": {"name": "P"},
        "creators": [person, {"name": "Org", "nameType": "Organizational", "affiliation": [{"name": "Hidden"}]}], "fundingReferences": [{"funderName": "F", "award_number": "1,2"}, {"funderName": "None"}],
        "relatedIdentifiers": [{"relationType": "IsPartOf", "relatedIdentifier": "https://doi.org/10.3/Ó", "relatedIdentifierType": "URL"}, {"relationType": "IsPartOf", "relatedIdentifier": "abc", "relatedIdentifierType": "DOI"}],
    }}
    r = records.datacite(raw(spark, tmp_path, records.DATACITE, work, {"id": "none"})).collect()
    assert len(r) == 1 and (r[0]["doi"], r[0]["title"], r[0]["abstract"], r[0]["work_type"]) == ("10.2/ds", "T", None, "Dataset")
    assert [(a["orcid"], a["given_name"], a["surname"]) for a in r[0]["authors"]] == [("0000-0001-2345-6789", "Jane", "Roe")] and [i["name"] for i in r[0]["institutions"]] == ["U"]
    assert [f["award_number"] for f in r[0]["funders"]] == ["1", "2"] and [tuple(x) for x in r[0]["relations"]] == [("IsPartOf", "10.3/ó", "DOI"), ("IsPartOf", "abc", None)]


def test_crossref(spark, tmp_path):
    work = {"DOI": "10.4/A", "title": ["T"], "abstract": "<jats:p>Text</jats:p>", "deposited": {"date-time": "2024-01-02T00:00:00Z"}, "funder": [{"DOI": "10.13039/1", "name": "F", "award": ["x, y", None]}, {"name": "G"}],
            "relation": {"is-part-of": [{"id": "10.5/B", "id-type": "uri", "asserted-by": "subject"}], "cites": [{"id": "q", "id-type": "doi"}]}}
    r = records.crossref(raw(spark, tmp_path, records.CROSSREF, work)).collect()[0]
    assert (r["doi"], r["title"], r["abstract"], str(r["updated_date"])) == ("10.4/a", "T", "Text", "2024-01-02 00:00:00")
    assert [(f["name"], f["funder_doi"], f["award"]) for f in r["funders"]] == [("F", "10.13039/1", "x"), ("F", "10.13039/1", "y")]
    assert sorted(map(repr, (tuple(x) for x in r["relations"]))) == sorted(map(repr, [("is-part-of", "10.5/b", "doi", "subject"), ("cites", "q", None, None)]))


def test_dmps_and_enrichment(spark):
    row = ("D1", None, None, None, "<b>Plan</b>", None, "2024-01-01", "bad", json.dumps([{"name": None, "affiliation_id": "https://ror.org/01ab23456"}, {"name": "A"}]), json.dumps([{"given_name": "B", "surname": "Two", "created": "2"}, {"given_name": "A", "surname": "One", "is_primary_contact": True}]),
           json.dumps([{"funder_name": "NIH", "funder_id": "https://ror.org/01cwqze88", "grant_id": "R01AI176039", "funder_opportunity_id": "N/A"}]), json.dumps([{"doi": "10.9/Z"}, {"doi": "10.9/a"}, {"doi": "10.9/z"}]))
    plans = records.dmps(spark.createDataFrame([row], records.DMPS))
    r = plans.first()
    assert r["doi"] == "10.48321/d1" and r["title"] == "Plan" and r["project_end"] is None and [i["name"] for i in r["institutions"]] == ["A", None]
    assert [a["surname"] for a in r["authors"]] == ["One", "Two"] and [o["doi"] for o in r["published_outputs"]] == ["10.9/a", "10.9/z"] and r["funding"][0]["funding_opportunity_id"] is None
    dois = spark.createDataFrame([("R01AI176039", "10.9/f")], "award string, doi string")
    e = outputs.enriched(plans, dois).first()
    assert e["funded_dois"] == ["10.9/f"] and e["awards"][0]["award"] == "R01AI176039" and "R01 AI 176039" in e["awards"][0]["variants"] and e["funders"][0]["name"] == "NIH"


def test_subset_and_files(spark, tmp_path):
    df = spark.createDataFrame([("a", ["r1"]), ("b", ["r2"]), ("c", None)], "doi string, rors array<string>")
    dois, rors = spark.createDataFrame([("c",)], "doi string"), spark.createDataFrame([("r1",)], "ror string")
    assert sorted(r[0] for r in records.subset(df, "doi", "rors", dois, rors).collect()) == ["a", "c"] and records.subset(df, "doi", "rors").count() == 0
    files.write_json_lines(df.limit(0), str(tmp_path / "empty"))
    assert [p.name for p in (tmp_path / "empty").iterdir() if p.name.startswith("part")] != []
    files.write_parquet(df, str(tmp_path / "p"), rows_per_file=1)
    assert files.parquet(spark, str(tmp_path / "p"), ["doi"]).count() == 3
