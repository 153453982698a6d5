import datetime as dt

import pytest
from pyspark.sql import functions as F

from citeloom.operators import audits, changes, keys, relations
from citeloom.plans import works

D = dt.date


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


OA = """id string, doi string, title string, abstract string, work_type string, publication_date date, updated_date timestamp_ntz, publication_venue string,
ids struct<mag:string,pmid:string,pmcid:string>, authors array<struct<orcid:string,full:string>>, institutions array<struct<name:string,ror:string>>,
funders array<struct<id:string,display_name:string,ror:string>>, awards array<struct<funder_award_id:string>>"""
DC = """doi string, title string, abstract string, work_type string, publication_date date, updated_date timestamp_ntz, publication_venue string, authors array<struct<orcid:string,full:string>>,
institutions array<struct<affiliation_identifier:string,name:string>>, funders array<struct<funder_identifier:string,funder_name:string,award_number:string>>,
relations array<struct<relation_type:string,related_identifier:string,related_identifier_type:string>>"""
CR = """doi string, title string, abstract string, updated_date timestamp_ntz, funders array<struct<name:string,funder_doi:string,award:string>>,
relations array<struct<relation_type:string,relation_id:string,id_type:string>>"""


def oa(id, doi, title=None, abstract=None, n=0, awards=(), day=1):
    return (id, doi, title, abstract, "book-chapter", D(2024, 1, day), dt.datetime(2024, 1, day), "V", (None, None, None), [(f"o{i}", f"A {i}") for i in range(n)], [("U", "r")], [("f", "F", "fr")] if n else [], [(a,) for a in awards])


@pytest.fixture
def sources(spark):
    openalex = frame(spark, OA, oa("w1", "d1", "short", None, 1, ["B", "a", None]), oa("w2", "d1", "much longer", "abc", 0), oa("w3", "d2", None, None), oa("w4", "dc1", "x"), oa("w5", None, "y"), oa("w6", "d4", "t", None, 2, day=3))
    datacite = frame(spark, DC,
        ("dc1", "T", "A", "Dataset", D(2024, 1, 1), dt.datetime(2024, 1, 1), "P", [], [("i2", "two"), ("i1", "one"), ("none", "three")], [("f1", "Fund", "N2"), ("zz", "Other", "n1")], [("IsVersionOf", "d1", "DOI"), ("Documents", "d2", "DOI"), ("IsVersionOf", "x", "URL")]),
        ("dc1", "Old", "A", "Text", D(2023, 1, 1), dt.datetime(2023, 1, 1), "P", [], [], [], []),
        ("dc2", "U", None, "Unknown", None, None, None, None, None, None, None))
    crossref = frame(spark, CR, ("d1", "A much longer title here", "ab", dt.datetime(2024, 5, 1), [("F", None, "C")], [("is-preprint-of", "d4", "doi"), ("has-part", "d4", "doi")]), ("d1", "x", "longest abstract", None, None, None), ("d2", "only here", None, None, None, None), ("d2", None, None, None, None, None))
    return openalex, datacite, crossref


def test_crossref_takes_the_longest_abstract(sources):
    assert rows(works.crossref_works(sources[2]), "doi", "title", "title_length", "abstract_length") == [("d1", "x", 1, 16), ("d2", "only here", 9, None)]


def test_openalex_leaves_out_datacite_and_ranks(sources):
    got = rows(works.openalex_works(sources[0], sources[1]), "id", "doi", "doi_count", "orcid_count", "award_id_count", "total_count", "doi_rank", "is_duplicate", "is_primary_doi")
    assert got == [("w1", "d1", 2, 1, 2, 5, 1, True, True), ("w2", "d1", 2, 0, 0, 1, 2, True, False), ("w3", "d2", 1, 0, 0, 1, 1, False, True), ("w6", "d4", 1, 2, 0, 4, 1, False, True)]


def test_longest_text_and_smallest_id_without_lengths(spark):
    w = frame(spark, "id string, doi string, title_length bigint, is_duplicate boolean", ("W2", "a", 5, True), ("W1", "a", 7, True), ("W5", "b", None, True), ("W4", "b", None, True), ("W6", "c", None, False), ("W7", "d", 0, False))
    c = frame(spark, "doi string, title string, title_length bigint", ("b", "other", 5), ("c", "ccc", 3), ("a", "same...", 7))
    stats = works.length_stats(w, c, "title_length")
    assert rows(stats, "id", "doi", "title_length") == [("W1", "a", 7), ("W4", "b", None), ("W6", "c", None)]
    own = frame(spark, "id string, title string", ("W1", "1234567"), ("W4", None), ("W6", None))
    assert rows(works.longest_text(stats, own, c, "title", "title_length"), "doi", "title") == [("a", "1234567"), ("b", "other"), ("c", "ccc")]


def test_registry(spark):
    ror = frame(spark, "id string, external_ids array<struct<type:string,all_ids:array<string>>>", ("https://ror.org/01X", [("isni", ["0000 0001"]), ("fundref", [" 501 "]), ("grid", [])]), ("https://ror.org/02Y", []))
    assert rows(works.ror_identifiers(ror), "ror_id", "type", "identifier") == [("01x", "fundref", "10.13039/501"), ("01x", "isni", "00000001"), ("01x", "ror", "01x"), ("02y", "ror", "02y")]


def test_citations_cap_and_symmetry(spark):
    corpus = frame(spark, "publication string, dataset string, source string", *[("https://doi.org/10.1/HUB", f"10.2/d{i}", "s") for i in range(4)], ("10.1/p", "10.2/d0", "s"), ("10.1/p", "10.2/D0", "t"), ("10.1/ó", "10.2/n", "s"), (None, "10.2/x", "s"))
    got = rows(works.dataset_citations(corpus, 3), "doi", "dataset_citation_dois")
    assert got == [("10.1/p", ["10.2/d0"]), ("10.1/ó", ["10.2/n"]), ("10.2/d0", ["10.1/p"]), ("10.2/n", ["10.1/ó"])]


def test_degrees_are_per_type(spark):
    e = frame(spark, "work_doi string, related_doi string, relation_type string", ("a", "x", "t"), ("a", "y", "t"), ("a", "x", "u"), ("b", "x", "t"), ("a", "x", "t"), ("c", "x", None))
    got = rows(relations.with_degrees(e, "work_doi", "related_doi", "relation_type"), "work_doi", "related_doi", "relation_type", "out_degree", "in_degree")
    assert got == [("a", "x", "t", 2, 2), ("a", "x", "u", 1, 1), ("a", "y", "t", 2, 1), ("b", "x", "t", 1, 2), ("c", "x", None, 1, 1)]


def release(spark, sources, date, history=None, drop=None):
    openalex, datacite, crossref = sources
    if drop:
        openalex = openalex.where(F.col("doi") != drop)
    ror = frame(spark, "id string, external_ids array<struct<type:string,all_ids:array<string>>>", ("https://ror.org/r1", [("grid", ["i1"])]), ("https://ror.org/r2", [("grid", ["i2"])]), ("https://ror.org/r3", [("grid", ["i2"])]), ("https://ror.org/rf", [("grid", ["f1"])]))
    corpus = frame(spark, "publication string, dataset string, source string", ("10.1/d1", "10.2/x", "s"))
    return works.Release(openalex, datacite, crossref, ror, corpus, date, history, most_states=2).build()


def test_whole_release(spark, sources, tmp_path):
    out = release(spark, sources, "2024-01-01")
    dc = {r["doi"]: r for r in out["datacite_index"].collect()}
    assert set(dc) == {"dc1", "dc2"} and dc["dc1"]["title"] == "T" and dc["dc1"]["work_type"] == "DATASET" and dc["dc2"]["work_type"] == "OTHER"
    # in the creators' order; an identifier of two organisations gives two entries; an unknown one none
    assert [tuple(i) for i in dc["dc1"]["institutions"]] == [("two", "r2"), ("two", "r3"), ("one", "r1"), ("three", None)]
    assert [tuple(i) for i in dc["dc1"]["funders"]] == [("Fund", "rf"), ("Other", None)] and [a[0] for a in dc["dc1"]["awards"]] == ["n1", "N2"]
    assert dc["dc2"]["institutions"] == [] and dc["dc2"]["relations"]["intra_work_dois"] == []
    oa_ = {r["doi"]: r for r in out["openalex_index"].collect()}
    assert set(oa_) == {"d1", "d2", "d4"} and oa_["d2"]["title"] == "only here" and oa_["d1"]["work_type"] == "BOOK_CHAPTER"
    assert oa_["d1"]["title"] == "much longer" and oa_["d1"]["abstract_text"] == "longest abstract"
    assert [a[0] for a in oa_["d1"]["awards"]] == ["a", "B", "C"] and oa_["d1"]["updated_date"] == dt.datetime(2024, 5, 1)
    assert [x[0] for x in oa_["d1"]["relations"]["intra_work_dois"]] == ["d4", "dc1"] and [x[0] for x in oa_["d4"]["relations"]["possible_shared_project_dois"]] == ["d1"]
    first = out["history"]
    first.write.parquet(str(tmp_path / "h1"))
    h1 = spark.read.parquet(str(tmp_path / "h1"))
    assert rows(h1, "doi", "state") == [(d, "UPSERT") for d in ("d1", "d2", "d4", "dc1", "dc2")] and out["export"].count() == 5
    again = release(spark, sources, "2024-02-01", h1, drop="d4")
    assert rows(again["history"].where("updated_date = '2024-02-01'"), "doi", "state") == [("d4", "DELETE")]
    assert again["export"].count() == 0


def test_history_life_cycle(spark):
    now = lambda *r: frame(spark, "doi string, hash string", *r)
    h = changes.next_history(changes.no_states(spark), now(("a", "1"), ("b", "1"), ("a", "1")), "2024-01-01", 2)
    h = changes.next_history(h, now(("a", "2"), ("b", "1"), ("c", "1")), "2024-02-01", 2)
    h = changes.next_history(h, now(("a", "3"), ("c", "1")), "2024-03-01", 2)
    assert rows(h, "doi", "hash", "state", F.col("updated_date").cast("string")) == sorted([("a", "3", "UPSERT", "2024-03-01"), ("a", "2", "UPSERT", "2024-02-01"), ("b", "1", "DELETE", "2024-03-01"), ("b", "1", "UPSERT", "2024-01-01"), ("c", "1", "UPSERT", "2024-02-01")], key=repr)
    h = changes.next_history(h, now(("b", "1"), ("c", "1"), ("a", "3")), "2024-04-01", 2)
    assert rows(changes.of_release(h, "UPSERT", "2024-04-01"), "doi") == [("b",)]


def test_apply_insert_and_audits(spark):
    index, up, gone = (frame(spark, "doi string, v int", *r) for r in ([("a", 1), ("b", 1)], [("b", 2), ("c", 2)], [("a", 0)]))
    assert rows(changes.applied(index, up, gone), "doi", "v") == [("b", 2), ("c", 2)]
    assert rows(changes.inserted(index, up.unionByName(up), ["doi"]), "doi", "v") == [("a", 1), ("b", 1), ("c", 2)]
    df = frame(spark, "k string, l array<int>", ("", [1, 2, 3]), ("x", []), ("x", None))
    checks = [audits.not_empty("k"), audits.accepted("k", ["x"]), audits.not_longer("l", 2)]
    assert rows(audits.run(df, checks), "audit", "failures") == [("accepted_values", 1), ("max_array_length", 1), ("not_empty_string", 1)]
    assert audits.duplicates(df, "k").first()["failures"] == 1 and audits.fewer_rows(df, 5).first()["failures"] == 2
    with pytest.raises(ValueError):
        audits.enforce(df, checks)
    audits.enforce(df, checks[:1])


def test_first_n_is_certain_on_ties(spark):
    df = frame(spark, "k string, t int, id int", ("a", 1, 2), ("a", 1, 1), ("a", None, 0), ("b", None, 3))
    assert rows(keys.latest(df, "k", "t", "id"), "k", "id") == [("a", 1), ("b", 3)]
