import datetime as dt

import pytest
from pyspark.sql import functions as F

from citeloom.matching import ranking, signals
from citeloom.plans import outputs

PLAN = """doi string, title string, abstract_text string, project_start date, project_end date, authors array<struct<orcid:string,surname:string>>, institutions array<struct<name:string,ror:string>>,
funders array<struct<name:string,ror:string>>, awards array<struct<award:string,variants:array<string>>>, funded_dois array<string>, published_outputs array<struct<doi:string>>"""
WORK = """doi string, hash string, title string, abstract_text string, work_type string, publication_date date, publication_venue string, authors array<struct<orcid:string,surname:string,full:string>>,
institutions array<struct<name:string,ror:string>>, funders array<struct<name:string,ror:string>>, awards array<struct<award_id:string>>,
relations struct<intra_work_dois:array<struct<doi:string>>,possible_shared_project_dois:array<struct<doi:string>>,dataset_citation_dois:array<struct<doi:string>>>, source struct<name:string,url:string>"""


def work(doi, authors=(), institutions=(), funders=(), awards=(), intra=(), shared=(), data=(), kind="ARTICLE", year=2021, title=""):
    link = lambda xs: [(x,) for x in xs]
    return (doi, "00ff", title, None, kind, dt.date(year, 1, 1), None, list(authors), list(institutions), list(funders), link(awards), (link(intra), link(shared), link(data)), ("S", "u"))


@pytest.fixture
def tables(spark):
    plan = ("p1", "ice cores", None, dt.date(2020, 1, 1), dt.date(2022, 1, 1), [("o1", "van Dyk"), (None, "Lee")], [("Polar Lab", "r1")], [("Fund", "f1")], [("A1", ["A1", "A 1"])], ["w_fund"], [("out1",)])
    works = [
        work("w_fund"), work("w_author", [("o1", "x", "Anna van Dyk"), (None, "Lee", "Bo Lee"), (None, "Lee", "Cy Lee")], [("The Polar Research Lab", None), ("Other", "r9")]), work("w_award", awards=["a 1", "A1"], funders=[("x", "f1")]),
        work("w_intra", intra=["out1"], shared=["out1"], data=["out1"]), work("w_should", institutions=[("Polar Lab", "r1")]), work("w_plan", awards=["A1"], kind="OUTPUT_MANAGEMENT_PLAN"),
        work("w_early", awards=["A1"], year=2019), work("w_late", awards=["A1"], year=2026), work("w_undated", awards=["zz"]),
    ]
    return spark.createDataFrame([plan], PLAN), spark.createDataFrame(works, WORK)


def test_scores_filters_and_ranks(tables):
    got = {r["doi"]: r for r in signals.match(*tables, signals.Weights(content=0)).collect()}
    # author: the mean of 2 (same ORCID), 1 and 1; institution: a loose phrase, 1
    assert {d: round(r["score"], 4) for d, r in got.items()} == {"w_fund": 15.0, "w_author": round(4 / 3 + 1, 4), "w_award": 12.0, "w_intra": 17.5}
    assert [r["doi"] for r in sorted(got.values(), key=lambda r: r["rank"])] == ["w_intra", "w_fund", "w_award", "w_author"] and got["w_award"]["score_max"] == 17.5
    assert got["w_intra"]["signals"] == {"dataset": 2.5, "same_project": 5.0, "same_work": 10.0}
    total = {r["doi"]: r["score"] for r in signals.match(*tables, signals.Weights(content=0, mode="sum", institution=0), k=2).collect()}
    assert total == {"w_intra": 17.5, "w_fund": 15.0}
    assert signals.match(*tables, signals.Weights(funded=0, author=0, same_work=0, same_project=0, dataset=0, content=0)).count() == 1


def test_content_adds_only_to_candidates(spark, tables):
    plans, works = tables
    more = spark.createDataFrame([work(f"n{i}", title="ice cores of old" if i < 6 else "other words") for i in range(20)] + [work("hit", awards=["A1"], title="ice cores")], WORK)
    got = {r["doi"]: r["score"] for r in signals.match(plans, works.unionByName(more)).collect()}
    assert got["hit"] > 10 and not any(d.startswith("n") for d in got)


def test_explanation_and_rows(tables):
    plans, works = tables
    found = signals.explain(signals.match(plans, works, signals.Weights(content=0)), plans, works)
    by = {r["doi"]: r for r in found.collect()}
    assert by["w_fund"]["doi_match"]["found"] and [tuple(x) for x in by["w_award"]["award_matches"]] == [(0, 10.0, ["award_id"]), (1, 10.0, ["award_id"])]
    assert [(x["index"], x["score"]) for x in by["w_author"]["author_matches"]] == [(0, 2.0), (1, 1.0), (2, 1.0)] and len(by["w_intra"]["dataset_citation_doi_matches"]) == 1
    assert signals.by_plan(found).first()["works"][0]["doi"] == "w_intra"
    rel = outputs.related_works(found)
    assert rel.count() == 4 and outputs.work_versions(found, works).first()["hash"] == b"\x00\xff"
    kept = outputs.merge_related(rel.limit(0), rel, plans.select(F.col("doi").alias("dmp_doi")))
    assert kept.count() == 4 and outputs.merge_related(kept, rel, plans.limit(0).select(F.col("doi").alias("dmp_doi"))).count() == 0


def test_highlight(spark):
    df = spark.createDataFrame([("Ice and (ice) cores, iced", ["ice", "cores"])], "t string, w array<string>")
    assert df.select(signals.highlighted("t", F.col("w"))).first()[0] == "<mark>Ice</mark> and (<mark>ice</mark>) <mark>cores</mark>, iced"


def test_features_and_training_rows(spark, tables, tmp_path):
    plans, works = tables
    cands = spark.createDataFrame([("p1", "w_author"), ("p1", "w_award"), ("p1", "w_intra")], "dmp_doi string, doi string")
    rows = ranking.features(cands, plans, works)
    by = {r["work_doi"]: r for r in rows.collect()}
    assert (by["w_author"]["author_orcid_match_count"], by["w_author"]["author_surname_match_count"], by["w_award"]["award_match_count"], by["w_intra"]["intra_work_doi_count"], by["w_intra"]["dmp_author_count"]) == (1, 1, 1, 1, 2)
    judged = ranking.with_judgements(rows, spark.createDataFrame([("p1", "w_award")], "dmp_doi string, work_doi string"))
    lines = {r[0].split("# ")[1].strip(): r[0] for r in judged.select(ranking.ranklib_line()).collect()}
    assert lines["w_award"].startswith("1 qid:p1 1:0.0 2:0 3:1 4:1 ") and lines["w_author"].startswith("0 qid:p1 ")
    judged.select(ranking.ranklib_line()).write.text(str(tmp_path / "r"))
    back = {r["comment"]: r for r in ranking.read_ranklib(spark, str(tmp_path / "r"), 16).collect()}
    assert back["w_award"]["judgement"] == 1 and back["w_award"]["qid"] == "p1" and back["w_award"]["values"][2:4] == [1.0, 1.0]
    z = ranking.z_scored(rows, ["dmp_award_count", "award_match_count"]).where("work_doi = 'w_award'").first()
    assert z["dmp_award_count"] == 0 and round(z["award_match_count"], 3) == round((1 - 1 / 3) / (2 / 9) ** 0.5, 3)


def test_rerank_and_metrics(spark):
    run = spark.createDataFrame([("p", f"d{i}", float(10 - i), float(i)) for i in range(5)], "dmp_doi string, doi string, score double, f double")
    top = ranking.reranked(run, {"f": 1.0}, window=3)
    assert [r["doi"] for r in top.orderBy("rank").collect()] == ["d2", "d1", "d0"]
    good = spark.createDataFrame([("p", "d0"), ("p", "d2"), ("q", "x")], "dmp_doi string, doi string")
    got = {(r["dmp_doi"], r["k"]): r for r in ranking.metrics(run, good, [2, 3]).collect()}
    import math

    assert got["p", 3]["map"] == pytest.approx((1 + 2 / 3) / 2) and got["p", 2]["precision"] == 0.5 and got["p", 2]["recall"] == 0.5 and got["q", 2]["map"] == 0
    assert got["p", 3]["ndcg"] == pytest.approx((1 + 1 / 2) / (1 + 1 / math.log2(3))) and got["all", 3]["map"] == pytest.approx((1 + 2 / 3) / 4)


def test_streamed_changes(spark, tmp_path):
    from citeloom.operators.changes import STATE
    from citeloom.streaming import change_feed

    source = tmp_path / "in"
    for i, rows in enumerate(([("a", "1"), ("b", "1")], [("a", "2"), ("b", "1")])):
        spark.createDataFrame(rows, "doi string, hash string").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("doi string, hash string").parquet(str(source))
        change_feed.start(stream, str(tmp_path / "h"), str(tmp_path / "c"), lambda n: f"2024-0{n + 1}-01").awaitTermination()
    got = spark.read.schema(STATE).parquet(str(tmp_path / "h" / "batch=1"))
    assert sorted((r["doi"], r["hash"], str(r["updated_date"])) for r in got.collect()) == [("a", "1", "2024-01-01"), ("a", "2", "2024-02-01"), ("b", "1", "2024-01-01")]


def test_plan_helpers(spark):
    plans = spark.createDataFrame([(1, "x", 1, dt.datetime(2024, 1, 1)), (2, "x", 2, dt.datetime(2024, 1, 2)), (3, "y", None, dt.datetime(2024, 1, 1))], "id int, dmp_id string, created int, modified timestamp_ntz")
    assert sorted(r["id"] for r in outputs.latest_plans(plans).collect()) == [2, 3]
    related = spark.createDataFrame([(2, "ACCEPTED", dt.datetime(2024, 5, 1)), (3, "PENDING", dt.datetime(2024, 5, 1))], "plan_id int, status string, modified timestamp_ntz")
    assert {r["id"]: r["modified"].month for r in outputs.last_modified(plans, related).collect()} == {1: 1, 2: 5, 3: 1}
    refs, works = spark.createDataFrame([(1, "Deep Íce-cores of the Arctic"), (2, "none")], "id int, title string"), spark.createDataFrame([("w", "Deep ice cores of the arctic"), ("v", "Arctic")], "doi string, title string")
    assert [(r["id"], r["doi"]) for r in outputs.title_matches(refs, works, 90).collect()] == [(1, "w")]
