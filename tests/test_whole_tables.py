"""Queries without a DuckDB twin against brute force over whole tables."""

import math
import re
import unicodedata
from collections import Counter

import pytest

from citeloom import queries


def words_of(text):
    plain = "".join(c for c in unicodedata.normalize("NFD", text or "") if not unicodedata.combining(c))
    return [w for w in re.split(r"[\W_]+", plain.lower()) if w]


def brute_force(items, documents, k=10, most=25, least=5):
    """item, rank: (document, score), by BM25 over every document."""
    docs = {i: words_of(t) for i, t in documents}
    have = Counter(w for ws in docs.values() for w in set(ws))
    idf = {w: math.log(1 + (len(docs) - n + 0.5) / (n + 0.5)) for w, n in have.items()}
    mean, counts, out = sum(map(len, docs.values())) / len(docs), {i: Counter(ws) for i, ws in docs.items()}, {}
    for item, text in items:
        terms = sorted(((-tf * idf[w], w) for w, tf in Counter(words_of(text)).items() if have[w] >= least))[:most]
        scores = []
        for i, tf in counts.items():
            norm = 1.2 * (0.25 + 0.75 * len(docs[i]) / mean)
            found = [idf[w] * tf[w] * 2.2 / (tf[w] + norm) for _, w in terms if tf[w]]
            if found:
                scores.append((-round(sum(found), 9), i))
        for rank, (score, i) in enumerate(sorted(scores)[:k], 1):
            out[item, rank] = (i, -score)
    return out


def test_match_content_scores_documents_without_the_rarest_term(spark, tmp_path):
    documents = [(i, "rare " + f"x{i} " * 3) for i in range(5)] + [(i, f"ice core drilling y{i % 7}") for i in range(5, 30)] + [(i, f"ice Core z{i} " + "other " * (i % 4)) for i in range(30, 50)]
    documents += [(50, "Îce core drilling in the north"), (51, None), (52, ""), (53, "none of these")]
    items = [(1, "rare ice core drilling"), (2, "core of ice"), (3, "unknown words")]
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {(r["dmp_doi"], r["rank"]): (r["doi"], pytest.approx(r["score"], abs=1e-8)) for r in queries.QUERIES["match_content"](spark, str(tmp_path)).collect()}
    want = brute_force(items, documents)
    assert got == want and len(got) == 20 and any(i >= 5 for (item, _), (i, _) in got.items() if item == 1)


def reverted(text):
    """The text's words between single spaces, markup removed; None if nothing is left."""
    return re.sub(r"<\S[^>]*>", "", " ".join(w for w in (text or "").split(" ") if w)).strip() or None


def test_revert_index_keeps_long_texts_line_breaks_and_markup(spark, tmp_path):
    documents = [(1, "a  b a "), (2, "one\ntwo three\n\nfour two"), (3, "<p>some <b>bold</b> words</p> a < b"), (4, " ".join(f"w{i % 700}" for i in range(5000))), (5, ""), (6, None), (7, "same"), (7, "other id"), (None, 'q"\\\t'), (8, " ")]
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.QUERIES["revert_index"](spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(repr((i, reverted(t))) for i, t in documents)
