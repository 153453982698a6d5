"""The engine's operators applied to the driver's tables, each with its DuckDB twin.

The tables hold no bibliographic records, so each query gives an operator columns of the same shape: orders stand for
works, lineitem for relations, events for release states, conversations for plans.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.functions import awards as A
from citeloom.functions import identifiers as I
from citeloom.functions import text as X
from citeloom.matching import ranking, signals
from citeloom.operators import audits, changes, keys, lists, relations
from citeloom.operators.stages import materialise
from citeloom.plans import works
from citeloom.sources import records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CAP_OUT, CAP_IN, RELEASE = 5, 30, "2024-06-01"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str | Column) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def joined(array: str | Column, mark: str = ",") -> Column:
    return F.array_join(array, mark)


@query("""SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1""")
def dedup_latest(spark, d):
    return keys.latest(table(spark, d, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@query("""SELECT source, doc_id, length(text) AS text_length FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY length(text) DESC NULLS LAST, length(lang) DESC NULLS LAST, doc_id) = 1""")
def dedup_longest(spark, d):
    rows = keys.richest(table(spark, d, "documents", "source", "doc_id", "text", "lang"), "source", ["text", "lang"], "doc_id")
    return rows.select("source", "doc_id", F.length("text").cast("long").alias("text_length"))


@query("""SELECT doc_id, md5(text) AS doi, count(*) OVER (PARTITION BY md5(text)) AS doi_count,
row_number() OVER (PARTITION BY md5(text) ORDER BY n_chars DESC, doc_id) AS doi_rank,
count(*) OVER (PARTITION BY md5(text)) > 1 AS is_duplicate,
row_number() OVER (PARTITION BY md5(text) ORDER BY n_chars DESC, doc_id) = 1 AS is_primary_doi FROM documents""")
def exact_dup_rank(spark, d):
    rows = table(spark, d, "documents", "doc_id", "text", "n_chars").select("doc_id", F.md5("text").alias("doi"), "n_chars")
    return works.ranked_copies(rows, "doi", "n_chars", "doc_id").drop("n_chars")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_join_exclude(spark, d):
    return table(spark, d, "documents", "doc_id", "lang").join(table(spark, d, "labels", "doc_id"), "doc_id", "left_anti")


def _shared_key() -> Column:
    """A key that several documents share: source, language and size."""
    return F.md5(F.concat_ws("/", "source", "lang", F.expr("n_chars div 100").cast("string")))


_DUP = """SELECT doc_id AS id, md5(concat_ws('/', source, lang, n_chars // 100)) AS doi, length(text) AS title_length,
count(*) OVER (PARTITION BY md5(concat_ws('/', source, lang, n_chars // 100))) > 1 AS is_duplicate FROM documents"""


def _copies(spark, d) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), _shared_key().alias("doi"), F.length("text").cast("long").alias("title_length"))
    return keys.with_counts(rows, "doi", "n").withColumn("is_duplicate", F.col("n") > 1).drop("n")


def _others(spark, d) -> DataFrame:
    """Every other text as a second source."""
    rows = table(spark, d, "documents").where("lang = 'en'")
    return rows.groupBy(_shared_key().alias("doi")).agg(F.max(F.length("text")).cast("long").alias("title_length"), F.min("text").alias("title"))


_OTHER = "SELECT md5(concat_ws('/', source, lang, n_chars // 100)) AS doi, max(length(text)) AS title_length, min(text) AS title FROM documents WHERE lang = 'en' GROUP BY 1"
_STATS = f"""WITH w AS ({_DUP}), c AS ({_OTHER}), b AS (SELECT w.*, c.title_length AS other FROM w LEFT JOIN c USING (doi) WHERE w.title_length > 0 OR c.title_length > 0),
s AS (SELECT coalesce(min(id) FILTER (WHERE title_length = m), min(id)) AS id, doi, max(title_length) AS title_length
FROM (SELECT *, max(title_length) OVER (PARTITION BY doi) AS m FROM b WHERE is_duplicate) GROUP BY doi
UNION ALL SELECT id, doi, title_length FROM b WHERE NOT is_duplicate)"""


@query(f"{_STATS} SELECT id, doi, title_length FROM s")
def longest_of_duplicates(spark, d):
    return works.length_stats(_copies(spark, d), _others(spark, d), "title_length")


@query(f"""{_STATS} SELECT s.doi, md5(CASE WHEN c.title_length IS NOT NULL AND (s.title_length IS NULL OR c.title_length > s.title_length) THEN c.title ELSE o.text END) AS title_hash
FROM s LEFT JOIN documents o ON o.doc_id = s.id LEFT JOIN c ON c.doi = s.doi""")
def choose_longest(spark, d):
    own = table(spark, d, "documents", "doc_id", "text").select(F.col("doc_id").alias("id"), F.col("text").alias("title"))
    other = _others(spark, d)
    best = works.longest_text(works.length_stats(_copies(spark, d), other, "title_length"), own, other, "title", "title_length")
    return best.select("doi", F.md5("title").alias("title_hash"))


@query("""SELECT k, max(t) AS t FROM (SELECT o_orderkey AS k, o_orderdate AS t FROM orders WHERE o_orderdate IS NOT NULL
UNION ALL SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_shipdate IS NOT NULL) GROUP BY k""")
def latest_of_two_sources(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("t"))
    return keys.latest_of("k", "t", a, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("t")))


@query("""SELECT p_partkey, coalesce(m.t, 'OTHER') AS work_type FROM part LEFT JOIN (VALUES ('Dataset','DATASET'),('Text','ARTICLE'),('Film','AUDIO_VISUAL')) m(o, t)
ON m.o = CASE p_size % 4 WHEN 0 THEN 'Dataset' WHEN 1 THEN 'Text' WHEN 2 THEN 'Film' ELSE 'Unheard' END""")
def type_map(spark, d):
    kind = F.when(F.col("p_size") % 4 == 0, "Dataset").when(F.col("p_size") % 4 == 1, "Text").when(F.col("p_size") % 4 == 2, "Film").otherwise("Unheard")
    return table(spark, d, "part", "p_partkey", "p_size").withColumn("kind", kind).select("p_partkey", F.coalesce(works.work_type("kind"), F.lit("OTHER")).alias("work_type"))


@query("""SELECT l_orderkey, string_agg(CAST(l_suppkey AS VARCHAR) || ':' || coalesce(s_name, ''), ',' ORDER BY l_linenumber, l_suppkey) AS items
FROM (SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem) LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON l_suppkey = s_suppkey GROUP BY l_orderkey""")
def ordered_struct_agg(spark, d):
    lines = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_suppkey").alias("supp")))).alias("institutions"))
    found = lists.ordered_lookup(lines, "l_orderkey", "institutions", "supp", table(spark, d, "supplier", "s_suppkey", "s_name").where("s_suppkey % 2 = 0"), "s_suppkey", [F.col("e.supp").alias("name"), F.col("s_name").alias("ror")], "items")
    return found.select("l_orderkey", joined(F.transform("items", lambda x: F.concat(x["name"].cast("string"), F.lit(":"), F.coalesce(x["ror"], F.lit(""))))).alias("items"))


@query("""WITH r AS (SELECT l_orderkey AS k, l_returnflag || l_linestatus AS v FROM lineitem UNION ALL SELECT o_orderkey, lower(o_orderpriority) FROM orders)
SELECT k, string_agg(v, ',' ORDER BY lower(v), v) AS awards FROM (SELECT DISTINCT k, v FROM r WHERE v IS NOT NULL) GROUP BY k""")
def distinct_sorted_ids(spark, d):
    a = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.concat("l_returnflag", "l_linestatus").alias("v"))
    b = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lower("o_orderpriority").alias("v"))
    return lists.distinct_list("k", "v", "awards", "award_id", a, b).select("k", joined("awards.award_id").alias("awards"))


@query("""SELECT c_custkey, n_name, r_name, coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey), '') AS orders, max(o_orderdate) AS last_order
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, 3""")
def index_assemble(spark, d):
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("_o"), F.max("o_orderdate").alias("last_order"))
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    out = table(spark, d, "customer", "c_custkey", "c_nationkey").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(orders, "c_custkey", "left")
    return out.select("c_custkey", "n_name", "r_name", joined(I.or_empty("_o", "bigint").cast("array<string>")).alias("orders"), "last_order")


_EDGES = "SELECT DISTINCT l_orderkey AS work_doi, l_partkey + 10000000 AS related_doi, l_returnflag AS relation_type FROM lineitem"
_DEGREES = f"SELECT *, count(*) OVER (PARTITION BY work_doi, relation_type) AS out_degree, count(*) OVER (PARTITION BY related_doi, relation_type) AS in_degree FROM ({_EDGES})"


def _edges(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("work_doi"), (F.col("l_partkey") + 10000000).alias("related_doi"), F.col("l_returnflag").alias("relation_type"))


@query(_DEGREES)
def relation_degrees(spark, d):
    return relations.with_degrees(_edges(spark, d), "work_doi", "related_doi", "relation_type")


_TYPED = f"""WITH near AS (SELECT unnest([work_doi, related_doi]) AS doi, unnest([related_doi, work_doi]) AS o, relation_type AS t FROM ({_DEGREES})
WHERE greatest(out_degree, in_degree) <= {CAP_IN} AND relation_type <> 'R'),
typed AS (SELECT doi, list_sort(list_distinct(coalesce(list(o) FILTER (t = 'A'), []))) AS a, list_sort(list_distinct(coalesce(list(o) FILTER (t = 'N'), []))) AS b FROM near GROUP BY doi)"""
_TEXT = "array_to_string({}, ',')"


@query(f"{_TYPED} SELECT doi, {_TEXT.format('a')} AS intra_work_dois, {_TEXT.format('b')} AS possible_shared_project_dois FROM typed")
def relations_symmetric(spark, d):
    degrees = relations.with_degrees(_edges(spark, d), "work_doi", "related_doi", "relation_type")
    out = relations.typed_neighbours(degrees, ["A"], ["N"], CAP_IN)
    return out.select("doi", *[joined(F.col(c).cast("array<string>")).alias(c) for c in ("intra_work_dois", "possible_shared_project_dois")])


_CITED = f"""SELECT work_doi, dataset_doi FROM (SELECT *, count(*) OVER (PARTITION BY work_doi) AS o, count(*) OVER (PARTITION BY dataset_doi) AS i
FROM (SELECT DISTINCT l_orderkey AS work_doi, l_partkey + 10000000 AS dataset_doi FROM lineitem)) WHERE o <= {CAP_OUT} AND i <= {CAP_OUT * 8}"""
_CITATIONS = f"SELECT doi, list_sort(array_agg(DISTINCT o)) AS l FROM (SELECT work_doi AS doi, dataset_doi AS o FROM ({_CITED}) UNION ALL SELECT dataset_doi, work_doi FROM ({_CITED})) GROUP BY doi"


def _citations(spark, d) -> DataFrame:
    pairs = _edges(spark, d).select("work_doi", F.col("related_doi").alias("dataset_doi"))
    capped = relations.with_degrees(pairs, "work_doi", "dataset_doi").where((F.col("out_degree") <= CAP_OUT) & (F.col("in_degree") <= CAP_OUT * 8))
    return relations.citations(capped, "work_doi", "dataset_doi", CAP_OUT * 8)


@query(f"SELECT doi, {_TEXT.format('l')} AS dataset_citation_dois FROM ({_CITATIONS})")
def dataset_citations(spark, d):
    return _citations(spark, d).select("doi", joined(F.col("dataset_citation_dois").cast("array<string>")).alias("dataset_citation_dois"))


@query(f"""{_TYPED}, cited AS ({_CITATIONS}), other AS (SELECT work_doi AS doi, list_sort(array_agg(DISTINCT related_doi)) AS a FROM ({_EDGES}) WHERE relation_type = 'R' GROUP BY 1),
k AS (SELECT doi FROM typed UNION SELECT doi FROM other UNION SELECT doi FROM cited)
SELECT k.doi, array_to_string(list_sort(list_distinct(list_concat(coalesce(t.a, []), coalesce(o.a, [])))), ',') AS intra_work_dois,
array_to_string(list_sort(coalesce(t.b, [])), ',') AS possible_shared_project_dois, array_to_string(coalesce(c.l, []), ',') AS dataset_citation_dois
FROM k LEFT JOIN typed t ON t.doi = k.doi LEFT JOIN other o ON o.doi = k.doi LEFT JOIN cited c ON c.doi = k.doi""")
def relations_index(spark, d):
    degrees = relations.with_degrees(_edges(spark, d), "work_doi", "related_doi", "relation_type")
    texts = lambda df: df.select("doi", *[F.transform(c, lambda x: F.lpad(x.cast("string"), 12, "0")).alias(c) for c in df.columns if c != "doi"])
    typed = texts(relations.typed_neighbours(degrees, ["A"], ["N"], CAP_IN))
    other = texts(_edges(spark, d).where("relation_type = 'R'").groupBy(F.col("work_doi").alias("doi")).agg(F.collect_set("related_doi").alias("intra_work_dois"))).withColumn("possible_shared_project_dois", I.empty_array("string"))
    out = relations.merged([typed, other], texts(_citations(spark, d)))
    plain = lambda c: joined(F.transform(F.col(f"{c}.doi"), lambda x: x.cast("bigint").cast("string"))).alias(c)
    return out.select("doi", *[plain(c) for c in out.columns if c != "doi"])


@query("""WITH r AS (SELECT 'https://reg.example/' || upper(r_name) AS id, list_transform([0, 1], lambda i: {'type': CASE i WHEN 0 THEN 'isni' ELSE 'fundref' END, 'ids': list_transform([0, 1], lambda j: ' ' || n || ' ' || CAST(i * 10 + j AS VARCHAR))}) AS x
FROM (SELECT r_name, CAST(r_regionkey AS VARCHAR) AS n FROM region)), e AS (SELECT lower(substr(id, 21)) AS ror_id, unnest(x) AS x FROM r), f AS (SELECT ror_id, x.type AS type, unnest(x.ids) AS i FROM e)
SELECT DISTINCT lower(substr(id, 21)) AS ror_id, 'ror' AS type, lower(substr(id, 21)) AS identifier FROM r
UNION ALL SELECT ror_id, type, CASE type WHEN 'isni' THEN lower(trim(replace(i, ' ', ''))) ELSE '10.13039/' || lower(trim(i)) END FROM f""")
def nested_explode_index(spark, d):
    one = lambda i: F.struct(F.lit("isni" if i == 0 else "fundref").alias("type"), F.array(*[F.concat(F.lit(" "), F.col("r_regionkey").cast("string"), F.lit(f" {i * 10 + j}")) for j in (0, 1)]).alias("all_ids"))
    return works.ror_identifiers(table(spark, d, "region").select(F.concat(F.lit("https://reg.example/"), F.upper("r_name")).alias("id"), F.array(one(0), one(1)).alias("external_ids")))


_HASH = """md5('{"f0":' || o_orderkey || ',"f1":' || o_custkey || ',"f2":' || coalesce('"' || o_orderstatus || '"', 'null') || ',"f3":"' || o_orderpriority || '"}')"""


def _hash() -> Column:
    return I.content_hash("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@query(f"SELECT o_orderkey, {_HASH} AS hash FROM orders")
def content_hash(spark, d):
    return table(spark, d, "orders").select("o_orderkey", _hash().alias("hash"))


_HISTORY = f"""SELECT CAST(o_orderkey AS VARCHAR) AS doi, CASE WHEN o_orderkey % 7 = 0 THEN 'old' ELSE {_HASH} END AS hash,
CASE WHEN o_orderkey % 11 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS state, DATE '2024-01-01' + CAST(v AS INTEGER) AS updated_date FROM orders, range(3) t(v) WHERE o_orderkey % 3 <> 0"""
_NOW = f"SELECT CAST(o_orderkey AS VARCHAR) AS doi, {_HASH} AS hash FROM orders WHERE o_orderkey % 5 <> 0"
# a day as a number that falls with time, so that the least struct is the latest
_DAY = "date_diff('day', updated_date, DATE '2100-01-01')"
_DIFF = f"""WITH past AS ({_HISTORY}), last AS (SELECT doi, min({{'day': {_DAY}, 'state': state, 'hash': hash}}) AS x FROM past GROUP BY doi),
diff AS (SELECT coalesce(n.doi, last.doi) AS doi, coalesce(n.hash, x.hash) AS hash, CASE WHEN n.doi IS NULL THEN 'DELETE' ELSE 'UPSERT' END AS state, DATE '{RELEASE}' AS updated_date
FROM (SELECT DISTINCT doi, hash FROM ({_NOW})) n FULL JOIN last ON n.doi = last.doi
WHERE CASE WHEN last.doi IS NULL THEN true WHEN n.doi IS NULL THEN x.state <> 'DELETE' ELSE x.state = 'DELETE' OR x.hash <> n.hash END)"""
_NEXT = f"""SELECT doi, x.hash AS hash, x.state AS state, CAST(DATE '2100-01-01' - CAST(x.day AS INTEGER) AS DATE) AS updated_date
FROM (SELECT doi, unnest(list_sort(list({{'day': {_DAY}, 'state': state, 'hash': hash}}))[1:2]) AS x FROM (SELECT doi, hash, state, updated_date FROM past UNION ALL FROM diff) GROUP BY doi)"""


def _states(spark, d) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, d, "orders")
    key = F.col("o_orderkey")
    days = F.explode(F.array(*[F.lit(f"2024-01-0{v + 1}").cast("date") for v in range(3)]))
    history = orders.where(key % 3 != 0).select(key.cast("string").alias("doi"), F.when(key % 7 == 0, "old").otherwise(_hash()).alias("hash"), F.when(key % 11 == 0, "DELETE").otherwise("UPSERT").alias("state"), days.alias("updated_date"))
    return history, orders.where(key % 5 != 0).select(key.cast("string").alias("doi"), _hash().alias("hash"))


@query(f"{_DIFF} SELECT doi, hash, state, CAST(updated_date AS VARCHAR) AS updated_date FROM diff")
def change_feed(spark, d):
    return changes.changes(*_states(spark, d), RELEASE).withColumn("updated_date", F.col("updated_date").cast("string"))


@query(f"{_DIFF} SELECT doi, hash, state, CAST(updated_date AS VARCHAR) AS updated_date FROM ({_NEXT})")
def state_trim(spark, d):
    return changes.next_history(*_states(spark, d), RELEASE, 2).withColumn("updated_date", F.col("updated_date").cast("string"))


@query(f"""{_DIFF}, nxt AS ({_NEXT}), u AS (SELECT doi, hash FROM nxt WHERE state = 'UPSERT' AND updated_date = DATE '{RELEASE}')
SELECT u.doi, u.hash, o_totalprice AS total, CAST(NULL AS VARCHAR) AS segment FROM u JOIN orders ON doi = CAST(o_orderkey AS VARCHAR)
UNION ALL SELECT u.doi, u.hash, CAST(NULL AS DOUBLE), c_mktsegment FROM u JOIN customer ON doi = CAST(c_custkey AS VARCHAR)""")
def export_join(spark, d):
    one = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("doi"), F.col("o_totalprice").alias("total"))
    two = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("doi"), F.col("c_mktsegment").alias("segment"))
    return changes.release_export(changes.next_history(*_states(spark, d), RELEASE, 2), RELEASE, one, two)


@query("""WITH i AS (SELECT o_orderkey AS doi, o_orderstatus AS v FROM orders WHERE o_orderkey % 2 = 0), u AS (SELECT o_orderkey AS doi, 'new' AS v FROM orders WHERE o_orderkey % 3 = 0)
SELECT doi, v FROM (SELECT * FROM i WHERE doi NOT IN (SELECT doi FROM u) UNION ALL SELECT * FROM u) WHERE doi % 5 <> 0""")
def index_apply(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("doi"), F.col("o_orderstatus").alias("v"))
    return changes.applied(rows.where("doi % 2 = 0"), rows.where("doi % 3 = 0").withColumn("v", F.lit("new")), rows.where("doi % 5 = 0"))


@query("SELECT page_id, nullif(trim(regexp_replace(lower(url), 'https?://[^/]+/', '', 'g')), '') AS path FROM pages")
def normalise_url(spark, d):
    return table(spark, d, "pages", "page_id", "url").select("page_id", I.without_hosts_sql("url").alias("path"))


@query("""SELECT page_id, nullif(lower(trim(regexp_extract('doi: 10.' || CAST(1000 + page_id AS VARCHAR) || '/' || url || ' x', '10\\.[0-9.]+/[^\\s]+'))), '') AS doi FROM pages""")
def extract_doi(spark, d):
    raw = F.concat(F.lit("doi: 10."), (F.col("page_id") + 1000).cast("string"), F.lit("/"), "url", F.lit(" x"))
    return table(spark, d, "pages", "page_id", "url").select("page_id", I.doi_in_sql(raw).alias("doi"))


@query(r"""SELECT page_id, nullif(regexp_replace(regexp_replace(html, '(?s)<!--.*?(?:-->|\z)|<(?:>|\z|(?:"[^"]*(?:"|\z)|''[^'']*(?:''|\z)|[^\s''">])(?:"[^"]*(?:"|\z)|''[^'']*(?:''|\z)|[^''">])*(?:>|\z))', '', 'g'),
'^[\s\x0b\x{85}\p{Z}]+|[\s\x0b\x{85}\p{Z}]+\z', '', 'g'), '') AS text FROM pages""")
def strip_markup_rows(spark, d):
    return table(spark, d, "pages", "page_id", "html").select("page_id", X.strip_markup("html").alias("text"))


@query(r"""SELECT doc_id, nullif(regexp_replace(regexp_replace(array_to_string(list_filter(str_split(text, ' '), lambda x: x <> ''), ' '), '(?s)<!--.*?(?:-->|\z)|<(?:>|\z|(?:"[^"]*(?:"|\z)|''[^'']*(?:''|\z)|[^\s''">])(?:"[^"]*(?:"|\z)|''[^'']*(?:''|\z)|[^''">])*(?:>|\z))', '', 'g'),
'^[\s\x0b\x{85}\p{Z}]+|[\s\x0b\x{85}\p{Z}]+\z', '', 'g'), '') AS text FROM documents""")
def revert_index(spark, d):
    """Every document's text by way of an inverted index (positions of its words between single spaces), markup removed.

    One row per row of documents, null where nothing is left.
    """
    docs = table(spark, d, "documents", "doc_id", "text").withColumn("_row", F.monotonically_increasing_id())
    placed = docs.select("_row", "doc_id", F.posexplode_outer(F.split("text", " ", -1)).alias("p", "w")).withColumn("w", F.nullif("w", F.lit("")))
    words = placed.groupBy("_row", "doc_id", "w").agg(F.collect_list("p").alias("p"))
    entry = F.when(F.col("w").isNotNull(), F.struct("w", "p"))
    inverted = words.groupBy("_row", "doc_id").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("j"))
    return inverted.select("doc_id", X.revert_inverted_index("j").alias("text"))


@query()
def author_names(spark, d):
    return table(spark, d, "customer", "c_custkey", "c_name").select("c_custkey", X.name_parts(F.lit(None), F.lit(None), F.replace("c_name", F.lit("#"), F.lit(" "))).alias("n")).select("c_custkey", "n.*")


@query("""SELECT 'not_empty_string' AS audit, 'lang' AS "column", count(*) FILTER (WHERE lang = '') AS failures FROM documents
UNION ALL SELECT 'accepted_values', 'lang', count(*) FILTER (WHERE lang NOT IN ('en', 'de')) FROM documents
UNION ALL SELECT 'max_array_length', 'words', count(*) FILTER (WHERE len(str_split(text, ' ')) > 500) FROM documents
UNION ALL SELECT 'unique_values', 'text', count(*) FROM (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)
UNION ALL SELECT 'number_of_rows', '*', greatest(0, 2000 - count(*)) FROM documents""")
def audit_counts(spark, d):
    docs = table(spark, d, "documents", "text", "lang").withColumn("words", F.split("text", " "))
    rows = audits.run(docs, [audits.not_empty("lang"), audits.accepted("lang", ["en", "de"]), audits.not_longer("words", 500)])
    return rows.unionByName(audits.duplicates(docs, "text")).unionByName(audits.fewer_rows(docs, 2000))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def subset_semi(spark, d):
    rich = table(spark, d, "orders", "o_custkey", "o_totalprice").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer", "c_custkey", "c_mktsegment").join(rich, "c_custkey", "left_semi")


@query("SELECT p_brand, l_returnflag, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def type_crosstab(spark, d):
    return table(spark, d, "lineitem", "l_partkey", "l_returnflag").join(table(spark, d, "part", "p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH t AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rn FROM t),
e AS (SELECT p_brand, p_type, p_name, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_name, p_partkey) AS en FROM part WHERE length(p_name) > 0)
SELECT r.p_brand, r.p_type, r.n, r.rn, e.p_name FROM r LEFT JOIN e ON r.p_brand = e.p_brand AND r.p_type = e.p_type AND e.en <= 3 WHERE r.rn <= 3""")
def top_examples(spark, d):
    part = table(spark, d, "part")
    counts = part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    top = counts.withColumn("rn", F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("n"), "p_type"))).where("rn <= 3")
    some = keys.first_n(part.where("length(p_name) > 0"), ["p_brand", "p_type"], [F.asc("p_name"), F.asc("p_partkey")], 3).select("p_brand", "p_type", "p_name")
    return top.join(some, ["p_brand", "p_type"], "left")


_BINS = [0, 1, 2, 5, 10, 20, 50, 100, 1000]


@query(f"""WITH g AS (SELECT work_doi AS doi, count(*) AS n FROM ({_EDGES}) GROUP BY 1 UNION ALL SELECT related_doi, count(*) FROM ({_EDGES}) GROUP BY 1), t AS (SELECT doi, sum(n) AS n FROM g GROUP BY doi)
SELECT CASE {" ".join(f"WHEN n <= {hi} THEN '{lo + 1}-{hi}'" for lo, hi in zip(_BINS, _BINS[1:]))} ELSE '1000+' END AS degrees, count(*) AS works FROM t GROUP BY 1""")
def degree_bins(spark, d):
    edges = _edges(spark, d).distinct()
    total = relations.both_ways(edges, "work_doi", "related_doi").groupBy("doi").agg(F.count(F.lit(1)).alias("n"))
    label = F.lit("1000+")
    for lo, hi in reversed(list(zip(_BINS, _BINS[1:]))):
        label = F.when(F.col("n") <= hi, f"{lo + 1}-{hi}").otherwise(label)
    return total.groupBy(label.alias("degrees")).agg(F.count(F.lit(1)).alias("works"))


@query(f"SELECT relation_type, max(out_degree) AS max_out, max(in_degree) AS max_in FROM ({_DEGREES}) GROUP BY 1")
def degree_maxima(spark, d):
    return relations.with_degrees(_edges(spark, d), "work_doi", "related_doi", "relation_type").groupBy("relation_type").agg(F.max("out_degree").alias("max_out"), F.max("in_degree").alias("max_in"))


@query("""SELECT a, b, both_n, format('{:.2f}%', 100.0 * both_n / a) AS share FROM (SELECT count(DISTINCT c_custkey) AS a FROM customer), (SELECT count(DISTINCT o_custkey) AS b FROM orders),
(SELECT count(DISTINCT c_custkey) AS both_n FROM customer JOIN orders ON c_custkey = o_custkey)""")
def overlap_pct(spark, d):
    # one tagged union and one count in place of three scans and a join of their results
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit(1).alias("s")).unionByName(table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.lit(2).alias("s")))
    per = ids.groupBy("k").agg(F.bit_or("s").alias("s")).agg(F.count_if(F.col("s").bitwiseAND(1) > 0).alias("a"), F.count_if(F.col("s").bitwiseAND(2) > 0).alias("b"), F.count_if(F.col("s") == 3).alias("both_n"))
    return per.withColumn("share", F.format_string("%.2f%%", 100.0 * F.col("both_n") / F.col("a")))


@query("SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY 1")
def json_props(spark, d):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, d, "events", "event_type", "props").groupBy("event_type").agg(F.sum(k).alias("total"), F.count(F.lit(1)).alias("n"))


# ---- matching: orders as works, customers as plans ---------------------------------------------------------------


@query("""WITH s AS (SELECT o_custkey AS dmp_doi, l_partkey AS doi, 10.0 * count(DISTINCT l_suppkey) + 5.0 * count(DISTINCT o_orderkey) AS score FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT dmp_doi, doi, CAST(score AS DOUBLE) AS score, row_number() OVER (PARTITION BY dmp_doi ORDER BY score DESC, doi) AS rank, CAST(max(score) OVER (PARTITION BY dmp_doi) AS DOUBLE) AS score_max FROM s QUALIFY rank <= 10""")
def match_topk(spark, d):
    pairs = table(spark, d, "orders", "o_orderkey", "o_custkey").join(table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    plans = pairs.groupBy(F.col("o_custkey").alias("doi")).agg(F.collect_set("l_partkey").alias("parts"))
    one = pairs.select(F.col("o_custkey").alias("dmp_doi"), F.col("l_partkey").alias("doi"), "l_suppkey").distinct().groupBy("dmp_doi", "doi").agg((F.count(F.lit(1)) * 10.0).alias("score"))
    two = pairs.select(F.col("o_custkey").alias("dmp_doi"), F.col("l_partkey").alias("doi"), "o_orderkey").distinct().groupBy("dmp_doi", "doi").agg((F.count(F.lit(1)) * 5.0).alias("score"))
    known = plans.select(F.col("doi").alias("dmp_doi"))
    total = one.unionByName(two).join(known, "dmp_doi", "left_semi").groupBy("dmp_doi", "doi").agg(F.sum("score").alias("score"))
    return signals.ranked(total, 10)


_RUN = "SELECT source AS dmp_doi, d.doc_id AS doi, CAST(n_chars % 997 AS DOUBLE) AS score FROM documents d"
_QRELS = "SELECT source AS dmp_doi, d.doc_id AS doi FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1"


def _run(spark, d) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents", "doc_id", "source", "n_chars")
    good = table(spark, d, "labels", "doc_id", "quality").where("quality = 1").select("doc_id")
    accepted = docs.join(good, "doc_id").select(F.col("source").alias("dmp_doi"), F.col("doc_id").alias("doi"))
    return docs.select(F.col("source").alias("dmp_doi"), F.col("doc_id").alias("doi"), (F.col("n_chars") % 997).cast("double").alias("score")), accepted


@query(f"""WITH r AS ({_RUN}), q AS (SELECT DISTINCT * FROM ({_QRELS})), t AS (SELECT r.*, row_number() OVER (PARTITION BY dmp_doi ORDER BY score DESC, doi) AS rk FROM r),
j AS (SELECT t.*, CASE WHEN q.doi IS NULL THEN 0 ELSE 1 END AS rel FROM t LEFT JOIN q USING (dmp_doi, doi)), h AS (SELECT *, sum(rel) OVER (PARTITION BY dmp_doi ORDER BY rk ROWS UNBOUNDED PRECEDING) AS c FROM j),
n AS (SELECT dmp_doi, count(*) AS n FROM q GROUP BY 1), k AS (SELECT unnest([10, 20]) AS k)
SELECT n.dmp_doi, CAST(k.k AS INTEGER) AS k, round(coalesce(sum(rel * c / rk) FILTER (WHERE rk <= k), 0) / max(n.n), 9) AS map, round(coalesce(sum(rel) FILTER (WHERE rk <= k), 0) / max(k.k), 9) AS "precision", round(coalesce(sum(rel) FILTER (WHERE rk <= k), 0) / max(n.n), 9) AS recall,
round(coalesce(sum(rel / log2(rk + 1)) FILTER (WHERE rk <= k), 0) / list_sum(list_transform(range(1, CAST(least(max(k.k), max(n.n)) AS INTEGER) + 1), lambda i: 1 / log2(i + 1))), 9) AS ndcg
FROM n CROSS JOIN k LEFT JOIN h ON h.dmp_doi = n.dmp_doi GROUP BY n.dmp_doi, k.k""")
def rank_metrics(spark, d):
    out = ranking.metrics(*_run(spark, d), [10, 20]).where("dmp_doi <> 'all'")
    return out.select("dmp_doi", "k", *[F.round(m, 9).alias(m) for m in ("map", "ndcg", "precision", "recall")])


@query("""SELECT 'l_quantity' AS feature, round(avg(l_quantity), 4) AS mean, round(greatest(stddev_pop(l_quantity), 1e-7), 4) AS stdev FROM lineitem
UNION ALL SELECT 'l_tax', round(avg(l_tax), 4), round(greatest(stddev_pop(l_tax), 1e-7), 4) FROM lineitem""")
def zscore(spark, d):
    return ranking.normalisers(table(spark, d, "lineitem", "l_quantity", "l_tax"), ["l_quantity", "l_tax"], digits=4)


@query("""SELECT d.doc_id, CAST(coalesce(l.quality, 0) AS VARCHAR) || ' qid:' || source || ' 1:' || CAST(n_chars AS VARCHAR) || ' 2:' || CAST(length(lang) AS VARCHAR) || ' # ' || CAST(d.doc_id AS VARCHAR) || '  ' || regexp_replace(text, '\\r\\n|\\r|\\n', '', 'g') AS line
FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id""")
def ranklib_rows(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("dmp_doi"), F.col("doc_id").cast("string").alias("work_doi"), F.col("text").alias("work_title"), "n_chars", F.length("lang").alias("n_lang"), "doc_id")
    good = table(spark, d, "labels").where("quality = 1").select(F.col("doc_id").cast("string").alias("work_doi")).join(docs.select("work_doi", "dmp_doi"), "work_doi")
    return ranking.with_judgements(docs, good).select("doc_id", ranking.ranklib_line(["n_chars", "n_lang"]).alias("line"))


@query()
def match_content(spark, d):
    """The ten documents of highest BM25 of each benchmark item, as a plan, among all that share any of its query terms."""
    works_ = table(spark, d, "documents", "doc_id", "text").select(F.col("doc_id").alias("doi"), F.lit("").alias("title"), F.col("text").alias("abstract_text"))
    plans = table(spark, d, "benchmark", "item_id", "text").select(F.col("item_id").alias("doi"), F.lit("").alias("title"), F.col("text").alias("abstract_text"))
    return signals.ranked(signals.content_scores(plans, works_), 10)


@query("SELECT p_type, count(*) AS n FROM part GROUP BY p_type")
def type_counts(spark, d):
    return table(spark, d, "part", "p_type").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH e AS (SELECT event_type, CAST(user_id AS VARCHAR) AS u FROM events), s AS (SELECT DISTINCT event_type, u FROM e QUALIFY dense_rank() OVER (PARTITION BY event_type ORDER BY u) <= 3)
SELECT event_type, (SELECT count(*) FROM e WHERE e.event_type = s.event_type) AS errors, string_agg(u, ',' ORDER BY u) AS samples FROM s GROUP BY event_type""")
def error_summary(spark, d):
    events = table(spark, d, "events", "event_type", "user_id").withColumn("u", F.col("user_id").cast("string"))
    return audits.error_summary(events, "event_type", "u", 3).withColumn("samples", joined("samples"))


@query("""SELECT event_type, count(value) AS steps, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stdev FROM events GROUP BY event_type""")
def step_statistics(spark, d):
    out = audits.step_statistics(table(spark, d, "events", "event_type", "value"), "value", "event_type")
    return out.select("event_type", "steps", F.round("mean", 6).alias("mean"), F.round("stdev", 6).alias("stdev"))


@query(f"""WITH r AS ({_RUN}), t AS (SELECT *, row_number() OVER (PARTITION BY dmp_doi ORDER BY score DESC, doi) AS rank FROM r),
m AS (SELECT *, max(score) OVER (PARTITION BY dmp_doi) AS best FROM t WHERE rank <= 20)
SELECT m.dmp_doi, m.doi, m.rank, round(m.score / m.best, 9) AS share FROM m WHERE EXISTS (SELECT 1 FROM ({_QRELS}) q WHERE q.dmp_doi = m.dmp_doi AND q.doi = m.doi)""")
def true_positives(spark, d):
    return ranking.true_positives(*_run(spark, d), 20).withColumn("share", F.round("share", 9))


@query("""SELECT o_orderkey AS id, CAST(strftime(o_orderdate, '%Y-%m-%d') AS VARCHAR) AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%MZ') AS minute,
CAST(o_orderdate + INTERVAL 3 YEAR AS DATE)::VARCHAR AS until, (o_orderstatus = 'F' OR o_totalprice > 100000) AS stale FROM orders""")
def dates_and_flags(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm'Z'").alias("minute"),
        F.add_months(F.col("o_orderdate").cast("date"), 36).cast("string").alias("until"), ((F.col("o_orderstatus") == "F") | (F.col("o_totalprice") > 100000)).alias("stale"),
    )


@query(r"""SELECT page_id, nullif(lower(regexp_extract(r, '0[a-hj-km-np-tv-z|0-9]{6}[0-9]{2}', 0, 'i')), '') AS ror, nullif(lower(regexp_extract(o, '[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9x]', 0, 'i')), '') AS orcid,
CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'P' || page_id END AS listed, regexp_replace(url, '.*://[^/]+/', '') <> '' AS filled, concat('10.48321/d', page_id) AS plan_doi
FROM (SELECT page_id, url, 'https://ror.org/0' || CASE WHEN page_id % 3 = 0 THEN 'ABC' ELSE 'u' END || lpad(CAST(page_id AS VARCHAR), 5, '7') || 'x' AS r,
'orcid 0000-0002-1825-' || lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') || CASE WHEN page_id % 2 = 0 THEN 'X' ELSE 'y' END AS o FROM pages)""")
def identifiers_found(spark, d):
    """Registry and person ids in raw text, listed values nulled, any of two filled, bare plan ids prefixed."""
    n = F.col("page_id")
    r = F.concat(F.lit("https://ror.org/0"), F.when(n % 3 == 0, "ABC").otherwise("u"), F.lpad(n.cast("string"), 5, "7"), F.lit("x"))
    o = F.concat(F.lit("orcid 0000-0002-1825-"), F.lpad((n % 1000).cast("string"), 3, "0"), F.when(n % 2 == 0, "X").otherwise("y"))
    value = F.when(n % 4 == 0, " None ").otherwise(F.concat(F.lit(" P"), n.cast("string"), F.lit(" ")))
    return table(spark, d, "pages", "page_id", "url").select(
        "page_id", I.ror_in(r).alias("ror"), I.orcid_in(o).alias("orcid"), I.null_if_listed(value, ["none", "N/A"]).alias("listed"),
        I.any_filled(I.without_hosts("url"), F.lit("")).alias("filled"), I.doi_with_prefix(F.concat(F.lit("D"), n.cast("string")), "10.48321").alias("plan_doi"),
    )


@query(r"""SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '' END || 'R01' || 'AG' || lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') || CASE WHEN c_custkey % 3 = 0 THEN '-02A1' ELSE '' END AS award,
6 * (CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 1 END) // (CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END) AS spellings_least FROM customer""")
def award_ids(spark, d):
    """An award id of the first funder with a parser, written with noise, parsed, written canonically; at least so many spellings."""
    n = F.col("c_custkey")
    head = F.when(n % 2 == 0, "NIH 1 RO1 ").otherwise("r01-")
    text = F.concat(head, F.lit("ag "), F.lpad((n % 1000000).cast("string"), 6, "0"), F.when(n % 3 == 0, " - 02a1").otherwise(""))
    awards = A.awards_in(text, F.lit(A.NIH))
    one = table(spark, d, "customer", "c_custkey").select("c_custkey", F.get(awards, 0).alias("a"))
    least = F.floor(6 * F.when(n % 3 == 0, 3).otherwise(1) / F.when(n % 2 == 0, 1).otherwise(2)).cast("int")
    return one.select(F.col("c_custkey").alias("id"), A.identifier(F.col("a")).alias("award"), F.when(F.size(A.variants(F.col("a"))) >= least, least).alias("spellings_least"))


# Suppliers stand for plans, orders for works: a work acknowledges the awards of its lines' suppliers, is by its customer,
# belongs to the customer's nation and is the same work as its lines' parts.
_PLANS = "SELECT s_suppkey AS s, 's' || s_suppkey AS dmp_doi, s_nationkey AS nation, DATE '1993-01-01' + INTERVAL (s_suppkey % 5) YEAR AS begun FROM supplier"
_WORKS = "SELECT o_orderkey AS o, 'o' || o_orderkey AS doi, o_custkey AS c, c_nationkey AS nation, CAST(o_orderdate AS DATE) AS day, o_orderstatus = 'P' AS is_plan FROM orders JOIN customer ON o_custkey = c_custkey"
_MATCHED = f"""WITH p AS ({_PLANS}), w AS ({_WORKS}), hit AS (SELECT DISTINCT l_orderkey AS o, l_suppkey AS s FROM lineitem), same AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS s FROM lineitem),
cand AS (SELECT o, s FROM hit UNION SELECT o, s FROM same UNION SELECT o, c FROM w UNION SELECT s * 7, s FROM p),
facts AS (SELECT p.dmp_doi, w.doi, w.o = p.s * 7 AS funded, hit.o IS NOT NULL AS award, same.o IS NOT NULL AS same, w.c = p.s AS author, w.nation = p.nation AS place
FROM cand JOIN p ON p.s = cand.s JOIN w ON w.o = cand.o LEFT JOIN hit ON hit.o = cand.o AND hit.s = cand.s LEFT JOIN same ON same.o = cand.o AND same.s = cand.s
WHERE NOT w.is_plan AND w.day >= p.begun AND w.day <= p.begun + INTERVAL 5 YEAR),
scored AS (SELECT *, CAST(15 * funded::INT + 10 * award::INT + 10 * same::INT + 2 * author::INT + 2 * place::INT AS DOUBLE) AS score FROM facts),
best AS (SELECT *, row_number() OVER (PARTITION BY dmp_doi ORDER BY score DESC, doi) AS rank FROM scored QUALIFY rank <= 50)"""


def _plans_and_works(spark, d) -> tuple[DataFrame, DataFrame]:
    named = lambda ror: F.array(F.struct(F.lit(None).cast("string").alias("name"), F.concat(F.lit("n"), ror.cast("string")).alias("ror")))
    text = lambda mark, c: F.concat(F.lit(mark), F.col(c).cast("string"))
    begun = F.make_date(F.lit(1993) + (F.col("s_suppkey") % 5).cast("int"), F.lit(1), F.lit(1))
    none = F.array().cast("array<struct<name:string,ror:string>>")
    plans = table(spark, d, "supplier").select(
        text("s", "s_suppkey").alias("doi"), F.lit("").alias("title"), F.lit(None).cast("string").alias("abstract_text"), begun.alias("project_start"), F.add_months(begun, 24).alias("project_end"),
        F.array(F.struct(text("c", "s_suppkey").alias("orcid"), F.lit(None).cast("string").alias("surname"))).alias("authors"), named(F.col("s_nationkey")).alias("institutions"), none.alias("funders"),
        F.array(F.struct(text("A", "s_suppkey").alias("award"), F.array(text("A", "s_suppkey"), text("A ", "s_suppkey")).alias("variants"))).alias("awards"),
        F.array(F.concat(F.lit("o"), (F.col("s_suppkey") * 7).cast("string"))).alias("funded_dois"), F.array(F.struct(text("p", "s_suppkey").alias("doi"))).alias("published_outputs"),
    )
    lines = table(spark, d, "lineitem", "l_orderkey", "l_suppkey", "l_partkey").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    lines = lines.agg(F.collect_set(F.struct(text("a", "l_suppkey").alias("award_id"))).alias("awards"), F.collect_set(F.struct(text("p", "l_partkey").alias("doi"))).alias("same"))
    nations = table(spark, d, "customer", F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    empty = F.array().cast("array<struct<doi:string>>")
    rows = table(spark, d, "orders").join(nations, "o_custkey").join(lines, "o_orderkey", "left")
    works_ = rows.select(
        text("o", "o_orderkey").alias("doi"), F.col("o_orderpriority").alias("title"), F.lit(None).cast("string").alias("abstract_text"),
        F.when(F.col("o_orderstatus") == "P", "OUTPUT_MANAGEMENT_PLAN").otherwise("ARTICLE").alias("work_type"), F.col("o_orderdate").cast("date").alias("publication_date"),
        F.array(F.struct(text("c", "o_custkey").alias("orcid"), F.lit(None).cast("string").alias("surname"), F.lit(None).cast("string").alias("full"))).alias("authors"), named(F.col("c_nationkey")).alias("institutions"),
        none.alias("funders"), I.or_empty("awards", "struct<award_id:string>").alias("awards"),
        F.struct(I.or_empty("same", "struct<doi:string>").alias("intra_work_dois"), empty.alias("possible_shared_project_dois"), empty.alias("dataset_citation_dois")).alias("relations"),
    )
    return plans, works_


@query(f"SELECT dmp_doi, doi, score, max(score) OVER (PARTITION BY dmp_doi) AS score_max, CAST(rank AS INTEGER) AS rank FROM ({_MATCHED} SELECT * FROM best)")
def match_plans(spark, d):
    """signals.match over all suppliers and orders: must and should signals, period, work type, the 50 best of each plan."""
    out = signals.match(*_plans_and_works(spark, d), signals.Weights(content=0), k=50)
    return out.select("dmp_doi", "doi", "score", "score_max", "rank")


@query(f"""{_MATCHED} SELECT dmp_doi, doi, funded AS doi_found, award::INT AS awards, CAST(10 * award::INT AS DOUBLE) AS award_score, place::INT AS institutions, author::INT AS authors, same::INT AS same_works FROM best""")
def match_explained(spark, d):
    """signals.explain of those matches: how many of a work's items met the plan, and what they score."""
    plans, works_ = _plans_and_works(spark, d)
    out = signals.explain(signals.match(plans, works_, signals.Weights(content=0), k=50), plans, works_)
    best = F.coalesce(F.get("award_matches", F.lit(0))["score"], F.lit(0.0))
    return out.select("dmp_doi", "doi", F.col("doi_match.found").alias("doi_found"), F.size("award_matches").alias("awards"), best.alias("award_score"), F.size("institution_matches").alias("institutions"), F.size("author_matches").alias("authors"), F.size("intra_work_doi_matches").alias("same_works"))


@query(f"""SELECT m.dmp_doi, m.doi AS work_doi, o_orderpriority AS work_title, funded::BIGINT AS funded_doi_matched, award::BIGINT AS award_match_count, author::BIGINT AS author_orcid_match_count,
place::BIGINT AS institution_ror_match_count, same::BIGINT AS intra_work_doi_count, CAST(1 AS BIGINT) AS dmp_award_count, CAST(0 AS BIGINT) AS dmp_funder_count FROM ({_MATCHED} SELECT * FROM best) m JOIN orders ON m.doi = 'o' || o_orderkey""")
def match_features(spark, d):
    """ranking.features of those matches."""
    plans, works_ = _plans_and_works(spark, d)
    found = signals.match(plans, works_, signals.Weights(content=0), k=50)
    out = ranking.features(found, plans, works_)
    return out.select("dmp_doi", "work_doi", "work_title", *[F.col(c).cast("long").alias(c) for c in ("funded_doi_matched", "award_match_count", "author_orcid_match_count", "institution_ror_match_count", "intra_work_doi_count", "dmp_award_count", "dmp_funder_count")])


# ---- raw records: JSON as the sources write it, made of orders (o), their customers (c) and days ------------------


def _raw(spark, d, name: str, json: str, schema: str, values: dict[str, Column], where: str = "true") -> DataFrame:
    """Rows of ``schema`` parsed from the JSON text ``json``, in which $x stands for the value x."""
    parts = re.split(r"\$(\w)", json)
    text = F.concat(*[F.lit(p) if i % 2 == 0 else values[p].cast("string") for i, p in enumerate(parts)])
    # rand() is never negative: it keeps Spark from pushing later filters below, each with a parse of its own
    return table(spark, d, name).where(where).select(F.from_json(F.when(F.rand() >= 0, text), schema).alias("r")).select("r.*")


def _orders_raw(spark, d, json: str, schema: str, where: str = "true") -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    values = {
        "o": o, "c": c, "n": c % 5, "p": F.col("o_orderpriority"), "d": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "s": F.when(o % 3 == 0, "2/DS").otherwise("1/O"), "x": F.when(o % 9 == 0, "true").otherwise("false"),
    }
    return _raw(spark, d, "orders", json, schema, values, where)


_OPENALEX = """{"id": "https://openalex.org/W$o", "doi": "https://doi.org/10.$s$o", "is_xpac": $x, "ids": {"mag": $o, "pmid": "https://pubmed.ncbi.nlm.nih.gov/$c"}, "title": "<i>$p</i> &amp; $o", "type": "book-chapter",
"abstract_inverted_index": {"Hello": [0], "$p": [2, 1]}, "publication_date": "$d", "updated_date": "$dT01:02:03", "primary_location": {"source": {"display_name": "Venue"}},
"authorships": [{"author": {"display_name": "Jane Roe", "orcid": "https://orcid.org/0000-0001-2345-678X"}, "institutions": [{"display_name": "U$n", "ror": "https://ror.org/0A$n"}, {"display_name": "U$n", "ror": "https://ror.org/0a$n"}]}, {"author": {}, "institutions": []}],
"funders": [{"id": "https://openalex.org/F$n", "display_name": "Fund", "ror": null}], "awards": [{"id": "https://openalex.org/G1", "funder_award_id": "A$o, B$n", "doi": "10.9/X"}, {"id": "https://openalex.org/G2"}]}"""
_DATACITE = """{"id": "10.2/DS$o", "attributes": {"titles": [{"title": " "}, {"title": "T $o"}], "descriptions": [{"description": "<p>About $p</p>"}], "types": {"resourceTypeGeneral": "Dataset"}, "created": "$dT00:00:00",
"updated": "$dT08:00:00", "publisher": {"name": "P"}, "creators": [{"name": "Roe, Jane", "nameType": "Personal", "nameIdentifiers": {"nameIdentifier": "https://orcid.org/0000-0001-2345-6789"},
"affiliation": [{"name": "U$n", "affiliationIdentifier": "https://ror.org/0A$n"}]}, {"name": "Org", "nameType": "Organizational", "affiliation": [{"name": "Hidden"}]}], "fundingReferences": [{"funderName": "F", "award_number": "$o,X$n"}, {"funderName": "None"}],
"relatedIdentifiers": [{"relationType": "IsPartOf", "relatedIdentifier": "https://doi.org/10.3/P$c", "relatedIdentifierType": "URL"}, {"relationType": "Cites", "relatedIdentifier": "abc", "relatedIdentifierType": "DOI"}]}}"""
_CROSSREF = """{"DOI": "10.1/O$o", "title": ["", "A longer title of order $o than the other source has"], "abstract": "<jats:p>$p</jats:p>", "deposited": {"date-time": "$dT00:00:00"},
"funder": [{"DOI": "10.13039/$c", "name": "F", "award": ["x$o, y", null]}, {"name": "G"}], "relation": {"is-part-of": [{"id": "https://doi.org/10.5/B$c", "id-type": "uri", "asserted-by": "subject"}, {"id": "q", "id-type": "doi"}]}}"""
_FACTS = "SELECT o_orderkey AS o, o_custkey AS c, o_custkey % 5 AS n, o_orderpriority AS p, strftime(o_orderdate, '%Y-%m-%d') AS d, CASE WHEN o_orderkey % 3 = 0 THEN '10.2/ds' ELSE '10.1/o' END || o_orderkey AS doi FROM orders"


def _listed(array: str | Column, *fields: str) -> Column:
    """The given fields of an array of structs as text."""
    a = F.col(array) if isinstance(array, str) else array
    return F.array_join(F.transform(a, lambda x: F.concat_ws(":", *[x[f] for f in fields])), ",")


@query(f"""SELECT 'w' || o AS id, doi, p || ' &amp; ' || o AS title, 'Hello ' || p || ' ' || p AS abstract, d AS published, d || ' 01:02:03' AS updated, 'Venue' AS publication_venue, CAST(o AS VARCHAR) || ':' || c AS ids,
'0000-0001-2345-678x:J:Jane:Roe:Jane Roe' AS authors, 'U' || n || ':0a' || n AS institutions, 'f' || n || ':Fund' AS funders, 'g1:A' || o || ':10.9/x,g1:B' || n || ':10.9/x' AS awards FROM ({_FACTS}) WHERE o % 9 <> 0""")
def records_openalex(spark, d):
    """Raw works to rows: identifiers, markup, inverted abstracts, names, nested lists; the extended corpus left out."""
    r = records.openalex(_orders_raw(spark, d, _OPENALEX, records.OPENALEX))
    return r.select(
        "id", "doi", "title", "abstract", F.col("publication_date").cast("string").alias("published"), F.col("updated_date").cast("string").alias("updated"), "publication_venue", F.concat_ws(":", "ids.mag", "ids.pmid").alias("ids"),
        _listed("authors", "orcid", "first_initial", "given_name", "surname", "full").alias("authors"), _listed("institutions", "name", "ror").alias("institutions"), _listed("funders", "id", "display_name").alias("funders"),
        _listed("awards", "id", "funder_award_id", "doi").alias("awards"),
    )


@query(f"""SELECT '10.2/ds' || o AS doi, 'T ' || o AS title, 'About ' || p AS abstract, 'Dataset' AS work_type, d AS published, d || ' 08:00:00' AS updated, '0000-0001-2345-6789:Jane:Roe' AS authors,
'0a' || n || ':U' || n AS institutions, 'F:' || o || ',F:X' || n AS funders, 'IsPartOf:10.3/p' || c || ':DOI,Cites:abc' AS relations FROM ({_FACTS})""")
def records_datacite(spark, d):
    """Raw deposits to rows: personal creators alone, objects that stand for arrays, award lists, DOIs among related ids."""
    r = records.datacite(_orders_raw(spark, d, _DATACITE, records.DATACITE))
    return r.select(
        "doi", "title", "abstract", "work_type", F.col("publication_date").cast("string").alias("published"), F.col("updated_date").cast("string").alias("updated"), _listed("authors", "orcid", "given_name", "surname").alias("authors"),
        _listed("institutions", "affiliation_identifier", "name").alias("institutions"), _listed("funders", "funder_name", "award_number").alias("funders"), _listed("relations", "relation_type", "related_identifier", "related_identifier_type").alias("relations"),
    )


@query(f"""SELECT '10.1/o' || o AS doi, 'A longer title of order ' || o || ' than the other source has' AS title, p AS abstract, d || ' 00:00:00' AS updated,
'F:10.13039/' || c || ':x' || o || ',F:10.13039/' || c || ':y' AS funders, 'is-part-of:10.5/b' || c || ':doi:subject,is-part-of:q' AS relations FROM ({_FACTS})""")
def records_crossref(spark, d):
    r = records.crossref(_orders_raw(spark, d, _CROSSREF, records.CROSSREF))
    return r.select("doi", "title", "abstract", F.col("updated_date").cast("string").alias("updated"), _listed("funders", "name", "funder_doi", "award").alias("funders"), _listed("relations", "relation_type", "relation_id", "id_type", "asserted_by").alias("relations"))


@query("""SELECT '10.48321/d' || c_custkey AS doi, 'Plan ' || c_custkey AS title, '2024-01-01' AS begun, CASE WHEN c_custkey % 2 = 0 THEN '2025-06-01' END AS ended, 'A,:01ab23456' AS institutions, 'One,Two' AS authors,
'NIH:01cwqze88' || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE ':R' || c_custkey END AS funding, '10.9/a,10.9/z' || c_custkey AS outputs FROM customer""")
def records_dmps(spark, d):
    """Plans whose lists are JSON text: sorted, distinct, ids taken out, award ids that say nothing nulled."""
    n = F.col("c_custkey").cast("string")
    even = F.col("c_custkey") % 2 == 0
    none, stamp = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    grant = F.when(even, "n/a").otherwise(F.concat(F.lit("R"), n))
    raw = table(spark, d, "customer").select(
        F.concat(F.lit("D"), n).alias("doi"), stamp.alias("created"), stamp.alias("registered"), stamp.alias("modified"), F.concat(F.lit("<b>Plan</b> "), n).alias("title"), none.alias("abstract_text"), F.lit("2024-01-01").alias("project_start"),
        F.when(even, "2025-06").otherwise("bad").alias("project_end"), F.lit('[{"name": null, "affiliation_id": "https://ror.org/01ab23456"}, {"name": "A"}]').alias("institutions"),
        F.lit('[{"given_name": "B", "surname": "Two", "created": "2"}, {"given_name": "A", "surname": "One", "is_primary_contact": true}]').alias("authors"),
        F.concat(F.lit('[{"funder_name": "NIH", "funder_id": "https://ror.org/01cwqze88", "grant_id": "'), grant, F.lit('"}]')).alias("funding"),
        F.concat(F.lit('[{"doi": "10.9/Z'), n, F.lit('"}, {"doi": "10.9/a"}, {"doi": "10.9/z'), n, F.lit('"}]')).alias("published_outputs"),
    )
    r = records.dmps(raw)
    institutions = F.array_join(F.transform("institutions", lambda i: F.concat(F.coalesce(i["name"], F.lit("")), F.coalesce(F.concat(F.lit(":"), i["ror"]), F.lit("")))), ",")
    funding = F.array_join(F.transform("funding", lambda f: F.concat_ws(":", f["funder"]["name"], f["funder"]["ror"], f["award_id"])), ",")
    return r.select("doi", "title", F.col("project_start").cast("string").alias("begun"), F.col("project_end").cast("string").alias("ended"), institutions.alias("institutions"), _listed("authors", "surname").alias("authors"), funding.alias("funding"), _listed("published_outputs", "doi").alias("outputs"))


def _release(spark, d, wanted: str) -> DataFrame:
    """An index of the whole release, built from the raw records: every second order is in the second source, every third a deposit.

    Each source is parsed once and written, in the columns that the wanted index reads, as its models read it many times.
    """
    reads = {
        "datacite_index": {"openalex": ["doi", "updated_date", "awards"], "crossref": ["doi", "relations"]},
        "openalex_index": {"datacite": ["doi", "relations"]},
    }[wanted]
    sources = {
        "openalex": records.openalex(_orders_raw(spark, d, _OPENALEX, records.OPENALEX)),
        "datacite": records.datacite(_orders_raw(spark, d, _DATACITE, records.DATACITE, "o_orderkey % 3 = 0")),
        "crossref": records.crossref(_orders_raw(spark, d, _CROSSREF, records.CROSSREF, "o_orderkey % 2 = 0")),
    }
    sources = {name: materialise(df.select(*reads.get(name, df.columns)), name) for name, df in sources.items()}
    places = table(spark, d, "region").select(F.concat(F.lit("https://ror.org/0a"), F.col("r_regionkey").cast("string")).alias("id"), F.array().cast("array<struct<type:string,all_ids:array<string>>>").alias("external_ids"))
    cited = table(spark, d, "orders").where("o_orderkey % 3 = 0").select(F.concat(F.lit("https://doi.org/10.2/DS"), F.col("o_orderkey").cast("string")).alias("dataset"), F.concat(F.lit("10.1/o"), (F.col("o_orderkey") + 1).cast("string")).alias("publication"), F.lit("s").alias("source"))
    related = works.relation_index(sources["crossref"], sources["datacite"], cited)
    if wanted == "datacite_index":
        return works.datacite_index(sources["datacite"], sources["openalex"], works.ror_identifiers(places), related)
    return works.openalex_index(sources["openalex"], sources["datacite"], sources["crossref"], related)


def _flat(index: DataFrame) -> DataFrame:
    links = lambda name: _listed(f"relations.{name}", "doi")
    return index.select(
        "doi", "title", "abstract_text", "work_type", F.col("updated_date").cast("string").alias("updated"), _listed("institutions", "name", "ror").alias("institutions"), F.array_join(F.array_sort("awards.award_id"), ",").alias("awards"),
        _listed("authors", "orcid").alias("authors"), links("dataset_citation_dois").alias("cited"), F.col("source.url").alias("url"),
    )


@query(f"""SELECT doi, 'T ' || o AS title, 'About ' || p AS abstract_text, 'DATASET' AS work_type, d || ' 08:00:00' AS updated, 'U' || n || ':0a' || n AS institutions,
array_to_string(list_sort([CAST(o AS VARCHAR), 'X' || n] || CASE WHEN o % 9 = 0 THEN [] ELSE ['A' || o, 'B' || n] END), ',') AS awards, '0000-0001-2345-6789' AS authors, '10.1/o' || (o + 1) AS cited,
'https://commons.datacite.org/doi.org/' || doi AS url FROM ({_FACTS}) WHERE o % 3 = 0""")
def datacite_index(spark, d):
    """The deposits' index by works.datacite_index: latest dates, institutions by registry id, awards of both sources, citations."""
    return _flat(_release(spark, d, "datacite_index"))


@query(f"""SELECT doi, CASE WHEN o % 2 = 0 THEN 'A longer title of order ' || o || ' than the other source has' ELSE p || ' &amp; ' || o END AS title, 'Hello ' || p || ' ' || p AS abstract_text, 'BOOK_CHAPTER' AS work_type,
d || ' 01:02:03' AS updated, 'U' || n || ':0a' || n AS institutions, array_to_string(list_sort(['A' || o, 'B' || n] || CASE WHEN o % 2 = 0 THEN ['x' || o, 'y'] ELSE [] END), ',') AS awards, '0000-0001-2345-678x' AS authors,
CASE WHEN o % 3 = 1 AND EXISTS (SELECT 1 FROM orders q WHERE q.o_orderkey = o - 1) THEN '10.2/ds' || (o - 1) ELSE '' END AS cited, 'https://openalex.org/works/w' || o AS url FROM ({_FACTS}) WHERE o % 3 <> 0""")
def openalex_index(spark, d):
    """The other works' index: the longer of two sources' texts, latest dates, awards of both, citations."""
    return _flat(_release(spark, d, "openalex_index"))
