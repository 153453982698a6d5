from pyspark.sql import functions as F

from citeloom.functions import awards as A
from citeloom.functions import identifiers as I
from citeloom.functions import text as X


def one(spark, column, *values, schema="x string"):
    return [r[0] for r in spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema).select(column).collect()]


def test_doi(spark):
    texts = ["10.1234/abc", "doi: 10.1234/ABC.def", None, "no doi here", "10.1/óx", "10.1/a b"]
    assert one(spark, I.doi_in("x"), *texts) == ["10.1234/abc", "10.1234/abc.def", None, None, "10.1/óx", "10.1/a"]
    assert one(spark, I.doi_in_sql("x"), *texts)[4:] == ["10.1/óx", "10.1/a b"]


def test_identifiers(spark):
    assert one(spark, I.ror_in("x"), "https://ror.org/01CWQZE88", "none") == ["01cwqze88", None]
    assert one(spark, I.orcid_in("x"), "https://orcid.org/0000-0002-1825-009X", "0000") == ["0000-0002-1825-009x", None]
    assert one(spark, I.without_hosts("x"), "https://openalex.org/W12 ", " HTTP://a/https://b/C", "", None) == ["w12", "c", None, None]
    assert one(spark, I.isni("x"), "0000 0001 2345 678X") == ["000000012345678x"]
    assert one(spark, I.clean("x"), "  a b\t", " \n", None) == ["a b", None, None]
    assert one(spark, I.null_if_listed("x", ["None", "n/a"]), " NONE ", "n/a", "R01") == [None, None, "R01"]
    assert one(spark, I.doi_with_prefix("x", "10.48321"), "D1ABC", "10.5/x") == ["10.48321/d1abc", "10.5/x"]


def test_dates(spark):
    assert [str(x) for x in one(spark, I.iso_date("x"), "2025-01-31", "2025-01", "2025", "20250131", "2025-02-30", "garbage", None)] == ["2025-01-31", "2025-01-01", "2025-01-01", "2025-01-31", "None", "None", "None"]
    assert [str(x) for x in one(spark, I.iso_timestamp("x"), "2025-01-31T10:00:00+02:00", "2025-01-31T10:00:00.5", "bad")] == ["2025-01-31 08:00:00", "2025-01-31 10:00:00.500000", "None"]


def test_lists(spark):
    assert one(spark, I.split_list("x"), "a, b,,c ", None) == [["a", "b", "c"], None]
    assert one(spark, I.distinct_count("x"), (["a", None, "a", "b"],), (None,), schema="x array<string>") == [2, 0]
    assert one(spark, I.first_present("x"), ([" ", None, " t "],), ([],), schema="x array<string>") == ["t", None]


def test_content_hash_is_stable_and_sees_nulls(spark):
    a, b, c = one(spark, I.content_hash("a", "b"), ("x", None), (None, "x"), ("x", None), schema="a string, b string")
    assert a == c != b


def test_names():
    name = lambda *a: tuple(X.parse_name(*a).values())
    assert name(None, None, "John Doe") == ("J", "John", None, None, "Doe", "John Doe")
    assert name(None, None, "Doe, John") == ("J", "John", None, None, "Doe", "Doe, John")
    assert name(None, None, "Dr. Martin Luther King Jr.") == ("M", "Martin", "L", "Luther", "King", "Dr. Martin Luther King Jr.")
    assert name("John", "Doe", None)[5] == "John Doe" and name("John", "Doe", "Dr. John Doe")[5] == "Dr. John Doe"
    assert name(None, None, "sam wu") == (None, "sam", None, None, "wu", "sam wu")
    assert name("가은", "김", None)[0] is None and name("Иван", "Петров", None)[0] == "И"
    assert name(None, None, "Ludwig van Beethoven")[4] == "van Beethoven"
    assert set(name("  ", "", None)) == {None}
    assert X.has_initial("Élise") and not X.has_initial("田中") and not X.has_initial("1234") and not X.has_initial(None)


def test_markup(spark):
    texts = ["<p>Hello</p>", "<div><p>Hello</p></div>", "Hello", "<p>None</p>", "  ", None, "a <b x='>'>c</b> <!-- > d --> e &amp; f"]
    assert one(spark, X.strip_markup("x", ["None"]), *texts) == ["Hello", "Hello", "Hello", None, None, None, "a c  e &amp; f"]
    odd = ["AT&T <i>x</i> a=1&b=2", "p < 0.05 and q > 1", "a <b", "x<!-- open", "<p title=\"a>b\">t</p>", "<>y", "<" + "a b='c' " * 20_000 + ">z", "a\n<br/>\nb"]
    assert one(spark, X.strip_markup("x"), *odd) == ["AT&T x a=1&b=2", "p < 0.05 and q > 1", "a", "x", "t", "y", "z", "a\n\nb"]


def test_inverted_index(spark):
    rows = ['{"The": [0], "prelims": [1]}', '{"A": [0], "C": [2]}', '{"A": [0], "B": [0]}', '{"<b>The</b>": [0], "end": [1, 3]}', "not json", "", None, "{}"]
    assert one(spark, X.revert_inverted_index("x"), *rows) == ["The prelims", "A C", "B", "The end end", None, None, None, None]


def test_similarity(spark):
    assert one(spark, F.round(X.similarity("a", "b"), 3), ("abcd", "abed"), ("", ""), ("a", "b"), (None, "a"), schema="a string, b string") == [75.0, 100.0, 0.0, None]


def test_award_ids(spark):
    texts = ["1R21NS139078-01", "R15 AR083143-01", "5R01-AI167850", "AI001335", "1 R01 AG080054-01R1", "RO1HL168018", "nothing", None]
    got = one(spark, F.transform(A.awards_in("x", F.lit(A.NIH)), lambda a: A.identifier(a)), *texts)
    assert got == [["1R21NS139078-01"], ["R15AR083143-01"], ["5R01AI167850"], ["AI001335"], ["1R01AG080054-01R1"], ["R01HL168018"], [], []]
    odd = ["NIH R01AG080054", "AG080054R1", "UO1HL168018", "RO1 HL168018-0", "AG0800541234567"]
    parts = one(spark, F.transform(A.awards_in("x", F.lit(A.NIH)), lambda a: F.concat_ws("/", *[F.coalesce(a[f], F.lit("")) for f in ("activity_code", "institute_code", "serial_number", "support_year", "other_suffixes")])), *odd)
    assert parts == [["R01/AG/080054//"], ["/AG/080054//R1"], ["UO1/HL/168018//"], ["R01/HL/168018//"], ["/AG/080054//"]]
    spelled = one(spark, F.flatten(F.transform(A.awards_in("x", F.lit(A.NIH)), lambda a: A.variants(a))), "R01AI176039")[0]
    assert spelled == sorted({"AI 176039", "AI176039", "R01 AI 176039", "R01AI176039", "R01 AI176039"})
    nsf = one(spark, F.flatten(F.transform(A.awards_in("x", F.lit(A.NSF)), lambda a: A.variants(a))), "https://x/showAward?AWD_ID=0932263&H=f", "DMR-1507101; 2132549")
    assert nsf == [["0932263"], ["1507101", "DMR 1507101", "DMR-1507101", "2132549"]]
    assert one(spark, A.awards_in("x", F.lit("other")), "R01AI176039") == [[]]
