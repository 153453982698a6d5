"""Identifier and text clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = str | Column


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def none_if_empty(c: ColumnLike) -> Column:
    # as a lambda's variable the value is made once; nullif writes its argument twice, and nested ones double each time
    return F.get(F.transform(F.array(col(c)), lambda x: F.when(x != "", x)), 0)


#: Unicode's white space: what ``(?U)\s`` matches.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def stripped(c: ColumnLike) -> Column:
    """Without white space of any script at either end; null if nothing is left."""
    return none_if_empty(F.btrim(col(c).cast("string"), F.lit(WHITE)))


def clean(c: ColumnLike, lower: bool = False) -> Column:
    return F.lower(stripped(c)) if lower else stripped(c)


def nfc(c: ColumnLike) -> Column:
    """Unicode NFC. Plain ASCII, the usual case, never leaves the JVM."""
    x = col(c)
    plain = F.octet_length(x) == F.char_length(x)
    return F.when(plain, x).otherwise(_nfc(F.when(~plain, x)))  # the function gets every row, in either case


@F.pandas_udf(T.StringType())
def _nfc(x):
    return x.str.normalize("NFC")


def first_match(c: ColumnLike, pattern: str) -> Column:
    return none_if_empty(F.regexp_extract(col(c), pattern, 0))


DOI = r"(?U)10\.[\d.]+/[^\s]+"


def doi_in(c: ColumnLike) -> Column:
    """The DOI in a raw text field: the first match up to white space of any script, lower case, NFC."""
    return nfc(F.lower(clean(first_match(c, DOI))))


def has_doi(c: ColumnLike) -> Column:
    """Whether ``doi_in`` finds one. The field stands in it once: Spark pushes filters below projections with whatever
    they read (a from_json of the whole record), and ``doi_in`` would have that evaluated a dozen times a row."""
    return col(c).rlike(DOI)


def doi_in_sql(c: ColumnLike) -> Column:
    """The same as the SQL models define it: ASCII digits and white space, and only spaces trimmed."""
    return nfc(none_if_empty(F.lower(F.trim(F.regexp_extract(col(c), r"10\.[0-9.]+/[^\s]+", 0)))))


def ror_in(c: ColumnLike) -> Column:
    return F.lower(first_match(c, r"(?i)0[a-hj-km-np-tv-z|0-9]{6}[0-9]{2}"))


def orcid_in(c: ColumnLike) -> Column:
    return F.lower(first_match(c, r"(?i)\d{4}-\d{4}-\d{4}-\d{3}[\dx]"))


def without_hosts(c: ColumnLike) -> Column:
    """An identifier without every http(s)://host/ part, cleaned, in lower case."""
    return clean(F.regexp_replace(col(c), r"(?i)https?://[^/]+/", ""), lower=True)


def without_hosts_sql(c: ColumnLike) -> Column:
    return none_if_empty(F.trim(F.regexp_replace(F.lower(col(c).cast("string")), "https?://[^/]+/", "")))


def isni(c: ColumnLike) -> Column:
    return F.lower(F.trim(F.replace(col(c), F.lit(" "), F.lit(""))))


def null_if_listed(c: ColumnLike, values: list[str]) -> Column:
    """Null where the stripped, lower-cased value is one of ``values`` (compared in lower case)."""
    x = F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")
    return F.when(F.lower(x).isin([v.lower() for v in values]), None).otherwise(x)


def without_newlines(c: ColumnLike) -> Column:
    return F.regexp_replace(col(c), r"\r\n|\r|\n", "")


def empty_array(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def or_empty(c: ColumnLike, kind: str) -> Column:
    return F.coalesce(col(c), empty_array(kind))


def first_present(array: ColumnLike) -> Column:
    """The first non-blank string of an array, stripped."""
    return F.get(F.filter(F.transform(col(array), lambda x: stripped(x)), lambda x: x.isNotNull()), 0)


def distinct_count(array: ColumnLike) -> Column:
    """Number of distinct non-null elements as a long; 0 for a null array."""
    return F.coalesce(F.size(F.array_distinct(F.array_compact(col(array)))), F.lit(0)).cast("long")


def sorted_distinct(array: ColumnLike) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(col(array))))


def split_list(c: ColumnLike, marks: str = ",") -> Column:
    """Parts of a delimited string, stripped, without the blank ones."""
    return F.filter(F.transform(F.split(col(c), f"[{marks}]"), lambda x: stripped(x)), lambda x: x.isNotNull())


def any_filled(*cs: ColumnLike) -> Column:
    """Whether one of the values is neither null nor empty."""
    return F.coalesce(*[none_if_empty(c) for c in cs]).isNotNull()


def iso_date(c: ColumnLike) -> Column:
    """Date of an ISO 8601 calendar date or timestamp, null where it is none."""
    x = stripped(c)
    full = F.when(x.rlike(r"^\d{4}$"), F.concat(x, F.lit("-01-01"))).when(x.rlike(r"^\d{4}-\d{2}$"), F.concat(x, F.lit("-01"))).when(x.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(x, 1, 4), F.substring(x, 5, 2), F.substring(x, 7, 2)))
    return F.coalesce(full, F.substring(x, 1, 10)).try_cast("date")


def iso_timestamp(c: ColumnLike) -> Column:
    """UTC time without zone of an ISO 8601 timestamp; needs spark.sql.session.timeZone=UTC."""
    return F.try_to_timestamp(stripped(c)).cast("timestamp_ntz")


def latest_filled(a: ColumnLike, b: ColumnLike) -> Column:
    """The later of a and b; a where b is null."""
    return F.greatest(col(a), F.coalesce(col(b), col(a)))


def content_hash(*cs: ColumnLike) -> Column:
    """md5 of a canonical JSON form: field order as given, nulls written, so that nothing engine-specific enters."""
    fields = [col(c).alias(f"f{i}") for i, c in enumerate(cs)]
    return F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))


def doi_with_prefix(c: ColumnLike, prefix: str) -> Column:
    """The DOI in a plan's id; a bare suffix gets the registrant's prefix first."""
    return F.coalesce(doi_in(c), doi_in(F.concat(F.lit(f"{prefix}/"), stripped(c))))


def ascii_words(c: ColumnLike) -> Column:
    """Lower case, accents folded, punctuation dropped, white space collapsed: for comparing titles."""
    x = F.regexp_replace(folded(F.lower(col(c))), r"[^\w\s]", "")
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def folded(c: ColumnLike) -> Column:
    x = col(c)
    return F.when(F.octet_length(x) == F.char_length(x), x).otherwise(_fold(x))


@F.pandas_udf(T.StringType())
def _fold(x):
    return x.str.normalize("NFKD").str.replace(r"[̀-ͯ]", "", regex=True)


def camel_names(names: list[str]) -> list[str]:
    """snake_case to camelCase."""
    return [n.split("_")[0] + "".join(p.title() for p in n.split("_")[1:]) for n in names]
