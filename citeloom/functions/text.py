"""Markup, inverted indexes and personal names. Names are Arrow-batched; the others are native."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.functions.identifiers import col, stripped

# Texts that stand for a missing abstract, by source.
MISSING_ABSTRACT = [
    "a", ":unav", "No abstract.", "Abstract", "abstract", "peer reviewed", "Peer Reviewed", "No abstract available.",
    "No description provided.", "No abstract available", "This article has no abstract.", "Abstract not Available.",
    "status: Published", "Version of Record", "[TODO] Add abstract here.", "No abstract", "No Abstract.",
    "No abstract is available for this article.", "Cover title.", "(Abstract to follow)", "No contiene resumen",
    "not provided.", "No abstract received.", "n/a", "N/A", ".", "-",
]
MISSING_DEPOSIT_ABSTRACT = [":unav", "Cover title."]


#: What strip_markup takes out: comments, and from a < that no white space follows to its > or the end of the text; a >
#: in quotes ends no tag. Character references stay as they are.
_QUOTED = r"""\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z)"""
TAG = rf"""(?s)<!--.*?(?:-->|\z)|<(?:>|\z|(?:{_QUOTED}|[^\s'\">])(?:{_QUOTED}|[^'\">]++)*+(?:>|\z))"""


def without_tags(c: str | Column) -> Column:
    x = col(c)
    return F.when(x.contains("<"), F.regexp_replace(x, TAG, "")).otherwise(x)


def strip_markup(c: str | Column, missing: list[str] | None = None) -> Column:
    """Text without tags, stripped; null if empty or exactly one of ``missing``."""
    x = stripped(without_tags(c))
    return F.when(~x.isin(missing), x) if missing else x


def revert_inverted_index(c: str | Column, missing: list[str] | None = None) -> Column:
    """Text of a JSON object word -> positions. Two words at one place: the greater stays; gaps are skipped; bad JSON: null. Tags are taken out."""
    words = F.from_json(col(c), "map<string,array<int>>")
    placed = F.flatten(F.transform(F.map_entries(words), lambda e: F.transform(F.array_distinct(e["value"]), lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    # of equal positions the last in order has the greatest word; as a lambda's variable the sorted array is made once a row
    last = lambda o: F.filter(o, lambda x, i: F.get(o, i + 1).isNull() | (F.get(o, i + 1)["p"] != x["p"]))
    plain = F.get(F.transform(F.array(F.array_sort(placed)), lambda o: F.array_join(F.transform(last(o), lambda x: x["w"]), " ")), 0)
    x = stripped(without_tags(plain))
    return F.when(~x.isin(missing), x) if missing else x


NAME = T.StructType([T.StructField(n, T.StringType()) for n in ("first_initial", "given_name", "middle_initials", "middle_names", "surname", "full")])
_IDEOGRAPHS = re.compile("^[぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿가-힯ᄀ-ᇿ]")
_TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "miss", "sir", "dame", "rev", "fr", "hon"}
_SUFFIXES = {"jr", "sr", "ii", "iii", "iv", "phd", "md", "esq", "msc", "bsc", "dphil"}
_PARTICLES = {"van", "von", "der", "den", "de", "del", "della", "da", "dos", "di", "la", "le", "bin", "al", "el", "ten", "ter"}


def has_initial(text: str | None) -> bool:
    """Whether the first character is a letter of a script in which initials mean something."""
    return bool(text) and text[0].isalpha() and not _IDEOGRAPHS.match(text)


def _initial(text: str | None) -> str | None:
    if not text or not has_initial(text):
        return None
    end = 1
    while end < len(text) and unicodedata.combining(text[end]):
        end += 1
    return text[:end].upper()


def _bare(word: str) -> str:
    return word.lower().replace(".", "").strip(",")


def parse_name(given: str | None, surname: str | None, full: str | None) -> dict[str, str | None]:
    """Name parts of a given name and surname, or else of a full name in either order; ``full`` stays as written."""
    given, surname, full = ((x or "").strip() or None for x in (given, surname, full))
    out: dict[str, str | None] = dict.fromkeys(NAME.fieldNames())
    if given and surname:
        return out | {"first_initial": _initial(given), "given_name": given, "surname": surname, "full": full or f"{given} {surname}"}
    full = full or given or surname
    if not full:
        return out
    out["full"] = full
    head, comma, tail = full.partition(",")
    if comma and _bare(tail.strip()) not in _SUFFIXES:
        words, last = tail.split(), head.split()
        last = [w for w in last if _bare(w) not in _SUFFIXES]
    else:
        words = full.replace(",", " ").split()
        while len(words) > 1 and _bare(words[0]) in _TITLES:
            words = words[1:]
        while len(words) > 1 and _bare(words[-1]) in _SUFFIXES:
            words = words[:-1]
        cut = len(words) - 1
        while cut > 1 and words[cut - 1].lower() in _PARTICLES:
            cut -= 1
        words, last = words[:cut], words[cut:]
    words = [w for w in words if _bare(w) not in _SUFFIXES]
    capital = [w for w in [*words, *last] if w.lower() not in _PARTICLES]
    if words and last and all(w[:1].isupper() for w in capital):
        middle = words[1:]
        return out | {
            "first_initial": _initial(words[0]), "given_name": words[0], "surname": " ".join(last),
            "middle_names": " ".join(middle) or None, "middle_initials": " ".join(filter(None, map(_initial, middle))) or None,
        }
    # not a name as Western names are written: cut at the comma, or before the last word
    if comma:
        return out | {"given_name": tail.strip() or None, "surname": head.strip() or None}
    first, _, rest = full.rpartition(" ")
    return out | {"given_name": first.strip() or None, "surname": rest or None}


@F.pandas_udf(NAME)
def _names(given: pd.Series, surname: pd.Series, full: pd.Series) -> pd.DataFrame:
    rows = [parse_name(*(None if pd.isna(x) else x for x in r)) for r in zip(given, surname, full)]
    return pd.DataFrame(rows, columns=NAME.fieldNames())


def name_parts(given: str | Column, surname: str | Column, full: str | Column) -> Column:
    return _names(col(given).cast("string"), col(surname).cast("string"), col(full).cast("string"))


@F.pandas_udf(T.ArrayType(NAME))
def _names_in(people: pd.Series) -> pd.Series:
    return people.map(lambda rows: [parse_name(r["given"], r["surname"], r["full"]) for r in rows], na_action="ignore")


def names_in(people: Column) -> Column:
    """Name parts of every element of an array<struct<given, surname, full>>."""
    return _names_in(people)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfc_in(values: pd.Series) -> pd.Series:
    return values.map(lambda xs: [None if x is None else unicodedata.normalize("NFC", x) for x in xs], na_action="ignore")


def nfc_in(values: Column) -> Column:
    """NFC of every string of an array; arrays of ASCII alone stay in the JVM."""
    odd = F.exists(values, lambda x: F.octet_length(x) != F.char_length(x))
    return F.when(odd, _nfc_in(F.when(odd, values))).otherwise(values)  # the function gets every row, in either case


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Indel-normalised similarity, 0 to 100: 200 * longest common subsequence / (length a + length b)."""

    def one(x: str, y: str) -> float:
        if not x and not y:
            return 100.0
        # bit-parallel longest common subsequence
        places: dict[str, int] = {}
        for i, ch in enumerate(x):
            places[ch] = places.get(ch, 0) | 1 << i
        full = (1 << len(x)) - 1
        state = full
        for ch in y:
            hit = state & places.get(ch, 0)
            state = ((state + hit) | (state - hit)) & full
        return 200.0 * (len(x) - state.bit_count()) / (len(x) + len(y))

    return pd.Series([None if pd.isna(x) or pd.isna(y) else one(x, y) for x, y in zip(a, b)], dtype="float64")
