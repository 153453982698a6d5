"""Award ids of funders whose formats are known: parsed, written canonically, and spelled in the usual ways."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.identifiers import ColumnLike, col, none_if_empty, split_list

# Registry ids of the funders with parsers.
NIH, NSF = "01cwqze88", "021nxhr62"

AWARD = "struct<funder:string,text:string,application_type:string,activity_code:string,institute_code:string,serial_number:string,support_year:string,other_suffixes:string,org_id:string,award_id:string>"
_FIELDS = [f.split(":")[0] for f in AWARD[7:-1].split(",")]


def _award(**parts: Column) -> Column:
    return F.struct(*[parts.get(f, F.lit(None)).cast("string").alias(f) for f in _FIELDS])


def _part(x: Column, pattern: str, group: int) -> Column:
    return none_if_empty(F.regexp_extract(x, pattern, group))


def nih(text: Column) -> Column:
    """[type][activity]INSTITUTE SERIAL[-year][suffixes]; null without an institute's two letters and six digits.

    Spaces and dashes are ignored. Before the institute, the funder's name is dropped and RO1 read as R01; after the serial
    number, two characters that are no year are suffixes.
    """
    x = F.trim(F.regexp_replace(F.upper(text), "[ -]", ""))
    core = r"(?s)^(.*?)([A-Z]{2})(\d{6})(.*)$"
    head = F.replace(F.replace(F.regexp_extract(x, core, 1), F.lit("RO1"), F.lit("R01")), F.lit("NIH"), F.lit(""))
    tail = F.regexp_extract(x, core, 4)
    kind = F.when(head.rlike(r"^[1-9]$"), head).otherwise(_part(head, r"^([1-9])([0-9A-Z]{3})$", 1))
    activity = F.when(head.rlike(r"^[0-9A-Z]{3}$"), head).otherwise(_part(head, r"^([1-9])([0-9A-Z]{3})$", 2))
    year = F.when(tail.rlike(r"^\d{2}$"), tail).otherwise(_part(tail, r"^(\d{2})([0-9A-Z]{2,4})$", 1))
    other = F.when((F.length(tail) == 2) & year.isNull(), tail).otherwise(_part(tail, r"^(\d{2})([0-9A-Z]{2,4})$", 2))
    return F.when(x.rlike(core), _award(funder=F.lit(NIH), text=text, application_type=kind, activity_code=activity, institute_code=F.regexp_extract(x, core, 2), serial_number=F.regexp_extract(x, core, 3), support_year=year, other_suffixes=other))


def nsf(text: Column) -> Column:
    """Seven digits, from an award page's address, after a directorate's letters, or alone."""
    number = F.coalesce(_part(text, r"(?i)AWD_ID=(\d{7})", 1), _part(text, r"(?:^|\D)(\d{7})(?:\D|$)", 1))
    org = _part(F.upper(text), r"(?:^|[^A-Z])([A-Z]{2,4})[ -]?\d{7}(?:\D|$)", 1)
    return F.when(number.isNotNull(), _award(funder=F.lit(NSF), text=text, award_id=number, org_id=org))


#: Parsers by funder. Add one to support another funder.
PARSERS: dict[str, Callable[[Column], Column]] = {NIH: nih, NSF: nsf}


def awards_in(text: ColumnLike, funder: ColumnLike) -> Column:
    """Distinct awards of a text that may list several, by the funder's parser; none for other funders."""
    out = F.array().cast(f"array<{AWARD}>")
    for ror, parse in PARSERS.items():
        found = F.array_distinct(F.filter(F.transform(split_list(text, ",;"), parse), lambda a: a.isNotNull()))
        out = F.when(col(funder) == ror, found).otherwise(out)
    return F.coalesce(out, F.array().cast(f"array<{AWARD}>"))


def identifier(a: Column) -> Column:
    """The canonical spelling."""
    blank = lambda f: F.coalesce(a[f], F.lit(""))
    dash = F.when(a["support_year"].isNotNull() | a["other_suffixes"].isNotNull(), "-").otherwise("")
    full = F.concat(blank("application_type"), blank("activity_code"), blank("institute_code"), blank("serial_number"), dash, blank("support_year"), blank("other_suffixes"))
    return F.when(a["funder"] == NSF, a["award_id"]).otherwise(full)


def variants(a: Column) -> Column:
    """Spellings under which works cite the award, distinct and sorted."""
    base = F.concat(a["institute_code"], F.lit(" "), a["serial_number"])
    stems = F.array(base, F.concat(base, F.lit("-"), a["support_year"]), F.concat(base, F.lit("-"), a["support_year"], a["other_suffixes"]))
    tight = lambda xs: F.concat(xs, F.transform(xs, lambda x: F.replace(x, F.lit(" "), F.lit(""))))

    def before(xs: Column, part: Column) -> Column:
        more = F.concat(F.transform(xs, lambda x: F.concat(part, F.lit(" "), x)), F.transform(xs, lambda x: F.concat(part, F.replace(x, F.lit(" "), F.lit("")))))
        return F.concat(xs, F.coalesce(F.when(part.isNotNull(), more), F.array().cast("array<string>")))

    health = before(before(tight(F.array_compact(stems)), a["activity_code"]), a["application_type"])
    science = F.array_compact(F.array(a["award_id"], F.concat(a["org_id"], F.lit(" "), a["award_id"]), F.concat(a["org_id"], F.lit("-"), a["award_id"])))
    return F.array_sort(F.array_distinct(F.when(a["funder"] == NSF, science).otherwise(health)))
