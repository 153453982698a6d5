"""Personal data replaced by surrogates: keyed, of the same type and format, distinct, and the same for the same entity.

An entity is reduced to a canonical form (lower-case address, digits of a number, a name's words), and an HMAC of type
and form decides its surrogate: digits stay digits, letters keep their case and script, punctuation stays, a card keeps
its first digit and its Luhn sum, a first name its gender. Mentions that differ in layout alone so keep pointing to one
surrogate, and so do the parts of a name: a text that names a person in full has its bare first and last names replaced
too. Surrogates of names are made up of syllables, so that they are nobody's, and as many as are needed.

The corpus's distinct entities are then checked: a surrogate that equals another's, or a real entity, is drawn again
with the next attempt number, until none collides. Those attempts, few, are joined back to the texts that need them;
where there are none, texts are neither exploded nor shuffled. Only DataFrame expressions are used.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.llm.textops import materialise

#: First names by gender, of several languages; part of what is detected, not of what is drawn.
WOMEN = (
    "Anna Maria Laura Julia Sophie Emma Claire Camille Elena Carmen Lucía Isabel Mary Linda Sarah Susan Karen Emily Ingrid Petra Heike Sabine "
    "Alice Amy Barbara Carol Catherine Charlotte Diana Elizabeth Eva Fatima Hannah Helen Jane Jennifer Jessica Katharina Kate Lisa Margaret Marie Martha Mei "
    "Monika Nancy Nina Olivia Patricia Priya Rachel Rosa Ruth Sofia Ursula Yuki Анна Мария Елена Ольга Наталья Татьяна"
).split()
MEN = (
    "John James Robert Michael David Thomas Peter Paul Pierre Jean Luc Antoine Carlos José Miguel Javier Hans Klaus Jürgen Stefan Wolfgang William "
    "Ahmed Alexander Andrew Anthony Antonio Charles Chen Christopher Daniel Diego Edward Eric Francisco Frank George Giovanni Henry Hiroshi Ivan Jack Jorge "
    "Joseph Juan Karl Kenji Luis Luigi Marco Mark Martin Matthew Mohammed Otto Pablo Patrick Philip Pedro Raj Richard Simon Stephen Wei Иван Сергей Андрей Павел Дмитрий Алексей"
).split()
_HER, _HIS = "Mrs Ms Miss Frau Señora Sra Madame Mme".split(), "Mr Herr Señor Sr Monsieur".split()
_TITLE = "|".join([*_HER, *_HIS, "Dr", "Prof"])
_NAME = r"\p{Lu}[\p{Ll}'’-]+"
_FIRST = "|".join([*WOMEN, *MEN])
_AND = "(?:and|und|et|y|e|и|&)"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

#: Each branch starts with a cheap look at the first character; what looks further back or ahead comes after it.
#: Order matters: the first that fits at a place is taken.
_AT = r"(?<![\w.%+-])[\w.%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)+"
_HEX = r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,128}+(?![0-9A-Za-z])"
_SECRET = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{12})(?<=(?i:token|secret|password|apikey|api_key)\s{0,2}[=:]\s{0,2}[\x22']?)[A-Za-z0-9+/_=-]{12,128}"
_IBAN = r"(?=[A-Z]{2}\d)(?<![0-9A-Za-z])[A-Z]{2}\d{2}[A-Z0-9]{11,30}+(?![0-9A-Za-z])"
_NUMBERS = (
    rf"(?=[0-9+(])(?:(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)"
    r"|(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\w)|(?<![\w.(])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\w)"
    r"|(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))"
)
_PERSON = rf"(?=\p{{Lu}})\b(?:(?:{_TITLE})\.? {_NAME}(?: {_NAME})?|(?:{_FIRST}) {_NAME})"
#: Two capitalised words joined by an "and" to a person before them.
_ALSO = rf"(?=\p{{Lu}})(?<= {_AND} )(?<=\b(?:(?:{_TITLE})\.?|{_FIRST}) \p{{Lu}}[\p{{Ll}}'’-]{{1,20}} {_AND} ){_NAME} {_NAME}"
#: What a text without digits and @ can hold, and what any text can.
WORDY = "|".join([_HEX, _SECRET, _PERSON, _ALSO])
ANY = "|".join([_AT, _HEX, _SECRET, _IBAN, _NUMBERS, _PERSON, _ALSO])
_VOWELS, _CONSONANTS = "aeiou", "bdfglmnprstv"


def _let(x: Column, body: Callable[[Column], Column]) -> Column:
    """body(x), with x computed once and written once in the plan."""
    return F.element_at(F.transform(F.array(x), lambda v: body(v)), 1)


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        x = F.substring(digits, i, F.lit(1)).cast("int") * (F.pmod(n - i, F.lit(2)) + 1)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, b: a + b)


def _is_card(e: Column) -> Column:
    """An issuer's first digits and a sound Luhn sum; other long numbers are no personal data."""
    digits = F.regexp_replace(e, r"\D", "")
    return digits.rlike("^(?:[3-6]|2[2-7])") & (F.pmod(_let(digits, _luhn), F.lit(10)) == 0)


def _kind(e: Column) -> Column:
    """The kind of an entity; ``number`` is left as it is."""
    return (
        F.when(e.contains("@"), "email")
        .when(e.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip")
        .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(e.rlike(r"^(?:\+|\(|\d{3}\)?[ .-]\d{3}[ .-]\d{4}$)"), "phone")
        .when(e.rlike(r"^\d(?:[ -]?\d){12,18}$"), F.when(_is_card(e), "card").otherwise("number"))
        .when(e.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9]{11,30}$"), "iban")
        .when(e.rlike(r"^\S{12,}$") & ~e.rlike(rf"^{_NAME}$"), "secret")
        .otherwise("person")
    )


def _form(kind: Column, e: Column) -> Column:
    return F.when(kind.isin("ssn", "phone", "card"), F.regexp_replace(e, r"\D", "")).otherwise(F.lower(e))


def _mac(key: str, message: Column) -> Column:
    """HMAC-SHA256 in hexadecimal digits."""
    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(x ^ pad for x in raw)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)


def _digest(key: str, kind: Column, form: Column, attempt: Column, length: Column) -> Column:
    """Hex digits of a keyed hash, enough for a draw at each of ``length`` places."""
    base = F.concat(kind, F.lit("\x1f"), form, F.lit("\x1f"), attempt.cast("string"), F.lit("\x1f"))
    blocks = F.sequence(F.lit(1), F.greatest(F.ceil(length / 16), F.lit(1)).cast("int"))
    return F.array_join(F.transform(blocks, lambda i: _mac(key, F.concat(base, i.cast("string")))), "")


def _draw(digest: Column, at: Column, of: int) -> Column:
    """A number below ``of`` from place ``at`` (from 1)."""
    return F.pmod(F.conv(F.substring(digest, (at - 1) * 4 + 1, F.lit(4)), 16, 10).cast("int"), F.lit(of))


def _chars(e: Column, change: Callable[[Column, Column], Column]) -> Column:
    """change(character, its place from 1) for each character of e."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(e)), lambda i: change(F.substring(e, i, F.lit(1)), i)), "")


def _pick(letters: str, at: Column) -> Column:
    return F.substring(F.lit(letters), at + 1, F.lit(1))


def _like(c: Column, n: Column) -> Column:
    """A character of the class of c chosen by the number n: digit, ASCII or Cyrillic or other letter of its case, or c itself."""
    low, cyr = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя"
    return (
        F.when(c.rlike("[0-9]"), F.pmod(n, F.lit(10)).cast("string"))
        .when(c.rlike("[a-z]"), _pick(low, F.pmod(n, F.lit(26))))
        .when(c.rlike("[A-Z]"), _pick(low.upper(), F.pmod(n, F.lit(26))))
        .when(c.rlike(r"[\p{IsCyrillic}&&\p{Lu}]"), _pick(cyr.upper(), F.pmod(n, F.lit(27))))
        .when(c.rlike(r"\p{IsCyrillic}"), _pick(cyr, F.pmod(n, F.lit(27))))
        .when(c.rlike(r"\p{Lu}"), _pick(low.upper(), F.pmod(n, F.lit(26))))
        .when(c.rlike(r"\p{L}"), _pick(low, F.pmod(n, F.lit(26))))
        .otherwise(c)
    )


def _alike(e: Column, d: Column, fixed: Callable[[Column, Column], Column] | None = None) -> Column:
    """e with each character drawn anew from its class; fixed(character, place) holds those that stay."""

    def change(c: Column, i: Column) -> Column:
        new = _let(_draw(d, i, 65536), lambda n: _like(c, n))
        return F.when(fixed(c, i), c).otherwise(new) if fixed else new

    return _chars(e, change)


def _digits(e: Column, d: Column, fixed: Column) -> Column:
    """e with its digits after the first ``fixed`` drawn anew; the n-th digit depends on n alone, so layouts agree."""

    def change(c: Column, i: Column) -> Column:
        n = F.length(F.regexp_replace(F.substring(e, F.lit(1), i), r"\D", ""))
        return F.when(c.rlike("[0-9]") & (n > fixed), _draw(d, n, 10).cast("string")).otherwise(c)

    return _chars(e, change)


def _card(e: Column, d: Column) -> Column:
    def close(drawn: Column) -> Column:
        body = F.substring(F.regexp_replace(drawn, r"\D", ""), F.lit(1), F.length(F.regexp_replace(e, r"\D", "")) - 1)
        last = F.pmod(10 - F.pmod(_let(F.concat(body, F.lit("0")), _luhn), F.lit(10)), F.lit(10)).cast("string")
        return F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), last)

    return _let(_digits(e, d, F.lit(1)), close)


def _email(e: Column, d: Column) -> Column:
    top = F.length(e) - F.length(F.substring_index(e, ".", -1))
    return _alike(e, d, lambda c, i: c.isin("@", ".") | (i > top))


def _secret(e: Column, d: Column) -> Column:
    hexed = _chars(e, lambda c, i: _pick("0123456789abcdef", _draw(d, i, 16)))
    return F.when(~e.rlike("^[0-9A-Fa-f]+$"), _alike(e, d)).when(e == F.upper(e), F.upper(hexed)).otherwise(hexed)


def _ip(d: Column) -> Column:
    return F.concat_ws(".", *[(_draw(d, F.lit(i), 254) + 1).cast("string") for i in range(1, 5)])


def _tokens(e: Column, known: Column | None = None) -> Column:
    """A person's words as (word, kind): title, her, his (first names), or last. A bare word has its kind from ``known``."""
    words = F.split(e, " ")
    title = F.regexp_replace(F.element_at(words, 1), r"\.", "")
    titled = title.isin(*_TITLE.split("|"))
    by_title = F.when(title.isin(*_HER), "her").when(title.isin(*_HIS), "his").otherwise("last")
    first = F.when(titled, by_title).otherwise("last")

    def kind(w: Column, i: Column) -> Column:
        more = i < F.size(words) - 1
        own = F.when(titled & (i == 0), "title").when(w.isin(*WOMEN), "her").when(w.isin(*MEN), "his").when(more, first).otherwise("last")
        if known is None:
            return own
        return F.when(F.size(words) == 1, F.coalesce(F.get(F.filter(known, lambda t: t["word"] == w), F.lit(0))["kind"], own)).otherwise(own)

    return F.transform(words, lambda w, i: F.struct(w.alias("word"), kind(w, i).alias("kind")))


def _name(word: Column, kind: Column, d: Column) -> Column:
    """A made-up name of syllables in the word's script; a woman's ends in na, others in a consonant, so lengths tell them apart."""
    cyrillic = word.rlike(r"\p{IsCyrillic}")
    v, c = (F.when(cyrillic, F.lit(x)).otherwise(F.lit(y)) for x, y in (("аеиоу", _VOWELS), ("бдфглмнпрств", _CONSONANTS)))
    at = lambda s, i, n: F.substring(s, _draw(d, F.lit(i), n) + 1, F.lit(1))
    stem = F.concat(*[x for i in range(0, 6, 2) for x in (at(c, i + 1, 12), at(v, i + 2, 5))])
    end = F.when(kind == "her", F.when(cyrillic, "на").otherwise("na")).otherwise(at(c, 7, 12))
    return F.initcap(F.concat(stem, end))


def _new(e: Column, kind: Column, d: Column, person: Column) -> Column:
    """The surrogate of entity e from its digest; of a person, what ``person`` says."""
    country = F.length(F.regexp_replace(F.regexp_extract(e, r"^\+\d{1,3}(?=[ .(-])", 0), r"\D", ""))
    return (
        F.when(kind == "email", _email(e, d))
        .when(kind == "ip", _ip(d))
        .when(kind == "ssn", _digits(e, d, F.lit(0)))
        .when(kind == "phone", _digits(e, d, country))
        .when(kind == "card", _card(e, d))
        .when(kind == "iban", F.concat(F.substring(e, 1, 2), _let(F.substring(e, F.lit(3), F.length(e)), lambda rest: _alike(rest, d))))
        .when(kind == "secret", _secret(e, d))
        .when(kind == "number", e)
        .otherwise(person)
    )


def _surrogates(key: str, found: Column, known: Column, attempt: Callable[[Column, Column], Column]) -> Column:
    """The surrogates of an array of entities; attempt(kind, form) gives the number of the attempt to take."""
    name = F.lit("name")

    def person(e: Column) -> Column:
        low = F.transform(_tokens(e, known), lambda t: F.struct(t["word"].alias("word"), t["kind"].alias("kind"), F.lower(t["word"]).alias("form")))
        keyed = F.transform(low, lambda t: F.struct(t["word"].alias("word"), t["kind"].alias("kind"), _digest(key, name, t["form"], attempt(name, t["form"]), F.lit(7)).alias("d")))
        return F.array_join(F.transform(keyed, lambda t: F.when(t["kind"] == "title", t["word"]).otherwise(_name(t["word"], t["kind"], t["d"]))), " ")

    kinds = F.transform(found, lambda e: F.struct(e.alias("e"), _kind(e).alias("kind")))
    forms = F.transform(kinds, lambda s: F.struct(s["e"].alias("e"), s["kind"].alias("kind"), _form(s["kind"], s["e"]).alias("form")))
    keyed = F.transform(forms, lambda s: F.struct(s["e"].alias("e"), s["kind"].alias("kind"), _digest(key, s["kind"], s["form"], attempt(s["kind"], s["form"]), F.length(s["e"])).alias("d")))
    return F.transform(keyed, lambda s: _new(s["e"], s["kind"], s["d"], person(s["e"])))


def _searched(docs: DataFrame) -> DataFrame:
    """The rows with pattern, known and found: the entities of text in order, bare mentions of its persons included.

    Most texts have neither digits nor @, and are searched for what needs neither.
    """
    rich = F.col("text").rlike("[0-9@]")
    full = F.when(rich, F.regexp_extract_all("text", F.lit(ANY), 0)).otherwise(F.regexp_extract_all("text", F.lit(WORDY), 0))
    docs = docs.withColumn("full", F.coalesce(full, F.array().cast("array<string>"))).withColumn("rich", rich)
    persons = F.filter("full", lambda e: _kind(e) == "person")
    parts = F.filter(F.flatten(F.transform(persons, lambda e: _tokens(e))), lambda t: (t["kind"] != "title") & (F.length(t["word"]) > 1))
    docs = docs.withColumn("known", F.when(F.size("full") > 0, F.array_sort(F.array_distinct(parts))).otherwise(F.array().cast("array<struct<word:string,kind:string>>")))
    base = F.when(F.col("rich"), F.lit(ANY)).otherwise(F.lit(WORDY))
    bare = F.concat(F.lit(r"|(?=\p{Lu})(?<![\p{L}\p{N}])(?:"), F.array_join(F.array_distinct(F.transform("known", lambda t: t["word"])), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    docs = docs.withColumn("pattern", F.when(F.size("known") > 0, F.concat(base, bare)).otherwise(base))
    return docs.withColumn("found", F.when(F.size("known") > 0, F.regexp_extract_all("text", F.col("pattern"), 0)).otherwise(F.col("full"))).drop("full", "rich")


def _forms(e: Column) -> Column:
    """(kind, form, example) that decide an entity's surrogate: one, or a person's words singly."""
    words = F.transform(F.filter(_tokens(e), lambda t: t["kind"] != "title"), lambda t: F.struct(F.lit("name").alias("kind"), F.lower(t["word"]).alias("form"), t["word"].alias("example")))
    kind = _kind(e)
    return F.when(kind == "person", words).otherwise(F.array(F.struct(kind.alias("kind"), _form(kind, e).alias("form"), e.alias("example"))))


def _mentions(searched: DataFrame) -> DataFrame:
    """Distinct (kind, form, example) of the entities in the texts."""
    found = searched.select(F.explode(F.array_distinct("found")).alias("e")).distinct()
    parts = found.select(F.explode(_forms(F.col("e"))).alias("t")).where("t.kind <> 'number'")
    return parts.groupBy("t.kind", "t.form").agg(F.min("t.example").alias("example"))


def attempts(searched: DataFrame, key: str, most: int = 50) -> DataFrame:
    """kind, form, attempt: the first attempt of each distinct entity whose surrogate is no other's and no real entity."""
    state = materialise(_mentions(searched).withColumn("attempt", F.lit(0)), "entities")
    for _ in range(most):
        is_name, kind = F.col("kind") == "name", F.col("kind")
        drawn = state.withColumn("d", _digest(key, kind, F.col("form"), F.col("attempt"), F.length("example")))
        # a name may take either ending, and neither may be real
        name = lambda of: F.lower(_name(F.col("example"), F.lit(of), F.col("d")))
        other = _form(kind, _new(F.col("example"), kind, F.col("d"), F.lit(None).cast("string")))
        drawn = drawn.withColumn("one", F.when(is_name, name("last")).otherwise(other)).withColumn("two", F.when(is_name, name("her")).otherwise(F.col("one")))
        real = state.select("kind", "form")
        # one surrogate has few claimants: its draw is a hash
        rank = F.row_number().over(Window.partitionBy("kind", "claim").orderBy("attempt", "form"))
        claim = F.when(is_name, F.substring("one", 1, 6)).otherwise(F.col("one"))
        judged = drawn.withColumn("claim", claim).withColumn("again", rank > 1)
        for place in ("one", "two"):
            judged = judged.join(real.select("kind", F.col("form").alias(place), F.lit(True).alias(f"real_{place}")), ["kind", place], "left")
        again = F.col("again") | F.col("real_one").isNotNull() | F.col("real_two").isNotNull()
        state = materialise(judged.select("kind", "form", "example", (F.col("attempt") + again.cast("int")).alias("attempt"), again.alias("again")), "entities")
        if state.where("again").isEmpty():
            return state.select("kind", "form", "attempt")
        state = state.drop("again")
    raise RuntimeError(f"surrogates still collide after {most} attempts")


def pseudonymise(docs: DataFrame, key: str, count: str | None = None) -> DataFrame:
    """The rows and columns of ``docs`` with the entities of text replaced; with ``count``, also their number, a column of that name.

    Null, empty and entity-free texts stay as they are; equal texts change alike, whatever their ids; an empty table stays
    empty; other columns may have any names. Without ``key`` the surrogates cannot be told from the entities by computing
    them anew.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = _searched(docs.select(whole, "text"))
    again = attempts(rows, key).where("attempt > 0")
    if again.isEmpty():
        rows = rows.withColumn("attempts", F.lit(None).cast("map<string,int>"))
    else:  # the texts that hold such an entity get their attempts by a join on the text's digest
        rows = rows.withColumn("digest", F.sha2("text", 256))
        pairs = rows.where("size(found) > 0").select("digest", F.explode("found").alias("e")).distinct()
        used = pairs.select("digest", F.explode(_forms(F.col("e"))).alias("t")).select("digest", "t.kind", "t.form").distinct().join(again, ["kind", "form"])
        maps = used.groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct(F.concat("kind", F.lit(":"), "form"), "attempt"))).alias("attempts"))
        rows = rows.join(maps, "digest", "left")
    taken = lambda kind, form: F.coalesce(F.try_element_at(F.col("attempts"), F.concat(kind, F.lit(":"), form)), F.lit(0))
    rows = rows.withColumn("new", F.when(F.size("found") > 0, _surrogates(key, F.col("found"), F.col("known"), taken)))
    joined = F.array_join(F.transform(F.split("text", F.col("pattern"), -1), lambda p, i: F.concat(p, F.coalesce(F.get("new", i), F.lit("")))), "")
    rows = rows.withColumn("text", F.when(F.size("found") > 0, joined).otherwise(F.col("text")))
    number = [F.size(F.filter("found", lambda e: _kind(e) != "number")).alias(count)] if count else []
    return rows.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c != count], *number)


#: Holds the key; without it each driver process draws one of its own, so surrogates of two runs differ.
KEY_SETTING = "spark.citeloom.privacy.key"
_OWN_KEY = secrets.token_hex(32)


def key_of(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, None) or _OWN_KEY


def op5_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, key_of(spark), "n_entities").select("doc_id", "n_entities", "text")
