"""Column functions for keys, identifiers and partial dates. All stay inside codegen unless noted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_key(s: Column) -> Column:
    """Lower case; every run of other than a-z and 0-9 becomes one space; trimmed."""
    return F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))


def compact_key(s: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.regexp_replace(F.lower(s), "[^\\p{L}\\p{N}]", "")


def article_free_key(s: Column) -> Column:
    """compact_key without a leading English article."""
    return compact_key(F.regexp_replace(F.lower(s), "^(the|an|a)\\s+", ""))


def ampersand_key(s: Column) -> Column:
    return compact_key(F.regexp_replace(s, "\\s*&\\s*", " and "))


def deslug(s: Column) -> Column:
    """Hyphens and underscores to single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(s, "[-_]+", " "), "\\s+", " "))


def base_title(s: Column) -> Column:
    """What stands before the first ': ', ' - ' or ' ('."""
    return F.trim(F.regexp_extract(s, "^(.*?)(: | - | \\(|$)", 1))


def title_heads(s: Column) -> Column:
    """Heads of more than two characters before each subtitle separator, in order, without repeats."""
    return F.array_distinct(F.filter(F.array(*[F.trim(F.substring_index(s, sep, 1)) for sep in (": ", " - ", " (")]), lambda x: (F.length(x) > 2) & (x != s)))


def alias_variants(s: Column) -> Column:
    """The string, its key and its heads, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.concat(F.array(s, ascii_key(s)), title_heads(s)), lambda x: x.isNotNull() & (x != ""))))


def stem(s: Column) -> Column:
    """A title without the number that ends it."""
    return F.trim(F.regexp_extract(s, "^(.*?)\\s*[0-9]*$", 1))


def trailing_number(s: Column) -> Column:
    return F.regexp_extract(s, "([0-9]+)$", 1).try_cast("int")


def words_contain(haystack: Column, needle: Column) -> Column:
    """needle's word sequence occurs in haystack's, whole words only."""
    return F.contains(F.concat(F.lit(" "), ascii_key(haystack), F.lit(" ")), F.concat(F.lit(" "), ascii_key(needle), F.lit(" ")))


def all_in(words: Column, known: list[str]) -> Column:
    """Every word of a key belongs to a fixed set."""
    return F.forall(F.split(words, " "), lambda w: w.isin(known))


def natural_id(prefix: str, *parts: Column) -> Column:
    """Prefix and 12 hex digits of the SHA-256 of the stripped, lower-cased parts joined by |."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[F.lower(F.trim(p)) for p in parts]), 256), 1, 12))


def surrogate_int(s: Column, salt: int = 0) -> Column:
    """The first 31 bits below the sign of the SHA-256 of the string (salted if salt)."""
    text = F.concat(s, F.lit(f"#{salt}")) if salt else s
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint").bitwiseAND(2147483647)


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value worked out once a row, however often `then` names it: inside lambdas Spark shares no equal parts."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def isbn13_check(body: Column) -> Column:
    """The check digit of 12 digits, weights 1 and 3 in turn."""
    total = sum((F.substring(body, i, 1).cast("int") * (1 if i % 2 else 3) for i in range(1, 13)), F.lit(0))
    return F.pmod(10 - total % 10, F.lit(10)).cast("int")


def isbn13_valid(s: Column) -> Column:
    digits = F.regexp_replace(s, "[- ]", "")
    return F.when(digits.rlike("^97[89][0-9]{10}$"), isbn13_check(digits) == F.substring(digits, 13, 1).cast("int")).otherwise(F.lit(False))


def isbn10_to_13(s: Column) -> Column:
    """978 and the first nine digits with a new check digit; null for malformed input."""
    digits = F.regexp_replace(F.upper(s), "[- ]", "")
    body = F.concat(F.lit("978"), F.substring(digits, 1, 9))
    return F.when(digits.rlike("^[0-9]{9}[0-9X]$"), F.concat(body, isbn13_check(body).cast("string")))


def precision(d: Column) -> Column:
    """Of a truncated ISO date, from its length."""
    return F.when(F.length(d) == 4, "year").when(F.length(d) == 7, "month").when(F.length(d) == 10, "day")


def months_between_iso(a: Column, b: Column) -> Column:
    """Whole months from a to b by their years and months; days don't count."""
    part = lambda d, p, n: F.substring(d, p, n).cast("int")
    return (part(b, 1, 4) - part(a, 1, 4)) * 12 + part(b, 6, 2) - part(a, 6, 2)


def dated_by(d: Column, today: str, projected: Column | None = None) -> Column:
    """A truncated date that has come by today, at its own precision; a malformed one has not.

    The current year alone counts only once the projected month is past; without a projected month it does.
    """
    month = F.coalesce(projected, F.lit("")) if projected is not None else F.lit("")
    year = (d < today[:4]) | ((d == today[:4]) & (month <= today[:7]))
    well = F.coalesce(d.rlike("^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$"), F.lit(False))
    return well & F.when(F.length(d) == 4, year).otherwise(d <= F.substring(F.lit(today), F.lit(1), F.length(d)))


def volume_number(s: Column) -> Column:
    """A unit's number as struct(number, kind): int, fraction, roman or label."""
    roman = "^M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"
    t = F.trim(F.regexp_replace(F.lower(s), "^(vol(ume)?|no|nr|band|tome)\\.?\\s*", ""))
    kind = (
        F.when(t.rlike("^[0-9]+$"), "int").when(t.rlike("^[0-9]+[.,][0-9]+$"), "fraction").when((t != "") & F.upper(t).rlike(roman), "roman").otherwise("label")
    )
    number = F.when(kind == "int", F.regexp_replace(t, "^0+(?=[0-9])", "")).when(kind == "fraction", F.translate(t, ",", ".")).when(kind == "roman", roman_value(t).cast("string"))
    return F.struct(number.alias("number"), kind.alias("kind"))


def roman_value(s: Column) -> Column:
    value = F.create_map(*[F.lit(x) for pair in zip("IVXLCDM", (1, 5, 10, 50, 100, 500, 1000)) for x in pair])
    v = F.transform(F.split(F.upper(s), ""), lambda c: F.coalesce(F.try_element_at(value, c), F.lit(0)))
    return F.aggregate(F.zip_with(v, F.slice(v, F.lit(2), F.size(v)), lambda a, b: F.when(a < F.coalesce(b, F.lit(0)), -a).otherwise(a)), F.lit(0), lambda x, y: x + y)
