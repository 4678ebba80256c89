"""Personal names as Column expressions: keys, spellings, ways to part a name, and whether two names are one person's."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings that count as one in romanised names, in their order, fixed values.
ROMANISED = [("ou", "o"), ("oh", "o"), ("oo", "o"), ("uu", "u"), ("tsu", "tu"), ("shi", "si"), ("chi", "ti"), ("ji", "zi"), ("fu", "hu")]

#: Latin letters with marks and what is left of them without, by their decomposition.
_BARE = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)) for c in block if unicodedata.normalize("NFD", chr(c))[0].isascii()}


def unmarked(s: Column) -> Column:
    """Latin letters without marks, whether these are part of the letter or stand behind it; lower case."""
    return F.lower(F.regexp_replace(F.translate(s, "".join(_BARE), "".join(_BARE.values())), "\\p{Mn}", ""))


def _said(name: Column, joiners: str) -> Column:
    """A name without bracketed parts and sort marks, letters on both sides of a joiner closed up."""
    open_ = F.regexp_replace(F.coalesce(name, F.lit("")), "\\(.*?\\)", " ")
    return F.regexp_replace(unmarked(open_), f"[\x98\x9c]|(?<=[\\p{{L}}\\p{{N}}_])[{joiners}](?=[\\p{{L}}\\p{{N}}_])", "")


def _words(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit("[a-z]+"), 0)


def person_key(name: Column) -> Column:
    """struct(family, tokens): the letters before a comma, else the last word, and all different words sorted; null if fewer than two words and four letters."""
    said = F.replace(F.replace(_said(name, "'’ʼ`-"), F.lit("ou"), F.lit("o")), F.lit("uu"), F.lit("u"))
    words = _words(said)
    family = F.when(F.contains(said, F.lit(",")), F.regexp_replace(F.substring_index(said, ",", 1), "[^a-z]", "")).otherwise(F.element_at(words, -1))
    enough = (F.size(words) > 1) | (F.length(F.array_join(words, "")) > 3)
    return F.when(enough, F.struct(family.alias("family"), F.array_sort(F.array_distinct(words)).alias("tokens")))


def romanised(token: Column) -> Column:
    """One spelling of a romanised token, doubled letters single."""
    for spelling, to in ROMANISED:
        token = F.replace(token, F.lit(spelling), F.lit(to))
    return F.regexp_replace(token, "(.)\\1", "$1")


def same_person(p: Column, q: Column) -> Column:
    """Two person keys agree: the same words in any order, written together or apart, or a family name of one (four letters) among the words of the
    other, give or take one letter in five."""
    a, b = (F.transform(k["tokens"], romanised) for k in (p, q))
    run = lambda x: F.array_join(x, "")
    whole = (run(F.array_sort(a)) == run(F.array_sort(b))) | run(a).isin(run(b), run(F.reverse(b)))

    def held(family: Column, tokens: Column) -> Column:
        spelt = romanised(family)
        near = lambda t: (F.least(F.length(family), F.length(t)) > 4) & (F.levenshtein(spelt, romanised(t)) < 2)
        return (F.length(family) > 3) & F.exists(tokens, lambda t: (spelt == romanised(t)) | near(t))

    return F.coalesce(whole | held(p["family"], q["tokens"]) | held(q["family"], p["tokens"]), F.lit(False))


def person_splits(name: Column) -> Column:
    """Sorted structs (family, given) of the ways to part a name: as its comma says, else the family first, the family last, or one pen name."""
    said = _said(name, "-‐'’")
    letters = lambda s: F.regexp_replace(s, "[^a-z]", "")
    words, way = _words(said), lambda family, given: F.struct(family.alias("family"), given.alias("given"))
    n, run = F.size(words), lambda x: F.array_join(x, "")
    told = F.array(way(letters(F.substring_index(said, ",", 1)), letters(F.regexp_extract(said, ",([\\s\\S]*)$", 1))))
    either = F.array(way(F.get(words, F.lit(0)), run(F.slice(words, F.lit(2), n))), way(F.get(words, n - 1), run(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))))), way(run(words), F.lit("")))
    ways = F.when(F.contains(said, F.lit(",")), told).when(n > 0, either)
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(ways, lambda w: w["family"] != ""))), F.array().cast("array<struct<family: string, given: string>>"))
