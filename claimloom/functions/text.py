"""What Catalyst has no expression for: Unicode folding and balanced-brace parsing, in Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.people import unmarked


#: Rules of the folding key in their order, fixed values; the first three are left out where numbers count.
_VOLUME_RULES = [(r"\b(?:vol(?:ume)?|band|bd|tome|nr)\.?\s*\d+.*$", ""), (r"[\s,.:;\-–]*\d{1,3}\.?\s*$", "")]
_SOUND_RULES = [(r"\bwo\b", "o"), ("ou", "o"), ("oo", "o"), ("uu", "u"), (r"\(.*?\)", " "), (r"[^0-9a-z぀-ヿ一-鿿가-힣]+", "")]


def _unmarked(s: str) -> str:
    """Without combining marks; what still composes is composed again."""
    return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)))


def fold(text: str | None, strip_volume: bool = True) -> str | None:
    """Folding key: compatibility forms and marks resolved, no leading article, volume suffix, parentheses or long vowels."""
    if text is None:
        return None
    t = unicodedata.normalize("NFKC", text.translate({0x98: None, 0x9C: None})).replace("×", "x").replace("&", " and ")
    t = re.sub(r"^the\s+", "", _unmarked(t).lower().strip())
    for pattern, to in (_VOLUME_RULES if strip_volume else []) + _SOUND_RULES:
        t = re.sub(pattern, to, t)
    return t


def folded(text: Column | str, strip_volume: bool = True) -> Column:
    """fold() as an expression, for texts whose only compatibility forms are full-width letters."""
    wide = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    t = F.col(text) if isinstance(text, str) else text
    t = F.regexp_replace(F.translate(t, "×" + "".join(wide), "x" + "".join(wide.values())), "[\x98\x9c]", "")
    t = F.regexp_replace(F.trim(unmarked(F.replace(t, F.lit("&"), F.lit(" and ")))), "^\\s*the\\s+", "")
    for pattern, to in (_VOLUME_RULES if strip_volume else []) + _SOUND_RULES:
        t = F.regexp_replace(t, pattern, to)
    return t


def strip_accents(text: str | None) -> str | None:
    """Marks go from Latin letters only; text without one comes back as it was."""
    if text is None:
        return None
    apart = unicodedata.normalize("NFD", text)
    bare = re.sub(r"([^\W\d_])([\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff]+)", lambda m: m[1] if "LATIN" in unicodedata.name(m[1], "") else m[0], apart)
    return text if bare == apart else unicodedata.normalize("NFC", bare)


def fold_numbers(text: str | None) -> str | None:
    """Numeric symbols become their plain form: Roman numeral signs letters, superscripts digits, fractions with a slash."""
    if text is None:
        return None
    plain = {c: unicodedata.normalize("NFKC", c) for c in set(text) if unicodedata.category(c) in ("No", "Nl")}
    return "".join(plain.get(c, c) for c in text).replace("\u2044", "/")


_MARKS = re.compile(r"\{\{|\}\}|\[\[|\]\]|\|")


def _marked(text: str) -> Iterator[tuple[int, str, int]]:
    """Position, mark and the number of groups that stay open behind it, for every brace pair, bracket pair and bar."""
    opened = 0
    for m in _MARKS.finditer(text):
        opened = max(0, opened + {"{{": 1, "[[": 1, "}}": -1, "]]": -1}.get(m[0], 0))
        yield m.start(), m[0], opened


def templates(text: str | None, name: str | None = None) -> list[dict]:
    """Outermost {{...}} with offset and body, braces balanced; unclosed ones are left out; with a name only those it opens, in any case."""
    found, stack = [], []
    for m in re.finditer(r"\{\{|\}\}", text or ""):
        if m[0] == "{{":
            stack.append(m.end())
        elif stack:
            begin = stack.pop()
            if not stack:
                found.append({"offset": begin - 2, "body": text[begin : m.start()]})
    return [t for t in found if name is None or re.match(rf"\s*{re.escape(name)}", t["body"], re.I)]


def split_fields(body: str | None) -> list[str]:
    """Splits at | outside of nested braces and brackets."""
    text = body or ""
    bars = [at for at, mark, opened in _marked(text) if mark == "|" and not opened]
    return [text[a:b] for a, b in zip([0, *(x + 1 for x in bars)], [*bars, len(text)])]


def field_map(body: str | None) -> dict[str, str]:
    """Named fields of a template body, keys lower-cased, values trimmed; the last of equal keys stays."""
    pairs = (part.partition("=") for part in split_fields(body)[1:])
    return {key.strip().lower(): value.strip() for key, sign, value in pairs if sign}


def clean_value(text: str | None) -> str | None:
    """A field's value as plain text: comments, references, tags, links, templates and quotes marks resolved."""
    if text is None:
        return None
    t = re.sub(r"<!--.*?-->|<ref[^>]*/>|<ref.*?</ref>", "", text, flags=re.S)
    t = re.sub(r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", r"\1", t)
    for found in reversed(templates(t)):
        args = split_fields(found["body"])
        t = t[: found["offset"]] + (args[-1] if len(args) > 1 else "") + t[found["offset"] + len(found["body"]) + 4 :]
    return re.sub(r"\s+", " ", re.sub(r"<[^>]+>|'{2,}", " ", t)).strip()


def number_range(first: float, last: float, most: int = 150) -> list[float]:
    """A chapter and those after it up to the last: whole ones and a last half; halves only where both ends are; no range over `most`."""
    if not first < last <= first + most:
        return [first]
    if first % 1 and last % 1:
        return [first + i for i in range(int(last - first) + 1)]
    return [first, *map(float, range(int(first) + 1, int(last) + 1)), *([last] if last % 1 else [])]


def numbers_in(text: str | None) -> list[float]:
    """Chapter numbers of a list: single ones and ranges, in order without repeats."""
    out: dict[float, None] = {}
    for a, b in re.findall(r"(\d+(?:\.\d+)?)(?:\s*[-–]\s*(\d+(?:\.\d+)?))?", text or ""):
        out |= dict.fromkeys(number_range(float(a), float(b or a)))
    return list(out)


def _series(f, kind: T.DataType):
    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(f, na_action="ignore") if isinstance(kind, T.StringType) else s.map(f)

    return run


fold_key = _series(fold, T.StringType())
numbered_key = _series(lambda t: fold(t, False), T.StringType())
accent_free = _series(strip_accents, T.StringType())
number_folded = _series(fold_numbers, T.StringType())
plain_value = _series(clean_value, T.StringType())
chapter_numbers = _series(numbers_in, T.ArrayType(T.DoubleType()))


_TEMPLATE = T.StructType(
    [T.StructField("start", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ("body", "name")], T.StructField("fields", T.MapType(T.StringType(), T.StringType()))]
)


@F.udtf(returnType=_TEMPLATE)
class ExtractTemplates:
    """A row for each outermost template of a text."""

    def eval(self, text: str):
        for t in templates(text):
            yield t["offset"], t["body"], split_fields(t["body"])[0].strip(), field_map(t["body"])


MARC = (
    "leader string, controlfield array<struct<_tag:string,_VALUE:string>>, "
    "datafield array<struct<_tag:string,_ind1:string,_ind2:string,subfield:array<struct<_code:string,_VALUE:string>>>>"
)


def marc_record(xml):
    """A MARC-XML record as a struct of leader, cf (map) and df (array of fields with subs)."""
    r = F.from_xml(xml, MARC)
    cf = F.map_from_entries(F.transform(r.controlfield, lambda c: F.struct(c["_tag"], c["_VALUE"])))
    df = F.transform(
        r.datafield,
        lambda d: F.struct(d["_tag"].alias("tag"), d["_ind1"].alias("i1"), d["_ind2"].alias("i2"), F.transform(d.subfield, lambda s: F.struct(s["_code"].alias("code"), s["_VALUE"].alias("value"))).alias("subs")),
    )
    return F.struct(r.leader.alias("leader"), cf.alias("cf"), df.alias("df"))


def subfields(record, tag: str, code: str):
    """All values of a subfield, in order."""
    fields = F.filter(record.df, lambda d: d.tag == tag)
    return F.flatten(F.transform(fields, lambda d: F.transform(F.filter(d.subs, lambda s: s.code == code), lambda s: s.value)))
