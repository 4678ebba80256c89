"""Records out of page markup: volume templates, tables, infoboxes, counted lists and links, in Arrow batches."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions import worded
from claimloom.functions.text import _series, clean_value, field_map, numbers_in, split_fields, templates

_S, _I = T.StringType(), T.IntegerType()


def _struct(**kinds) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def _isbn(text: str | None) -> str | None:
    """The first ISBN-13 of a text with a right check digit."""
    for m in re.findall(r"97[89](?:[- ]?\d){10}", text or ""):
        digits = re.sub(r"\D", "", m)
        if sum(int(d) * (3 if i % 2 else 1) for i, d in enumerate(digits)) % 10 == 0:
            return digits
    return None


#: Registration groups of the markets, longest first.
GROUPS = [("979-10", "FR"), ("979-11", "KR"), ("979-8", "EN"), ("978-89", "KR"), ("978-4", "JP"), ("978-0", "EN"), ("978-1", "EN"), ("978-2", "FR"), ("978-3", "DE")]


def isbn_market(isbn: str | None) -> str | None:
    """The market whose registration group an ISBN-13 begins with, the longest prefix first."""
    return next((market for group, market in GROUPS if isbn and isbn.startswith(group.replace("-", ""))), None)


def blank(value: str | None) -> bool:
    return not clean_value(value or "") or bool(re.fullmatch(r"[-–—?ー]+|n/?a|tba|tbd", clean_value(value or ""), re.I))


def volume_records(text: str | None, template: str = "Graphic novel list") -> list[dict]:
    """A record for each volume template: number, its offset, title, original and licensed date and ISBN, chapters.

    A market without date and ISBN is none; a volume with neither market is announced in the original one. Headers (name/...) are no rows.
    """
    out = []
    for t in templates(text, template):
        head = split_fields(t["body"])[0]
        f = field_map(t["body"])
        number = clean_value(f.get("volumenumber", ""))
        if "/" in head or blank(number):
            continue
        get = lambda *names: next((f[n] for n in names if not blank(f.get(n))), None)
        day = lambda v: worded.parse_date(clean_value(v)) if v else None
        one = {"number": re.sub(r"^0+(?=\d)", "", number), "offset": t["offset"], "title": clean_value(get("licensedtitle", "title", "originaltitle"))}
        for side, dates, isbns in (("original", ("originalreldate", "reldate"), ("originalisbn", "isbn")), ("licensed", ("licensedreldate",), ("licensedisbn",))):
            one |= {f"{side}_date": day(get(*dates)), f"{side}_isbn": _isbn(get(*isbns))}
        one["chapters"] = numbers_in(" ".join(clean_value(v) for k, v in f.items() if k.startswith("chapterlist")))
        one["announced"] = not any(one[f"{s}_{k}"] for s in ("original", "licensed") for k in ("date", "isbn"))
        if not one["announced"] or one["title"] or number.isdigit():
            out.append(one)
    return out


def table_rows(text: str | None) -> list[dict]:
    """Rows of wiki tables as (number, market, isbn, day): ISBNs name their own market and dates are counted in the order of the markets, so spans don't matter.

    A second edition's row of a (number, market) that is there already goes.
    """
    out, seen = [], set()
    for table in re.findall(r"\{\|.*?\|\}", text or "", flags=re.S):
        for row in re.split(r"\n\|-[^\n]*", table):
            cells = [c for c in re.split(r"\|\||\n\|", row) if c.strip()]
            number = next((m[1] for c in cells[:2] if (m := re.fullmatch(r"\s*(?:rowspan[^|]*\|)?\s*0*(\d{1,4}(?:[.,]\d)?)\s*", c))), None)
            found = dict.fromkeys(i for m in re.findall(r"97[89](?:[- ]?\d){10}", row) if (i := _isbn(m)))
            dates = re.findall(r"\b(?:19|20)\d\d-\d\d-\d\d\b", row)
            if number is None or not (dates or found):
                continue
            by: dict[str, str] = {}
            for i in found:
                by.setdefault(isbn_market(i) or "?", i)
            order = [m for m in ("JP", "DE", "FR", "EN") if m in by] + [m for m in by if m not in ("JP", "DE", "FR", "EN")]
            for place, market in enumerate(order):
                if (number, market) not in seen:
                    seen.add((number, market))
                    out.append({"number": number.replace(",", "."), "market": market, "isbn": by[market], "day": dates[place] if place < len(dates) else None})
    return out


def counted_numbers(text: str | None) -> list[int]:
    """Numbers that lists state by count: <ol start=N>, list templates with start=N, and # lines behind one with a value."""
    out: list[int] = []
    for start, body in re.findall(r"<ol[^>]*\bstart=[\"']?(\d+)[^>]*>(.*?)(?=<ol|</ol|$)", text or "", flags=re.S | re.I):
        n = len(re.findall(r"<li\b", body, re.I))
        out += range(int(start), int(start) + n)
    for t in templates(text, "numbered list"):
        args = split_fields(t["body"])[1:]
        start = next((int(m[1]) for a in args if (m := re.match(r"\s*start\s*=\s*(\d+)", a))), 1)
        items = [a for a in args if a.strip() and not re.match(r"\s*\w+\s*=", a)]
        out += range(start, start + len(items))
    at = None
    for value in re.findall(r"^#(?:\s*<li value=[\"']?(\d+)[\"']?>)?", text or "", flags=re.M):
        at = int(value) if value else at
        if at is not None:
            out.append(at)
            at += 1
    return out


def entries(text: str | None) -> list[dict]:
    """A chapter cell as (mark, entry): bullets, other list lines, or the cell's <br> pieces where it has no list."""
    t = re.sub(r"<nowiki\s*/?>", "", text or "")
    if not re.search(r"^[*#:]", t, re.M):
        return [{"mark": "*" if not i else "br", "entry": p.strip()} for i, p in enumerate(re.split(r"<br\s*/?>", t, flags=re.I)) if p.strip()]
    return [{"mark": m if m == "*" else "list", "entry": e.strip()} for m, e in re.findall(r"^([*#:])+\s*([^\n]*)", t, flags=re.M) if e.strip()]


_STALE = re.compile(r"\b(former(ly)?|expired|defunct|webcomic|self-published)\b", re.I)
_NOW = re.compile(r"\b(current|present|print)\b", re.I)


def current_publisher(value: str | None) -> str | None:
    """Of a field's publishers the one marked as current, else the first not marked as past, else the first; status words go."""
    told = []
    for part in re.split(r"<br\s*/?>", re.sub(r"</?small>", " ", value or "", flags=re.I), flags=re.I):
        plain = clean_value(part) or ""
        name = re.sub(r"\s+", " ", re.sub(r"\(\s*(?:former(?:ly)?|current(?:ly)?|expired|defunct|original)\s*\)", "", plain, flags=re.I)).strip(" ,;")
        if name:
            told.append((bool(_STALE.search(plain)), not _NOW.search(plain), len(told), name))
    live = [x for x in told if not x[0]] or told
    return min(live, key=lambda x: (x[1], x[2]))[3] if live else None


def english_publisher(value: str | None) -> str | None:
    """The publisher of the first of NA, US, EN and UK in a regional template, else of another region, else the plain field's."""
    found = templates(value, "English manga publisher")
    if not found:
        return current_publisher(value)
    regions = {k.upper(): current_publisher(v) for k, v in field_map(found[0]["body"]).items()}
    return next((regions[r] for r in ("NA", "US", "EN", "UK", "AUS", "NZ", "SEA") if regions.get(r)), None)


def _items(value: str | None) -> list[str]:
    inner = templates(value, "ubl") or templates(value, "plainlist")
    raw = split_fields(inner[0]["body"])[1:] if inner else re.split(r"<br\s*/?>|,|;", value or "")
    return list(dict.fromkeys(x for r in raw if (x := (clean_value(r) or "").strip(" *"))))


def infobox_facts(text: str | None, list_article: str | None = None) -> dict | None:
    """Facts of the print infobox that names our list article, else of the first."""
    boxes = [field_map(t["body"]) for t in templates(text, "Infobox animanga/Print")]
    if not boxes:
        return None
    f = next((b for b in boxes if list_article and squeezed(clean_value(b.get("volume_list"))) == squeezed(list_article)), boxes[0])
    header = next((field_map(t["body"]) for t in templates(text, "Infobox animanga/Header")), {})
    first, last = (worded.parse_date(clean_value(f.get(k))) if f.get(k) else None for k in ("first", "last"))
    volumes = re.match(r"\d{1,4}", clean_value(f.get("volumes", "")) or "")
    return {
        "name": clean_value(header.get("name")), "genres": "|".join(_items(header.get("genre"))[:6]), "author": "|".join(_items(f.get("author"))[:4]), "publisher": current_publisher(f.get("publisher")),
        "publisher_en": english_publisher(f.get("publisher_en")), "first": first, "last": last, "status": ("ended" if last else "ongoing") if first or last else None,
        "volumes": int(volumes[0]) if volumes else None, "volume_list": clean_value(f.get("volume_list")),
    }


def squeezed(s: str | None) -> str:
    return re.sub(r"[^a-z0-9]", "", unicodedata.normalize("NFKD", s or "").lower())


def lead_link(text: str | None, work: str | None) -> str | None:
    """The target of the lead's first italic link that holds the work's title, in its target or what it shows."""
    want = squeezed(work)
    for target, shown in re.findall(r"''+\[\[([^\]|]+)(?:\|([^\]]*))?\]\]''+", (text or "")[:4000]):
        if not re.match(r"\w+:", target) and (not want or want in squeezed(target) or want in squeezed(shown)):
            return target.strip()
    return None


def names_back(name: str | None, volume_list: str | None, work: str | None, list_article: str | None) -> bool:
    """A page counts only if its infobox names the work or the list article it was found from."""
    return bool(name and squeezed(work) in squeezed(name)) or bool(volume_list and squeezed(volume_list) == squeezed(list_article))


VOLUME = _struct(number=_S, offset=_I, title=_S, original_date=_S, original_isbn=_S, licensed_date=_S, licensed_isbn=_S, chapters=T.ArrayType(T.DoubleType()), announced=T.BooleanType())
volumes_of = _series(volume_records, T.ArrayType(VOLUME))
rows_of = _series(table_rows, T.ArrayType(_struct(number=_S, market=_S, isbn=_S, day=_S)))
counted = _series(counted_numbers, T.ArrayType(_I))
entries_of = _series(entries, T.ArrayType(_struct(mark=_S, entry=_S)))
current_publisher_of = _series(current_publisher, _S)
english_publisher_of = _series(english_publisher, _S)
FACTS = _struct(name=_S, genres=_S, author=_S, publisher=_S, publisher_en=_S, first=_S, last=_S, status=_S, volumes=_I, volume_list=_S)
facts_of = _series(lambda t: [x for x in [infobox_facts(t)] if x], T.ArrayType(FACTS))
market_of = _series(isbn_market, _S)


@F.pandas_udf(_S)
def lead_links(text, work):
    """lead_link over two columns."""
    import pandas as pd

    return pd.Series([lead_link(t, w) for t, w in zip(text, work)])


def run_shape(entry: Column) -> Column:
    """struct(shape, number) of an entry that may be part of a numbered run: bare, padded, ordinal or label."""
    e = F.trim(entry)
    shapes = [("bare", "^([0-9]{1,4})$", 1), ("padded", "^(0[0-9])\\s+\\p{L}", 1), ("ordinal", "^['\"“\\s]*([0-9]{1,4})(?:st|nd|rd|th)\\s+(\\p{L}+)", 1), ("label", "^['\"“\\s]*\\p{L}{2,12}[\\s.:#]*([0-9]{1,4})['\"”\\s]*$", 1)]
    shape = F.coalesce(*[F.when(e.rlike(p), name) for name, p, _ in shapes])
    number = F.coalesce(*[F.when(e.rlike(p), F.regexp_extract(e, p, g)) for _, p, g in shapes]).try_cast("int")
    word = F.lower(F.coalesce(F.nullif(F.regexp_extract(e, "(?:st|nd|rd|th)\\s+(\\p{L}+)", 1), F.lit("")), F.regexp_extract(e, "^['\"“\\s]*(\\p{L}{2,12})", 1)))
    return F.struct(F.when(shape.isin("ordinal", "label"), F.concat_ws(" ", shape, F.regexp_replace(word, "s$", ""))).otherwise(shape).alias("shape"), number.alias("number"))
