"""Dates in words of several languages, in Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from calendar import monthrange

from pyspark.sql import types as T

from claimloom.functions.text import _series

#: Month names by language, fixed values; abbreviations of three letters or more count too.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
}


def _plain(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))


_NUMBER: dict[str, set[int]] = {}
for _names in MONTHS.values():
    for _i, _name in enumerate(_names.split(), 1):
        for _n in range(3, len(_plain(_name)) + 1):
            _NUMBER.setdefault(_plain(_name)[:_n], set()).add(_i)


def month_number(word: str) -> int | None:
    """The month that a name or an unambiguous abbreviation stands for."""
    found = _NUMBER.get(_plain(word).rstrip("."), set())
    return next(iter(found)) if len(found) == 1 else None


def _iso(y: int, m: int | None, d: int | None) -> str | None:
    if not m or not 1 <= m <= 12:
        return f"{y:04d}"
    if not d or not 1 <= d <= monthrange(y, m)[1]:
        return f"{y:04d}-{m:02d}"  # an impossible day leaves the month
    return f"{y:04d}-{m:02d}-{d:02d}"


def parse_date(text: str | None) -> str | None:
    """An ISO date cut to the precision that the text has; day and month that could be swapped leave the year."""
    if not text:
        return None
    t = text.strip()
    if m := re.search(r"(\d{4})\s*年\s*(?:(\d{1,2})\s*月)?\s*(?:(\d{1,2})\s*日)?", t):
        return _iso(int(m[1]), int(m[2] or 0), int(m[3] or 0))
    if m := re.search(r"\b(\d{4})-(\d{1,2})(?:-(\d{1,2}))?\b", t):
        return _iso(int(m[1]), int(m[2]), int(m[3] or 0))
    if m := re.search(r"\b(\d{1,2})[./](\d{1,2})[./](\d{4})\b", t):
        a, b, y = int(m[1]), int(m[2]), int(m[3])
        if a > 12 or "." in m[0]:
            return _iso(y, b, a)
        return _iso(y, a, b) if b > 12 or a == b else f"{y:04d}"
    if m := re.search(r"\b(\d{1,2})(?:er|st|nd|rd|th|\.)?\s+(?:de\s+)?([^\W\d_]{3,})\.?,?\s+(?:de\s+)?(\d{4})\b", t):
        return _iso(int(m[3]), month_number(m[2]), int(m[1]))
    if m := re.search(r"\b([^\W\d_]{3,})\.?\s+(?:(\d{1,2})(?:st|nd|rd|th)?,?\s+)?(?:de\s+)?(\d{4})\b", t):
        month = month_number(m[1])
        return _iso(int(m[3]), month, int(m[2] or 0) if month else 0)
    m = re.search(r"\b(1[89]\d\d|20\d\d)\b", t)
    return m[1] if m else None


iso_date = _series(parse_date, T.StringType())
