"""Partial dates as column functions: templates, compact and free-text forms, and the policies that choose between dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English and French month names, fixed values; abbreviations of three letters or more count where they stand for one month.
MONTHS = {
    "EN": "january february march april may june july august september october november december".split(),
    "FR": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
}


def month_index(word: Column, market: str = "EN") -> Column:
    """The month that a name, an abbreviation or a number stands for."""
    w = F.lower(F.trim(word, F.lit(". ")))
    named = [F.when((w == m) | ((F.length(w) >= 3) & F.startswith(F.lit(m), w)), F.lit(i)) for i, m in enumerate(MONTHS[market], 1)]
    n = w.try_cast("int")
    return F.coalesce(F.when(n.between(1, 12), n), *named)


def iso(year: Column, month: Column | None = None, day: Column | None = None) -> Column:
    """A truncated ISO date: an impossible day leaves the month, an impossible month the year."""
    y = F.lpad(year.cast("string"), 4, "0")
    if month is None:
        return y
    m = F.when(month.between(1, 12), F.concat(y, F.lit("-"), F.lpad(month.cast("string"), 2, "0")))
    whole = F.concat(m, F.lit("-"), F.lpad((day if day is not None else F.lit(0)).cast("string"), 2, "0"))
    return F.coalesce(F.when(F.try_to_date(whole).isNotNull(), whole), m, y)


def _int(s: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(s, pattern, group).try_cast("int")


def expand_template(s: Column) -> Column:
    """A date template as text: Y|M|D and D|M|Y as ISO dates, a day, a month's name and a year as words, else its first argument."""
    args = F.filter(F.transform(F.split(F.regexp_extract(s, "\\{\\{[^{}|]*\\|([^{}]*)\\}\\}", 1), "\\|"), lambda p: F.regexp_replace(F.trim(p), "^([0-9]{1,2})(er|re|e)$", "$1")), lambda p: (p != "") & ~F.contains(p, F.lit("=")))
    a, b, c = (F.get(args, F.lit(i)) for i in range(3))
    digits = lambda x: F.coalesce(x.rlike("^[0-9]+$"), F.lit(False))
    two = lambda x: F.lpad(x, F.greatest(F.length(x), F.lit(2)), F.lit("0"))
    three = digits(a) & digits(b) & digits(c)
    flat = (
        F.when(three & (F.length(a) == 4), F.concat_ws("-", a, two(b), two(c))).when(three & (F.length(c) == 4), F.concat_ws("-", c, two(b), two(a)))
        .when(digits(a) & digits(c), F.concat_ws(" ", a, b, c)).when((F.size(args) == 2) & digits(a) & digits(b) & (F.length(a) == 4), F.concat_ws("-", a, two(b))).otherwise(F.coalesce(a, F.lit("")))
    )
    is_date = s.rlike("\\{\\{\\s*(?i:start date|start-date|dts|date-|date rapide|date)\\s*\\|[^{}]*\\}\\}")
    parts = F.split(s, "\\{\\{[^{}]*\\}\\}", 2)
    return F.when(is_date, F.concat(F.get(parts, F.lit(0)), flat, F.coalesce(F.get(parts, F.lit(1)), F.lit("")))).otherwise(s)


def parse_compact(s: Column) -> Column:
    """'201003', '20100317', '2010-3-1', '2014-5 (reprint)': month and day must be possible, a wrong day leaves the month, a wrong month nothing."""
    t = F.trim(F.regexp_replace(s, "[（(].*?[)）]", ""))
    shape = "^([0-9]{4})[-/.]?([0-9]{1,2})?[-/.]?([0-9]{1,2})?"
    y, m, d = (_int(t, shape, i) for i in (1, 2, 3))
    return F.when(y.between(1900, 2100) & (m.isNull() | m.between(1, 12)), F.when(m.isNull(), iso(y)).otherwise(iso(y, m, d)))


def parse_free(s: Column, market: Column) -> Column:
    """'Sep 02, 2020', '2 September 2020', 'September 2003', '16/02/2022', an ISO date or a year; a day and month that could be swapped leave the month."""
    t = F.trim(s)
    mdy, dmy, my, slashed = "^(\\w+)\\.?\\s+([0-9]{1,2}),\\s*([0-9]{4})$", "^([0-9]{1,2})\\s+(\\w+)\\.?\\s+([0-9]{4})$", "^(\\w+)\\.?\\s+([0-9]{4})$", "^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"
    a, b, y = (_int(t, slashed, i) for i in (1, 2, 3))
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    day = lambda p, i, j, k: F.concat_ws("-", F.regexp_extract(t, p, i), two(month_index(F.regexp_extract(t, p, j))), two(_int(t, p, k)))
    named = lambda p, j: t.rlike(p) & month_index(F.regexp_extract(t, p, j)).isNotNull()
    numeric = (
        F.when((a > 12) & (b <= 12), F.concat_ws("-", y.cast("string"), two(b), two(a))).when((b > 12) & (a <= 12), F.concat_ws("-", y.cast("string"), two(a), two(b)))
        .otherwise(F.concat_ws("-", y.cast("string"), two(F.when(market == "EN", a).otherwise(b))))
    )
    return (
        F.when(named(mdy, 1), day(mdy, 3, 1, 2)).when(named(dmy, 2), day(dmy, 3, 2, 1))
        .when(named(my, 1), F.concat_ws("-", F.regexp_extract(t, my, 2), two(month_index(F.regexp_extract(t, my, 1)))))
        .when(t.rlike(slashed), numeric).when(t.rlike("^[0-9]{4}(-[0-9]{2}-[0-9]{2})?$"), t)
    )


def canonical_number(label: Column) -> Column:
    """struct(number, kind, label): int (unit words and leading zeros off), range, decimal, special or blank."""
    t = F.trim(label)
    whole = F.regexp_extract(t, "^(?:(?i:vol(?:ume)?|tome|band|no|t)\\.?\\s*)?0*([0-9]+)$", 1)
    pair = "^0*([0-9]+)\\s*(?:[-–—]|&|à|to|bis)\\s*0*([0-9]+)$"
    lo, hi = _int(t, pair, 1), _int(t, pair, 2)
    none = F.coalesce(t, F.lit("")).rlike("^(?:|[-–—ー]+|n/?a|tba|tbd)$")
    kind = F.when(none, "blank").when(whole != "", "int").when(lo < hi, "range").when(t.rlike("^[0-9]+\\.[0-9]+$"), "decimal").otherwise("special")
    number = F.when(kind == "int", whole).when(kind == "range", F.concat_ws("-", lo, hi)).when(kind.isin("decimal", "special"), t)
    return F.struct(number.alias("number"), kind.alias("kind"), F.coalesce(t, F.lit("")).alias("label"))
