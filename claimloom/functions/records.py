"""Library records as struct(leader, cf, df): what their fields say about numbers, dates, origin, kind, people and identifiers.

Column functions over the record that text.marc_record() reads; fields are df elements (tag, i1, i2, subs of (code, value)).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import keys
from claimloom.functions.text import subfields

#: Words before a part's number, fixed values.
_UNIT = "(?i:vol(?:ume)?\\.?|band|bd\\.?|teil|nr\\.?|no\\.?|tome|buch|#|folge)"
_CLOSING = "[\\s,.:;–—-]+$"


def clean(s: Column) -> Column:
    """Without sort marks, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(s, "[\\u0098\\u009c]", ""), "\\s+", " "))


def first(record: Column, tag: str, code: str) -> Column:
    return F.get(subfields(record, tag, code), F.lit(0))


def fields(record: Column, *tags: str) -> Column:
    return F.filter(record.df, lambda d: d.tag.isin(*tags))


def of_field(field: Column, code: str) -> Column:
    return F.transform(F.filter(field.subs, lambda s: s.code == code), lambda s: s.value)


def joined(record: Column, *places: tuple[str, str]) -> Column:
    """All these subfields in one text."""
    return F.array_join(F.transform(F.concat(*[subfields(record, t, c) for t, c in places]), clean), " ")


def part_number(raw: Column) -> Column:
    """struct(number, kind): range, int, decimal or none; a single integer among words is the number."""
    return keys.bound(F.trim(F.substring_index(clean(raw), " / ", 1)), _part_number)


def _part_number(s: Column) -> Column:
    lo, hi = (F.regexp_extract(s, "([0-9]+)\\s*(?:[-–/+]|(?i:und|bis)|&)\\s*([0-9]+)", i).try_cast("int") for i in (1, 2))
    shape = f"^\\s*\\[?\\s*(?:{_UNIT}\\s*)?" + "([0-9]{1,4})(?:[.,]([0-9]{1,2}))?\\s*\\.?\\s*\\]?\\s*$"
    whole, part = F.regexp_extract(s, shape, 1), F.regexp_extract(s, shape, 2)
    lone = F.regexp_extract_all(s, F.lit("([0-9]+)"))
    alone = (F.size(lone) == 1) & ~s.rlike("[0-9][.,][0-9]")
    plain = lambda c: c.try_cast("int").cast("string")
    kind = F.when(hi > lo, "range").when(part != "", "decimal").when((whole != "") | alone, "int").otherwise("none")
    number = F.when(hi > lo, F.concat_ws("-", lo, hi)).when(part != "", F.concat(plain(whole), F.lit("."), part)).when(whole != "", plain(whole)).when(alone, plain(F.get(lone, F.lit(0))))
    return F.struct(number.alias("number"), F.coalesce(F.when(s.isNotNull(), kind), F.lit("none")).alias("kind"))


def title_number(record: Column) -> Column:
    """struct(number, before) of the title alone: an explicit volume word, else a number at its end."""
    return keys.bound(clean(first(record, "245", "a")), _title_number)


def _title_number(a: Column) -> Column:
    word = "^(.*?\\S)\\s*[,.:;–—-]?\\s*\\b(?i:band|bd\\.|vol\\.|volume)\\s*([0-9]{1,3})\\b"
    end = "^(.*?[^\\s0-9])\\s*(?:[,.:;–—-]\\s*)?([0-9]{1,3})\\s*$"
    by_word, by_end = F.regexp_extract(a, word, 2), F.regexp_extract(a, end, 2)
    number = F.when(by_word != "", by_word).when(by_end != "", by_end).try_cast("int").cast("string")
    before = F.when(by_word != "", F.regexp_extract(a, word, 1)).when(by_end != "", F.regexp_extract(a, end, 1))
    return F.struct(number.alias("number"), F.regexp_replace(before, _CLOSING, "").alias("before"))


def series_statements(record: Column) -> Column:
    """(name, number) of the series fields 830, then 490, that have a number; one without is an imprint."""
    def told(tag: str) -> Column:
        each = F.transform(fields(record, tag), lambda d: F.struct(clean(F.coalesce(F.get(of_field(d, "a"), F.lit(0)), F.get(of_field(d, "t"), F.lit(0)))).alias("name"), F.get(of_field(d, "v"), F.lit(0)).alias("number")))
        return F.filter(each, lambda s: (F.coalesce(s.number, F.lit("")) != "") & (F.coalesce(s["name"], F.lit("")) != ""))

    return F.concat(told("830"), told("490"))


def record_number(record: Column) -> Column:
    """struct(number, kind, via): 245 $n (the last that is a number), else the series' number, else the title's.

    The title's number comes before the series' where the title without it is the series' name.
    """
    own = F.filter(F.transform(F.reverse(subfields(record, "245", "n")), part_number), lambda s: s.kind != "none")
    told = F.filter(F.transform(series_statements(record), lambda s: F.struct(s["name"].alias("name"), part_number(s.number).alias("n"))), lambda s: s.n.kind != "none")
    return keys.bound(F.struct(F.get(own, F.lit(0)).alias("n"), F.get(told, F.lit(0)).alias("s"), title_number(record).alias("t")), _record_number)


def _record_number(found: Column) -> Column:
    n, s, t = found.n, found.s, found.t
    same = (t.number != s.n.number) & (keys.compact_key(t.before) == keys.compact_key(s["name"]))
    pick = lambda number, kind, via: F.struct(number.alias("number"), kind.alias("kind"), F.lit(via).alias("via"))
    title = pick(t.number, F.lit("int"), "title")
    return (
        F.when(n.isNotNull(), pick(n.number, n.kind, "245n")).when(s.isNotNull() & F.coalesce(same, F.lit(False)), title)
        .when(s.isNotNull(), pick(s.n.number, s.n.kind, "series")).when(t.number.isNotNull(), title)
    )


#: Roman numerals to twenty and number words, fixed values.
ROMANS = "I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX".split()
WORDS = {"ONE": 1, "TWO": 2, "THREE": 3}


def word_number(s: Column) -> Column:
    """A volume numbered in Roman numerals or in words."""
    known = F.create_map(*[F.lit(x) for k, v in [*((r, i) for i, r in enumerate(ROMANS, 1)), *WORDS.items()] for x in (k, v)])
    return F.try_element_at(known, F.upper(F.regexp_extract(clean(s), "^\\[?\\s*(?:(?i:vol(?:ume)?|tome|t)\\.?\\s+)?([A-Za-z]+)\\s*\\.?\\s*\\]?$", 1))).cast("string")


def extent_pages(extent: Column) -> Column:
    """Numbered and unnumbered pages of an extent ('180 Seiten, 12 ungezählte Seiten', 'viii, 106 pages'); null beyond 2,000."""
    a = clean(extent)
    german = "^(?:ca\\.|circa)?\\s*\\[?([0-9]{1,4})\\]?\\s*(?:ungezählte\\s+)?(?:Seiten|S\\.)?(?:\\s*,\\s*\\[?([0-9]{1,3})\\]?\\s*(?:ungezählte\\s+)?(?:Seiten|S\\.))?"
    english = "^(?:[ivxlc]+\\s*,\\s*)?\\[?([0-9]{1,4})\\]?\\s*(?:unnumbered\\s+)?(?:pages|p\\.)"
    first_, more = (F.regexp_extract(a, german, i).try_cast("int") for i in (1, 2))
    n = F.when(a.rlike("Seiten|S\\."), first_ + F.coalesce(more, F.lit(0))).otherwise(F.regexp_extract(a, english, 1).try_cast("int"))
    return F.when((n > 0) & (n <= 2000), n)


def planned_month(values: Column, short: bool = False) -> Column:
    """The first YYYYMM (or YYMM, 1111 being unknown) as YYYY-MM."""
    shape = "^([0-9]{2})(0[1-9]|1[0-2])$" if short else "^((?:19|20)[0-9]{2})(0[1-9]|1[0-2])"
    told = F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v.rlike(shape) & (v != "1111"))
    v = F.get(told, F.lit(0))
    year = F.concat(F.lit("20"), F.regexp_extract(v, shape, 1)) if short else F.regexp_extract(v, shape, 1)
    return F.when(v.isNotNull(), F.concat(year, F.lit("-"), F.regexp_extract(v, shape, 2)))


def lccn(raw: Column) -> Column:
    """A control number without blanks and what follows a slash; the part behind a hyphen gets six digits; null if malformed."""
    s = F.lower(F.substring_index(F.regexp_replace(raw, "\\s+", ""), "/", 1))
    serial = F.regexp_extract(s, "^[^-]*-([0-9]{1,6})$", 1)
    whole = F.when(serial != "", F.concat(F.substring_index(s, "-", 1), F.lpad(serial, 6, "0"))).otherwise(s)
    return F.when(whole.rlike("^[a-z]{0,3}[0-9]{8,10}$"), whole)


def isbn(raw: Column) -> Column:
    """A valid ISBN-13 of what stands before the first space, ISBN-10s converted; else null."""
    bare = F.upper(F.regexp_replace(F.substring_index(F.trim(raw), " ", 1), "[-]", ""))
    return keys.bound(bare, lambda s: F.when(s.rlike("^97[89][0-9]{10}$") & (keys.isbn13_check(s) == F.substring(s, 13, 1).cast("int")), s).otherwise(keys.isbn10_to_13(s)))


_BOX = "(?i)behältnis|kassette|schuber|\\bbox\\b"


def box_isbns(record: Column) -> Column:
    """ISBNs of the 020 fields that name a box."""
    boxes = F.filter(fields(record, "020"), lambda d: F.exists(F.concat(of_field(d, "q"), of_field(d, "c")), lambda v: v.rlike(_BOX)))
    return F.array_compact(F.transform(F.flatten(F.transform(boxes, lambda d: of_field(d, "a"))), isbn))


def own_isbns(record: Column) -> Column:
    """The record's ISBNs in order without a box's."""
    return F.array_except(F.array_distinct(F.array_compact(F.transform(subfields(record, "020", "a"), isbn))), box_isbns(record))


def boxed(record: Column) -> Column:
    """A box or a set in a case: its extent or edition says so, or it has no ISBN but a box's; one paginated book in a case is none."""
    cased = F.coalesce(clean(first(record, "300", "a")).rlike("^\\s*(?:ca\\.|circa)?\\s*\\[?[0-9]{2,4}\\]?\\s*(?:ungezählte\\s+)?Seiten\\b"), F.lit(False)) & (F.size(fields(record, "773")) == 0)
    says = joined(record, ("300", "a"), ("300", "c"), ("250", "a")).rlike(_BOX)
    return ~cased & (says | ((F.size(box_isbns(record)) > 0) & (F.size(own_isbns(record)) == 0)))


def qualified_isbns(record: Column) -> Column:
    """(number, isbn, qualifiers) of each 020 field, the number where a qualifier names a volume."""
    def one(d: Column) -> Column:
        return keys.bound(F.array_join(of_field(d, "q"), " "), lambda q: told(d, q))

    def told(d: Column, q: Column) -> Column:
        n = F.coalesce(
            F.nullif(F.regexp_extract(q, "\\b(?i:v(?:ol(?:ume)?)?|bk|book)\\.?\\s*([0-9]+(?:\\.[0-9]+)?)(?![0-9-])", 1), F.lit("")),
            F.nullif(F.regexp_extract(q, "^\\W*([0-9]+(?:\\.[0-9]+)?)\\s*:\\s*(?i:pbk|paperback|hbk|hardcover)", 1), F.lit("")),
        )
        return F.struct(part_number(n).number.alias("number"), isbn(F.get(of_field(d, "a"), F.lit(0))).alias("isbn"), q.alias("qualifiers"))

    return F.filter(F.transform(fields(record, "020"), one), lambda s: s.isbn.isNotNull())


def volume_isbns(record: Column) -> Column:
    """ISBNs by volume number, in order."""
    def by_number(found: Column) -> Column:
        numbers = F.array_distinct(F.transform(found, lambda s: s.number))
        return F.map_from_arrays(numbers, F.transform(numbers, lambda n: F.transform(F.filter(found, lambda s: s.number == n), lambda s: s.isbn)))

    return keys.bound(F.filter(qualified_isbns(record), lambda s: s.number.isNotNull()), by_number)


def pick_isbn(candidates: Column, existing: Column) -> Column:
    """The ISBN that a volume has already, else the first paperback, else the first; candidates are structs (isbn, qualifiers)."""
    def best(every: Column) -> Column:
        held = F.filter(every, lambda s: F.array_contains(existing, s.isbn))
        paper = F.filter(every, lambda s: s.qualifiers.rlike("(?i)paperback|pbk"))
        return F.coalesce(F.get(held, F.lit(0)).isbn, F.get(paper, F.lit(0)).isbn, F.get(every, F.lit(0)).isbn)

    return keys.bound(candidates, best)


def volume_date(month: Column, year: Column, set_record: Column, preliminary: Column, date_type: Column, today: str, most: int = 12) -> Column:
    """struct(value, precision, type): a set never dates a volume; a preliminary record only by a planned month not too long past."""
    recent = keys.months_between_iso(month, F.lit(today)) <= most
    value = F.when(set_record, None).when(preliminary, F.when(recent, month)).when(date_type.isin("s", "t"), year)
    return F.struct(value.alias("value"), F.when(value.isNotNull(), keys.precision(value)).alias("precision"), F.when(value.isNotNull(), F.when(preliminary, "projected").otherwise("published")).alias("type"))


def origin(record: Column) -> Column:
    """struct(origin, explicit): the stated original language, else a statement of translation, else a keyword (not explicit)."""
    langs = F.transform(subfields(record, "041", "h"), lambda v: F.lower(F.trim(v)))
    says = joined(record, ("245", "c"), ("500", "a"), ("546", "a"))
    words = F.transform(subfields(record, "653", "a"), lambda v: F.lower(clean(v)))
    any_of = lambda column, *names: F.arrays_overlap(column, F.array(*[F.lit(n) for n in names]))
    stated = F.when(any_of(langs, "jpn"), None).when(any_of(langs, "kor"), "kor").when(any_of(langs, "chi", "zho"), "chi")
    told = F.when(says.rlike("(?i)aus dem korean"), "kor").when(says.rlike("(?i)aus dem chines"), "chi")
    hinted = F.when(any_of(words, "manhwa", "webtoon", "k-comic"), "kor").when(any_of(words, "manhua"), "chi")
    value = F.when(F.size(langs) > 0, stated).otherwise(F.coalesce(told, hinted))
    explicit = value.isNotNull() & ((F.size(langs) > 0) | told.isNotNull())
    return F.struct(value.alias("origin"), explicit.alias("explicit"))


def comic_signal(record: Column) -> Column:
    return joined(record, ("082", "a")).rlike("(^| )(741\\.5|08( |$))") | joined(record, ("655", "a")).rlike("(?i)\\bcomics?\\b|graphic novels|manhwa|manhua|webtoons")


def prose_signal(record: Column) -> Column:
    return joined(record, ("082", "a")).rlike("\\b895\\.[17]") | (joined(record, ("655", "a")).rlike("(?i)\\bfiction\\b|light novels?|\\bnovels\\b") & ~comic_signal(record))


def record_class(record: Column) -> Column:
    """bundle, extra, light_novel, comic, both (for review) or other."""
    title = joined(record, ("245", "a"), ("245", "n"), ("245", "p"), ("250", "a"), ("490", "a"), ("246", "a"))
    comic, prose = comic_signal(record), prose_signal(record)
    return (
        F.when(title.rlike("(?i)bundle|doppelband|box set|starter ?pack") | boxed(record), "bundle").when(title.rlike("(?i)art ?book|guide ?book|sticker|calendar"), "extra")
        .when(joined(record, ("653", "a")).rlike("(?i)light novel|ranobe"), "light_novel").when(comic & prose, "both").when(comic, "comic").when(prose, "prose").otherwise("other")
    )


#: Editions that are lines of their own, first match first.
EDITIONS = [("deluxe", "deluxe"), ("massive", "\\bmassiv\\b"), ("multiple", "\\b[0-9]\\s*in\\s*1\\b|sammelband|omnibus"), ("perfect", "perfect edition"), ("collector", "collector'?s? edition"), ("limited", "limited edition|special edition|sonderausgabe")]


def edition_marker(record: Column) -> Column:
    text = F.lower(F.concat_ws(" ", joined(record, ("250", "a"), ("245", "a"), ("245", "p")), F.array_join(F.transform(series_statements(record), lambda s: s["name"]), " ")))
    return F.coalesce(*[F.when(text.rlike(p), name) for name, p in EDITIONS])


#: Relators of those who make a book, fixed values.
CREATORS = ["aut", "art", "ill", "oth", "ant", "cre", "ctb"]


def creators(record: Column) -> Column:
    """Names of 100 and 700 whose role is a creator's (or unsaid), then those of 245 $c up to four words, in order without repeats."""
    def counts(d: Column) -> Column:
        roles = F.transform(of_field(d, "4"), lambda v: F.trim(v))
        unsaid = ~F.exists(of_field(d, "e"), lambda v: v.rlike("(?i)übers|hrsg|herausg|bearb|lektor|redakt|letter"))
        return F.when(F.size(roles) > 0, F.arrays_overlap(roles, F.array(*[F.lit(c) for c in CREATORS]))).otherwise(unsaid)

    named = F.transform(F.concat(F.filter(fields(record, "100"), counts), F.filter(fields(record, "700"), counts)), lambda d: clean(F.get(of_field(d, "a"), F.lit(0))))
    segments = F.flatten(F.transform(subfields(record, "245", "c"), lambda v: F.split(F.substring_index(clean(v), "[", 1), ";")))
    telling = F.filter(segments, lambda s: ~s.rlike("(?i)aus dem|übers|deutsch|bearb|redakt|letter|lektor|hrsg|nach einer"))
    parts = F.flatten(F.transform(telling, lambda s: F.split(s, ",|&|\\+|\\bund\\b|\\band\\b")))
    bare = F.transform(parts, lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, "^.*:", ""), "^\\s*(?i:text|story|art|by|von)\\s+", ""), F.lit(" .")))
    said = F.filter(bare, lambda n: (n != "") & (F.size(F.split(n, "\\s+")) <= 4) & ~n.rlike("[0-9]"))
    return F.array_distinct(F.filter(F.concat(named, said), lambda n: F.coalesce(n, F.lit("")) != ""))


def native_titles(record: Column) -> Column:
    """Titles in Hangul or Hanzi: 880 fields paired with a title field, then 246, without a language note."""
    paired = F.filter(fields(record, "880"), lambda d: F.coalesce(F.get(of_field(d, "6"), F.lit(0)), F.lit("")).rlike("^(245|246|240|130)-"))
    every = F.concat(F.flatten(F.transform(paired, lambda d: of_field(d, "a"))), F.filter(subfields(record, "246", "a"), lambda v: v.rlike("[\\uac00-\\ud7a3\\u4e00-\\u9fff]")))
    return F.array_distinct(F.filter(F.transform(every, lambda v: F.regexp_replace(F.regexp_replace(clean(v), "\\s*[/:;=]\\s*$", ""), "\\.\\s*(?:Korean|Chinese|English)$", "")), lambda v: v != ""))


def section(record: Column) -> Column:
    """The section of its set that a volume is filed under: a designation in words before the last $n of 245, else its $p."""
    subs = F.get(fields(record, "245"), F.lit(0)).subs
    numbers = F.transform(F.filter(subs, lambda s: s.code == "n"), lambda s: F.trim(F.substring_index(clean(s.value), " / ", 1)))
    leading = F.filter(F.slice(numbers, F.lit(1), F.greatest(F.size(numbers) - 1, F.lit(0))), lambda n: ~n.rlike("^\\[?\\s*(\\.\\.\\.|…)\\s*\\]?$"))
    n = F.get(leading, F.lit(0))
    part = F.get(F.transform(F.filter(subs, lambda s: s.code == "p"), lambda s: clean(s.value)), F.lit(0))
    bare = lambda c: F.trim(F.regexp_replace(c, "^\\[\\s*|\\s*\\]$", ""))
    return F.when(F.size(numbers) < 2, None).when(n.isNotNull(), F.when(n.rlike("\\p{L}") & ~n.rlike(f"^\\[?\\s*(?:{_UNIT}\\s*)?[0-9]{{1,4}}(?:[.,][0-9]{{1,2}})?\\s*\\.?\\s*\\]?$"), bare(n))).otherwise(bare(part))


def cluster_key(parent: Column, series: Column, title: Column, record_id: Column) -> Column:
    """Of a record: its parent, else its series, else its title, else itself."""
    return F.coalesce(F.concat(F.lit("p:"), parent), F.concat(F.lit("s:"), series), F.concat(F.lit("t:"), title), F.concat(F.lit("r:"), record_id))
