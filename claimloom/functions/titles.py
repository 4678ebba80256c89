"""Names of series and their parts: search forms, cuts, qualifiers, display rules, media. Column functions, inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import keys, text

#: What a trailing parenthesis may say for the name without it to be the line's own.
EDITION_QUALIFIERS = (
    "edition|volume list|release|version|tank[oō]bon|shins[oō]ban|vizbig|2-in-1|parution|printing|omnibus|perfect collection|"
    "publication|list of|manga list|overview|original manga|bunko|aiz[oō]ban|kanzenban|deluxe|volumes"
)
#: Editions that may or may not collect several volumes.
EDITIONS = (
    "deluxe|perfect|kanzenban|collector|bunko|aiz[oō]ban|shins[oō]ban|wide-?ban|new edition|complete|master\\s?(piece|edition)|anniversary|"
    "remaster|ultimate|library edition|hardcover|luxe|star edition|collected edition|special edition|re-?edition"
)
OMNIBUSES = "omnibus|[23]-in-1|box set|all-in-one"
#: What in parentheses after a work's title only says its kind.
KINDS = (
    "novel series|light novel|novel|literary series|manga series|manga|webcomic|TV series|anime|film|video game|webtoon|manhwa|manhua|comics|"
    "franchise|roman|bande dessin[ée]e|s[ée]rie t[ée]l[ée]vis[ée]e|s[ée]rie|jeu vid[ée]o"
)
#: Words that say no more than a line's medium, with the medium they stand for (null: none of its own).
GENERIC = {"manga": "manga", "manga volumes": "manga", "light novels": "light_novel", "light novel": "light_novel", "novels": "novel", "novel": "novel", "volumes": None, "volume list": None, "chapters": None}
COMICS = ("manga", "manhwa", "manhua")
NOVELS = ("novel", "light_novel")
_CUT = "^(.+?)( \\(|: | - | / )"


def search_form(s: Column) -> Column:
    """Marks off Latin letters, numeric symbols plain, typographic quotes, dashes and spaces as ASCII, single spaces."""
    plain = F.translate(text.number_folded(text.accent_free(s)), "‘’“”–— ", "''\"\"-- ")
    return F.trim(F.regexp_replace(plain, "\\s+", " "))


def title_key(s: Column) -> Column:
    return keys.compact_key(search_form(s))


def article_key(s: Column) -> Column:
    return keys.compact_key(F.regexp_replace(search_form(s), "^(?i)(the|a|an)\\s+", ""))


def and_key(s: Column) -> Column:
    return keys.compact_key(F.regexp_replace(search_form(s), "\\s*&\\s*", " and "))


def slug_words(s: Column) -> Column:
    """The name as its slug reads with spaces for hyphens."""
    return F.trim(F.regexp_replace(F.lower(search_form(s)), "[^a-z0-9]+", " "))


def parent_name(s: Column) -> Column:
    """What stands before the first ' (', ': ', ' - ' or ' / '; null without such a cut."""
    head = F.regexp_extract(search_form(s), _CUT, 1)
    return F.when(head != "", head)


def without_edition(s: Column) -> Column:
    """The name without a trailing edition qualifier, closed or not; null where it has none or where that would cut an arc."""
    t = search_form(s)
    listed = F.trim(F.regexp_extract(t, "^([^(]*?)\\s+(?i:volumes|volume list)$", 1), F.lit(' "'))
    inner = F.regexp_extract(t, "\\(([^()]*)\\)?$", 1)
    base = F.rtrim(F.regexp_extract(t, "^(.*?)\\s*\\([^()]*\\)?$", 1))
    opened = F.length(F.regexp_replace(base, "[^(]", "")) > F.length(F.regexp_replace(base, "[^)]", ""))
    outer = F.rtrim(F.regexp_extract(base, "^(.*)\\(", 1))
    whole = F.when(opened, F.concat(F.regexp_extract(base, "\\(([^(]*)$", 1), F.lit("("), inner)).otherwise(inner)
    name = F.when(opened, outer).otherwise(base)
    ok = (name != "") & whole.rlike(f"(?i){EDITION_QUALIFIERS}") & ~F.lower(whole).rlike('chapter|series ?\\(|"')
    return F.when(listed != "", listed).when(t.rlike("\\([^()]*\\)?$") & ok, name)


def base_and_arc(s: Column) -> Column:
    """struct(base, arc): the name before its first cut and the rest without parentheses; an edition's name has no arc."""
    t, edition, head = search_form(s), without_edition(s), F.regexp_extract(search_form(s), _CUT, 1)
    rest = F.expr("null").cast("string")
    tail = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(t, "^.+?(?: \\(|: | - | / )(.*)$", 1), "[()]", " "), "\\s+", " "))
    rest = F.when(edition.isNull() & (head != "") & (tail != ""), tail)
    return F.struct(F.coalesce(edition, F.when(head != "", head), t).alias("base"), rest.alias("arc"))


def _literal(s: Column) -> Column:
    """A pattern for the text itself."""
    return F.concat(F.lit("(?i)"), F.regexp_replace(s, "([^A-Za-z0-9 ])", "\\\\\\\\$1"))


def _beside(name: Column, work: Column) -> Column:
    """The name without the work's own title."""
    return F.when(F.coalesce(work, F.lit("")) == "", name).otherwise(F.regexp_replace(name, _literal(work), F.lit(" ")))


def edition_named(name: Column, work: Column, names: str = EDITIONS) -> Column:
    """The part of a line's name beside the work's title names an edition."""
    own = keys.ascii_key(name) == keys.ascii_key(F.coalesce(work, F.lit("")))
    return F.coalesce((name != "") & ~own & _beside(name, work).rlike(f"(?i){names}"), F.lit(False))


def bare_arc(name: Column, work: Column) -> Column:
    """'Work (Arc)' -> Arc; other names as they are, null for an empty one."""
    head, inner = F.regexp_extract(name, "^(.*)\\s\\((.+)\\)$", 1), F.trim(F.regexp_extract(name, "^(.*)\\s\\((.+)\\)$", 2))
    return F.when(name == "", None).when((inner != "") & (keys.ascii_key(head) == keys.ascii_key(work)), inner).otherwise(name)


def without_kind(name: Column, work: Column) -> Column:
    """Rule D: the kind in parentheses that ends the work's title goes from a name that starts with this title."""
    cut = F.regexp_replace(work, f"\\s+\\((?i:{KINDS})\\)$", "")
    return F.when((cut != work) & F.startswith(name, work), F.concat(cut, F.substr(name, F.length(work) + 1))).otherwise(name)


def self_named(name: Column, base: Column) -> Column:
    """Rule S: 'B (R)' -> R where R starts with B, then a separator or its end."""
    head, inner = F.regexp_extract(name, "^(.+?)\\s+\\(([^()]+)\\)$", 1), F.trim(F.regexp_extract(name, "^(.+?)\\s+\\(([^()]+)\\)$", 2))
    n = F.length(base)
    follows = (F.length(inner) == n) | F.substr(inner, n + 1, F.lit(1)).isin(":", " ", "-", "–", "!", "?")
    return F.when((head == base) & F.startswith(F.lower(inner), F.lower(base)) & follows, inner).otherwise(name)


def without_generic_word(name: Column, medium: Column) -> Column:
    """Rules W and M: struct(name, medium, rule): a trailing word for the medium goes, and may change a manga line's medium."""
    head, word = F.regexp_extract(name, "^(.+?)\\s+\\(([^()]+)\\)$", 1), F.lower(F.trim(F.regexp_extract(name, "^(.+?)\\s+\\(([^()]+)\\)$", 2)))
    known = F.create_map(*[F.lit(x) for k, v in GENERIC.items() if v for x in (k, v)])
    target, generic = F.try_element_at(known, word), word.isin(*GENERIC)
    retag = generic & (medium == "manga") & target.isNotNull() & (target != "manga")
    return F.struct(F.when(generic, head).otherwise(name).alias("name"), F.when(retag, target).otherwise(medium).alias("medium"), F.when(retag, "M").when(generic, "W").alias("rule"))


def display_name(name: Column, work: Column, medium: Column) -> Column:
    """struct(name, medium, rules): the rules D, S, then W or M, one after the other."""
    d = without_kind(name, work)
    s = self_named(d, F.regexp_replace(work, f"\\s+\\((?i:{KINDS})\\)$", ""))
    w = without_generic_word(s, medium)
    rules = F.array_compact(F.array(F.when(d != name, "D"), F.when(s != d, "S"), w["rule"]))
    return F.struct(w["name"].alias("name"), w["medium"].alias("medium"), F.array_join(rules, "").alias("rules"))


def family(medium: Column) -> Column:
    """novel, comic (also for no medium), else the medium itself."""
    return F.when(medium.isin(*NOVELS), "novel").when(medium.isNull() | medium.isin(*COMICS), "comic").otherwise(medium)


#: Media by what a heading says, first match first.
MEDIUM_HINTS = [("light_novel", "light novels?"), ("novel", "novels?|romans?"), ("manhwa", "manhwa|webtoons?"), ("manhua", "manhua"), ("artbook", "art ?books?"), ("manga", "manga")]


def detect_medium(path: Column, title: Column, default: str = "manga") -> Column:
    """The medium that the innermost heading with a hint names, else the title, else the default; path runs from outer to inner."""
    def hint(s: Column) -> Column:
        return F.coalesce(*[F.when(F.lower(s).rlike(f"\\b(?:{words})\\b"), medium) for medium, words in MEDIUM_HINTS])

    inner = F.array_compact(F.transform(F.reverse(path), hint))
    return F.coalesce(F.get(inner, F.lit(0)), hint(title), F.lit(default))


#: Headings that only structure a page.
STRUCTURE = "volumes?|volume list|list of volumes|chapters?|chapter list|manga|light novels?|novels?|publication|media|contents?"


def line_name(path: Column, work: Column) -> Column:
    """The work's title, with the innermost heading that says more than structure in parentheses."""
    telling = F.filter(F.reverse(path), lambda h: ~F.lower(F.trim(h)).rlike(f"^(?:{STRUCTURE})$") & (keys.ascii_key(h) != "") & (keys.ascii_key(h) != keys.ascii_key(work)))
    inner = F.get(telling, F.lit(0))
    return F.when(inner.isNull(), work).when(F.startswith(F.lower(inner), F.lower(work)), inner).otherwise(F.concat(work, F.lit(" ("), inner, F.lit(")")))


def clean_heading(s: Column) -> Column:
    """A heading without references, comments, link targets, templates, tags and quote marks."""
    t = F.regexp_replace(s, "(?s)<ref[^>]*/>|<ref.*?</ref>|<!--.*?-->", "")
    t = F.regexp_replace(t, "\\[\\[(?:[^\\]|]*\\|)?([^\\]]*)\\]\\]", "$1")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "\\{\\{[^}]*\\}\\}|<[^>]+>|'{2,}", " "), "\\s+", " "))


#: How lists of a work's parts are titled; the article that 'des' and 'du' swallow comes back.
LISTS = [
    ("^(?i:list of) (.+?) (?i:chapters|volumes|light novels|manga volumes)$", ""),
    ("^(?i:liste) (?i:des) .+? (?i:des) (.+)$", "Les "),
    ("^(?i:liste) (?i:des) .+? (?i:du) (.+)$", "Le "),
    ("^(?i:liste) (?i:des) .+? (?i:de |d')(.+)$", ""),
]


def work_title(s: Column) -> Column:
    """The title of the work that a list article is about, else the string itself."""
    found = [F.when(F.regexp_extract(s, p, 1) != "", F.concat(F.lit(article), F.regexp_extract(s, p, 1))) for p, article in LISTS]
    return F.coalesce(*found, s)


MARKUP = "\\{\\{|\\}\\}|\\[\\[|\\]\\]|<[a-z/]|'''|&[a-z]+;"


def local_title(s: Column) -> Column:
    """A title as readers of its language see it: no list prefix, no trailing qualifier; null where nothing or markup is left."""
    t = F.trim(F.regexp_replace(work_title(F.trim(s)), "\\s+\\([^()]*\\)\\s*$", ""))
    return F.when((t != "") & ~t.rlike(MARKUP), t)


def local_name(market: Column, is_main: Column, library_name: Column, official: Column) -> Column:
    """A line's name in its own language: none for English, a German or French line's library title, else a main line's official title."""
    own, title = local_title(library_name), local_title(official)
    return (
        F.when(market == "EN", None).when((market == "DE") & own.isNotNull(), own).when((market == "FR") & own.isNotNull() & title.isNull(), own).when(is_main, title)
    )


_NATIVE = "[\\u3040-\\u30ff\\u4e00-\\u9fff\\uac00-\\ud7a3]"
_REST = "[\\s,:#–-]*(?:(?:vol(?:ume)?|band|tome)\\.?\\s*)?[0-9]*"


def exported_title(title: Column, series: Column, native_ok: Column, trusted: Column) -> Column:
    """struct(title, reason): a volume's title where it says something, else why not; trusted ones are only kept from markup and bare numbers."""
    number = title.rlike("^\\s*(?i:vol(?:ume)?\\.?|band|tome|#)?\\s*[0-9]+\\s*$")
    name = F.trim(F.regexp_replace(series, "\\s+", " "))
    t = F.trim(F.regexp_replace(title, "\\s+", " "))
    starts = (name != "") & F.startswith(F.lower(t), F.lower(name))
    rest = F.substr(t, F.length(name) + 1)
    after = F.regexp_extract(rest, "^\\s*(?:(?i:vol(?:ume)?)\\.?\\s*)?[0-9]*\\s*[:–-]\\s*(.+)$", 1)
    stripped = F.when(starts & (after != ""), after).otherwise(title)
    reason = (
        F.when(F.coalesce(title, F.lit("")) == "", "empty").when(number, "number_only").when(title.rlike(MARKUP), "markup").when(trusted, None)
        .when(~native_ok & title.rlike(_NATIVE), "wrong_script").when(starts & (after != "") & after.rlike("^[0-9]+$"), "number_only")
        .when(starts & (after == "") & rest.rlike(f"^(?i:{_REST})$"), "redundant")
    )
    return F.struct(F.when(reason.isNull(), F.when(trusted, title).otherwise(stripped)).alias("title"), reason.alias("reason"))


def blank(value: Column) -> Column:
    """Nothing, a dash, a question mark or a word for 'not yet'."""
    return F.coalesce(F.lower(F.trim(value)), F.lit("")).rlike("^(?:|[-–—?]+|n/?a|tba|tbd|none|unknown)$")


def list_items(value: Column) -> Column:
    """The items of a list-valued field, split at line breaks, bullets, commas and semicolons, in order without repeats."""
    return F.array_distinct(F.filter(F.transform(F.split(value, "(?i)<br ?/?>|\\n|[*•;,]"), lambda x: F.trim(x)), lambda x: x != ""))


def first_author(names: Column) -> Column:
    """The first name of a JSON list that is not a template or empty."""
    every = F.transform(F.from_json(names, "array<string>"), lambda x: F.trim(F.regexp_replace(x, "\\{\\{[^}]*\\}\\}|\\[\\[|\\]\\]", "")))
    return F.get(F.filter(every, lambda x: x != ""), F.lit(0))


#: Words that a publisher's name goes without.
PUBLISHER_WORDS = "verlag|editions?|publishing|books?|comics|gmbh|inc|ltd|llc|usa|media|group|press"


def publisher_key(s: Column, families: dict[str, str] | None = None) -> Column:
    """A publisher's family: its key without words that any publisher has, mapped where a family is known."""
    k = keys.compact_key(F.regexp_replace(F.lower(text.accent_free(s)), f"\\b(?:{PUBLISHER_WORDS})\\b\\.?", " "))
    known = F.create_map(*[F.lit(x) for pair in (families or {"": ""}).items() for x in pair])
    return F.coalesce(F.try_element_at(known, k), k)


def publisher_now(value: Column) -> Column:
    """The publisher that a field marks as current, else the last that it does not mark as former."""
    items = list_items(value)
    now = F.filter(items, lambda x: F.lower(x).rlike("\\((?:current|now|present|since [0-9]{4})\\)"))
    left = F.filter(items, lambda x: ~F.lower(x).rlike("\\((?:former(?:ly)?|expired|until [0-9]{4})\\)"))
    return F.trim(F.regexp_replace(F.coalesce(F.get(now, F.lit(0)), F.try_element_at(left, F.lit(-1))), "\\s*\\([^)]*\\)", ""))


def regional(values: Column, order: tuple[str, ...] = ("NA", "US", "EN", "UK")) -> Column:
    """The value of the first region that has one."""
    return F.coalesce(*[F.try_element_at(values, F.lit(r)) for r in order])


def source_name(url: Column, hosts: list[tuple[str, str]]) -> Column:
    """A source's name by what its address contains, first match first, else 'other'; null for none."""
    found = F.coalesce(*[F.when(F.contains(F.lower(url), F.lit(part)), name) for part, name in hosts], F.lit("other"))
    return F.when(url.isNotNull(), found)
