"""Names as queries: search forms, keys, cuts, qualifiers, display rules and their guards, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.functions import keys, text, titles
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows

NAMES = """SELECT p_partkey AS id, p_name AS work, p_brand AS market, p_type AS kind, p_size AS size, p_retailprice AS price, CASE p_partkey % 17
 WHEN 0 THEN 'The ' || p_name WHEN 1 THEN p_name || ' & Co' WHEN 2 THEN p_name || ' (VizBig edition)' WHEN 3 THEN p_name || ': Truth of ' || p_type
 WHEN 4 THEN p_name || ' - ' || p_type WHEN 5 THEN p_name || ' (2014 release (2-in-1 Edition)' WHEN 6 THEN upper(p_name) || ' volumes'
 WHEN 7 THEN 'Fushigi Yûgi  ' || p_name || ' ½' WHEN 8 THEN p_name || '’s — “Große” Ⅱ' WHEN 9 THEN p_name || ' / ' || p_type WHEN 10 THEN p_name || ' (chapter 3 edition)'
 WHEN 11 THEN p_name || ', Vol. ' || p_size WHEN 12 THEN p_name || ' ' || p_size WHEN 13 THEN p_name || ' (novel series)' WHEN 14 THEN p_name || '-' || p_type || '_x'
 WHEN 15 THEN p_name || ' (Saga' ELSE p_name END AS name FROM {part}"""
_N = f"WITH n AS ({plain(NAMES)})"
_FORM = "trim(regexp_replace(translate(replace(replace(replace(regexp_replace(strip_accents(name), 'GroSSe', 'Große'), '½', '1/2'), 'Ⅱ', 'II'), '²', '2'), '‘’“”–— ', '''''\"\"-- '), '\\s+', ' ', 'g'))"
_F = f"{_N}, f AS (SELECT *, {_FORM} AS form FROM n)"
_COMPACT = "regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


@query(f"""{_F} SELECT id, form, {_COMPACT.format('form')} AS key, {_COMPACT.format("regexp_replace(form, '^(?i:the|a|an)\\s+', '')")} AS article,
{_COMPACT.format("regexp_replace(form, '\\s*&\\s*', ' and ', 'g')")} AS ampersand, trim(regexp_replace(lower(form), '[^a-z0-9]+', ' ', 'g')) AS slug FROM f""")
def search_forms(spark, sf_dir):
    """Search form, key, key without article, key with 'and', and the words of the slug."""
    n = rows(spark, sf_dir, NAMES)
    c = F.col("name")
    return n.select("id", titles.search_form(c).alias("form"), titles.title_key(c).alias("key"), titles.article_key(c).alias("article"), titles.and_key(c).alias("ampersand"), titles.slug_words(c).alias("slug"))


@query(f"""{_N} SELECT id, strip_accents(name) AS bare, replace(replace(name, '½', '1/2'), 'Ⅱ', 'II') AS plain_numbers FROM n WHERE id % 17 <> 8
UNION ALL SELECT id, name, replace(name, 'Ⅱ', 'II') FROM n WHERE id % 17 = 8""")
def accents_and_numbers(spark, sf_dir):
    """Marks off Latin letters; numeric symbols as plain text."""
    return rows(spark, sf_dir, NAMES).select("id", text.accent_free("name").alias("bare"), text.number_folded("name").alias("plain_numbers"))


_FOLD = """regexp_replace(regexp_replace(replace(replace(replace(regexp_replace({}, '\\bwo\\b', 'o', 'g'), 'ou', 'o'), 'oo', 'o'), 'uu', 'u'), '\\(.*?\\)', ' ', 'g'), '[^0-9a-z]+', '', 'g')"""
_LOWER = "regexp_replace(trim(replace(lower(strip_accents(replace(replace(replace(name, '½', '1⁄2'), 'Ⅱ', 'II'), '&', ' and '))), 'ß', 'ß')), '^the\\s+', '')"


@query(f"""{_N}, l AS (SELECT id, replace({_LOWER}, 'grosse', 'große') AS t FROM n)
SELECT id, {_FOLD.format("regexp_replace(regexp_replace(t, '\\b(vol(ume)?|band|bd|tome|nr)\\.?\\s*\\d+.*$', ''), '[\\s,.:;\\-–]*\\d{1,3}\\.?\\s*$', '')")} AS folded, {_FOLD.format('t')} AS numbered FROM l""")
def folding_keys(spark, sf_dir):
    """The folding key without and with volume numbers."""
    return rows(spark, sf_dir, NAMES).select("id", text.fold_key("name").alias("folded"), text.numbered_key("name").alias("numbered"))


_EDITION = titles.EDITION_QUALIFIERS


@query(f"""{_F}, e AS (SELECT *, trim(regexp_extract(form, '^([^(]*?)\\s+(?i:volumes|volume list)$', 1), ' "') AS listed, regexp_extract(form, '\\(([^()]*)\\)?$', 1) AS inside, rtrim(regexp_extract(form, '^(.*?)\\s*\\([^()]*\\)?$', 1)) AS base FROM f),
o AS (SELECT *, (length(base) - length(replace(base, '(', ''))) > (length(base) - length(replace(base, ')', ''))) AS opened FROM e),
w AS (SELECT *, CASE WHEN opened THEN rtrim(regexp_extract(base, '^(.*)\\(', 1)) ELSE base END AS head, CASE WHEN opened THEN regexp_extract(base, '\\(([^(]*)$', 1) || '(' || inside ELSE inside END AS whole FROM o),
q AS (SELECT id, form, CASE WHEN listed <> '' THEN listed WHEN regexp_matches(form, '\\([^()]*\\)?$') AND head <> '' AND regexp_matches(whole, '(?i){_EDITION}') AND NOT regexp_matches(lower(whole), 'chapter|series ?\\(|"') THEN head END AS edition,
  regexp_extract(form, '^(.+?)( \\(|: | - | / )', 1) AS cut FROM w)
SELECT id, edition, CASE WHEN cut <> '' THEN cut END AS parent, coalesce(edition, CASE WHEN cut <> '' THEN cut END, form) AS base,
CASE WHEN edition IS NULL AND cut <> '' THEN nullif(trim(regexp_replace(regexp_replace(regexp_extract(form, '^.+?( \\(|: | - | / )(.*)$', 2), '[()]', ' ', 'g'), '\\s+', ' ', 'g')), '') END AS arc FROM q""")
def name_cuts(spark, sf_dir):
    """The name without its edition, its parent's name, and base and arc."""
    c = F.col("name")
    out = rows(spark, sf_dir, NAMES).select("id", titles.without_edition(c).alias("edition"), titles.parent_name(c).alias("parent"), titles.base_and_arc(c).alias("s"))
    return out.select("id", "edition", "parent", "s.base", "s.arc")


@query(f"""{_N} SELECT id, trim(regexp_extract(name, '^(.*?)\\s*[0-9]*$', 1)) AS stem, try_cast(regexp_extract(name, '([0-9]+)$', 1) AS INTEGER) AS number,
trim(regexp_replace(regexp_replace(name, '[-_]+', ' ', 'g'), '\\s+', ' ', 'g')) AS words, list_aggregate(list_sort(list_distinct(list_filter([name, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), CASE WHEN length(trim(split_part(name, ': ', 1))) > 2 THEN trim(split_part(name, ': ', 1)) END,
  CASE WHEN length(trim(split_part(name, ' - ', 1))) > 2 THEN trim(split_part(name, ' - ', 1)) END, CASE WHEN length(trim(split_part(name, ' (', 1))) > 2 THEN trim(split_part(name, ' (', 1)) END], lambda x: x IS NOT NULL AND x <> ''))), 'string_agg', '|') AS variants,
contains(' ' || trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) || ' ', ' ' || trim(regexp_replace(lower(work), '[^a-z0-9]+', ' ', 'g')) || ' ') AS holds_work,
len(list_filter(string_split(trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w NOT IN ('volumes', 'small', 'bolt', 'ring', 'the'))) = 0 AS form_only FROM n""")
def name_parts(spark, sf_dir):
    """Stem and number, slug words, alias variants, whole-word containment and titles made of form words only."""
    c = F.col("name")
    return rows(spark, sf_dir, NAMES).select(
        "id", keys.stem(c).alias("stem"), keys.trailing_number(c).alias("number"), keys.deslug(c).alias("words"), F.array_join(keys.alias_variants(c), "|").alias("variants"),
        keys.words_contain(c, F.col("work")).alias("holds_work"), keys.all_in(keys.ascii_key(c), ["volumes", "small", "bolt", "ring", "the"]).alias("form_only"),
    )


LINES = """SELECT id, market, kind, size, work || CASE WHEN id % 3 = 0 THEN ' (novel series)' ELSE '' END AS work,
 CASE id % 8 WHEN 0 THEN work || ' (novel series)' WHEN 1 THEN work || ' (' || work || ': Origins)' WHEN 2 THEN work || ' (Light novels)' WHEN 3 THEN work || ' (Manga volumes)'
 WHEN 4 THEN work || ' (Deluxe Edition)' WHEN 5 THEN work || ' (3-in-1)' WHEN 6 THEN work || ' (novel series) (novel)' ELSE work END AS name,
 CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN 'novel' ELSE 'manga' END AS medium FROM (""" + NAMES + ")"
_LINES_SQL = plain(LINES)
_KIND = f"\\s+\\((?i:{titles.KINDS})\\)$"
_GENERIC = "(VALUES " + ", ".join(f"('{k}', {repr(v) if v else 'NULL'})" for k, v in titles.GENERIC.items()) + ") g(word, target)"
_DISPLAY = f"""d AS (SELECT *, regexp_replace(work, '{_KIND}', '') AS base FROM l),
d1 AS (SELECT *, CASE WHEN base <> work AND starts_with(name, work) THEN base || substr(name, length(work) + 1) ELSE name END AS n1 FROM d),
d2 AS (SELECT *, regexp_extract(n1, '^(.+?)\\s+\\(([^()]+)\\)$', 1) AS h, trim(regexp_extract(n1, '^(.+?)\\s+\\(([^()]+)\\)$', 2)) AS r FROM d1),
d3 AS (SELECT *, CASE WHEN h = base AND starts_with(lower(r), lower(base)) AND (length(r) = length(base) OR substr(r, length(base) + 1, 1) IN (':', ' ', '-', '–', '!', '?')) THEN r ELSE n1 END AS n2 FROM d2),
d4 AS (SELECT *, regexp_extract(n2, '^(.+?)\\s+\\(([^()]+)\\)$', 1) AS h2, lower(trim(regexp_extract(n2, '^(.+?)\\s+\\(([^()]+)\\)$', 2))) AS r2 FROM d3),
d5 AS (SELECT d4.*, g.word IS NOT NULL AS generic, g.word IS NOT NULL AND coalesce(medium = 'manga' AND target <> 'manga', false) AS retag, target FROM d4 LEFT JOIN {_GENERIC} ON word = r2),
shown AS (SELECT id, work, market, name AS was, medium AS was_medium, CASE WHEN generic THEN h2 ELSE n2 END AS name, CASE WHEN retag THEN target ELSE medium END AS medium,
  CASE WHEN n1 <> name THEN 'D' ELSE '' END || CASE WHEN n2 <> n1 THEN 'S' ELSE '' END || CASE WHEN retag THEN 'M' WHEN generic THEN 'W' ELSE '' END AS rules FROM d5)"""


@query(f"WITH l AS ({_LINES_SQL}), {_DISPLAY} SELECT id, name, medium, rules FROM shown")
def display_names(spark, sf_dir):
    """Rules D, S, W and M."""
    out = rows(spark, sf_dir, LINES).select("id", titles.display_name(F.col("name"), F.col("work"), F.col("medium")).alias("s"))
    return out.select("id", "s.*")


_FAMILY = "CASE WHEN medium IN ('novel', 'light_novel') THEN 'novel' WHEN medium IS NULL OR medium IN ('manga', 'manhwa', 'manhua') THEN 'comic' ELSE medium END"


@query(f"""WITH l AS ({_LINES_SQL}), {_DISPLAY},
c AS (SELECT *, count(*) OVER (PARTITION BY work, market, medium, lower(name)) > 1 AND (name <> was OR medium IS DISTINCT FROM was_medium) AS clash FROM shown),
a AS (SELECT id, work, market, was, CASE WHEN clash THEN was ELSE name END AS name, CASE WHEN clash THEN was_medium ELSE medium END AS medium, CASE WHEN clash THEN '' ELSE rules END AS rules, CASE WHEN clash THEN 'held-clash' END AS held FROM c),
k AS (SELECT market, {_FAMILY} AS family, lower(name) AS low, count(DISTINCT work) > 1 AS several FROM a GROUP BY ALL)
SELECT id, CASE WHEN contains(rules, 'D') AND several THEN was ELSE a.name END AS name, CASE WHEN contains(rules, 'D') AND several THEN 'held-cross' ELSE held END AS held, {_FAMILY} AS family
FROM a JOIN k ON k.market = a.market AND k.family = {_FAMILY} AND k.low = lower(a.name)""")
def display_guards(spark, sf_dir):
    """A rename is held where it clashes within a work, then where rule D makes names of different works equal."""
    l = rows(spark, sf_dir, LINES)  # noqa: E741
    s = l.withColumn("s", titles.display_name(F.col("name"), F.col("work"), F.col("medium")))
    same = Window.partitionBy("work", "market", F.col("s.medium"), F.lower(F.col("s.name")))
    changed = (F.col("s.name") != F.col("name")) | ~F.col("s.medium").eqNullSafe(F.col("medium"))
    held = s.withColumn("clash", (F.count("*").over(same) > 1) & changed).select(
        "id", "work", "market", F.col("name").alias("was"), F.when(F.col("clash"), F.col("name")).otherwise(F.col("s.name")).alias("name"),
        F.when(F.col("clash"), F.col("medium")).otherwise(F.col("s.medium")).alias("medium"), F.when(F.col("clash"), "").otherwise(F.col("s.rules")).alias("rules"), F.when(F.col("clash"), "held-clash").alias("held"),
    ).withColumn("family", titles.family(F.col("medium")))
    key = ["market", "family", F.lower(F.col("name")).alias("low")]
    several = held.groupBy(*key).agg((F.count_distinct("work") > 1).alias("several"))
    cross = F.contains(F.col("rules"), F.lit("D")) & F.col("several")
    out = held.withColumn("low", F.lower(F.col("name"))).join(several, ["market", "family", "low"])
    return out.select("id", F.when(cross, F.col("was")).otherwise(F.col("name")).alias("name"), F.when(cross, "held-cross").otherwise(F.col("held")).alias("held"), "family")


@query(f"""WITH l AS ({_LINES_SQL}), r AS (SELECT *, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS k, trim(regexp_replace(lower(work), '[^a-z0-9]+', ' ', 'g')) AS kw, replace(name, work, ' ') AS rest, regexp_extract(name, '^(.*)\\s\\((.+)\\)$', 1) AS h, trim(regexp_extract(name, '^(.*)\\s\\((.+)\\)$', 2)) AS i FROM l)
SELECT id, k <> kw AND regexp_matches(rest, '(?i){titles.EDITIONS}') AS edition, k <> kw AND regexp_matches(rest, '(?i){titles.OMNIBUSES}') AS omnibus,
CASE WHEN i <> '' AND trim(regexp_replace(lower(h), '[^a-z0-9]+', ' ', 'g')) = kw THEN i ELSE name END AS arc FROM r""")
def edition_names(spark, sf_dir):
    """Lines whose name beside the work's title says edition or omnibus, and the bare arc."""
    l, n, w = rows(spark, sf_dir, LINES), F.col("name"), F.col("work")  # noqa: E741
    return l.select("id", titles.edition_named(n, w).alias("edition"), titles.edition_named(n, w, titles.OMNIBUSES).alias("omnibus"), titles.bare_arc(n, w).alias("arc"))


HEADINGS = """SELECT id, work, CASE WHEN id % 7 = 0 THEN 'Light novels' WHEN id % 7 = 1 THEN 'Manga' WHEN id % 7 = 2 THEN kind || ' <ref name="a"/>[[Webtoon|webtoons]]' ELSE 'Volumes' END AS h1,
 CASE WHEN id % 5 = 0 THEN 'Volume list' WHEN id % 5 = 1 THEN work || ' ' || kind WHEN id % 5 = 2 THEN '''''Side {{lang|x}} stories''''<!-- c -->' ELSE 'Chapters' END AS h2,
 CASE WHEN id % 4 = 0 THEN 'List of ' || work || ' chapters' WHEN id % 4 = 1 THEN 'Liste des chapitres des ' || work WHEN id % 4 = 2 THEN 'Liste des tomes de ' || work ELSE work || ' (art book)' END AS article, size, market FROM (""" + NAMES + ")"
_CLEAN = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '(?s)<ref[^>]*/>|<ref.*?</ref>|<!--.*?-->', '', 'g'), '\\[\\[(?:[^\\]|]*\\|)?([^\\]]*)\\]\\]', '\\1', 'g'), '\\{{\\{{[^}}]*\\}}\\}}|<[^>]+>|''{{2,}}', ' ', 'g'), '\\s+', ' ', 'g'))"


def _hint_sql(s: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower({s}), '\\b(?:{w})\\b') THEN '{m}'" for m, w in titles.MEDIUM_HINTS) + " END"


_TELLS = "(NOT regexp_matches(lower(trim({0})), '^(?:" + titles.STRUCTURE + ")$') AND trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')) NOT IN ('', trim(regexp_replace(lower(work), '[^a-z0-9]+', ' ', 'g'))))"
_WORK_TITLE = "coalesce(" + ", ".join("CASE WHEN regexp_extract(article, '{0}', 1) <> '' THEN '{1}' || regexp_extract(article, '{0}', 1) END".format(p.replace("'", "''"), a) for p, a in titles.LISTS) + ", article)"


@query(f"""WITH h AS (SELECT id, work, article, size, market, {_CLEAN.format('h1')} AS a, {_CLEAN.format('h2')} AS b FROM ({plain(HEADINGS)})),
t AS (SELECT *, CASE WHEN {_TELLS.format('b')} THEN b WHEN {_TELLS.format('a')} THEN a END AS told, {_WORK_TITLE} AS title FROM h)
SELECT id, a, b, coalesce({_hint_sql('b')}, {_hint_sql('a')}, {_hint_sql('article')}, 'manga') AS medium, CASE WHEN told IS NULL THEN work WHEN starts_with(lower(told), lower(work)) THEN told ELSE work || ' (' || told || ')' END AS line,
title, nullif(trim(regexp_replace(title, '\\s+\\([^()]*\\)\\s*$', '')), '') AS local_title FROM t""")
def heading_names(spark, sf_dir):
    """Clean headings, the medium they hint at, the line's name, the work's title and the local one."""
    h = rows(spark, sf_dir, HEADINGS).withColumns({"a": titles.clean_heading(F.col("h1")), "b": titles.clean_heading(F.col("h2"))})
    path = F.array("a", "b")
    return h.select("id", "a", "b", titles.detect_medium(path, F.col("article")).alias("medium"), titles.line_name(path, F.col("work")).alias("line"), titles.work_title(F.col("article")).alias("title"), titles.local_title(F.col("article")).alias("local_title"))


LOCAL = """SELECT id, CASE id % 4 WHEN 0 THEN 'EN' WHEN 1 THEN 'DE' WHEN 2 THEN 'FR' ELSE 'JP' END AS market, id % 3 <> 0 AS is_main, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN '[[' || work ELSE work || ' (roman)' END AS library,
 CASE WHEN id % 7 < 3 THEN NULL ELSE 'Titre ' || work END AS official FROM (""" + NAMES + ")"


@query(f"""WITH l AS (SELECT *, CASE WHEN NOT contains(library, '[[') THEN nullif(trim(regexp_replace(library, '\\s+\\([^()]*\\)\\s*$', '')), '') END AS own FROM ({plain(LOCAL)}))
SELECT id, CASE WHEN market = 'EN' THEN NULL WHEN market = 'DE' AND own IS NOT NULL THEN own WHEN market = 'FR' AND own IS NOT NULL AND official IS NULL THEN own WHEN is_main THEN official END AS local_name FROM l""")
def local_names(spark, sf_dir):
    """A line's name in its own language."""
    return rows(spark, sf_dir, LOCAL).select("id", titles.local_name(F.col("market"), F.col("is_main"), F.col("library"), F.col("official")).alias("local_name"))


VOLUME_TITLES = """SELECT id, work AS series, id % 2 = 0 AS native_ok, id % 11 = 0 AS trusted, CASE id % 10 WHEN 0 THEN '12' WHEN 1 THEN work || ': The ' || kind WHEN 2 THEN work || ' 5' WHEN 3 THEN '[[' || kind || ']]'
 WHEN 4 THEN '漫画 ' || kind WHEN 5 THEN '漫画' WHEN 6 THEN work || ' Vol. 3: 7' WHEN 7 THEN '' WHEN 8 THEN upper(work) || ' Vol 2' ELSE kind || ' days' END AS title FROM (""" + NAMES + ")"


@query(f"""WITH v AS (SELECT *, starts_with(lower(title), lower(series)) AS starts, substr(title, length(series) + 1) AS rest FROM ({plain(VOLUME_TITLES)})),
a AS (SELECT *, regexp_extract(rest, '^\\s*(?:(?i:vol(?:ume)?)\\.?\\s*)?[0-9]*\\s*[:–-]\\s*(.+)$', 1) AS behind FROM v),
r AS (SELECT *, CASE WHEN title = '' THEN 'empty' WHEN regexp_matches(title, '^[0-9]+$') THEN 'number_only' WHEN contains(title, '[[') THEN 'markup' WHEN trusted THEN NULL WHEN NOT native_ok AND contains(title, '漫') THEN 'wrong_script'
  WHEN starts AND behind <> '' AND regexp_matches(behind, '^[0-9]+$') THEN 'number_only' WHEN starts AND behind = '' AND regexp_matches(rest, '^(?i:{titles._REST})$') THEN 'redundant' END AS reason FROM a)
SELECT id, CASE WHEN reason IS NULL THEN CASE WHEN NOT trusted AND starts AND behind <> '' THEN behind ELSE title END END AS title, reason FROM r""")
def title_hygiene(spark, sf_dir):
    """Volume titles that say something, else why not."""
    out = rows(spark, sf_dir, VOLUME_TITLES).select("id", titles.exported_title(F.col("title"), F.col("series"), F.col("native_ok"), F.col("trusted")).alias("s"))
    return out.select("id", "s.*")


FIELDS = """SELECT id, CASE id % 6 WHEN 0 THEN '—' WHEN 1 THEN ' TBA ' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE kind END AS value, market || ' Verlag' AS publisher, CASE id % 3 WHEN 0 THEN market || ' (former)<br/>' || kind || ' Press (current)' WHEN 1 THEN market || ', ' || kind || ', ' || market ELSE '* ' || kind || ' (until 2009)' END AS publishers,
 CASE id % 4 WHEN 0 THEN '["{{" || "x" || "}}"]' ELSE '["", "[[' || work || ']]", "b"]' END AS authors, CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'https://openlibrary.org/b/' || id WHEN 2 THEN 'http://d-nb.info/' || id ELSE 'https://x.example.com/WIKI/' || id END AS url,
 CASE id % 3 WHEN 0 THEN 'b/id/-1-M.jpg' WHEN 1 THEN 'b/id/' || id || '-M.jpg' ELSE 'none' END AS cover, CASE id % 4 WHEN 0 THEN '2003-13' WHEN 1 THEN '2003-12-01' WHEN 2 THEN '1999' ELSE '2010-00-02' END AS day, CAST(size * 60 AS string) AS pages FROM (""" + NAMES + ")"
FIELDS = FIELDS.replace("""'["{{" || "x" || "}}"]'""", """'["", " ", ""]'""").replace("CAST(size * 60 AS string)", "CAST(size * 60 AS VARCHAR(9))")
HOSTS = [("openlibrary.org", "open"), ("d-nb.info", "dnb"), ("/wiki/", "wikipedia")]


@query(f"""WITH f AS (SELECT * FROM ({plain(FIELDS)})) SELECT id, regexp_matches(coalesce(lower(trim(value)), ''), '^(|[-–—?]+|n/?a|tba|tbd|none|unknown)$') AS is_blank, lower(regexp_replace(split_part(publisher, ' ', 1), '[^A-Za-z0-9]', '', 'g')) AS family,
string_agg_items AS items, now, CASE WHEN url IS NULL THEN NULL WHEN contains(url, 'openlibrary') THEN 'open' WHEN contains(url, 'd-nb') THEN 'dnb' ELSE 'wikipedia' END AS source, coalesce(try_cast(regexp_extract(cover, '/(-?[0-9]+)-', 1) AS INTEGER) > 0, false) AS has_cover,
regexp_matches(day, '^[0-9]{{4}}-(00|1[3-9]|[2-9][0-9])') AS month_wrong, try_cast(pages AS INTEGER) BETWEEN 20 AND 2000 AS pages_plausible, CASE WHEN id % 4 > 0 THEN work END AS author, regexp_matches(coalesce(url, ''), '^https?://') AS is_link
FROM (SELECT f.*, n.work, CASE id % 3 WHEN 0 THEN n.market || ' (former)|' || n.kind || ' Press (current)' WHEN 1 THEN n.market || '|' || n.kind ELSE n.kind || ' (until 2009)' END AS string_agg_items,
  CASE id % 3 WHEN 0 THEN n.kind || ' Press' WHEN 1 THEN n.kind END AS now FROM f JOIN ({plain(NAMES)}) n USING (id))""")
def field_values(spark, sf_dir):
    """Blank values, publisher keys and choices, list items, sources by host, cover placeholders, impossible months, page counts, first authors, links."""
    c = F.col
    return rows(spark, sf_dir, FIELDS).select(
        "id", titles.blank(c("value")).alias("is_blank"), titles.publisher_key(c("publisher")).alias("family"), F.array_join(titles.list_items(c("publishers")), "|").alias("items"), titles.publisher_now(c("publishers")).alias("now"),
        titles.source_name(c("url"), HOSTS).alias("source"), F.coalesce(F.regexp_extract("cover", "/(-?[0-9]+)-", 1).try_cast("int") > 0, F.lit(False)).alias("has_cover"),
        c("day").rlike("^[0-9]{4}-(00|1[3-9]|[2-9][0-9])").alias("month_wrong"), c("pages").try_cast("int").between(20, 2000).alias("pages_plausible"), titles.first_author(c("authors")).alias("author"),
        F.coalesce(c("url"), F.lit("")).rlike("^https?://").alias("is_link"),
    )
