"""Binding of native lines and of works without an English line, over searched pages, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import keys
from claimloom.operators import binding
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows
from claimloom.plans.lookup import _PICK, PAGES
from claimloom.session import cut

_FIRST = "split_part(p_name, ' ', 1)"
_LINES = """SELECT p_partkey AS line, p_partkey - p_partkey % 3 AS work, CASE p_partkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'ja' ELSE 'fr' END AS language, CASE WHEN p_size % 5 = 0 THEN 'novel' WHEN p_size % 7 = 0 THEN 'artbook' WHEN p_partkey % 3 = 0 THEN 'manga' ELSE 'manhwa' END AS medium,
  p_size % 6 > 0 AS main, CASE WHEN p_partkey % 10 = 0 THEN p_partkey % 60 END AS bound, p_size = 49 AS pinned, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN split_part(p_name, ' ', 1) || ' ' || lower(p_type) END AS local_name, p_size % 12 AS volume_count, CASE WHEN p_size % 4 > 0 THEN 1990 + p_size % 8 END AS year_began FROM {part}"""
_ALIASES = f"""SELECT p_partkey AS line, 1 AS pos, p_name || ' ' || replace(p_brand, '#', '') AS alias, 'fr' AS language, 'official' AS kind FROM {{part}} UNION ALL SELECT p_partkey, 2, 'the ' || p_name, 'en', 'official' FROM {{part}} UNION ALL SELECT p_partkey, 3, {_FIRST} || ' saga', 'ja', 'official' FROM {{part}} WHERE p_size % 2 = 0
UNION ALL SELECT p_partkey, 4, 'List of ' || p_name, 'en', 'alias' FROM {{part}} UNION ALL SELECT p_partkey, 5, upper(p_name), 'en', 'alias' FROM {{part}} UNION ALL SELECT p_partkey, 6, {_FIRST} || ' tale', 'en', 'alias' FROM {{part}} UNION ALL SELECT p_partkey, 7, {_FIRST} || ' legend', 'en', 'alias' FROM {{part}}
UNION ALL SELECT p_partkey, 8, {_FIRST} || ' end', 'en', 'alias' FROM {{part}} UNION ALL SELECT p_partkey, 9, {_FIRST} || ' past', 'en', 'alias' FROM {{part}} UNION ALL SELECT p_partkey, 10, {_FIRST} || ' & ' || lower(p_type), 'ko', 'romanized' FROM {{part}} UNION ALL SELECT p_partkey, 11, lower(p_type) || ' saga', 'ko', 'official' FROM {{part}}"""
#: A search gives the ten most popular entries of a family that begin like the term.
_ENTRIES = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family, head ORDER BY popularity DESC, id) AS position FROM (SELECT *, substr(replace(regexp_replace(lower(title), '^(the|an|a) ', ''), ' ', ''), 1, 4) AS head FROM (
  SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 'novel' ELSE 'comic' END AS family, CASE p_partkey % 7 WHEN 0 THEN p_name WHEN 1 THEN 'the ' || p_name WHEN 2 THEN {_FIRST} || ' ' || lower(p_type) WHEN 3 THEN {_FIRST} || ' saga' WHEN 4 THEN {_FIRST} || ' tale' WHEN 5 THEN {_FIRST} || ' and ' || lower(p_type) ELSE p_name || ' ' || replace(p_brand, '#', '') END AS title,
  CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN {_FIRST} || ' legend' WHEN 2 THEN {_FIRST} || ' saga' ELSE p_name || ' x' END AS synonym, CASE WHEN p_partkey % 9 = 0 THEN 'ONE_SHOT' ELSE 'MANGA' END AS format, CASE WHEN p_partkey % 5 > 0 AND p_partkey % 17 > 0 THEN p_partkey % 17 END AS volumes, CASE WHEN p_partkey % 4 = 0 THEN 'RELEASING' ELSE 'FINISHED' END AS status,
  p_partkey * 7 % 101 AS popularity, CASE WHEN p_partkey % 3 > 0 THEN 1988 + p_size % 12 END AS year FROM {{part}}))) WHERE position <= 10"""


def _pages(spark, sf_dir, terms, by):
    e = rows(spark, sf_dir, _ENTRIES)
    one = lambda c: F.array(c)
    e = e.withColumns({
        "pk": one(keys.compact_key(F.col("title"))), "apk": one(keys.article_free_key(F.col("title"))), "sk": one(keys.compact_key(F.col("synonym"))), "ask": one(keys.article_free_key(F.col("synonym"))),
        "titles": F.array(F.lower("title"), F.lower("synonym")),
    })
    searched = terms.select(by, "term_key", F.substring(keys.article_free_key(F.col("term")), 1, 4).alias("head")).distinct()
    return cut(searched.join(e.withColumnRenamed("family", by), [by, "head"]).drop("head", "title", "synonym").withColumnRenamed(by, "family"))


def _key(x):
    return f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


_HEAD = "substr(regexp_replace(regexp_replace(lower({}), '^(the|an|a) ', ''), '[^\\p{{L}}\\p{{N}}]', '', 'g'), 1, 4)"


def _picked(terms: str) -> str:
    """The ranker's CTEs over the pages of terms (q, term, volume_count, head, family)."""
    page = f"""SELECT t.q, '' AS name, t.term, t.volume_count, t.own AS own_name, FALSE AS fallback, NULL AS orig_count, e.* EXCLUDE (head, family, year) FROM {terms} t JOIN entries e ON e.family = t.family AND e.head = t.head"""
    return _PICK.replace(plain(PAGES), page)[len("WITH ") :]


_NATIVE = f"""lines AS MATERIALIZED (SELECT *, CASE WHEN medium = 'novel' THEN 'novel' WHEN medium IN ('manga', 'manhwa') THEN 'comic' ELSE 'other' END AS family FROM ({plain(_LINES)})), aliases AS ({plain(_ALIASES)}), entries AS MATERIALIZED ({plain(_ENTRIES)}),
served AS (SELECT DISTINCT work, family FROM lines WHERE language = 'en' OR bound IS NOT NULL),
mine AS MATERIALIZED (SELECT * FROM lines WHERE language = 'ja' AND main AND bound IS NULL AND NOT pinned AND family <> 'other' AND (work, family) NOT IN (SELECT (work, family) FROM served)),
t0 AS (SELECT line, 0 AS a, 0 AS b, name AS term, 'name' AS kind FROM mine UNION ALL SELECT line, 1, 0, local_name, 'native' FROM mine UNION ALL SELECT line, CASE a.language WHEN 'ja' THEN 2 WHEN 'en' THEN 3 ELSE 4 END, pos, alias, 'official' FROM aliases a SEMI JOIN mine USING (line) WHERE kind = 'official'
  UNION ALL SELECT line, 9, pos, alias, 'alias' FROM aliases SEMI JOIN mine USING (line) WHERE kind = 'alias' AND NOT starts_with(lower(alias), 'list of ')),
t1 AS (SELECT * FROM (SELECT *, {_key('term')} AS k FROM t0) WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY line, k ORDER BY a, b) = 1),
t2 AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY a, b) AS place, row_number() OVER (PARTITION BY line, kind ORDER BY a, b) AS nth FROM t1),
terms AS MATERIALIZED (SELECT t.line || ':' || place AS q, t.line, place, term, kind, kind = 'name' AS own, volume_count, year_began, family, {_HEAD.format('term')} AS head FROM t2 t JOIN mine USING (line) WHERE kind <> 'alias' OR nth <= 3),
{_picked('terms')},
good AS (SELECT t.line, t.place, t.kind, x.id, x.via FROM picked x JOIN terms t USING (q) JOIN entries e ON e.id = x.id AND e.family = t.family WHERE abs(e.year - t.year_began) <= 3 IS NOT FALSE),
bound AS MATERIALIZED (SELECT line, CASE WHEN kind IN ('name', 'native') THEN 1 WHEN kind = 'official' THEN 2 ELSE 3 END::INTEGER AS round, place::INTEGER AS place, id, via, kind FROM good QUALIFY row_number() OVER (PARTITION BY line ORDER BY place) = 1),
g AS (SELECT b.*, work, family FROM bound b JOIN lines USING (line)),
taken AS (SELECT bound AS id, min(work)::VARCHAR AS holder FROM lines WHERE bound IS NOT NULL GROUP BY bound)"""


def _native(spark, sf_dir):
    """The native lines to bind, what their terms' pages bind, all terms' picks, and all lines."""
    every = rows(spark, sf_dir, _LINES).withColumn("family", binding.family(F.col("medium")))
    lines = binding.unbound_native(every.drop("family"), "ja")
    lines = cut(lines)
    terms = cut(binding.native_terms(lines, rows(spark, sf_dir, _ALIASES), "ja"))
    return every, lines, terms, _pages(spark, sf_dir, terms.join(lines.select("line", "family"), "line"), "family")


@query(f"""WITH {_NATIVE}
SELECT line, round, place, id, via, kind, CASE WHEN holder IS NOT NULL THEN holder WHEN (SELECT count(DISTINCT o.id) FROM g o WHERE o.work = g.work AND o.family = g.family) > 1 THEN (SELECT min(o.line)::VARCHAR FROM g o WHERE o.work = g.work AND o.family = g.family AND o.line <> g.line)
  ELSE (SELECT min(o.line)::VARCHAR FROM g o WHERE o.id = g.id AND (o.work <> g.work OR o.family <> g.family)) END AS note FROM g LEFT JOIN taken USING (id)""")
def binding_rounds(spark, sf_dir):
    """Native lines bound in rounds of names, official titles and aliases by the ranker over searched pages; what others hold or pick is withheld."""
    every, lines, terms, pages = _native(spark, sf_dir)
    found = binding.bind(lines, terms, pages)
    taken = every.where("bound is not null").select(F.col("bound").alias("id"), "work")
    notes = binding.withheld(found.select("line", "id"), lines, taken).select("line", "note")
    return found.join(notes, "line").select("line", "round", F.col("place").cast("int").alias("place"), "id", "via", "kind", "note")


@query(f"""WITH l AS ({plain(_LINES)}) SELECT line, CASE WHEN m IN ('novel', 'light_novel') THEN 'novel' WHEN m IS NULL OR m IN ('manga', 'manhwa') THEN 'comic' ELSE m END AS family FROM (SELECT line, CASE WHEN line % 8 = 3 THEN NULL WHEN line % 8 = 5 THEN 'light_novel' ELSE medium END AS m FROM l)""")
def media_families(spark, sf_dir):
    """The family of each line's medium: bindings never cross families."""
    m = F.when(F.col("line") % 8 == 3, None).when(F.col("line") % 8 == 5, "light_novel").otherwise(F.col("medium"))
    return rows(spark, sf_dir, _LINES).select("line", binding.family(m).alias("family"))


@query()
def handed_on_bindings(spark, sf_dir):
    """The same lines with contested ids handed on: each line gets the best id that nobody with a better claim wants; a loop holds it in the tests."""
    every, lines, terms, pages = _native(spark, sf_dir)
    all_terms = terms.join(lines.select("line", "family", "volume_count", "year_began"), "line")
    choices = binding.picks(all_terms, pages, "line").join(all_terms.select("line", "place", "own"), ["line", "place"])
    choices = choices.select("line", "place", "id", F.struct(~F.col("own"), "place").alias("claim"))
    return binding.assign(choices, every.where("bound is not null").select(F.col("bound").alias("id")))


_WORKS = f"""lines AS MATERIALIZED ({plain(_LINES)}), aliases AS ({plain(_ALIASES)}), entries AS MATERIALIZED ({plain(_ENTRIES)}),
mine AS (SELECT * FROM lines WHERE main AND medium = 'manhwa' AND NOT pinned AND work NOT IN (SELECT work FROM lines WHERE language = 'en' AND medium IN ('manga', 'manhwa'))),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY work ORDER BY language <> 'fr', line)::INTEGER AS rank FROM mine WHERE work IN (SELECT work FROM mine WHERE bound IS NULL)),
met AS (SELECT a.*, r.work, rank, first_value(volume_count) OVER (PARTITION BY r.work ORDER BY rank) AS vc FROM aliases a JOIN ranked r USING (line)),
u0 AS (SELECT work, 0 AS a, rank AS b, f.c, CASE f.c WHEN 0 THEN name WHEN 1 THEN trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) ELSE regexp_replace(name, '(?i)[ :-]+(deluxe|collector.?s|perfect|complete|omnibus) edition$', '') END AS term, f.c < 2 AS own, volume_count FROM ranked, (SELECT unnest(range(3)) AS c) f
  UNION ALL (SELECT work, CASE kind WHEN 'official' THEN 1 ELSE 2 END, 0, 0, alias, FALSE, vc FROM met WHERE language IN ('ko', 'zh') AND kind IN ('official', 'romanized') QUALIFY row_number() OVER (PARTITION BY work, kind ORDER BY rank <> 1, line, pos) = 1)
  UNION ALL SELECT work, 9, rank, pos, alias, FALSE, vc FROM met WHERE kind = 'alias' AND NOT starts_with(lower(alias), 'list of ')),
u1 AS (SELECT *, {_key('term')} AS k, CASE WHEN a < 9 THEN term ELSE {_key('term')} END AS d FROM u0),
u2 AS (SELECT * FROM u1 WHERE k <> '' AND (a < 9 OR (work, k) NOT IN (SELECT (work, k) FROM u1 WHERE a < 9)) QUALIFY row_number() OVER (PARTITION BY work, d ORDER BY a, b, c) = 1),
u3 AS (SELECT *, row_number() OVER (PARTITION BY work ORDER BY a, b, c) AS place, row_number() OVER (PARTITION BY work, a = 9 ORDER BY a, b, c) AS nth FROM u2),
terms AS MATERIALIZED (SELECT work, place::INTEGER AS place, term, k AS term_key, own, volume_count::INTEGER AS volume_count FROM u3 WHERE a < 9 OR nth <= 3)"""


def _works(spark, sf_dir):
    lines = binding.unvoiced_works(rows(spark, sf_dir, _LINES), ("manhwa",), "fr")
    return lines, binding.work_terms(lines, rows(spark, sf_dir, _ALIASES), ("ko", "zh"))


@query(f"WITH {_WORKS} SELECT * FROM terms")
def foreign_terms(spark, sf_dir):
    """The terms a work without an English line is searched by: its lines' names, its native and romanized title, a few aliases."""
    return _works(spark, sf_dir)[1]


@query(f"WITH {_WORKS} SELECT work, line, rank FROM ranked")
def binding_candidates(spark, sf_dir):
    """Works without an English comic line, with their main lines in the order in which they lend their names."""
    return _works(spark, sf_dir)[0].select("work", "line", "rank")


def _country(i: int) -> str:
    return f"""p{i}_terms AS MATERIALIZED (SELECT t.work || ':' || place AS q, t.*, '{'comic' if i == 1 else 'novel'}' AS family, {_HEAD.format('term')} AS head FROM terms t {'' if i == 1 else 'ANTI JOIN won1 USING (work)'})"""


@query(f"""WITH {_WORKS}, {_country(1)}, picks1 AS MATERIALIZED (WITH {_picked('p1_terms')} SELECT * FROM picked),
amp1 AS (SELECT q, e.id, e.popularity, e.position FROM p1_terms t JOIN entries e ON e.family = t.family AND e.head = t.head WHERE contains(t.term, '&') AND {_key("replace(t.term, ' & ', ' and ')")} = {_key('e.title')} AND e.format <> 'ONE_SHOT'
  AND NOT coalesce(e.volumes > 0 AND t.volume_count > 0 AND (t.volume_count - e.volumes > greatest(3.0, 0.4 * t.volume_count) * CASE WHEN e.status = 'RELEASING' THEN 2 ELSE 1 END OR e.volumes > 4 * t.volume_count), FALSE)
  AND NOT EXISTS (SELECT 1 FROM entries x WHERE x.family = t.family AND x.head = t.head AND ({_key('x.title')} = t.term_key OR {_key('x.synonym')} = t.term_key)) QUALIFY row_number() OVER (PARTITION BY q ORDER BY e.popularity DESC, e.position) = 1),
won1 AS MATERIALIZED (SELECT work, 'comic' AS country, place, id, via FROM (SELECT t.work, place, id, via, 1 AS turn FROM picks1 JOIN p1_terms t USING (q) UNION ALL SELECT t.work, place, id, 'amp', 2 FROM amp1 JOIN p1_terms t USING (q)) QUALIFY row_number() OVER (PARTITION BY work ORDER BY turn, place) = 1),
{_country(2)}, picks2 AS MATERIALIZED (WITH {_picked('p2_terms')} SELECT * FROM picked), amp2 AS (SELECT q, e.id, e.popularity, e.position FROM p2_terms t JOIN entries e ON e.family = t.family AND e.head = t.head WHERE contains(t.term, '&') AND {_key("replace(t.term, ' & ', ' and ')")} = {_key('e.title')} AND e.format <> 'ONE_SHOT'
  AND NOT coalesce(e.volumes > 0 AND t.volume_count > 0 AND (t.volume_count - e.volumes > greatest(3.0, 0.4 * t.volume_count) * CASE WHEN e.status = 'RELEASING' THEN 2 ELSE 1 END OR e.volumes > 4 * t.volume_count), FALSE)
  AND NOT EXISTS (SELECT 1 FROM entries x WHERE x.family = t.family AND x.head = t.head AND ({_key('x.title')} = t.term_key OR {_key('x.synonym')} = t.term_key)) QUALIFY row_number() OVER (PARTITION BY q ORDER BY e.popularity DESC, e.position) = 1),
won2 AS (SELECT work, 'novel' AS country, place, id, via FROM (SELECT t.work, place, id, via, 1 AS turn FROM picks2 JOIN p2_terms t USING (q) UNION ALL SELECT t.work, place, id, 'amp', 2 FROM amp2 JOIN p2_terms t USING (q)) QUALIFY row_number() OVER (PARTITION BY work ORDER BY turn, place) = 1)
FROM won1 UNION ALL FROM won2""")
def work_bindings(spark, sf_dir):
    """Works without an English line bound through two catalogues in turn, by the ranker, then by '&' read as 'and'."""
    lines, terms = map(cut, _works(spark, sf_dir))
    catalogues = F.array(F.lit("comic"), F.lit("novel"))
    works = lines.where("rank = 1").select("work", catalogues.alias("countries"), F.lit(None).cast("int").alias("year_began"))
    asked = works.join(terms, "work").select("*", F.explode("countries").alias("family"))
    return binding.bind_works(works, terms, _pages(spark, sf_dir, asked, "family")).select("work", "country", "place", "id", "via")


_SHOWN = """SELECT p_partkey AS line, p_type AS work, CASE WHEN p_partkey % 5 = 0 THEN 'ja' ELSE 'en' END AS language, CASE WHEN p_size % 2 = 0 THEN 'novel' ELSE 'manga' END AS medium, CASE WHEN p_partkey % 7 = 0 THEN p_size % 40 END AS bound,
  CASE p_partkey % 4 WHEN 1 THEN p_name || ' (Side ' || p_size || ')' WHEN 2 THEN p_name || ': Other' ELSE p_name END AS name, p_size % 12 AS volume_count FROM {part}"""


@query(f"""WITH lines AS MATERIALIZED ({plain(_SHOWN)}), entries AS MATERIALIZED ({plain(_ENTRIES)}), english AS (SELECT *, regexp_extract(name, '^(.+?)( \\(|: | - | / )', 1) AS head FROM lines WHERE language = 'en'),
bound AS (SELECT work, {_key('name')} AS k, count(DISTINCT bound) AS n, min(bound) AS id FROM english WHERE bound IS NOT NULL GROUP BY ALL),
j AS (SELECT e.*, b.n, b.id FROM english e LEFT JOIN bound b ON b.work = e.work AND b.k = {_key('e.head')} AND e.head <> '' WHERE e.bound IS NULL),
novels AS (SELECT line::VARCHAR || ':1' AS q, line, name AS term, TRUE AS own, volume_count, 'comic' AS family, {_HEAD.format('name')} AS head FROM lines WHERE language = 'en' AND bound IS NULL AND medium = 'novel'),
{_picked('novels')},
seen AS (SELECT DISTINCT line FROM novels t JOIN entries e ON e.family = 'novel' AND e.head = t.head WHERE {_key('e.title')} = {_key('t.term')} OR {_key('e.synonym')} = {_key('t.term')})
SELECT line, id, 'parent' AS via FROM j WHERE n = 1 UNION ALL SELECT line, picked.id, 'medium' FROM j JOIN novels USING (line) JOIN picked USING (q) WHERE j.n IS NULL AND line NOT IN (FROM seen)""")
def display_fallback(spark, sf_dir):
    """What an English line without an id shows instead: its parent's id, or for a novel the comic's of its name; never a binding."""
    lines = rows(spark, sf_dir, _SHOWN)
    novels = lines.where("language = 'en' and bound is null and medium = 'novel'")
    terms = cut(novels.select("line", F.lit(1).alias("place"), "name", F.col("name").alias("term"), keys.compact_key(F.col("name")).alias("term_key"), F.lit(True).alias("own"), "volume_count", F.lit(None).cast("int").alias("year_began"), F.explode(F.array(F.lit("comic"), F.lit("novel"))).alias("family")))
    pages = _pages(spark, sf_dir, terms, "family")
    adapted = binding.picks(terms.where("family = 'comic'"), pages, "line").select("line", "id")
    own = terms.where("family = 'novel'").join(pages, ["family", "term_key"])
    seen = own.where(F.array_contains(F.concat("pk", "sk"), F.col("term_key"))).select("line").distinct()
    return binding.shown_instead(lines, adapted, seen)
