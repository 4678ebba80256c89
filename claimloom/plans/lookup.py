"""Ranked lookups and their guards as queries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.functions import keys
from claimloom.operators import ranking
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows
from claimloom.session import table

#: Queries and the pages of candidates that a search gives them.
PAGES = """SELECT a.p_partkey AS q, a.p_name AS name, CASE a.p_partkey % 5 WHEN 0 THEN a.p_name WHEN 1 THEN 'the ' || a.p_name WHEN 2 THEN substr(a.p_name, 1, length(a.p_name) - 2) WHEN 3 THEN a.p_name || ' & ' || a.p_type ELSE a.p_type END AS term, a.p_size % 12 AS volume_count, a.p_partkey % 3 > 0 AS own_name, a.p_partkey % 7 > 0 AS fallback,
 a.p_size AS orig_count, b.p_partkey AS id, b.p_partkey AS position, CASE WHEN b.p_partkey % 9 = 0 THEN 'ONE_SHOT' ELSE 'MANGA' END AS format, CASE WHEN b.p_partkey * 7 % 23 > 0 THEN b.p_partkey * 7 % 23 END AS volumes, CASE WHEN b.p_partkey % 4 = 0 THEN 'RELEASING' ELSE 'FINISHED' END AS status, b.p_partkey % 13 AS popularity,
 CASE b.p_partkey % 5 WHEN 0 THEN 'the ' || b.p_name WHEN 1 THEN b.p_name || ' ' || b.p_type WHEN 2 THEN b.p_name || ' and ' || b.p_type ELSE b.p_name END AS title, CASE b.p_partkey % 3 WHEN 0 THEN b.p_type WHEN 1 THEN 'an ' || b.p_name ELSE a.p_name END AS synonym FROM {part} a JOIN {part} b ON a.p_type = b.p_type AND a.p_size = b.p_size"""
_KEY = "replace(replace({}, ' ', ''), '&', '')"
_AKEY = "regexp_replace({}, '^(the|a|an) ', '')"
_C = f"""WITH p AS ({plain(PAGES)}), k AS (SELECT *, {_KEY.format('lower(term)')} AS k, {_KEY.format(_AKEY.format('lower(term)'))} AS ak, {_KEY.format('lower(title)')} AS pk, {_KEY.format(_AKEY.format('lower(title)'))} AS apk, {_KEY.format('lower(synonym)')} AS sk, {_KEY.format(_AKEY.format('lower(synonym)'))} AS ask FROM p),
v AS (SELECT *, volumes IS NOT NULL AND volume_count > 0 AS known, own_name AND fallback AS loose FROM k),
w AS (SELECT *, known AND volume_count - volumes > greatest(3.0, 0.4 * volume_count) * CASE WHEN status = 'RELEASING' THEN 2 ELSE 1 END AS short FROM v)"""
_PICK = f"""{_C}, f AS (SELECT *, k = pk AS f1, k = sk AS f2, ak = apk AS f3, ak = ask AS f4, known AND (volume_count > 2 OR NOT loose) AND volumes > 4 * volume_count AS over, (least(length(pk), length(k)) >= 4 AND (contains(pk, k) OR contains(k, pk))) OR (least(length(sk), length(k)) >= 4 AND (contains(sk, k) OR contains(k, sk))) AS inside FROM w),
h AS (SELECT *, bool_or(f1) OVER p AS ph, bool_or(f1 OR f3) OVER p AS ah, bool_or(f1 OR f2 OR f3 OR f4) OVER p AS eh FROM f WINDOW p AS (PARTITION BY q)),
c AS (SELECT *, CASE WHEN format = 'ONE_SHOT' OR short THEN NULL WHEN over THEN CASE WHEN loose AND f1 THEN 'o1' WHEN loose AND f2 THEN 'o2' END WHEN f1 THEN 'primary' WHEN f2 THEN CASE WHEN ph THEN 'carrier' ELSE 'synonym' END WHEN f3 THEN 'a1' WHEN f4 THEN CASE WHEN NOT ah THEN 'a2' END
  WHEN loose AND volumes = volume_count AND inside THEN 'substring' END AS kind FROM h),
n AS (SELECT q, bool_or(ph) AS ph, bool_or(eh) AS eh, count_if(kind = 'primary') AS n1, count_if(kind = 'synonym') AS n2, count_if(kind = 'a1') AS n3, count_if(kind = 'a2') AS n4, count_if(kind = 'substring') AS n5, count_if(kind = 'o1') AS n6, count_if(kind = 'o2') AS n7, count_if(kind = 'carrier') AS n8 FROM c GROUP BY q),
t AS (SELECT q, CASE WHEN n1 > 0 THEN 'primary' WHEN n2 > 0 THEN 'synonym' WHEN n3 > 0 AND NOT ph THEN 'a1' WHEN n4 > 0 AND NOT ph THEN 'a2' WHEN NOT eh AND n5 = 1 THEN 'substring' WHEN n8 + n3 + n4 = 0 AND n6 > 0 THEN 'o1' WHEN n8 + n3 + n4 = 0 AND n7 > 0 AND NOT ph THEN 'o2' END AS kind FROM n),
picked AS (SELECT c.q, id, CASE WHEN kind IN ('a1', 'a2') THEN 'article' WHEN kind IN ('o1', 'o2') THEN 'ceiling' ELSE kind END AS via FROM c JOIN t USING (q, kind) QUALIFY row_number() OVER (PARTITION BY c.q ORDER BY popularity DESC, position) = 1)"""


def _plain_key(c):
    return F.regexp_replace(F.lower(c), "[ &]", "")


def _article_key(c):
    return F.regexp_replace(F.regexp_replace(F.lower(c), "^(the|a|an) ", ""), "[ &]", "")


_ASKED = """SELECT p_partkey AS q, p_type || '|' || p_size AS page, p_name AS name, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN 'the ' || p_name WHEN 2 THEN substr(p_name, 1, length(p_name) - 2) WHEN 3 THEN p_name || ' & ' || p_type ELSE p_type END AS term, p_size % 12 AS volume_count, p_partkey % 3 > 0 AS own_name, p_partkey % 7 > 0 AS fallback, p_size AS orig_count FROM {part} WHERE p_type IS NOT NULL AND p_size IS NOT NULL"""
_GIVEN = """SELECT p_type || '|' || p_size AS page, p_partkey AS id, p_partkey AS position, CASE WHEN p_partkey % 9 = 0 THEN 'ONE_SHOT' ELSE 'MANGA' END AS format, CASE WHEN p_partkey * 7 % 23 > 0 THEN p_partkey * 7 % 23 END AS volumes, CASE WHEN p_partkey % 4 = 0 THEN 'RELEASING' ELSE 'FINISHED' END AS status, p_partkey % 13 AS popularity,
 CASE p_partkey % 5 WHEN 0 THEN 'the ' || p_name WHEN 1 THEN p_name || ' ' || p_type WHEN 2 THEN p_name || ' and ' || p_type ELSE p_name END AS title, CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN 'an ' || p_name END AS synonym, p_partkey % 3 = 2 AS echo FROM {part} WHERE p_type IS NOT NULL AND p_size IS NOT NULL"""


def _pages(spark, sf_dir):
    """Queries and candidates of the pages they share: parts of one type and size are given one page, where some synonyms are the query's own name."""
    asked, given = rows(spark, sf_dir, _ASKED, part="p_partkey"), rows(spark, sf_dir, _GIVEN, part="p_partkey")
    one = lambda c: F.array(c)
    asked = asked.withColumns({"k": _plain_key("term"), "ak": _article_key("term"), "nk": _plain_key("name"), "ank": _article_key("name")})
    return asked, given.withColumns({"pk": one(_plain_key("title")), "apk": one(_article_key("title")), "sk": one(_plain_key("synonym")), "ask": one(_article_key("synonym"))})


@query(f"{_PICK} SELECT * FROM picked")
def title_picks(spark, sf_dir):
    """The ranker over pages of search results: classes, guards over the whole page, fallbacks."""
    return ranking.pick_shared(*_pages(spark, sf_dir))


@query(f"""{_C}, x AS (SELECT *, trim(regexp_replace(lower(term), '[^a-z0-9]+', ' ', 'g')) AS words, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS tw, trim(regexp_replace(lower(synonym), '[^a-z0-9]+', ' ', 'g')) AS sw, {_KEY.format('lower(name)')} AS base, lower(substr(term, 1, 4)) AS arc, {_KEY.format("replace(lower(term), '&', 'and')")} AS amp, {_KEY.format("replace(lower(title), '&', 'and')")} AS amp2,
format <> 'ONE_SHOT' AND NOT short AND NOT (known AND (volume_count > 2 OR NOT own_name) AND volumes > 4 * volume_count) AS fits, bool_or(k = pk OR k = sk) OVER (PARTITION BY q) AS eh FROM w),
f AS (SELECT *, volume_count >= 3 AND length(k) >= 6 AND NOT eh AND format <> 'ONE_SHOT' AND (starts_with(tw || ' ', words || ' ') OR starts_with(sw || ' ', words || ' ')) AS v1,
 length(base) >= 4 AND length(arc) >= 4 AND fits AND coalesce(volumes = volume_count OR volumes = orig_count, false) AND ((contains(pk, base) AND contains(pk, arc)) OR (contains(sk, base) AND contains(sk, arc))) AS v2,
 contains(words, ' and ') AND NOT eh AND fits AND amp = amp2 AS v3, volume_count >= 3 AND orig_count > 4 * volume_count AND format <> 'ONE_SHOT' AND coalesce(volumes = orig_count, false) AND (k = pk OR k = sk) AS v4 FROM x),
n AS (SELECT *, count_if(v1) OVER p AS n1, count_if(v2) OVER p AS n2, count_if(v4) OVER p AS n4 FROM f WINDOW p AS (PARTITION BY q)),
t AS (SELECT *, CASE WHEN v1 AND n1 = 1 AND fits AND coalesce(volumes, volume_count) >= volume_count THEN 1 WHEN v2 AND n2 = 1 THEN 2 WHEN v3 THEN 3 WHEN v4 AND n4 = 1 THEN 4 END AS tier FROM n)
SELECT q, id, ['prefix', 'arc', 'amp', 'origin'][tier] AS via FROM t WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY q ORDER BY tier, popularity DESC, position) = 1""")
def post_walk_picks(spark, sf_dir):
    """Post-walk tiers: a head of the full title, base and arc in one title, '&' as 'and', the origin's count."""
    asked, given = _pages(spark, sf_dir)
    amp = lambda c: _plain_key(F.regexp_replace(F.lower(c), "&", "and"))
    asked = asked.withColumns({"words": keys.ascii_key(F.col("term")), "nwords": keys.ascii_key(F.col("name")), "base": F.col("nk"), "arc": F.lower(F.substring("term", 1, 4)), "amp": amp("term")})
    given = given.withColumns({"titles": F.array_compact(F.array(keys.ascii_key(F.col("title")), keys.ascii_key(F.col("synonym")))), "amps": F.array(amp("title"))})
    return ranking.post_walk_shared(asked, given)


@query("""WITH l AS (SELECT p_partkey AS line, p_name AS name, [p_name, upper(p_name), 'List of ' || p_name || ' chapters', p_type || ' ' || p_brand, lower(p_type) || ' ' || p_brand, 'x', 'y' || p_size] AS aliases FROM part),
t AS (SELECT line, name, unnest(aliases) AS term, generate_subscripts(aliases, 1) AS pos FROM l), k AS (SELECT *, regexp_replace(lower(term), '[^a-z0-9]', '', 'g') AS key FROM t WHERE NOT regexp_matches(lower(term), '^list of ')),
f AS (SELECT line, key, min(pos) AS pos, arg_min(term, pos) AS term FROM k WHERE key <> regexp_replace(lower(name), '[^a-z0-9]', '', 'g') GROUP BY line, key)
SELECT line, row_number() OVER (PARTITION BY line ORDER BY pos)::INTEGER AS place, term FROM f""")
def alias_walk_terms(spark, sf_dir):
    """The aliases that a walk tries, in order."""
    p = table(spark, sf_dir, "part")
    aliases = F.array("p_name", F.upper("p_name"), F.concat(F.lit("List of "), "p_name", F.lit(" chapters")), F.concat_ws(" ", "p_type", "p_brand"), F.concat_ws(" ", F.lower("p_type"), "p_brand"), F.lit("x"), F.concat(F.lit("y"), "p_size"))
    lines = p.select(F.col("p_partkey").alias("line"), "p_name", aliases.alias("aliases"))
    return ranking.alias_terms(lines, [keys.compact_key(F.col("p_name"))], keys.compact_key)


@query("""WITH t AS (SELECT p_partkey AS line, i AS place, 't' || i AS term, p_partkey * 10 + i AS q, i > 2 AS alias FROM part, range(1, 9) r(i)), k AS (SELECT q, q % 97 AS id, 'alias' AS via FROM t WHERE (q * 31) % 11 = 0),
a AS (SELECT *, sum(alias::INT) OVER (PARTITION BY line ORDER BY place) AS spent FROM t) SELECT line, arg_min(id, place) AS id, arg_min(term, place) AS term, arg_min(via, place) AS via FROM a JOIN k USING (q) WHERE NOT alias OR spent <= 3 GROUP BY line""")
def retry_walk(spark, sf_dir):
    """The first term of a walk that finds something, alias searches capped."""
    t = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("line"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("place"))
    t = t.select("line", "place", F.concat(F.lit("t"), "place").alias("term"), (F.col("line") * 10 + F.col("place")).alias("q"), (F.col("place") > 2).alias("alias"))
    picks = t.where("(q * 31) % 11 = 0").select("q", (F.col("q") % 97).alias("id"), F.lit("alias").alias("via"))
    return ranking.first_hit(picks, t)


SERIES = """SELECT p_partkey AS id, p_name AS name, CASE p_partkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'en' ELSE 'fr' END AS language, CASE p_partkey % 4 WHEN 0 THEN 'manga' WHEN 1 THEN 'novel' WHEN 2 THEN NULL ELSE 'light_novel' END AS medium, p_partkey % 6 = 0 AS is_omnibus, p_size % 9 AS dated_count, p_size AS volume_count, p_name || ' ' || p_type AS alias, p_brand AS brand FROM {part}"""
_QUERIES = "SELECT DISTINCT p_name AS query FROM {part} UNION SELECT DISTINCT upper(p_name || ' ' || p_type) FROM {part}"
_CANDS = f"""s AS ({plain(SERIES)}), q AS ({plain(_QUERIES)}), m AS (SELECT query, s.* FROM q JOIN s ON lower(name) = lower(query) UNION SELECT query, s.* FROM q JOIN s ON lower(alias) = lower(query)),
e AS (SELECT *, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) = trim(regexp_replace(lower(query), '[^a-z0-9]+', ' ', 'g')) AS exact, medium IN ('novel', 'light_novel') IS NOT TRUE AS comic FROM m)"""


@query(f"""WITH {_CANDS}, n AS (SELECT query, id AS new_pick FROM e WHERE language = 'en' QUALIFY row_number() OVER (PARTITION BY query ORDER BY NOT comic, NOT exact, is_omnibus, dated_count DESC, volume_count DESC, id) = 1),
o AS (SELECT query, id AS old_pick FROM e QUALIFY row_number() OVER (PARTITION BY query ORDER BY language <> 'en', is_omnibus, volume_count DESC, id) = 1), v AS (SELECT query, id AS novel_pick FROM e WHERE language = 'en' AND NOT comic QUALIFY row_number() OVER (PARTITION BY query ORDER BY NOT exact, is_omnibus, dated_count DESC, volume_count DESC, id) = 1)
SELECT query, new_pick, old_pick, novel_pick, new_pick IS DISTINCT FROM old_pick AS changed FROM o LEFT JOIN n USING (query) LEFT JOIN v USING (query)""")
def series_lookup(spark, sf_dir):
    """Candidates by name or alias in any case, the present ranking, the one before it, and the ranking for novels.

    The best under each key and name are found before queries meet them, so a key that very many hold is one row, and no list of candidates is sorted.
    """
    s, q = rows(spark, sf_dir, SERIES, part="p_partkey"), rows(spark, sf_dir, _QUERIES, part="p_partkey").withColumn("low", F.lower("query"))
    english, comic = F.col("language") == "en", ~F.coalesce(F.col("medium").isin("novel", "light_novel"), F.lit(False))
    rest = [F.col("is_omnibus"), (-F.col("dated_count")).alias("dated"), (-F.col("volume_count")).alias("volumes"), F.col("id")]
    known = s.select("name", F.explode(F.array(F.lower("name"), F.lower("alias"))).alias("low"), english.alias("english"), comic.alias("comic"), *rest)
    rest = [F.col(c) for c in ("is_omnibus", "dated", "volumes", "id")]
    english, novel = F.col("english"), F.col("english") & ~F.col("comic")
    heads = known.groupBy("low", "name").agg(
        F.min(F.when(english, F.struct((~F.col("comic")).alias("other"), *rest))).alias("new"),
        F.min(F.struct((~english).alias("foreign"), "is_omnibus", "volumes", "id")).alias("old"), F.min(F.when(novel, F.struct(*rest))).alias("novel"),
    )
    e = q.join(heads, "low").withColumn("inexact", keys.ascii_key(F.col("name")) != keys.ascii_key(F.col("query")))
    inner = lambda c: [F.col(f"{c}.{x}") for x in ("is_omnibus", "dated", "volumes", "id")]
    out = e.groupBy("query").agg(
        F.min(F.when(F.col("new").isNotNull(), F.struct("new.other", "inexact", *inner("new")))).getField("id").alias("new_pick"), F.min("old").getField("id").alias("old_pick"),
        F.min(F.when(F.col("novel").isNotNull(), F.struct("inexact", *inner("novel")))).getField("id").alias("novel_pick"),
    )
    return out.withColumn("changed", ~F.col("new_pick").eqNullSafe(F.col("old_pick")))


@query(f"""WITH s AS ({plain(SERIES)}), k AS (SELECT *, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS key FROM s), q AS (SELECT DISTINCT name || ': the ' || name || ' of old' AS query, name FROM s WHERE id % 2 = 0 UNION SELECT DISTINCT brand || ', the great ' || name, 'the great ' || name FROM s),
b AS (SELECT key, min(id) AS id FROM k GROUP BY key UNION ALL SELECT 'the great ' || key, min(id) FROM k GROUP BY key),
t AS (SELECT DISTINCT query, trim(regexp_replace(lower(CASE WHEN contains(query, ':') THEN regexp_extract(query, ':([^:]*)$', 1) ELSE regexp_extract(query, ',([^,]*)$', 1) END), '[^a-z0-9]+', ' ', 'g')) AS tail FROM q)
SELECT query, id, CASE WHEN id IS NOT NULL THEN tail END AS by FROM t LEFT JOIN b ON b.key = tail AND len(string_split(tail, ' ')) >= 3""")
def subtitle_lookup(spark, sf_dir):
    """A name without a match is tried by what stands behind its last colon or comma, if that has three words."""
    s = rows(spark, sf_dir, SERIES)
    q = s.where("id % 2 = 0").select(F.concat("name", F.lit(": the "), "name", F.lit(" of old")).alias("query")).union(s.select(F.concat("brand", F.lit(", the great "), "name"))).distinct()
    known = s.select(keys.ascii_key(F.col("name")).alias("key"), "id")
    known = known.union(known.select(F.concat(F.lit("the great "), "key"), "id")).groupBy("key").agg(F.min("id").alias("id"))
    tail = keys.ascii_key(F.when(F.contains("query", F.lit(":")), F.substring_index("query", ":", -1)).otherwise(F.substring_index("query", ",", -1)))
    t = q.withColumn("tail", tail).withColumn("key", F.when(F.size(F.split("tail", " ")) >= 3, F.col("tail")))
    return t.join(known, "key", "left").select("query", "id", F.when(F.col("id").isNotNull(), F.col("tail")).alias("by"))


@query(f"""WITH s AS ({plain(SERIES)}), b AS (SELECT *, CASE WHEN id % 10 = 0 THEN name || ' renamed' ELSE name END AS new_name FROM s), q AS (SELECT DISTINCT lower(new_name) AS q FROM b WHERE new_name <> name UNION SELECT DISTINCT lower(name) FROM b WHERE new_name <> name),
o AS (SELECT q, min(id) AS before FROM q JOIN b ON lower(name) = q GROUP BY q), n AS (SELECT q, min(id) AS after FROM q JOIN b ON lower(new_name) = q GROUP BY q)
SELECT q, before, after, CASE WHEN after IS NOT NULL AND before IS DISTINCT FROM after AND before IS NOT NULL THEN 'held-lookup' ELSE 'ok' END AS state FROM q LEFT JOIN o USING (q) LEFT JOIN n USING (q)""")
def lookup_stability(spark, sf_dir):
    """What a lookup picks before and after renames; a rename that changes another's pick is held."""
    b = rows(spark, sf_dir, SERIES).withColumn("new_name", F.when(F.col("id") % 10 == 0, F.concat("name", F.lit(" renamed"))).otherwise(F.col("name")))
    renamed = b.where("new_name <> name")
    q = renamed.select(F.lower("new_name").alias("q")).union(renamed.select(F.lower("name"))).distinct()
    by = lambda c, name: b.groupBy(F.lower(c).alias("q")).agg(F.min("id").alias(name))
    out = q.join(by("name", "before"), "q", "left").join(by("new_name", "after"), "q", "left")
    bad = F.col("after").isNotNull() & F.col("before").isNotNull() & (F.col("before") != F.col("after"))
    return out.withColumn("state", F.when(bad, "held-lookup").otherwise("ok"))


@query("""WITH b AS (SELECT c_custkey AS line, c_nationkey AS grp, CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 50 END AS picked, CASE WHEN c_custkey % 9 = 0 THEN c_custkey % 60 END AS held FROM customer), p AS (SELECT picked, count(DISTINCT grp) AS groups FROM b WHERE picked IS NOT NULL GROUP BY picked), t AS (SELECT DISTINCT held FROM b WHERE held IS NOT NULL)
SELECT line, b.picked, CASE WHEN t.held IS NOT NULL THEN 'taken' WHEN groups > 1 THEN 'contested' ELSE 'free' END AS state FROM b JOIN p ON p.picked = b.picked LEFT JOIN t ON t.held = b.picked""")
def picked_collisions(spark, sf_dir):
    """An id that another line holds, or that two groups picked, is refused."""
    b = rows(spark, sf_dir, "SELECT c_custkey AS line, c_nationkey AS grp, CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 50 END AS picked, CASE WHEN c_custkey % 9 = 0 THEN c_custkey % 60 END AS held FROM {customer}")
    groups = b.where("picked is not null").groupBy("picked").agg(F.count_distinct("grp").alias("groups"))
    held = b.where("held is not null").select(F.col("held").alias("picked"), F.lit(True).alias("taken")).distinct()
    state = F.when(F.col("taken"), "taken").when(F.col("groups") > 1, "contested").otherwise("free")
    return b.where("picked is not null").join(groups, "picked").join(held, "picked", "left").select("line", "picked", state.alias("state"))


@query("""WITH o AS (SELECT o_orderkey AS entity, o_custkey AS work, strftime(o_orderdate, '%Y-%m-%d') || o_orderpriority AS shared, o_custkey % 10 AS kind FROM orders), g AS (SELECT shared, kind, count(DISTINCT work) AS works, min(entity) AS head FROM o GROUP BY ALL)
SELECT entity, work, shared, head, works FROM o JOIN g USING (shared, kind) WHERE works > 1""")
def created_collisions(spark, sf_dir):
    """Created entities of different works with one id, a row a member under the group's first, for a report."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("entity"), F.col("o_custkey").alias("work"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority").alias("shared"), (F.col("o_custkey") % 10).alias("kind"))
    return ranking.collisions(o, ["shared", "kind"], "work", "entity").select("entity", "work", "shared", "head", "works")


@query("""WITH v AS (SELECT o_custkey AS old, o_orderkey % 400 AS sid, count(*) AS n FROM orders GROUP BY ALL), m AS (SELECT old, sid, n, rank() OVER (PARTITION BY old ORDER BY n DESC) AS r FROM v), b AS (SELECT old, CASE WHEN count(*) = 1 THEN min(sid) END AS best FROM m WHERE r = 1 GROUP BY old),
l AS (SELECT DISTINCT o_orderkey % 400 AS sid, CASE WHEN o_orderkey % 400 % 3 = 0 THEN 'en' ELSE 'fr' END AS lang, o_orderkey % 400 // 4 AS work FROM orders), s AS (SELECT work, lang, min(sid) AS sid FROM l GROUP BY ALL)
SELECT old, best, CASE WHEN best IS NULL THEN NULL WHEN l.lang = 'en' THEN best ELSE s.sid END AS target, CASE WHEN best IS NULL THEN 'unmatched' WHEN l.lang = 'en' THEN 'isbn' WHEN s.sid IS NOT NULL THEN 'rerouted' ELSE 'refused' END AS how FROM b LEFT JOIN l ON l.sid = best LEFT JOIN s ON s.work = l.work AND s.lang = 'en'""")
def vote_mapping(spark, sf_dir):
    """Old series to new ones by their most voted, if unique, re-routed to the sibling in the wanted language."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("old"), (F.col("o_orderkey") % 400).alias("sid"))
    v = o.groupBy("old", "sid").agg(F.count("*").alias("n"))
    top = v.groupBy("old").agg(F.max("n").alias("n"))
    best = v.join(top, ["old", "n"]).groupBy("old").agg(F.when(F.count("*") == 1, F.min("sid")).alias("best"))
    line = o.select("sid").distinct().select("sid", F.when(F.col("sid") % 3 == 0, "en").otherwise("fr").alias("lang"), F.expr("sid div 4").alias("work"))
    sibling = line.where("lang = 'en'").groupBy("work").agg(F.min("sid").alias("sibling"))
    out = best.join(line.withColumnRenamed("sid", "best"), "best", "left").join(sibling, "work", "left")
    how = F.when(F.col("best").isNull(), "unmatched").when(F.col("lang") == "en", "isbn").when(F.col("sibling").isNotNull(), "rerouted").otherwise("refused")
    return out.select("old", "best", F.when(F.col("best").isNull(), None).when(F.col("lang") == "en", F.col("best")).otherwise(F.col("sibling")).alias("target"), how.alias("how"))


_AUTH = "SELECT l_orderkey AS line, l_suppkey % 25 AS author, l_partkey % 50 AS work FROM {lineitem}"


@query(f"""WITH r AS ({plain(_AUTH)}), a AS (SELECT DISTINCT line, author FROM r), c AS (SELECT DISTINCT line, work FROM r), w AS (SELECT DISTINCT work, author FROM r WHERE work % 10 = author % 10), s AS (SELECT c.line, c.work, count(w.author) AS shared FROM c LEFT JOIN a ON a.line = c.line LEFT JOIN w ON w.work = c.work AND w.author = a.author GROUP BY ALL),
k AS (SELECT DISTINCT work FROM w) SELECT line, s.work, shared, shared > 0 AND shared = max(shared) OVER (PARTITION BY line) AS best, shared = 0 AND k.work IS NOT NULL AS disagree FROM s LEFT JOIN k ON k.work = s.work""")
def shared_authors(spark, sf_dir):
    """Works that share the most authors with a line, and those whose known authors disagree with it."""
    r = rows(spark, sf_dir, _AUTH)
    a, c = r.select("line", "author").distinct(), r.select("line", "work").distinct()
    w = r.where("work % 10 = author % 10").select("work", "author").distinct()
    met = c.join(a, "line").join(w, ["work", "author"]).groupBy("line", "work").agg(F.count("*").alias("shared"))
    s = c.join(met, ["line", "work"], "left").fillna(0, ["shared"]).join(w.select("work").distinct().withColumn("known", F.lit(True)), "work", "left")
    top = F.max("shared").over(Window.partitionBy("line"))
    return s.select("line", "work", "shared", ((F.col("shared") > 0) & (F.col("shared") == top)).alias("best"), ((F.col("shared") == 0) & F.coalesce("known", F.lit(False))).alias("disagree"))


@query("""WITH l AS (SELECT p_partkey AS id, p_brand AS work, p_type AS market, p_name AS name, p_size AS n, CASE WHEN p_partkey % 20 = 0 THEN p_partkey - 1 END AS pin FROM part), j AS (SELECT work, name, min(id) AS same FROM l WHERE market = 'ECONOMY' GROUP BY ALL), m AS (SELECT work, arg_max(id, n * 100000 - id) AS main FROM l WHERE market = 'ECONOMY' GROUP BY work), f AS (SELECT work, min(id) AS fam FROM l WHERE market IN ('SMALL', 'MEDIUM') GROUP BY work)
SELECT id, coalesce(pin, same, main, fam) AS origin, CASE WHEN pin IS NOT NULL THEN 'pin' WHEN same IS NOT NULL THEN 'name' WHEN main IS NOT NULL THEN 'main' WHEN fam IS NOT NULL THEN 'family' END AS via FROM l LEFT JOIN j USING (work, name) LEFT JOIN m USING (work) LEFT JOIN f USING (work) WHERE market <> 'ECONOMY'""")
def origin_counterpart(spark, sf_dir):
    """A line's origin: the pinned one, the same name's, the market's main line, one of its family."""
    l = rows(spark, sf_dir, "SELECT p_partkey AS id, p_brand AS work, p_type AS market, p_name AS name, p_size AS n, CASE WHEN p_partkey % 20 = 0 THEN p_partkey - 1 END AS pin FROM {part}")  # noqa: E741
    home = l.where("market = 'ECONOMY'")
    same = home.groupBy("work", "name").agg(F.min("id").alias("same"))
    main = home.groupBy("work").agg(F.min_by("id", F.struct(-F.col("n"), F.col("id"))).alias("main"))
    fam = l.where("market in ('SMALL', 'MEDIUM')").groupBy("work").agg(F.min("id").alias("fam"))
    out = l.where("market <> 'ECONOMY'").join(same, ["work", "name"], "left").join(main, "work", "left").join(fam, "work", "left")
    via = F.when(F.col("pin").isNotNull(), "pin").when(F.col("same").isNotNull(), "name").when(F.col("main").isNotNull(), "main").when(F.col("fam").isNotNull(), "family")
    return out.select("id", F.coalesce("pin", "same", "main", "fam").alias("origin"), via.alias("via"))


@query("""WITH n AS (SELECT c_custkey AS id, c_acctbal < 0 AS novel, CASE WHEN c_custkey % 3 = 0 THEN 2000 + c_custkey % 20 END AS y, CASE WHEN c_custkey % 4 > 0 THEN 2003 + c_nationkey END AS began, c_custkey % 30 AS v, c_nationkey AS n, c_custkey % 5 = 0 AS rel FROM customer)
SELECT id, coalesce(abs(y - began) <= 3, true) AS year_ok, NOT (v > 0 AND n > 0 AND (n - v > greatest(3.0, 0.4 * n) * CASE WHEN rel THEN 2 ELSE 1 END OR (n > 2 AND v > 4 * n))) AS volumes_ok FROM n""")
def plausibility(spark, sf_dir):
    """Years within three, volumes within tolerance and ceiling."""
    n = rows(spark, sf_dir, "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 2000 + c_custkey % 20 END AS y, CASE WHEN c_custkey % 4 > 0 THEN 2003 + c_nationkey END AS began, c_custkey % 30 AS v, c_nationkey AS n, c_custkey % 5 = 0 AS rel FROM {customer}")
    return n.select("id", ranking.year_fits(F.col("y"), F.col("began")).alias("year_ok"), ranking.volumes_fit(F.col("v"), F.col("n"), F.col("rel"), F.col("n") > 2).alias("volumes_ok"))
