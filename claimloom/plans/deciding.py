"""The decision plan over lines and works derived from the driver's tables, with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.operators import decisions
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows

_LINES = """SELECT 'k' || lpad(p_partkey::STRING, 9, '0') AS key, 's' || (p_partkey % 3) AS source, CASE WHEN p_partkey % 2 = 0 THEN 'EN' ELSE 'DE' END AS market,
  CASE p_partkey % 4 WHEN 0 THEN p_name || ' ' || p_type || ' ' || p_size % 10 WHEN 1 THEN p_name || ' ' || p_type || ' ' || p_size % 10 || ' ' || p_brand WHEN 2 THEN p_type || ' ' || p_brand || ' ' || p_name ELSE p_brand || ' ' || p_name || ' ' || p_partkey END AS title,
  CASE WHEN p_partkey % 5 = 0 THEN p_name || ' ' || p_brand END AS orig, p_brand AS author, CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_size % 7 = 0 THEN 'novel' ELSE 'comic' END AS medium,
  p_size % 6 > 0 AS explicit, p_size % 9 > 0 AS comic, p_size % 3 > 0 AS opens, CASE WHEN p_partkey % 23 = 0 OR p_partkey % 4 = 0 THEN 'w' || (p_partkey - p_partkey % 10 + 7) END AS published FROM {part} WHERE p_partkey % 10 <> 7"""
_WORKS = """SELECT 'w' || p_partkey AS work, p_name || ' ' || p_type || ' ' || p_size % 10 AS title, p_type || ' ' || p_brand || ' ' || p_name AS alias, p_brand AS author, p_size % 2 = 0 AS native, p_size % 5 = 0 AS guarded, p_size % 2 = 0 AS library FROM {part} WHERE p_partkey % 10 = 7"""
_REVIEWS = """SELECT 'k' || lpad(p_partkey::STRING, 9, '0') AS key, 'size' AS why FROM {part} WHERE p_size = 50"""


def _fold(x: str) -> str:
    return f"replace({_words(x)}, ' ', '')"


def _words(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


_COMMON = f"""
lines AS MATERIALIZED ({plain(_LINES)}), works AS MATERIALIZED ({plain(_WORKS)}), told AS ({plain(_REVIEWS)}),
known AS (SELECT work, {_fold('title')} AS k, TRUE AS official FROM works UNION ALL SELECT work, {_fold('alias')}, FALSE FROM works),
said AS MATERIALIZED (SELECT key, source, author, {_fold('title')} AS k, {_words('title')} AS w, FALSE AS o FROM lines UNION ALL SELECT key, source, author, {_fold('orig')}, {_words('orig')}, TRUE FROM lines WHERE orig IS NOT NULL),
voted AS (SELECT key, work, bool_or(official) AS official FROM said JOIN known USING (k) GROUP BY ALL),
best AS (SELECT key, list(work ORDER BY work) AS c, any_value(official) AS official FROM (SELECT *, max(official) OVER (PARTITION BY key) AS top FROM voted) WHERE official = top GROUP BY key),
single AS (SELECT key, CASE WHEN len(c) > 1 THEN 'ambiguous' WHEN NOT official THEN 'low' ELSE 'linked' END AS tier, c[1] AS w FROM best),
placed AS MATERIALIZED (SELECT l.*, CASE WHEN tier = 'linked' THEN w END AS target, nullif(concat_ws('+', CASE WHEN tier = 'linked' AND guarded THEN 'guarded' WHEN tier IN ('low', 'ambiguous') THEN tier END, CASE WHEN l.medium IS NULL THEN 'no-class-signal' END), '') AS why
  FROM lines l LEFT JOIN single USING (key) LEFT JOIN works ON work = w),
pool AS MATERIALIZED (SELECT * FROM placed WHERE why IS NULL AND target IS NULL),
keyed AS MATERIALIZED (SELECT DISTINCT s.key, CASE WHEN o THEN 'o' || s.source ELSE 't' END AS kind, k FROM said s WHERE length(k) >= 5),
near AS MATERIALIZED (SELECT DISTINCT a.key AS a, b.key AS b FROM keyed a JOIN keyed b USING (kind, k) WHERE a.key IN (SELECT key FROM pool) AND b.key IN (SELECT key FROM pool)),
reach AS (SELECT key AS a, key AS b FROM pool UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b),
member AS MATERIALIZED (SELECT p.*, m.c, library AS shelf FROM pool p JOIN (SELECT a AS key, min(b) AS c FROM reach GROUP BY a) m USING (key) LEFT JOIN works ON work = published),
spelled AS MATERIALIZED (SELECT DISTINCT m.c, s.k, s.w, s.o FROM said s JOIN member m USING (key)),
c_voted AS (SELECT c, work, bool_or(official) AS official FROM spelled JOIN known USING (k) WHERE c IN (SELECT c FROM member GROUP BY c HAVING count(*) > 1) GROUP BY ALL),
c_best AS (SELECT c, list(work ORDER BY work) AS l, any_value(official) AS official FROM (SELECT *, max(official) OVER (PARTITION BY c) AS top FROM c_voted) WHERE official = top GROUP BY c),
c_link AS (SELECT c, CASE WHEN len(l) > 1 THEN 'ambiguous' WHEN NOT official THEN 'low' ELSE 'linked' END AS tier, l[1] AS w, len(l) = 1 AND guarded AS guarded FROM c_best LEFT JOIN works ON work = l[1]),
held_keys AS (SELECT DISTINCT kind, k FROM keyed JOIN placed USING (key) WHERE why IS NULL AND target IS NOT NULL),
sibling AS (SELECT DISTINCT c FROM keyed JOIN member USING (key) JOIN held_keys USING (kind, k)),
hit AS MATERIALIZED (SELECT DISTINCT c FROM spelled s JOIN (SELECT {_fold('title')} AS wk, native FROM works) ON (NOT o AND native AND (contains(s.k, wk) OR contains(wk, s.k))) OR (o AND s.k = wk)),
told_c AS (SELECT c, min_by(told.why, key) AS told FROM member JOIN told USING (key) GROUP BY c),
groups AS (SELECT c, bool_or(published IS NOT NULL) AS carried, bool_or(explicit) AS explicit, bool_or(comic) AS comic, min(CASE WHEN shelf THEN published END) AS frozen, bool_or(published IS NOT NULL AND NOT coalesce(shelf, TRUE)) AS elsewhere,
  coalesce(min(CASE WHEN medium = 'comic' AND market = 'EN' THEN key END), min(CASE WHEN medium = 'comic' THEN key END)) AS anchor FROM member GROUP BY c),
outcome AS MATERIALIZED (SELECT g.*, l.w AS c_work, CASE WHEN told IS NOT NULL AND NOT carried THEN 'review|correction: ' || told WHEN tier = 'linked' AND NOT guarded THEN 'linked|' WHEN tier IS NOT NULL THEN 'review|cluster-' || CASE WHEN guarded THEN 'guarded' ELSE tier END
  WHEN frozen IS NOT NULL THEN 'new_work|frozen' WHEN c IN (FROM sibling) THEN 'review|linked-sibling-key' WHEN c IN (FROM hit) THEN 'review|containment' WHEN NOT explicit THEN 'unlinked|no-explicit-origin' WHEN NOT comic THEN 'unlinked|no-comic'
  WHEN elsewhere THEN 'review|carried-elsewhere' WHEN anchor IS NULL THEN 'held|novel-without-comic' ELSE 'new_work|' END AS o FROM groups g LEFT JOIN c_link l USING (c) LEFT JOIN told_c USING (c)),
late AS (SELECT * FROM outcome WHERE o IN ('new_work|', 'unlinked|no-explicit-origin', 'unlinked|no-comic', 'review|carried-elsewhere', 'held|novel-without-comic')),
maker AS MATERIALIZED (SELECT c, o = 'new_work|frozen' AS fixed, row_number() OVER (ORDER BY c) AS i FROM outcome WHERE starts_with(o, 'new_work|')),
edges AS MATERIALIZED (SELECT DISTINCT a.c AS early, b.c AS late FROM spelled a JOIN maker ON maker.c = a.c JOIN spelled b ON a.c < b.c AND length(a.k) >= 5 AND length(b.k) >= 5 JOIN late ON late.c = b.c
  WHERE NOT b.o AND (a.k = b.k OR least(length(a.k), length(b.k)) >= 7 AND (contains(' ' || a.w || ' ', ' ' || b.w || ' ') OR contains(' ' || b.w || ' ', ' ' || a.w || ' '))) OR a.o AND b.o AND a.k = b.k),
rivals AS (SELECT maker.i, any_value(fixed) AS fixed, list(e.i) FILTER (e.i IS NOT NULL) AS before FROM maker LEFT JOIN (SELECT early, late, m.i FROM edges JOIN maker m ON m.c = early) e ON e.late = maker.c GROUP BY maker.i),
walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS taken UNION ALL SELECT r.i, CASE WHEN r.fixed OR NOT list_has_any(coalesce(r.before, []), taken) THEN list_append(taken, r.i) ELSE taken END FROM walk JOIN rivals r ON r.i = walk.i + 1),
made AS (SELECT c FROM maker WHERE list_contains((SELECT taken FROM walk ORDER BY i DESC LIMIT 1), i)),
final AS (SELECT c, CASE WHEN c IN (SELECT late FROM edges WHERE early IN (FROM made)) THEN 'review|containment' ELSE o END AS o, CASE o WHEN 'linked|' THEN c_work WHEN 'new_work|frozen' THEN frozen WHEN 'new_work|' THEN 'w:' || anchor END AS dest FROM outcome),
first AS (SELECT p.key, p.market, p.medium, p.opens, p.published, m.c AS cluster, CASE WHEN p.why IS NOT NULL THEN 'review' WHEN p.target IS NOT NULL THEN 'linked' ELSE split_part(f.o, '|', 1) END AS role,
  CASE WHEN p.why IS NULL THEN coalesce(p.target, f.dest) END AS work, coalesce(p.why, nullif(split_part(f.o, '|', 2), '')) AS reason, coalesce(p.medium = 'novel', FALSE) AS novel
  FROM placed p LEFT JOIN member m USING (key) LEFT JOIN final f ON f.c = m.c),
second AS (SELECT f.* REPLACE (CASE WHEN frag THEN 'review' ELSE role END AS role, CASE WHEN NOT frag THEN work END AS work, CASE WHEN frag THEN concat_ws('+', reason, 'fragment') ELSE reason END AS reason) FROM (SELECT *,
  published IS NULL AND role = 'linked' AND NOT opens AND (work, market, novel) IN (SELECT (published, market, novel) FROM first WHERE published IS NOT NULL) AS frag FROM first) f),
third AS (SELECT s.* REPLACE (CASE WHEN k THEN 'kept' ELSE role END AS role, CASE WHEN k THEN published ELSE work END AS work, CASE WHEN k THEN coalesce(reason, '') || ';kept' ELSE reason END AS reason) FROM (SELECT *,
  coalesce(role IN ('review', 'unlinked', 'held') AND published IN (SELECT work FROM works UNION SELECT work FROM second WHERE role = 'new_work'), FALSE) AS k FROM second) s),
drawn AS (SELECT work FROM third WHERE work IS NOT NULL AND role IN ('linked', 'new_work', 'kept') AND (role = 'new_work' OR medium IS NOT NULL AND NOT novel)),
done AS (SELECT key, cluster, CASE WHEN h THEN 'held' ELSE role END AS role, CASE WHEN h OR role NOT IN ('linked', 'new_work', 'kept') THEN NULL ELSE work END AS work, CASE WHEN h THEN 'novel-without-comic' ELSE reason END AS reason
  FROM (SELECT *, novel AND role = 'linked' AND published IS NULL AND work NOT IN (FROM drawn) AS h FROM third))"""


def _inputs(spark, sf_dir):
    one = lambda c: F.array_compact(F.array(c))
    none, absent = F.array().cast("array<string>"), F.lit(None).cast("string")
    lines = rows(spark, sf_dir, _LINES).select(
        "key", "source", "market", F.col("title").alias("name"), one("title").alias("titles"), none.alias("native"), one("orig").alias("orig"), one("author").alias("authors"), "medium",
        absent.alias("medium_why"), absent.alias("medium_guess"), "explicit", "comic", absent.alias("role"), absent.alias("work"), "published", "opens",
    )
    works = rows(spark, sf_dir, _WORKS).select("work", one("title").alias("titles"), one("alias").alias("aliases"), one("author").alias("authors"), "native", "guarded", "library")
    return lines, works


def _decided(spark, sf_dir):
    lines, works = _inputs(spark, sf_dir)
    links = spark.createDataFrame([], "key string, work string, override boolean")
    joins = spark.createDataFrame([], "a string, b string")
    return decisions.decide(lines, works, links, rows(spark, sf_dir, _REVIEWS), joins)


@query(f"WITH RECURSIVE {_COMMON} SELECT key, cluster, role, work, reason FROM done")
def decision_plan(spark, sf_dir):
    """Which work each pooled line goes to, or why to none; works that earlier clusters made count against later ones."""
    return _decided(spark, sf_dir).drop("medium")


@query(f"""WITH RECURSIVE {_COMMON}, moved AS (SELECT d.work, min(l.published) AS public FROM done d JOIN lines l USING (key) JOIN works w ON w.work = l.published AND library WHERE d.work IS NOT NULL AND role <> 'new_work' AND l.published <> d.work GROUP BY d.work)
SELECT work, public, count(*) OVER (PARTITION BY public) > 1 OR public IN (SELECT work FROM done WHERE role = 'new_work') AS conflict FROM moved""")
def adopted_works(spark, sf_dir):
    """Works that take the id under which a library's build published their lines."""
    lines, works = _inputs(spark, sf_dir)
    return decisions.adoptions(_decided(spark, sf_dir), lines, works)


_PLACED = """SELECT c_custkey AS line, CASE c_custkey % 9 WHEN 0 THEN 'merged' WHEN 1 THEN 'sibling' END AS role, CASE WHEN c_custkey % 9 < 2 THEN c_nationkey END AS target, CASE c_custkey % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' WHEN 3 THEN 'ambiguous' ELSE 'none' END AS tier,
  CASE WHEN c_custkey % 5 < 3 THEN c_custkey % 30 END AS link_work, 'official' AS via, c_custkey % 6 = 0 AS differ, CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 30 WHEN c_custkey % 4 = 1 THEN c_nationkey + 5 END AS published FROM {customer}"""
_SCOPES = "SELECT n_nationkey AS work, n_regionkey = 2 AS out_of_scope FROM {nation}"
_LINKED = "SELECT c_custkey AS line, c_nationkey + CASE WHEN c_custkey % 26 = 0 THEN 100 ELSE 0 END AS work FROM {customer} WHERE c_custkey % 13 = 0"


@query(f"""WITH l AS ({plain(_PLACED)}), w AS ({plain(_SCOPES)}), h AS (SELECT line, work AS by_hand FROM ({plain(_LINKED)}) WHERE work IN (SELECT work FROM w)),
a AS (SELECT l.*, by_hand, CASE WHEN role IS NOT NULL THEN role WHEN by_hand IS NOT NULL OR tier IN ('high', 'medium') THEN 'linked' WHEN tier IN ('low', 'ambiguous') THEN 'review' ELSE 'unlinked' END AS state FROM l LEFT JOIN h USING (line)),
b AS (SELECT *, CASE WHEN role IS NOT NULL THEN target WHEN state = 'linked' THEN coalesce(by_hand, link_work) END AS dest FROM a), c AS (SELECT b.*, role IS NULL AND state = 'linked' AND coalesce(w.out_of_scope, FALSE) AS gone FROM b LEFT JOIN w ON w.work = dest),
d AS (SELECT *, role IS NULL AND state IN ('review', 'unlinked') AND published IN (SELECT work FROM w) AND NOT coalesce(differ AND link_work = published, FALSE) AS keep FROM c)
SELECT line, CASE WHEN gone THEN 'out_of_scope' WHEN coalesce(keep, FALSE) THEN 'kept' ELSE state END AS role, CASE WHEN gone THEN NULL WHEN coalesce(keep, FALSE) THEN published ELSE dest END AS work, CASE WHEN role IS NULL AND by_hand IS NOT NULL THEN 'correction' ELSE via END AS via FROM d""")
def line_roles(spark, sf_dir):
    """The roles of a library's lines after linking: attached, linked, in review, out of scope, kept under their published work."""
    return decisions.line_roles(rows(spark, sf_dir, _PLACED), rows(spark, sf_dir, _SCOPES), rows(spark, sf_dir, _LINKED))
