"""The gates of single markets over lines, volumes and claims derived from the driver's tables, with SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators import market_gates as gates
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows

TODAY = "2000-06-15"
_D = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_LINES = """SELECT c_custkey AS line, 'k' || c_custkey AS key, CASE c_nationkey % 3 WHEN 0 THEN 'DE' WHEN 1 THEN 'JP' ELSE 'FR' END AS market, CASE WHEN c_custkey % 5 = 0 THEN 'novel' WHEN c_nationkey % 4 = 0 THEN 'manhwa' ELSE 'comic' END AS medium, c_custkey % 400 AS work, c_name AS name,
  CASE c_custkey % 7 WHEN 0 THEN 'merged' WHEN 1 THEN 'sibling' WHEN 2 THEN 'held' WHEN 3 THEN 'review' WHEN 4 THEN 'kept' ELSE 'linked' END AS role, CASE c_nationkey % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'none' END AS tier, CASE WHEN c_custkey % 17 = 0 THEN 'correction' ELSE 'official' END AS via,
  c_custkey % 7 < 2 OR c_custkey % 7 > 3 AS exported, c_custkey % 2 = 0 AS is_main, c_custkey % 400 AS link_work, CASE WHEN c_nationkey % 2 = 0 THEN c_custkey % 399 END AS truth_work, c_custkey % 11 = 0 AS explicit, c_custkey % 150 AS cluster, c_custkey % 9 = 0 AS carried FROM {customer}"""
_VOLUMES = f"""SELECT o_orderkey AS volume, o_custkey AS line, CASE WHEN o_orderkey % 7 > 0 THEN 'i' || (o_orderkey % 900) END AS isbn, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN substr({_D}, 1, 7) WHEN 2 THEN substr({_D}, 1, 4) ELSE {_D} END AS date, CASE WHEN o_orderkey % 45 = 0 OR o_orderkey % 5 > 0 AND o_orderkey % 31 > 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'projected' ELSE 'published' END END AS date_type, o_orderkey % 97 = 0 AS future FROM {{orders}}"""
_CLAIMS = f"""SELECT o_orderkey AS entity_id, CASE o_orderkey % 6 WHEN 0 THEN 'release_date' WHEN 1 THEN 'projected_date' WHEN 2 THEN 'isbn13' WHEN 3 THEN 'page_count' WHEN 4 THEN 'title' ELSE CASE WHEN o_orderkey % 4 = 1 THEN 'cover' ELSE 'publisher' END END AS field,
  CASE o_orderkey % 6 WHEN 0 THEN substr({_D}, 1, CASE WHEN o_orderkey % 4 = 0 THEN 7 ELSE 4 END) WHEN 1 THEN substr({_D}, 1, CASE WHEN o_orderkey % 5 = 0 THEN 4 ELSE 7 END) WHEN 2 THEN 'i' || (o_orderkey % 900) ELSE '1' END AS value, CASE o_custkey % 3 WHEN 0 THEN 'dnb' WHEN 1 THEN 'loc' ELSE 'wiki' END AS source,
  CASE WHEN o_orderkey % 50 = 3 THEN 'by' WHEN o_orderkey % 77 = 1 THEN NULL ELSE 'cc0' END AS licence, CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN 'http://elsewhere/' || o_orderkey ELSE 'https://records/' || (o_orderkey % 700) END AS source_url FROM {{orders}}"""
_RECORDS = "SELECT DISTINCT 'https://records/' || (o_orderkey % 700) AS source_url, o_orderkey % 700 % 10 > 0 AS authority, o_orderkey % 700 % 7 = 0 AS set_record, CASE o_orderkey % 700 % 4 WHEN 0 THEN '5' WHEN 1 THEN '8' ELSE '' END AS level FROM {orders}"
_BEFORE = "SELECT c_custkey + CASE WHEN c_custkey % 40 = 5 THEN 1000000 ELSE 0 END AS line, c_custkey % 2 = 0 AND c_custkey % 33 > 0 AS is_main, 'i' || (c_custkey % 1000) AS isbn FROM {customer} WHERE c_custkey % 7 < 2"
_LABELS = "SELECT 'k' || c_custkey AS key, c_custkey % 400 + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS expected_work FROM {customer}"
_MUST_NOT = "SELECT 'k' || c_custkey AS key, c_custkey % 397 AS wrong_work FROM {customer}"
_CREATED = "SELECT DISTINCT c_custkey % 400 AS work FROM {customer} WHERE c_nationkey % 6 = 0"
_WORKS_BEFORE = "SELECT DISTINCT c_custkey % 350 AS work FROM {customer}"
_REDIRECTS = "SELECT c_custkey AS old FROM {customer} WHERE c_mktsegment = 'BUILDING'"

_TABLES = f"""lines AS ({plain(_LINES)}), volumes AS ({plain(_VOLUMES)}), claims AS ({plain(_CLAIMS)}), records AS ({plain(_RECORDS)}), before AS ({plain(_BEFORE)}), labels AS ({plain(_LABELS)}), must_not AS ({plain(_MUST_NOT)}), created AS ({plain(_CREATED)}), works_before AS ({plain(_WORKS_BEFORE)}), redirects AS ({plain(_REDIRECTS)})"""


@query(f"""WITH {_TABLES}, c AS (SELECT *, coalesce(value, '') AS v FROM claims WHERE source = 'dnb'), told AS (SELECT DISTINCT entity_id AS volume, value AS isbn FROM claims WHERE field = 'isbn13' AND source = 'wiki'),
now AS (SELECT line, is_main AS main_now FROM lines WHERE exported), lost AS (SELECT b.line FROM before b JOIN now USING (line) WHERE NOT EXISTS (SELECT 1 FROM volumes v WHERE v.line = b.line AND v.isbn = b.isbn)),
j AS (SELECT count(*) AS n, count_if(link_work = expected_work) AS good FROM lines JOIN labels USING (key) WHERE tier IN ('high', 'medium'))
SELECT rule, n::BIGINT AS n FROM (SELECT 'claim not licensed' AS rule, count_if(licence IS DISTINCT FROM 'cc0') AS n FROM c UNION ALL SELECT 'claim without a record', count_if(NOT starts_with(coalesce(source_url, ''), 'https://records/')) FROM c
UNION ALL SELECT 'claim of another field', count_if(field = 'cover') FROM c UNION ALL SELECT 'published date not a year', count_if(field = 'release_date' AND NOT regexp_full_match(v, '[12][0-9]{{3}}')) FROM c UNION ALL SELECT 'projected date not a month', count_if(field = 'projected_date' AND NOT regexp_full_match(v, '[12][0-9]{{3}}-[01][0-9]')) FROM c
UNION ALL SELECT 'projected long ago', count_if(date_type = 'projected' AND date < '1999-06') FROM volumes UNION ALL SELECT 'projected not to the month', count_if(date_type = 'projected' AND NOT regexp_full_match(coalesce(date, ''), '[12][0-9]{{3}}-[01][0-9]')) FROM volumes
UNION ALL SELECT 'type without a date, or a date without', count_if((date_type IS NULL) <> (date IS NULL)) FROM volumes UNION ALL SELECT 'volume of a later year''s announcement', count_if(future) FROM volumes
UNION ALL SELECT 'projected although published', count(*) FROM volumes WHERE date_type = 'projected' AND volume IN (SELECT entity_id FROM claims WHERE field = 'release_date')
UNION ALL SELECT 'isbn twice in a line', count(*) FROM (SELECT v.line, v.isbn FROM volumes v JOIN lines l ON l.line = v.line AND market = 'DE' LEFT JOIN told t ON t.volume = v.volume AND t.isbn = v.isbn WHERE v.isbn IS NOT NULL GROUP BY ALL HAVING count(*) > 1 AND count_if(t.volume IS NULL) > 0)
UNION ALL SELECT 'shipped against the policy', count_if(exported AND NOT (role IN ('merged', 'sibling', 'kept') OR role = 'linked' AND (tier IN ('high', 'medium') OR via = 'correction'))) FROM lines UNION ALL SELECT 'linked against the truth', count_if(tier IN ('high', 'medium') AND link_work <> truth_work) FROM lines
UNION ALL SELECT 'published line demoted', count_if(carried AND NOT exported AND role IN ('held', 'review', 'unlinked')) FROM lines UNION ALL SELECT 'name not composed', count_if(name <> nfc_normalize(name)) FROM lines
UNION ALL SELECT 'published line gone', count(*) FROM before WHERE line NOT IN (SELECT line FROM now) UNION ALL SELECT 'published line lost its place or an isbn', count(DISTINCT line) FROM (SELECT line FROM before JOIN now USING (line) WHERE is_main <> main_now UNION FROM lost)
UNION ALL SELECT 'linked to a work known as wrong', count(DISTINCT key) FROM lines JOIN must_not USING (key) WHERE (tier IN ('high', 'medium') OR exported) AND (link_work = wrong_work OR work = wrong_work) UNION ALL SELECT 'precision', CASE WHEN n > 0 AND good < 0.95 * n THEN 1 ELSE 0 END FROM j)""")
def market_rules(spark, sf_dir):
    """The gate of a market whose lines a library's records fill: claims, dates, ISBNs, what ships, what was published, the linker's labels."""
    t = {n: rows(spark, sf_dir, sql) for n, sql in (("lines", _LINES), ("volumes", _VOLUMES), ("claims", _CLAIMS), ("before", _BEFORE), ("labels", _LABELS), ("must_not", _MUST_NOT))}
    before = t["before"].select("line", "is_main", F.array("isbn").alias("isbns"))
    return reduce(DataFrame.unionAll, [
        gates.claim_rules(t["claims"], "dnb", "cc0", "https://records/"), gates.volume_rules(t["volumes"], t["claims"], t["lines"], "DE", "wiki", TODAY),
        gates.line_rules(t["lines"], t["volumes"], before, t["must_not"], t["labels"]),
    ])


@query(f"""WITH {_TABLES}, c AS (SELECT c.*, r.authority, r.set_record, r.level FROM claims c LEFT JOIN records r USING (source_url) WHERE source = 'loc'), shown AS (SELECT * FROM lines WHERE exported), drawn AS (SELECT work FROM shown WHERE medium IN ('comic', 'manhwa'))
SELECT rule, n::BIGINT AS n FROM (SELECT 'claim of no record of its own' AS rule, count_if(NOT coalesce(authority, FALSE)) AS n FROM c UNION ALL SELECT 'date of a set', count_if(field IN ('release_date', 'projected_date') AND set_record) FROM c UNION ALL SELECT 'published date of a planned record', count_if(field = 'release_date' AND level IN ('5', '8')) FROM c
UNION ALL SELECT 'made without explicit origin', count(*) FROM created WHERE work NOT IN (SELECT work FROM shown WHERE explicit OR cluster IN (SELECT cluster FROM lines WHERE explicit)) UNION ALL SELECT 'made without a comic', count(*) FROM created WHERE work NOT IN (FROM drawn)
UNION ALL SELECT 'made beside a line of the home market', count(*) FROM created WHERE work IN (SELECT work FROM shown WHERE market = 'JP' AND medium <> 'manhwa') UNION ALL SELECT 'published line gone', count(*) FROM before WHERE line NOT IN (SELECT line FROM shown) AND line NOT IN (FROM redirects)
UNION ALL SELECT 'novel in a work without a comic', count(*) FROM shown WHERE medium = 'novel' AND work NOT IN (FROM drawn) UNION ALL SELECT 'flood', CASE WHEN count(*) > 25 THEN 1 ELSE 0 END FROM (FROM created EXCEPT FROM works_before))""")
def created_work_rules(spark, sf_dir):
    """The gate of works that a build makes from library records: their records, origin, comics, home market, what was published, no flood."""
    t = {n: rows(spark, sf_dir, sql) for n, sql in (("lines", _LINES), ("claims", _CLAIMS), ("records", _RECORDS), ("created", _CREATED), ("works", _WORKS_BEFORE), ("before", _BEFORE), ("redirects", _REDIRECTS))}
    return gates.record_rules(t["claims"], t["records"], "loc").unionAll(gates.created_rules(t["created"], t["lines"], "JP", t["works"], t["before"].select("line"), t["redirects"]))


@query(f"""WITH {_TABLES}, b AS (SELECT volume, 'i' || ((volume + CASE WHEN volume % 12 = 0 THEN 1 ELSE 0 END) % 900) AS isbn FROM volumes WHERE isbn IS NOT NULL), o AS (SELECT isbn, min(volume) AS now FROM volumes WHERE isbn IS NOT NULL GROUP BY isbn)
SELECT b.volume, b.isbn, now FROM b JOIN volumes v USING (volume) JOIN o ON o.isbn = b.isbn WHERE v.isbn IS DISTINCT FROM b.isbn""")
def moved_isbns(spark, sf_dir):
    """Published volumes whose ISBN now sits on another."""
    v = rows(spark, sf_dir, _VOLUMES)
    was = v.where("isbn is not null").select("volume", F.concat(F.lit("i"), ((F.col("volume") + F.when(F.col("volume") % 12 == 0, 1).otherwise(0)) % 900).cast("string")).alias("isbn"))
    return gates.moved_isbns(was, v)


_TAKES = "SELECT 'k' || s_suppkey AS key, s_suppkey % 60 AS id, s_suppkey % 4 AS shared, s_suppkey % 7 AS mine, s_suppkey % 5 AS theirs FROM {supplier}"


@query(f"""WITH t AS ({plain(_TAKES)}) SELECT 'taken_weak' AS list, key || ':' || id AS item FROM t WHERE 2 * shared <= least(mine, theirs) AND least(mine, theirs) > 0 AND id % 9 > 0 UNION ALL SELECT 'corrections_skipped', 'review:k' || n_nationkey FROM nation WHERE n_regionkey = 2""")
def gate_lists(spark, sf_dir):
    """What a reviewer must see before a build ships."""
    takes = rows(spark, sf_dir, _TAKES)
    skipped = rows(spark, sf_dir, "SELECT 'k' || n_nationkey AS key, 'review' AS shape FROM {nation} WHERE n_regionkey = 2")
    return gates.gate_lists(takes, takes.where("id % 9 = 0").select("key", "id"), skipped)
