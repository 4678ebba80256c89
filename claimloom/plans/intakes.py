"""What a build takes in and gives out, over rows derived from the driver's tables, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.operators import intake
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows
from claimloom.session import cut

_EDITIONS = "SELECT o_custkey AS work, o_orderkey % 3 AS edition, o_orderkey AS pos, o_orderkey % 7 AS number, CASE o_orderstatus WHEN 'F' THEN 'DE' WHEN 'O' THEN 'FR' ELSE 'EN' END AS market FROM {orders}"


@query(f"WITH e AS ({plain(_EDITIONS)}) SELECT work, edition, pos, number, market FROM e QUALIFY row_number() OVER (PARTITION BY work, number, market ORDER BY edition, pos) = 1")
def market_dedup(spark, sf_dir):
    """A second edition's (volume, market) goes; what only it has stays."""
    return intake.first_edition_only(rows(spark, sf_dir, _EDITIONS))[0]


_SCAN = "SELECT p_partkey AS key, p_brand AS brand, p_size AS size FROM {part} WHERE p_size % 9 > 0"
_EXPECTED = "SELECT p_partkey AS key, CASE WHEN p_partkey % 10 = 0 THEN 'other' ELSE p_brand END AS brand, p_size AS size FROM {part}"


@query(f"WITH s AS ({plain(_SCAN)}), e AS ({plain(_EXPECTED)}) SELECT e.key, CASE WHEN s.key IS NULL THEN 'absent' WHEN s.brand = e.brand AND s.size = e.size THEN 'present' ELSE 'changed' END AS state FROM e LEFT JOIN s USING (key)")
def canary(spark, sf_dir):
    """Rows that must be in a scan as they are known before it is trusted."""
    return intake.canary(rows(spark, sf_dir, _SCAN), rows(spark, sf_dir, _EXPECTED), "key")


_CHANNELS = "SELECT l_partkey AS key FROM {lineitem} WHERE l_linenumber = 2"
_ANSWERS = "SELECT s_suppkey AS key, CASE WHEN s_nationkey % 3 > 0 THEN s_name END AS record FROM {supplier}"


@query(f"""WITH lost AS (SELECT p_partkey AS key FROM part WHERE p_partkey NOT IN ({plain(_CHANNELS)})), r AS (SELECT key, row_number() OVER (ORDER BY key)::INTEGER AS place FROM lost), a AS ({plain(_ANSWERS)})
SELECT key, CASE WHEN place <= 25 THEN place END AS place, CASE WHEN place > 25 THEN 'not asked' WHEN key IN (SELECT key FROM a WHERE record IS NOT NULL) THEN 'found' ELSE 'lost' END AS state FROM r""")
def followed_up(spark, sf_dir):
    """Carried keys that no channel brought, asked one by one, at most twenty-five (the follow-up's own cap); the answers decide."""
    carried = rows(spark, sf_dir, "SELECT p_partkey AS key FROM {part}")
    return intake.follow_up(carried, rows(spark, sf_dir, _CHANNELS), rows(spark, sf_dir, _ANSWERS), "key", 25)


_LIBRARY = "SELECT c_custkey AS id, c_name AS name, 'f' || (c_custkey % 90) AS folder, CASE WHEN c_acctbal < 0 THEN 'ended' ELSE 'continuing' END AS status, c_nationkey % 4 = 0 AS novel FROM {customer}"
_OWNED = "SELECT o_custkey AS id, CAST(o_orderkey % 15 AS DOUBLE) AS number FROM {orders}"


@query(f"""WITH l AS ({plain(_LIBRARY)}), o AS ({plain(_OWNED)}) SELECT name, folder, status, novel, list_aggregate(list_transform(coalesce((SELECT list(DISTINCT number ORDER BY number) FROM o WHERE o.id = l.id), []), lambda x: x::INTEGER::VARCHAR), 'string_agg', ' ') AS volumes, TRUE AS same FROM l""")
def library_either_way(spark, sf_dir):
    """A library out of its JSON snapshot, and whether each entry is the one its database gives."""
    owned = rows(spark, sf_dir, _OWNED).groupBy("id").agg(F.collect_list("number").alias("volumes"))
    library = cut(rows(spark, sf_dir, _LIBRARY).join(owned, "id", "left").withColumn("volumes", F.coalesce("volumes", F.array().cast("array<double>"))))
    back, differences = intake.either_way(library, intake.snapshot_of(library))
    other = differences.select("name").distinct().withColumn("other", F.lit(True))
    listed = F.when(F.size("volumes") > 0, F.array_join(F.transform("volumes", lambda x: x.cast("int").cast("string")), " "))
    return back.join(other, "name", "left").select("name", "folder", "status", "novel", listed.alias("volumes"), F.col("other").isNull().alias("same"))


_BEFORE = "SELECT DISTINCT l_suppkey AS id, 'line' AS kind, 'b' || (l_suppkey % 3) AS first_build FROM {lineitem} UNION ALL SELECT o_orderkey + 1000000, 'volume', 'b1' FROM {orders}"
_EXPORTED = "SELECT s_suppkey AS id, 'line' AS kind FROM {supplier} WHERE s_suppkey % 4 > 0 UNION ALL SELECT o_orderkey + 1000000, 'volume' FROM {orders} WHERE o_orderkey % 5 > 0 UNION ALL SELECT p_partkey + 5000000, 'volume' FROM {part}"
_REDIRECTS = "SELECT s_suppkey AS old_id, s_suppkey + 1 AS new_id FROM {supplier} WHERE s_suppkey % 8 = 0 UNION ALL SELECT o_orderkey + 1000000, o_orderkey + 1000005 FROM {orders} WHERE o_orderkey % 10 = 0 UNION ALL SELECT o_orderkey + 1000000, 1000001 FROM {orders} WHERE o_orderkey % 20 = 5"


@query(f"""WITH RECURSIVE b AS ({plain(_BEFORE)}), e AS ({plain(_EXPORTED)}), r AS ({plain(_REDIRECTS)}), one AS (SELECT old_id, min(new_id) AS new_id FROM r WHERE old_id NOT IN (SELECT id FROM e) GROUP BY old_id),
walk AS (SELECT old_id, new_id, 1 AS step FROM one UNION ALL SELECT w.old_id, o.new_id, step + 1 FROM walk w JOIN one o ON o.old_id = w.new_id WHERE step < 50), ends AS (SELECT old_id, arg_max(new_id, step) AS final FROM walk GROUP BY old_id)
SELECT id, kind, coalesce(first_build, 'now') AS first_build, CASE WHEN e.id IS NOT NULL THEN 'shipped' WHEN final IN (SELECT id FROM e) THEN 'redirected' ELSE 'lost' END AS state FROM b FULL JOIN e USING (id, kind) LEFT JOIN ends ON old_id = id""")
def shipped_ids(spark, sf_dir):
    """The registry of every id that ever went out, and where it is now."""
    return intake.shipped_registry(rows(spark, sf_dir, _BEFORE), rows(spark, sf_dir, _EXPORTED), rows(spark, sf_dir, _REDIRECTS), "now")


_MERGES = "SELECT c_custkey AS keep, CASE WHEN c_custkey % 11 = 0 THEN 'broken' ELSE '[' || (c_custkey + 3) || ',' || (c_custkey + 100000) || ',' || c_custkey || ']' END AS merged FROM {customer}"


@query("""WITH RECURSIVE m AS (SELECT unnest([c_custkey + 3, c_custkey + 100000]) AS old_id, c_custkey AS new_id FROM customer WHERE c_custkey % 11 > 0), w AS (SELECT old_id, new_id, 1 AS step FROM m UNION ALL SELECT w.old_id, m.new_id, step + 1 FROM w JOIN m ON m.old_id = w.new_id)
SELECT old_id AS merged, arg_max(new_id, step) AS keep FROM w GROUP BY old_id""")
def carried_merges(spark, sf_dir):
    """Merges of earlier builds out of a JSON column, each id with the one that stands for it in the end."""
    return intake.carried_merges(rows(spark, sf_dir, _MERGES))


@query("""SELECT p_partkey AS line, p_brand AS grp, coalesce(was, p_name) AS name, was IS NOT NULL AS held FROM part LEFT JOIN (SELECT p_brand, min(p_type || ' of ' || p_brand) AS was FROM part WHERE p_size = 7 GROUP BY p_brand) USING (p_brand)""")
def restored_names(spark, sf_dir):
    """Groups whose new names are held take back the names they had."""
    lines = rows(spark, sf_dir, "SELECT p_partkey AS line, p_brand AS grp, p_name AS name FROM {part}")
    return intake.restore_held(lines, rows(spark, sf_dir, "SELECT p_brand AS grp, p_type || ' of ' || p_brand AS name FROM {part} WHERE p_size = 7"))


_COVERS = "SELECT l_partkey AS line, CASE WHEN l_partkey % 4 > 0 THEN l_suppkey ELSE 0 - l_linenumber END AS cover FROM {lineitem}"
_SHOWN = "SELECT p_partkey AS line, CASE WHEN p_size % 3 = 0 THEN p_size END AS shown, CASE WHEN p_size % 7 > 0 THEN p_partkey + 1000 END AS own FROM {part}"


@query(f"WITH c AS ({plain(_COVERS)}), l AS ({plain(_SHOWN)}) SELECT DISTINCT coalesce(shown, own) AS cover FROM l WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.line = l.line AND cover > 0) AND coalesce(shown, own) IS NOT NULL")
def cover_fallbacks(spark, sf_dir):
    """Ids whose cover stands in for lines none of whose volumes has one."""
    return intake.covers_in_place(rows(spark, sf_dir, _SHOWN), rows(spark, sf_dir, _COVERS))


_QUALITY = """SELECT o_orderpriority AS sample, substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, CASE o_orderkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 7 ELSE 10 END) AS date, CASE WHEN o_orderkey % 3 > 0 THEN '978' || lpad(CAST(o_orderkey AS STRING), 9, '0') || (o_orderkey % 10) END AS isbn FROM {orders}"""


@query(f"""WITH v AS (SELECT *, list_sum(list_transform(range(1, 14), lambda i: substr(isbn, i, 1)::INT * CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END)) AS total FROM ({plain(_QUALITY)}))
SELECT sample, count(*) AS volumes, round(count_if(length(date) = 10) / count(*), 6) AS day_share, round(count_if(total % 10 = 0) / count(*), 6) AS isbn_share FROM v GROUP BY sample""")
def sample_quality(spark, sf_dir):
    """Shares of each sample's volumes with a date to the day and a sound ISBN."""
    return intake.sample_quality(rows(spark, sf_dir, _QUALITY), "sample")


_DATED = "SELECT o_orderkey AS volume, CASE WHEN o_orderkey % 9 > 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date FROM {orders}"
_SAID = "SELECT l_orderkey AS volume, CASE WHEN l_linenumber = 1 THEN 'page_count' ELSE 'release_date' END AS field, CAST(CAST(o_orderdate AS DATE) AS STRING) AS value, CASE l_returnflag WHEN 'R' THEN 'plan' WHEN 'A' THEN 'shop' ELSE 'other' END AS source FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey"


@query(f"""WITH v AS ({plain(_DATED)}), c AS ({plain(_SAID)}), t AS (SELECT volume, value AS date, bool_or(source = 'shop') AS shop FROM c WHERE field = 'release_date' AND source IN ('shop', 'plan') GROUP BY ALL)
SELECT volume, date, CASE WHEN date IS NULL THEN NULL WHEN shop THEN 'published' WHEN NOT shop THEN 'projected' ELSE 'unknown' END AS date_type FROM v LEFT JOIN t USING (volume, date)""")
def typed_dates(spark, sf_dir):
    """Dates are labelled by a source that states its milestone and claims the very date."""
    return intake.typed_by_source(rows(spark, sf_dir, _DATED), rows(spark, sf_dir, _SAID), {"shop": "published", "plan": "projected"})


_TAKEN = "SELECT lower(c_mktsegment) AS source, c_nationkey AS volumes FROM {customer} WHERE c_mktsegment <> 'MACHINERY'"
_LOG = "SELECT lower(c_mktsegment) AS source, CASE WHEN c_mktsegment = 'BUILDING' AND o_orderkey % 10 = 0 THEN 'refused' WHEN c_mktsegment = 'BUILDING' AND o_orderkey % 10 = 1 THEN 'not_sent' WHEN c_mktsegment = 'FURNITURE' AND o_orderkey % 4 = 0 THEN 'stale' ELSE 'ok' END AS fate FROM {orders} JOIN {customer} ON c_custkey = o_custkey"


@query(f"""WITH t AS ({plain(_TAKEN)}), g AS ({plain(_LOG)}), s AS (SELECT unnest(['automobile', 'building', 'furniture', 'household', 'machinery', 'nowhere']) AS source), l AS (SELECT source, count(*) AS lines, sum(volumes)::BIGINT AS volumes FROM t GROUP BY source),
r AS (SELECT source, count_if(fate <> 'not_sent')::BIGINT AS sent, count_if(fate = 'refused')::BIGINT AS refused, bool_or(fate = 'not_sent') AS stopped, bool_or(fate = 'stale') AS stale FROM g GROUP BY source)
SELECT source, coalesce(lines, 0) AS lines, coalesce(volumes, 0) AS volumes, coalesce(sent, 0) AS sent, coalesce(refused, 0) AS refused, nullif(concat_ws('+', CASE WHEN refused > 0 THEN 'refused' END, CASE WHEN stopped THEN 'stopped' END, CASE WHEN stale THEN 'stale' END, CASE WHEN lines IS NULL THEN 'empty' END), '') AS degraded FROM s LEFT JOIN l USING (source) LEFT JOIN r USING (source)""")
def run_metadata(spark, sf_dir):
    """What each source brought to a run, what it was asked, and why it counts as degraded."""
    return intake.run_record(rows(spark, sf_dir, _TAKEN), rows(spark, sf_dir, _LOG), ["automobile", "building", "furniture", "household", "machinery", "nowhere"])


_SET = "SELECT l_orderkey AS line, l_linenumber AS number, min(l_partkey) AS isbn FROM {lineitem} GROUP BY l_orderkey, l_linenumber"
_SINGLE = "SELECT l_orderkey AS line, CASE WHEN l_suppkey % 3 > 0 THEN l_linenumber END AS number, l_partkey AS isbn, min(l_suppkey) AS pages FROM {lineitem} GROUP BY l_orderkey, CASE WHEN l_suppkey % 3 > 0 THEN l_linenumber END, l_partkey"


@query(f"""WITH s AS ({plain(_SET)}), o AS ({plain(_SINGLE)}), t AS (SELECT line, isbn, min(pages) AS p1 FROM o GROUP BY ALL), u AS (SELECT line, number, min(pages) AS p2 FROM o WHERE number IS NOT NULL GROUP BY ALL)
SELECT s.line, s.number, s.isbn, coalesce(p1, p2) AS pages, CASE WHEN p1 IS NOT NULL THEN 'isbn' WHEN p2 IS NOT NULL THEN 'number' ELSE 'set' END AS twin FROM s LEFT JOIN t USING (line, isbn) LEFT JOIN u USING (line, number)""")
def assembled_lines(spark, sf_dir):
    """A set's volumes with what their single records add, found by ISBN, else by number."""
    return intake.set_and_singles(rows(spark, sf_dir, _SET), rows(spark, sf_dir, _SINGLE))


_RECORDS = """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 40 * 1000000 END AS parent, CASE WHEN p_size % 4 = 0 THEN 's' || (p_size % 3) END AS section, CAST(p_size % 9 AS STRING) AS number, CASE WHEN p_partkey % 5 > 0 THEN 'i' || (p_partkey % 1500) END AS isbn, p_name AS title, p_brand AS publisher, p_size * 13 AS pages,
  CASE p_partkey % 4 WHEN 0 THEN 'kor' WHEN 1 THEN 'chi' ELSE 'jpn' END AS origin, p_size % 6 = 0 AS explicit, CASE WHEN p_size % 17 = 0 THEN 'light_novel' ELSE 'manga' END AS medium, p_size = 50 AS roman, p_partkey % 2 = 0 AS drawn, p_partkey % 7 = 0 AS announced FROM {part}"""


@query()
def library_lines(spark, sf_dir):
    """A library's records as lines; components of twins and modes make it long in SQL, so a loop holds it in the tests."""
    return intake.library_lines(rows(spark, sf_dir, _RECORDS))[0]


_NAMED = "SELECT l_orderkey AS line, CASE WHEN l_quantity > 10 THEN 'line_name' ELSE 'note' END AS field, CASE WHEN l_linenumber < 7 THEN 'n' || l_partkey END AS value, CASE WHEN l_suppkey % 3 = 0 THEN 'wiki' ELSE 'lib' END AS source, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS seq FROM {lineitem}"


@query(f"WITH c AS ({plain(_NAMED)}) SELECT line, arg_min(value, CASE WHEN source = 'wiki' THEN 0 ELSE 1000000000000000 END + seq) AS name FROM c WHERE field = 'line_name' AND value IS NOT NULL GROUP BY line")
def first_claim_names(spark, sf_dir):
    """What a line is called by the encyclopedia's first claim, else by the first of any other source."""
    return intake.first_claim_name(rows(spark, sf_dir, _NAMED), "wiki")
