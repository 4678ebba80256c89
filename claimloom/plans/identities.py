"""Clusters, ids and their history as queries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.operators import identity, runs
from claimloom.plans.catalogue import query
from claimloom.plans.derived import rows
from claimloom.session import table

_CLOSE = """w(a, b) AS (SELECT id, id FROM n UNION SELECT w.a, s.b FROM w JOIN s ON s.a = w.b) SELECT a AS id, min(b) AS component FROM w GROUP BY a"""


@query(f"""WITH RECURSIVE n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 't' || (c_custkey - c_custkey % 21) ELSE 'u' || c_custkey END AS title FROM customer), e AS (SELECT id AS a, id + 1 AS b FROM n WHERE id % 5 = 1 AND id + 1 IN (SELECT id FROM n)
UNION SELECT id, min(id) OVER (PARTITION BY title) FROM n), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), {_CLOSE}""")
def two_pass_identity(spark, sf_dir):
    """Works joined by links first, then by equal title keys."""
    n = rows(spark, sf_dir, "SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 't' || (c_custkey - c_custkey % 21) ELSE 'u' || c_custkey END AS title FROM {customer}")
    linked = n.where("id % 5 = 1").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).join(n.select(F.col("id").alias("b")), "b", "left_semi").select("a", "b")
    return identity.shared_key_clusters(n, "id", F.array("title"), linked)


@query(f"""WITH RECURSIVE n AS (SELECT p_partkey AS id, [p_name || p_brand || p_type, 'o' || (p_partkey - p_partkey % 4) || p_size] AS ks FROM part), k AS (SELECT id, unnest(ks) AS k FROM n), e AS (SELECT id AS a, min(id) OVER (PARTITION BY k) AS b FROM k UNION SELECT id, id + 8 FROM n WHERE id % 100 = 1 AND id + 8 IN (SELECT id FROM n)),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), {_CLOSE}""")
def shared_key_clusters(spark, sf_dir):
    """Lines that share a key of any kind, with forced joins."""
    p = rows(spark, sf_dir, "SELECT p_partkey AS id, p_name || p_brand || p_type AS k1, 'o' || (p_partkey - p_partkey % 4) || p_size AS k2 FROM {part}")
    joins = p.where("id % 100 = 1").select(F.col("id").alias("a"), (F.col("id") + 8).alias("b")).join(p.select(F.col("id").alias("b")), "b", "left_semi").select("a", "b")
    return identity.shared_key_clusters(p, "id", F.array("k1", "k2"), joins)


_TWINS = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 > 0 THEN 'i' || (o_orderkey - o_orderkey % 3) END AS isbn, CASE WHEN o_orderkey % 8 > 0 THEN o_orderkey % 30 - o_orderkey % 3 + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END END AS number, CASE WHEN o_custkey % 3 = 0 THEN o_custkey % 10 END AS parent, 't' || (o_custkey % 2) AS title FROM {orders}"


@query(f"""WITH RECURSIVE n AS ({_TWINS.replace('{orders}', 'orders')}), f AS (SELECT isbn, min(id) AS head, arg_min(parent, id) AS fp0, count(DISTINCT number) AS numbers FROM n WHERE isbn IS NOT NULL GROUP BY isbn), h AS (SELECT f.*, n.parent AS fp, n.title AS ft FROM f JOIN n ON n.id = f.head),
bad AS (SELECT DISTINCT isbn FROM n JOIN h USING (isbn) WHERE numbers > 1 OR (n.parent <> fp AND n.title <> ft)), e AS (SELECT head AS a, id AS b FROM n JOIN h USING (isbn) WHERE isbn NOT IN (SELECT isbn FROM bad)), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), {_CLOSE}""")
def isbn_twins(spark, sf_dir):
    """Records that are one physical volume; boxes' and colliding ISBNs join nothing."""
    return identity.twins(rows(spark, sf_dir, _TWINS))


@query("""WITH l AS (SELECT l_suppkey % 20 AS parent, CASE WHEN l_suppkey % 20 < 10 THEN 's' || (l_linenumber % 2) END AS section, CASE WHEN l_suppkey % 20 < 5 THEN l_linenumber ELSE l_linenumber % 4 END AS number, l_orderkey * 10 + l_linenumber AS id FROM lineitem),
c AS (SELECT parent, max(n) > 1 AS clash FROM (SELECT parent, number, count(DISTINCT coalesce(section, '')) AS n FROM l GROUP BY ALL) GROUP BY parent)
SELECT CASE WHEN clash AND section IS NOT NULL THEN parent || '#' || section ELSE parent::VARCHAR END AS line, count(*) AS n, sum(id)::BIGINT AS ids FROM l JOIN c USING (parent) GROUP BY 1""")
def section_split(spark, sf_dir):
    """Sections of a set that repeat its numbers become lines of their own."""
    l = rows(spark, sf_dir, "SELECT l_suppkey % 20 AS parent, CASE WHEN l_suppkey % 20 < 10 THEN 's' || (l_linenumber % 2) END AS section, CASE WHEN l_suppkey % 20 < 5 THEN l_linenumber ELSE l_linenumber % 4 END AS number, l_orderkey * 10 + l_linenumber AS id FROM {lineitem}")  # noqa: E741
    return identity.split_sections(l).groupBy("line").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query("""WITH RECURSIVE t AS (SELECT p_brand || '|' || p_type AS signature, p_partkey AS set_id, list_sort(list_distinct([p_size % 6, p_size % 6 + 1, p_size % 6 + 2 + p_partkey % 2])) AS numbers FROM part), q AS (SELECT *, row_number() OVER (PARTITION BY signature ORDER BY set_id) AS r FROM t),
st AS (SELECT signature, 1::BIGINT AS r, [{'head': set_id, 'held': numbers}] AS lines, set_id, set_id AS line FROM q WHERE r = 1
UNION ALL SELECT signature, r, CASE WHEN pos = 0 THEN list_append(lines, {'head': id, 'held': nums}) ELSE list_transform(lines, lambda x, i: CASE WHEN i = pos THEN {'head': x.head, 'held': list_distinct(list_concat(x.held, nums))} ELSE x END) END, id, CASE WHEN pos = 0 THEN id ELSE lines[pos].head END
FROM (SELECT st.signature, q.r, st.lines, q.set_id AS id, q.numbers AS nums, coalesce(list_position(list_transform(st.lines, lambda x: len(list_intersect(x.held, q.numbers)) = 0 OR (len(list_intersect(x.held, q.numbers)) = 1 AND len(x.held) >= 3 AND len(q.numbers) >= 3)), true), 0) AS pos
  FROM st JOIN q ON q.signature = st.signature AND q.r = st.r + 1))
SELECT signature, set_id, line FROM st""")
def merged_sets(spark, sf_dir):
    """Sets of one signature merge while their numbers stay disjoint."""
    p = table(spark, sf_dir, "part")
    a = F.col("p_size") % 6
    numbers = F.array_sort(F.array_distinct(F.array(a, a + 1, a + 2 + (F.col("p_partkey") % 2).cast("int"))))
    return identity.merge_disjoint(p.select(F.concat_ws("|", "p_brand", "p_type").alias("signature"), F.col("p_partkey").alias("set_id"), numbers.alias("numbers")))


_VOTES = "SELECT o_custkey AS old, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey - o_custkey % 4 + 5000 WHEN o_orderkey % 3 = 1 THEN o_custkey + 20000 ELSE o_custkey + 40000 END AS now FROM {orders}"


@query(f"""WITH o AS ({_VOTES.replace('{orders}', 'orders')}), m AS (SELECT old, now FROM o UNION ALL SELECT old, old + 60000 FROM o WHERE old % 5 = 0), v AS (SELECT old, now, count(*) AS shared FROM m GROUP BY ALL), n AS (SELECT old, count(*) AS n FROM o GROUP BY old), f AS (SELECT * FROM v JOIN n USING (old) WHERE 2 * shared > n),
t AS (SELECT *, max(shared) OVER (PARTITION BY old) AS top FROM f), g AS (SELECT old, count(*) AS ties, count_if(now >= 40000) AS fresh, min(now) AS one, min(CASE WHEN now >= 40000 THEN now END) AS new_one FROM t WHERE shared = top GROUP BY old)
SELECT old, CASE WHEN ties = 1 THEN one WHEN fresh = 1 THEN new_one END AS winner, NOT (ties = 1 OR fresh = 1) AS ambiguous FROM g""")
def majority_winner(spark, sf_dir):
    """Where an old id's volumes went: a strict majority; of equals the only new one, else it is reported as ambiguous."""
    o = rows(spark, sf_dir, _VOTES)
    n = o.groupBy("old").agg(F.count("*").alias("n"))
    # A twin of every fifth holds all its volumes too.
    every = o.unionAll(o.where("old % 5 = 0").select("old", (F.col("old") + 60000).alias("now")))
    votes = every.groupBy("old", "now").agg(F.count("*").alias("shared")).join(n, "old")
    return identity.winner(votes, "old", "now", F.col("now") >= 40000)


_BUILT = "SELECT o_custkey AS key, o_orderkey AS isbn, 'n' || (o_custkey % 9) AS name, 'p' || (o_custkey % 3) AS publisher FROM {orders}"


@query("""WITH b AS (SELECT o_custkey AS key, o_orderkey AS isbn, 'n' || (o_custkey % 9) AS name, 'p' || (o_custkey % 3) AS publisher FROM orders),
c AS (SELECT CASE WHEN o_custkey % 4 = 0 THEN o_custkey ELSE 100000 + o_custkey - o_custkey % 2 END AS id, o_orderkey AS isbn, 'n' || (o_custkey % 9) AS name, 'p' || (o_custkey % 3) AS publisher FROM orders WHERE o_orderkey % 3 > 0),
ci AS (SELECT id, min(name) AS name, min(publisher) AS publisher FROM c GROUP BY id), bk AS (SELECT key, min(name) AS name, min(publisher) AS publisher FROM b GROUP BY key), kept AS (SELECT key FROM bk WHERE key IN (SELECT id FROM ci)),
m AS (SELECT bk.key, ci.id, count(DISTINCT b.isbn) AS shared, bool_or(bk.name = ci.name AND bk.publisher = ci.publisher) AS same FROM b JOIN bk USING (key) JOIN c USING (isbn) JOIN ci ON ci.id = c.id WHERE bk.key NOT IN (SELECT key FROM kept) AND ci.id NOT IN (SELECT key FROM kept) GROUP BY bk.key, ci.id),
best AS (SELECT * FROM m WHERE shared >= 2 OR same QUALIFY row_number() OVER (PARTITION BY id ORDER BY shared DESC, key) = 1), taken AS (SELECT key, min(id) AS id FROM best GROUP BY key)
SELECT key, CASE WHEN key IN (SELECT key FROM kept) THEN key ELSE coalesce(id, key) END AS id, CASE WHEN key IN (SELECT key FROM kept) THEN 'continuity' WHEN id IS NOT NULL THEN 'lookup' ELSE 'minted' END AS via FROM bk LEFT JOIN taken USING (key)""")
def line_ids(spark, sf_dir):
    """Ids of built lines: continuity, then lookup on evidence, then minted."""
    b = rows(spark, sf_dir, _BUILT).groupBy("key").agg(F.collect_set("isbn").alias("isbns"), F.min("name").alias("name"), F.min("publisher").alias("publisher"))
    c = rows(spark, sf_dir, _BUILT).where("isbn % 3 > 0").withColumn("id", F.when(F.col("key") % 4 == 0, F.col("key")).otherwise(100000 + F.col("key") - F.col("key") % 2))
    c = c.groupBy("id").agg(F.collect_set("isbn").alias("isbns"), F.min("name").alias("name"), F.min("publisher").alias("publisher"))
    return identity.line_ids(b, c, F.col("key"))


@query("""WITH l AS (SELECT o_custkey AS line, list_distinct(list(CASE WHEN o_custkey % 4 > 0 THEN o_orderkey - o_orderkey % 2 END) FILTER (o_custkey % 4 > 0)) AS isbns, list_distinct(list(o_orderkey % 5 || '@' || year(o_orderdate))) AS dated FROM orders GROUP BY o_custkey),
p AS (SELECT a.line, b.line AS other, coalesce(a.isbns, []) AS x, coalesce(b.isbns, []) AS y, a.dated AS dx, b.dated AS dy FROM l a JOIN l b ON b.line = a.line + 4), q AS (SELECT *, len(list_intersect(x, y)) AS shared, len(list_intersect(dx, dy)) AS dated, least(len(dx), len(dy)) AS fewer FROM p)
SELECT line, other, CASE WHEN len(x) > 0 AND len(y) > 0 THEN CASE WHEN shared * 2 > least(len(x), len(y)) THEN shared ELSE 0 END WHEN fewer >= 2 AND dated * 2 > fewer THEN dated ELSE 0 END::INTEGER AS evidence FROM q""")
def same_edition(spark, sf_dir):
    """Evidence that neighbouring lines are one edition, by ISBNs or dated volumes."""
    o = table(spark, sf_dir, "orders")
    l = o.groupBy(F.col("o_custkey").alias("line")).agg(  # noqa: E741
        F.collect_set(F.when(F.col("o_custkey") % 4 > 0, F.col("o_orderkey") - F.col("o_orderkey") % 2)).alias("isbns"), F.collect_set(F.concat_ws("@", F.col("o_orderkey") % 5, F.year("o_orderdate"))).alias("dated")
    )
    r = l.select((F.col("line") - 4).alias("line"), F.col("line").alias("other"), F.col("isbns").alias("y"), F.col("dated").alias("dy"))
    return l.join(r, "line").select("line", "other", identity.same_edition(F.col("isbns"), F.col("y"), F.col("dated"), F.col("dy")).alias("evidence"))


@query("""WITH r AS (SELECT p_partkey AS id, p_brand AS g, p_size % 5 AS v, p_partkey % 6 = 0 AS held FROM part) SELECT id, g, CASE WHEN bool_or(held) OVER (PARTITION BY g, v) THEN 'held' ELSE 'free' END AS state FROM r""")
def guards_to_fixpoint(spark, sf_dir):
    """Guards run until nothing changes: who shares a value with a held row is held."""
    r = rows(spark, sf_dir, "SELECT p_partkey AS id, p_brand AS g, p_size % 5 AS v, CASE WHEN p_partkey % 6 = 0 THEN 'held' ELSE 'free' END AS state FROM {part}")

    def guard(df):
        some = df.groupBy("g", "v").agg(F.bool_or(F.col("state") == "held").alias("h"))
        return df.join(some, ["g", "v"]).select("id", "g", "v", F.when(F.col("h"), "held").otherwise("free").alias("state"))

    return identity.settle(r, guard).select("id", "g", "state")


_ONE = "SELECT l_orderkey AS line, l_linenumber AS number, min(l_partkey) % 3 AS isbn, CASE WHEN min(l_suppkey) % 4 > 0 THEN 'd' || (min(l_suppkey) % 2) END AS day FROM {lineitem} GROUP BY l_orderkey, l_linenumber"


@query(f"""WITH v AS ({_ONE.replace('{lineitem}', 'lineitem')}), m AS (SELECT *, CASE WHEN number = lag(number) OVER w + 1 AND isbn = lag(isbn) OVER w AND coalesce(day = lag(day) OVER w, true) THEN 0 ELSE 1 END AS new FROM v WINDOW w AS (PARTITION BY line ORDER BY number)),
r AS (SELECT *, sum(new) OVER (PARTITION BY line ORDER BY number) AS run FROM m), c AS (SELECT line, run, min(number) AS first, count(*) AS n, string_agg(number::VARCHAR, ',' ORDER BY number) AS contains, arg_min(day, number) FILTER (day IS NOT NULL) AS day FROM r GROUP BY line, run)
SELECT line, CASE WHEN max(n) OVER (PARTITION BY line) > 1 THEN row_number() OVER (PARTITION BY line ORDER BY first) ELSE first END::INTEGER AS number, contains, day FROM c""")
def renumber_lines(spark, sf_dir):
    """Runs collapse and the whole line is numbered anew where there is one."""
    return runs.renumbered(rows(spark, sf_dir, _ONE), ["line"], "number", "isbn", "day")


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'error' THEN 2 WHEN event_type = 'click' THEN 3 END AS level, event_type || event_id AS h FROM events),
a AS (SELECT *, max(CASE WHEN level = 1 THEN event_id END) OVER w AS a1, max(CASE WHEN level = 2 THEN event_id END) OVER w AS a2, max(CASE WHEN level = 3 THEN event_id END) OVER w AS a3 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))
SELECT user_id, event_id, concat_ws(' > ', 'purchase' || a1, CASE WHEN a2 > coalesce(a1, -1) THEN 'error' || a2 END, CASE WHEN a3 > coalesce(a1, -1) AND a3 > coalesce(a2, -1) THEN 'click' || a3 END) AS stack FROM a""")
def heading_stack(spark, sf_dir):
    """The open heading of each level at every position."""
    level = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", 2).when(F.col("event_type") == "click", 3)
    e = table(spark, sf_dir, "events").select("user_id", "event_id", level.alias("level"), F.concat("event_type", "event_id").alias("h"))
    return runs.heading_stack(e, ["user_id"], "event_id", "level", "h").select("user_id", "event_id", "stack")


@query("""WITH v AS (SELECT l_orderkey AS line, CASE WHEN l_partkey % 5 > 0 THEN l_linenumber::VARCHAR END AS number, l_suppkey, l_partkey, l_shipdate, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey, l_partkey, l_shipdate, l_linenumber, l_quantity) AS id FROM lineitem),
k AS (SELECT *, CASE WHEN number IS NULL AND n = 1 AND line % 2 = 0 THEN '1' ELSE number END AS num FROM v) SELECT fate, count(*) AS n FROM (SELECT CASE WHEN num IS NULL THEN 'dropped_unnumbered' WHEN row_number() OVER (PARTITION BY line, num ORDER BY id) > 1 THEN 'dropped_duplicate_number' ELSE 'kept' END AS fate FROM k) GROUP BY fate""")
def one_per_number(spark, sf_dir):
    """One volume a number; what is lost keeps its fate."""
    line = table(spark, sf_dir, "lineitem")
    v = line.select(F.col("l_orderkey").alias("line"), F.when(F.col("l_partkey") % 5 > 0, F.col("l_linenumber").cast("string")).alias("number"), F.struct("l_suppkey", "l_partkey", "l_shipdate", "l_linenumber", "l_quantity").alias("pref"))
    return runs.one_per_number(v, ["line"], "number", [F.col("pref")], F.col("line") % 2 == 0).groupBy("fate").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT user_id AS g, CASE WHEN event_id % 3 = 0 THEN 'label x' ELSE 'plain' END AS shape, event_id, CASE WHEN event_id % 50 = 0 THEN 1990 ELSE event_id // 40 END AS n FROM events), m AS (SELECT g, shape, count(*) AS k, count_if(n = p + 1) AS steps, count_if(n BETWEEN 1900 AND 2100) AS years FROM (SELECT *, lag(n) OVER (PARTITION BY g, shape ORDER BY event_id) AS p FROM e) GROUP BY ALL)
SELECT g, shape, k, (k >= CASE WHEN starts_with(shape, 'label ') THEN 3 ELSE 2 END AND steps = k - 1 AND years = 0) AS is_run FROM m""")
def ascending_runs(spark, sf_dir):
    """Shapes whose numbers form one ascending run, two long (three for labels), no year among them."""
    e = rows(spark, sf_dir, "SELECT user_id AS g, CASE WHEN event_id % 3 = 0 THEN 'label x' ELSE 'plain' END AS shape, event_id, CASE WHEN event_id % 50 = 0 THEN 1990 ELSE event_id div 40 END AS n FROM {events}")
    e = e.withColumn("p", F.lag("n").over(Window.partitionBy("g", "shape").orderBy("event_id")))
    m = e.groupBy("g", "shape").agg(F.count("*").alias("k"), F.count_if(F.col("n") == F.col("p") + 1).alias("steps"), F.count_if(F.col("n").between(1900, 2100)).alias("years"))
    least = F.when(F.startswith("shape", F.lit("label ")), 3).otherwise(2)
    return m.select("g", "shape", "k", ((F.col("k") >= least) & (F.col("steps") == F.col("k") - 1) & (F.col("years") == 0)).alias("is_run"))


@query("""WITH g AS (SELECT p_brand, p_name, count(*) AS n, min(p_partkey) AS head FROM part GROUP BY ALL)
SELECT p_brand, p_name, n, head, CASE WHEN n > 1 THEN 'shared' ELSE 'alone' END AS state FROM g""")
def primary_of_group(spark, sf_dir):
    """Lines with one target are paired to its primary."""
    g = table(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(F.count("*").alias("n"), F.min("p_partkey").alias("head"))
    return g.withColumn("state", F.when(F.col("n") > 1, "shared").otherwise("alone"))


@query("""WITH d AS (SELECT doc_id, len(string_split(text, chr(10))) AS lines, len(list_filter(string_split(text, chr(10)), lambda x: x <> '')) AS told FROM documents WHERE text IS NOT NULL)
SELECT doc_id, lines::INTEGER AS lines, told::INTEGER AS records, (lines - told)::INTEGER AS lost, CASE WHEN lines > told THEN 'LOSS' ELSE 'ok' END AS issue FROM d""")
def integrity_counts(spark, sf_dir):
    """Rows in against records out, per document."""
    d = table(spark, sf_dir, "documents").where("text is not null").withColumn("l", F.split("text", "\n"))
    told = F.size(F.filter("l", lambda x: x != ""))
    return d.select("doc_id", F.size("l").alias("lines"), told.alias("records"), (F.size("l") - told).alias("lost"), F.when(F.size("l") > told, "LOSS").otherwise("ok").alias("issue"))


@query("""SELECT e.user_id, bool_and(coalesce(ts >= p, true)) AS in_order, count(*) AS n FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) e GROUP BY e.user_id""")
def offsets_increase(spark, sf_dir):
    """Whether positions only grow in the order of ids."""
    e = table(spark, sf_dir, "events").withColumn("p", F.lag("ts").over(Window.partitionBy("user_id").orderBy("event_id")))
    return e.groupBy("user_id").agg(F.bool_and(F.coalesce(F.col("ts") >= F.col("p"), F.lit(True))).alias("in_order"), F.count("*").alias("n"))
