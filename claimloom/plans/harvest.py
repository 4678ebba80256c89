"""Fetching plans and what comes back, as queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import keys
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows
from claimloom.session import table
from claimloom.sources import cache


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'absent' WHEN c_custkey % 100 > CASE WHEN c_custkey % 3 > 0 THEN 30 ELSE 60 END THEN 'stale' END AS reason FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 100 > CASE WHEN c_custkey % 3 > 0 THEN 30 ELSE 60 END""")
def refresh_plan(spark, sf_dir):
    """Which cached answers are fetched again: absent ones, old ones, old refusals."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    held = c.where("k % 5 > 0").select("k", (F.col("k") % 100).alias("age"), (F.col("k") % 3 > 0).alias("found"))
    return cache.to_fetch(c, held, "k", 30, 60)


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'A' || (s_suppkey % 10) WHEN s_suppkey % 4 = 1 THEN NULL ELSE 'A' || s_suppkey END AS answer, true AS asked_once, true AS fits FROM supplier""")
def batched_lookup(spark, sf_dir):
    """Keys looked up in batches, answers mapped back through the server's own spelling."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    spelt = s.where("s_suppkey % 4 = 0").select("s_suppkey", (F.col("s_suppkey") % 10 + 100000).alias("to"))
    found = s.where("s_suppkey % 4 <> 1").select(F.col("s_suppkey").alias("to"), F.concat(F.lit("A"), "s_suppkey").alias("answer")).unionAll(spelt.select("to", F.concat(F.lit("A"), F.col("to") - 100000)).distinct())
    b = cache.batches(s, "s_suppkey", 50)
    size = b.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    once = b.groupBy("s_suppkey").agg(F.count("*").alias("times"), F.first("bucket").alias("bucket"), F.first("part").alias("part")).join(size, ["bucket", "part"])
    return cache.answered(s, spelt, found, "s_suppkey").join(once, "s_suppkey").select("s_suppkey", "answer", (F.col("times") == 1).alias("asked_once"), (F.col("n") <= 50).alias("fits"))


_WORDS = "list_filter(string_split(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"


@query(f"""WITH q AS (SELECT DISTINCT p_name AS q, {_WORDS.format('p_name')} AS want FROM part), p AS (SELECT p_partkey AS page, {_WORDS.format("p_name || ' ' || p_type || CASE WHEN p_partkey % 3 = 0 THEN ' volumes' ELSE '' END")} AS got FROM part),
m AS (SELECT q, page, len(list_distinct(want)) / len(list_distinct(got)) AS score FROM q JOIN p ON list_has_all(got, want)) SELECT q, page, score FROM m QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, page) = 1""")
def find_articles(spark, sf_dir):
    """The page that holds all of a query's words, by the share of its own words that were asked for."""
    p = table(spark, sf_dir, "part")
    words = lambda c: F.split(keys.ascii_key(c), " ")
    q = p.select(F.col("p_name").alias("q")).distinct().select("q", words(F.col("q")).alias("words"))
    title = F.concat_ws(" ", "p_name", "p_type", F.when(F.col("p_partkey") % 3 == 0, "volumes"))
    return cache.best_article(q, p.select(F.col("p_partkey").alias("page"), words(title).alias("words")))


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, length(html)::BIGINT AS n, contains(html, '<script') AS uses_template, contains(html, '<a href=') AS linked FROM pages""")
def page_sources(spark, sf_dir):
    """Pages by what they use: their source text, host and templates."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"), F.length("html").cast("bigint").alias("n"), F.contains("html", F.lit("<script")).alias("uses_template"), F.contains("html", F.lit("<a href=")).alias("linked"))


_LOG = "SELECT user_id % 20 AS source, event_id AS seq, 'u' || (event_id % 300) AS url, CASE WHEN event_type = 'error' THEN 429 WHEN event_type = 'click' THEN 500 ELSE 200 END AS status FROM {events}"


@query(f"""WITH l AS ({plain(_LOG)}), m AS (SELECT *, status = 429 AS refused, sum((status <> 429)::INT) OVER (PARTITION BY source ORDER BY seq) AS island FROM l), c AS (SELECT *, sum(refused::INT) OVER (PARTITION BY source, island ORDER BY seq) AS streak FROM m),
b AS (SELECT *, coalesce(max(streak) OVER (PARTITION BY source ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS worst, row_number() OVER (PARTITION BY source, url ORDER BY seq) AS tries FROM c)
SELECT source, seq, url, status::INTEGER AS status, CASE WHEN worst >= 3 THEN 'not_sent' WHEN status = 200 THEN 'ok' WHEN tries >= 3 THEN 'gave_up' ELSE 'retry' END AS fate FROM b""")
def request_fates(spark, sf_dir):
    """Requests in order: retries are bounded, and a source that refuses three times in a row is left alone for good."""
    return cache.request_fates(rows(spark, sf_dir, _LOG))


_PAGED = "SELECT o_custkey AS query, o_orderkey AS id, o_orderkey % 13 AS p FROM {orders}"


@query(f"""WITH o AS ({plain(_PAGED)}), n AS (SELECT query, id FROM o WHERE p <> 4 OR query % 2 = 0), t AS (SELECT query, count(*) AS total FROM o GROUP BY query), g AS (SELECT query, total, (SELECT count(*) FROM n WHERE n.query = t.query) = total AS whole FROM t)
SELECT n.query, id, false AS degraded FROM n JOIN g ON g.query = n.query AND whole UNION ALL SELECT o.query, id, true FROM o JOIN g ON g.query = o.query AND NOT whole WHERE p < 9""")
def whole_result_sets(spark, sf_dir):
    """A result set counts whole or not at all; else the previous one stands, marked degraded."""
    o = rows(spark, sf_dir, _PAGED)
    new = o.where("p <> 4 or query % 2 = 0")
    return cache.whole_sets(new, o.groupBy("query").agg(F.count("*").alias("total")), o.where("p < 9"))


@query("""WITH s AS (SELECT c_nationkey AS slice, c_mktsegment AS prefix, count(*) AS total FROM customer GROUP BY ALL) SELECT slice, prefix, total, CASE WHEN slice % 5 = 0 THEN 100 WHEN slice % 5 = 1 THEN 50 WHEN slice % 5 = 2 THEN 25 END::INTEGER AS page_size, ceil(total / CASE WHEN slice % 5 = 0 THEN 100 WHEN slice % 5 = 1 THEN 50 WHEN slice % 5 = 2 THEN 25 END)::BIGINT AS pages FROM s""")
def page_ladder(spark, sf_dir):
    """Smaller pages where large ones fail, key prefixes where all do."""
    s = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("slice"), F.col("c_mktsegment").alias("prefix")).agg(F.count("*").alias("total"))
    limit = F.when(F.col("slice") % 5 == 0, 100).when(F.col("slice") % 5 == 1, 50).when(F.col("slice") % 5 == 2, 25).otherwise(0)
    return cache.page_ladder(s, limit)


@query("""WITH k AS (SELECT o_orderkey AS k, o_orderkey // 64 AS batch, o_orderkey % 64 AS place, o_orderkey % 77 = 5 AS bad FROM orders), l AS (SELECT k, batch, bad, 1 + sum(CASE WHEN EXISTS (SELECT 1 FROM k b WHERE b.bad AND b.batch = k.batch AND b.place >> e = k.place >> e) THEN 1 ELSE 0 END) AS calls FROM k, (VALUES (1), (2), (3), (4), (5), (6)) h(e) GROUP BY ALL)
SELECT batch, k, calls::INTEGER AS calls, NOT bad AS ok FROM l""")
def halved_batches(spark, sf_dir):
    """Batches that fail are halved down to the key at fault."""
    o = rows(spark, sf_dir, "SELECT o_orderkey AS k, o_orderkey div 64 AS batch, CAST(o_orderkey % 64 AS INT) AS place, 64 AS size FROM {orders}")
    return cache.halved(o, "k", F.col("k") % 77 == 5)


@query("""WITH a AS (SELECT 'orders' AS channel, o_custkey AS k, 0 AS r FROM orders UNION ALL SELECT 'customers', c_custkey, 1 FROM customer UNION ALL SELECT 'lines', l_suppkey, 2 FROM lineitem), m AS (SELECT k, min(r) AS r FROM a GROUP BY k) SELECT a.channel, count(*) AS rows, count(DISTINCT CASE WHEN a.r = m.r THEN a.k END) AS new_keys FROM a JOIN m USING (k) GROUP BY a.channel""")
def channel_report(spark, sf_dir):
    """All channels together, the first record of a key winning, and what each brought."""
    o, c, line = (table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    every = [("orders", o.select(F.col("o_custkey").alias("k"))), ("customers", c.select(F.col("c_custkey").alias("k"))), ("lines", line.select(F.col("l_suppkey").alias("k")))]
    return cache.channel_union(every, "k")[1]


@query("""SELECT p_partkey AS k, row_number() OVER (ORDER BY p_partkey)::INTEGER AS place FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1) ORDER BY p_partkey LIMIT 60""")
def recovered_rows(spark, sf_dir):
    """Carried keys that a channel lost, in order, the first sixty (the cap is the recovery's own)."""
    seen = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_partkey").alias("k"))
    lost = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")).join(seen, "k", "left_anti").orderBy("k").limit(60)
    from pyspark.sql import Window

    # At most sixty rows are numbered.
    return lost.select("k", F.row_number().over(Window.orderBy("k")).alias("place"))


@query("""SELECT o_custkey AS isbn, (list(o_orderkey ORDER BY (o_orderstatus = 'F') DESC, o_totalprice DESC, o_orderkey))[1] AS variant, count(*) AS variants FROM orders GROUP BY o_custkey""")
def variant_choice(spark, sf_dir):
    """A batch's records by key: of several variants the one that ranks first."""
    rank = F.struct((F.col("o_orderstatus") == "F").cast("int"), F.col("o_totalprice"), -F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("isbn")).agg(F.max_by("o_orderkey", rank).alias("variant"), F.count("*").alias("variants"))


@query("""SELECT event_id, coalesce(json_extract_string(props, '$.cover'), json_extract_string(props, '$.k'), event_type) AS value, CASE WHEN json_extract_string(props, '$.cover') IS NOT NULL THEN 'cover' WHEN json_extract_string(props, '$.k') IS NOT NULL THEN 'k' ELSE 'type' END AS shape FROM events""")
def shape_sniffed(spark, sf_dir):
    """Records of several shapes: the first shape that fits gives the value."""
    cover, k = F.get_json_object("props", "$.cover"), F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(cover, k, "event_type").alias("value"), F.when(cover.isNotNull(), "cover").when(k.isNotNull(), "k").otherwise("type").alias("shape"))


@query("""WITH r AS (SELECT l_orderkey AS q, l_linenumber AS pos, l_suppkey, CASE WHEN l_suppkey % 50 = 0 THEN 'x' ELSE 'q' || l_orderkey END AS told FROM lineitem) SELECT q, count(*) AS got, count(DISTINCT pos) AS positions, count_if(told <> 'q' || q)::BIGINT AS crossed, CASE WHEN count_if(told <> 'q' || q) > 0 THEN 'crossed' WHEN count(*) > count(DISTINCT pos) THEN 'repeated' WHEN count(*) < 2 THEN 'short' ELSE 'ok' END AS verdict FROM r GROUP BY q""")
def page_verdicts(spark, sf_dir):
    """Pages that answer another question, repeat positions or come short."""
    r = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("q"), F.col("l_linenumber").alias("pos"), (F.col("l_suppkey") % 50 == 0).alias("strange"))
    c = r.groupBy("q").agg(F.count("*").alias("got"), F.count_distinct("pos").alias("positions"), F.count_if("strange").alias("crossed"))
    return c.withColumn("verdict", F.when(F.col("crossed") > 0, "crossed").when(F.col("got") > F.col("positions"), "repeated").when(F.col("got") < 2, "short").otherwise("ok"))


@query("""SELECT lo, hi, (SELECT count(*) FROM orders WHERE (lo IS NULL AND hi IS NULL AND o_orderdate IS NULL) OR (year(o_orderdate) >= lo AND (hi IS NULL OR year(o_orderdate) <= hi))) AS n FROM (VALUES (1990, 1995), (1996, 1996), (1997, 1997), (1998, 1998), (1999, 1999), (2000, 2000), (2001, NULL), (NULL, NULL)) s(lo, hi)""")
def year_slices(spark, sf_dir):
    """Coarse, yearly, open and yearless slices of a set, and what each holds: counted once by year."""
    # A set's slices are as many as its years.
    slices = spark.createDataFrame([(1990, 1995), *((y, y) for y in range(1996, 2001)), (2001, None), (None, None)], "lo int, hi int")
    by = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("k"))
    here = (F.col("lo").isNull() & F.col("y").isNull()) | ((F.col("y") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("y") <= F.col("hi"))))
    return slices.join(by, here, "left").groupBy("lo", "hi").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"))


@query("""SELECT c_custkey AS k, c_mktsegment AS name, CASE WHEN c_custkey % 2 = 0 THEN 'legacy' ELSE 'both' END AS state FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 3 > 0""")
def allowlisted_channels(spark, sf_dir):
    """Channels on a list, and which of their keys only the old run had."""
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("name"))
    new = table(spark, sf_dir, "customer").where("c_custkey % 2 > 0").select(F.col("c_custkey").alias("k"), F.lit(True).alias("new"))
    return c.join(new, "k", "left").select("k", "name", F.when(F.col("new"), "both").otherwise("legacy").alias("state"))


@query("""SELECT c_custkey AS id, c_name AS name, NULL::VARCHAR AS licence, c_custkey % 4 = 0 AS library_born FROM customer""")
def previous_artifact(spark, sf_dir):
    """The previous artifact's rows under the present columns, those it lacked null, and which were born in a library."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    present = spark.createDataFrame([], "id bigint, name string, licence string")
    return present.unionByName(old, allowMissingColumns=True).withColumn("library_born", F.col("id") % 4 == 0)


@query("""SELECT l_orderkey AS parent FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0) GROUP BY l_orderkey""")
def missing_parents(spark, sf_dir):
    """Parents that rows refer to and no channel brought."""
    want = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("parent"))
    have = table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("parent"))
    return want.join(have, "parent", "left_anti").distinct()


