"""Loads, keyed writes and reports as queries, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators import writes
from claimloom.operators.identity import probed_ints
from claimloom.plans.catalogue import query
from claimloom.plans.derived import rows
from claimloom.session import dealt, table

_ID = "'{p}' || substr(sha256({e}), 1, 12)"
_L = "SELECT *, 'order ' || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'novel' ELSE 'manga' END AS medium FROM orders JOIN lineitem ON l_orderkey = o_orderkey"


@query(f"""WITH l AS ({_L}), k AS (SELECT *, {_ID.format(p='w_', e="title")} AS work, {_ID.format(p='l_', e="title || '|' || medium")} AS line FROM l), v AS (SELECT *, {_ID.format(p='v_', e="line || '|' || l_linenumber")} AS volume FROM k)
SELECT 'work' AS t, count(DISTINCT work) AS n, min(work) AS first FROM v UNION ALL SELECT 'line', count(DISTINCT line), min(line) FROM v UNION ALL SELECT 'volume', count(DISTINCT volume), min(volume) FROM v
UNION ALL SELECT 'claim', count(DISTINCT volume || field), min(volume) FROM (SELECT volume, 'isbn' AS field FROM v UNION ALL SELECT volume, 'day' FROM v WHERE l_returnflag <> 'R') UNION ALL SELECT 'composition', count(DISTINCT volume || part), min(volume) FROM (SELECT volume, unnest([l_linestatus, l_returnflag]) AS part FROM v)""")
def nested_load(spark, sf_dir):
    """Nested records into five tables, loaded twice: the second load adds nothing.

    Lines are dealt by order, so a record is nested where its lines lie; a table is counted without a key, for which no rows are sorted.
    """
    line, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    v = F.struct(F.col("l_linenumber").alias("number"), F.col("l_partkey").cast("string").alias("isbn"), F.when(F.col("l_returnflag") != "R", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("day"), F.array("l_linestatus", "l_returnflag").alias("contains"))
    lines = dealt(line.select("l_orderkey", v.alias("volume")), "l_orderkey")
    nested = lines.join(dealt(o.select("o_orderkey"), "o_orderkey").hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey").agg(F.collect_list("volume").alias("volumes"))
    records = nested.select(F.concat(F.lit("Order "), "o_orderkey").alias("title"), F.when(F.col("o_orderkey") % 3 == 0, "novel").otherwise("manga").alias("medium"), "volumes")
    loaded = writes.load_records(records.unionAll(records))
    key = {"claim": "entity_id"}
    return reduce(DataFrame.unionAll, [df.agg(F.count("*").alias("n"), F.min(key.get(t, "id")).alias("first")).select(F.lit(t).alias("t"), "n", "first") for t, df in loaded.items()])


@query("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey - o_custkey % 3 ELSE o_custkey END AS o_custkey, o_custkey AS was, o_orderpriority FROM orders)
SELECT o_orderkey, o_custkey, o_orderpriority FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY (o_custkey <> was), o_orderkey) = 1""")
def update_or_ignore(spark, sf_dir):
    """A re-key that gives way where the key is taken."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    moved = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_custkey") - F.col("o_custkey") % 3).otherwise(F.col("o_custkey"))
    return writes.update_or_ignore(o, ["o_custkey", "o_orderpriority"], {"o_custkey": moved}, [F.col("o_orderkey")])


_VOLUMES = """SELECT l_orderkey AS line, l_linenumber AS number, CASE WHEN l_partkey % 7 > 0 THEN l_partkey END AS isbn, l_suppkey AS supplier FROM {lineitem}"""


@query("""WITH n AS (SELECT l_orderkey AS line, l_linenumber AS number, CASE WHEN l_partkey % 7 > 0 THEN l_partkey END AS isbn, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CASE WHEN l_partkey % 7 > 0 THEN l_partkey END NULLS FIRST) AS rn FROM lineitem),
o AS (SELECT l_orderkey AS line, l_linenumber AS number, min(CASE WHEN l_partkey % 5 > 0 THEN l_partkey + CASE WHEN l_suppkey % 11 = 0 THEN 1 ELSE 0 END END) AS old FROM lineitem WHERE l_linenumber < 5 GROUP BY ALL)
SELECT fate, count(*) AS n FROM (SELECT CASE WHEN rn > 1 THEN 'repeated' WHEN o.line IS NULL THEN 'added' WHEN old IS NULL AND isbn IS NOT NULL THEN 'filled' WHEN isbn IS NULL OR isbn = old THEN 'same' ELSE 'clash' END AS fate FROM n LEFT JOIN o USING (line, number)) GROUP BY fate""")
def load_fates(spark, sf_dir):
    """What a stage's load does with each volume."""
    new = rows(spark, sf_dir, _VOLUMES)
    old = rows(spark, sf_dir, "SELECT l_orderkey AS line, l_linenumber AS number, CASE WHEN l_partkey % 5 > 0 THEN l_partkey + CASE WHEN l_suppkey % 11 = 0 THEN 1 ELSE 0 END END AS isbn FROM {lineitem} WHERE l_linenumber < 5")
    return writes.fates(new, old, ["line", "number"], "isbn").groupBy("fate").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'b' || p_partkey ELSE p_brand END AS p_brand, CASE WHEN p_size % 4 = 0 AND p_partkey % 2 = 0 THEN 't' || p_size WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS p_type,
concat_ws(',', CASE WHEN p_size % 3 = 0 THEN 'p_brand' END, CASE WHEN p_size % 4 = 0 AND p_partkey % 2 = 0 THEN 'p_type' END) AS filled FROM part""")
def fill_only_empty(spark, sf_dir):
    """Empty columns are filled from a library, and which were is remembered."""
    p = rows(spark, sf_dir, "SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN p_brand END AS p_brand, CASE WHEN p_size % 4 > 0 THEN p_type END AS p_type FROM {part}")
    lib = rows(spark, sf_dir, "SELECT p_partkey, 'b' || p_partkey AS p_brand, CASE WHEN p_partkey % 2 = 0 THEN 't' || p_size END AS p_type FROM {part}")
    return writes.fill_empty(p, lib, "p_partkey", ["p_brand", "p_type"])


_CLAIMS = "SELECT l_orderkey AS id, 'f' || l_linenumber AS field, CASE l_suppkey % 3 WHEN 0 THEN 'dnb' WHEN 1 THEN 'wiki' ELSE 'loc' END AS source, max(l_partkey) AS value FROM {lineitem} GROUP BY l_orderkey, l_linenumber, CASE l_suppkey % 3 WHEN 0 THEN 'dnb' WHEN 1 THEN 'wiki' ELSE 'loc' END"


@query("""WITH c AS (SELECT l_orderkey AS id, 'f' || l_linenumber AS field, ['dnb', 'wiki', 'loc'][l_suppkey % 3 + 1] AS source, max(l_partkey) AS value FROM lineitem GROUP BY ALL), o AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY id, field ORDER BY source, value) = 1),
n AS (SELECT id, field, 'dnb' AS source, min(value) + 1 AS value FROM c GROUP BY ALL HAVING id % 2 = 0 UNION ALL SELECT o_orderkey, 'f9', 'dnb', 7 FROM orders),
u AS (SELECT o.id, o.field, o.source, o.value FROM o LEFT JOIN n USING (id, field) WHERE n.id IS NULL OR o.source <> 'dnb' UNION ALL SELECT n.* FROM n LEFT JOIN o USING (id, field) WHERE o.id IS NULL OR o.source = 'dnb')
SELECT source, count(*) AS n, sum(value)::BIGINT AS total, count_if(source <> 'dnb')::BIGINT AS without_stage FROM u GROUP BY source""")
def claim_upsert(spark, sf_dir):
    """A stage's claims replace its own and add absent ones, never another's; and what is left once the stage is undone."""
    c = rows(spark, sf_dir, _CLAIMS)
    w = Window.partitionBy("id", "field").orderBy("source", "value")
    old = c.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")
    new = c.groupBy("id", "field").agg((F.min("value") + 1).alias("value")).where("id % 2 = 0").select("id", "field", F.lit("dnb").alias("source"), "value")
    new = new.unionAll(table(spark, sf_dir, "orders").select("o_orderkey", F.lit("f9"), F.lit("dnb"), F.lit(7).cast("long")))
    up = writes.claim_upsert(old, new, ["id", "field"], "dnb")
    left = writes.unload(up, "dnb").groupBy("source").agg(F.count("*").alias("without_stage"))
    return up.groupBy("source").agg(F.count("*").alias("n"), F.sum("value").alias("total")).join(left, "source", "left").fillna(0, ["without_stage"])


@query("""WITH v AS (SELECT l_orderkey AS line, l_linenumber AS number, min(l_partkey) AS id FROM lineitem GROUP BY ALL), t AS (SELECT line, number, id, CASE WHEN line % 4 = 1 THEN line - 1 END AS goal FROM v),
p AS (SELECT coalesce(goal, line) AS line, number, id, CASE WHEN goal IS NULL THEN 'kept' WHEN row_number() OVER (PARTITION BY coalesce(goal, line), number ORDER BY (goal IS NOT NULL), id) = 1 THEN 'moved' ELSE 'dropped' END AS fate FROM t)
SELECT fate, count(*) AS n, count(DISTINCT line) AS lines, sum(id)::BIGINT AS ids FROM p GROUP BY fate""")
def merge_lines(spark, sf_dir):
    """A duplicate line's volumes move to the one kept unless it has the number."""
    v = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("line"), F.col("l_linenumber").alias("number")).agg(F.min("l_partkey").alias("id"))
    merges = v.select("line").distinct().where("line % 4 = 1").select(F.col("line").alias("old_id"), (F.col("line") - 1).alias("new_id"))
    return writes.merge_lines(v, merges).groupBy("fate").agg(F.count("*").alias("n"), F.countDistinct("line").alias("lines"), F.sum("id").alias("ids"))


@query("""SELECT 'orders' AS t, CASE WHEN o_custkey % 10 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS id, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'customer', CASE WHEN c_custkey % 10 = 0 THEN c_custkey + 1000000 ELSE c_custkey END, count(*) FROM customer GROUP BY 2""")
def rekey_everywhere(spark, sf_dir):
    """A renamed id in every table that refers to it."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    renames = c.where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("old_id"), (F.col("c_custkey") + 1000000).alias("new_id"))
    parts = [writes.renamed_ids(df.select(F.col(k).alias("id")), "id", renames).groupBy("id").agg(F.count("*").alias("n")).select(F.lit(t).alias("t"), "id", "n") for t, df, k in (("orders", o, "o_custkey"), ("customer", c, "c_custkey"))]
    return parts[0].unionAll(parts[1])


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 10 = 1 THEN 500 WHEN s_suppkey % 3 > 0 THEN s_nationkey::BIGINT ELSE s_suppkey END AS picked FROM supplier""")
def pins_and_conditional_writes(spark, sf_dir):
    """A value written only where there is none, then hand-set pins, an explicit null among them."""
    s = rows(spark, sf_dir, "SELECT s_suppkey, CASE WHEN s_suppkey % 3 > 0 THEN CAST(s_nationkey AS BIGINT) END AS held FROM {supplier}")
    s = s.select("s_suppkey", F.coalesce("held", "s_suppkey").alias("picked"))
    pins = rows(spark, sf_dir, "SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 1 THEN CAST(500 AS BIGINT) END AS picked FROM {supplier} WHERE s_suppkey % 10 < 2")
    return writes.pinned(s, pins, "s_suppkey", "picked")


@query("""WITH r AS (SELECT p_partkey, CASE WHEN p_size > 45 THEN 'held' WHEN p_type = 'PROMO' THEN 'review' WHEN p_size < 3 THEN 'new' ELSE 'kept' END AS role, p_name, p_brand FROM part)
SELECT role, p_partkey, row_number() OVER (PARTITION BY role ORDER BY p_brand, p_name, p_partkey)::INTEGER AS place FROM r WHERE role <> 'kept'""")
def review_files(spark, sf_dir):
    """The rows of each reviewers' file in the file's order."""
    p = table(spark, sf_dir, "part")
    role = F.when(F.col("p_size") > 45, "held").when(F.col("p_type") == "PROMO", "review").when(F.col("p_size") < 3, "new")
    r = p.select("p_partkey", "p_brand", "p_name", role.alias("role")).where("role is not null")
    return r.select("role", "p_partkey", F.row_number().over(Window.partitionBy("role").orderBy("p_brand", "p_name", "p_partkey")).alias("place"))


@query("""SELECT c_nationkey, c_mktsegment, '[' || string_agg(DISTINCT b, ',' ORDER BY b) || ']' AS volumes FROM (SELECT c_nationkey, c_mktsegment, (c_custkey % 7)::VARCHAR AS b FROM customer) GROUP BY ALL""")
def snapshot_json(spark, sf_dir):
    """A library's holdings as sorted JSON arrays."""
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.array_sort(F.collect_set(F.col("c_custkey") % 7)).alias("v"))
    return c.select("c_nationkey", "c_mktsegment", F.to_json("v").alias("volumes"))


@query("""WITH e AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '[1, 2, 3]' WHEN 1 THEN '[]' WHEN 2 THEN '[1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]' WHEN 3 THEN '["x"]' ELSE '[7]' END AS parts FROM events) SELECT event_id, event_id % 5 IN (0, 4) AS valid FROM e""")
def json_array_valid(spark, sf_dir):
    """JSON arrays of one to twelve integers."""
    e = rows(spark, sf_dir, "SELECT event_id, CASE event_id % 5 WHEN 0 THEN '[1, 2, 3]' WHEN 1 THEN '[]' WHEN 2 THEN '[1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]' WHEN 3 THEN '[\"x\"]' ELSE '[7]' END AS parts FROM {events}")
    ints = F.from_json("parts", "array<string>")
    fine = F.size(ints).between(1, 12) & F.forall(ints, lambda x: x.rlike("^-?[0-9]+$"))
    return e.select("event_id", F.coalesce(fine, F.lit(False)).alias("valid"))


@query("""WITH RECURSIVE b AS (SELECT c_nationkey, 'c_' || c_nationkey || '_' || (c_custkey % 40) AS name, min(c_custkey) AS first FROM customer GROUP BY ALL), h AS (SELECT *, (('0x' || substr(sha256(name), 1, 8))::BIGINT & 255) AS slot FROM b)
SELECT count(*) AS names, count(DISTINCT slot) AS slots, count(*) AS probed FROM h""")
def probed_ids(spark, sf_dir):
    """Small integers hashed from names, salted again until no two are equal: as many as there are names."""
    c = rows(spark, sf_dir, "SELECT DISTINCT 'c_' || c_nationkey || '_' || (c_custkey % 40) AS name FROM {customer}")
    ids = probed_ints(c, "name", bits=16)
    slots = c.select(F.conv(F.substring(F.sha2("name", 256), 1, 8), 16, 10).cast("bigint").bitwiseAND(255).alias("s")).distinct().agg(F.count("*").alias("slots"))
    return ids.agg(F.count("*").alias("names"), F.count_distinct("id").alias("probed")).join(slots, F.lit(True)).select("names", "slots", "probed")
