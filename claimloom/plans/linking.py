"""Composite linkage, identity and serving queries over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.functions import keys
from claimloom.operators import linkage
from claimloom.plans.catalogue import QUERIES, query
from claimloom.session import dealt, table

_K = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH i AS (SELECT p_partkey, {_K.format('p_name')} AS k, p_brand, p_size FROM part), q AS (SELECT p_partkey AS q, CASE p_partkey % 3 WHEN 0 THEN {_K.format('p_name')} WHEN 1 THEN substr({_K.format('p_name')}, 1, 7) ELSE {_K.format('p_name')} || ' ' || p_partkey END AS k, p_brand AS a FROM part),
i2 AS (SELECT p_partkey, k, p_brand FROM i UNION ALL SELECT p_partkey, k || ' ' || p_partkey, p_brand FROM i WHERE p_size % 2 = 0), a AS (SELECT p_partkey, substr(k, 1, 7) AS k FROM i),
o AS (SELECT q, count(*) AS official, count_if(a = p_brand) AS authors FROM q JOIN i2 USING (k) GROUP BY q), l AS (SELECT q, count(*) AS alias FROM q JOIN a USING (k) GROUP BY q)
SELECT q, coalesce(official, 0)::BIGINT AS official, coalesce(alias, 0)::BIGINT AS alias, CASE WHEN official = 1 AND authors > 0 THEN 'high' WHEN official = 1 THEN 'medium' WHEN official IS NULL AND alias = 1 THEN 'low'
WHEN official > 1 OR alias > 1 THEN 'ambiguous' ELSE 'none' END AS tier, CASE WHEN official IS NOT NULL THEN 'official' WHEN alias IS NOT NULL THEN 'alias' END AS via FROM q LEFT JOIN o USING (q) LEFT JOIN l USING (q)""")
def link_tiers(spark, sf_dir):
    """Official keys, then alias keys, with shared authors as evidence; the index is counted per key before it is joined."""
    p = table(spark, sf_dir, "part").withColumn("k", keys.ascii_key(F.col("p_name")))
    own = F.concat_ws(" ", "k", "p_partkey")
    q = p.select(F.col("p_partkey").alias("q"), F.when(F.col("p_partkey") % 3 == 0, F.col("k")).when(F.col("p_partkey") % 3 == 1, F.substring("k", 1, 7)).otherwise(own).alias("k"), F.col("p_brand").alias("a"))
    index = p.select("k", "p_brand").unionAll(p.where("p_size % 2 = 0").select(own, "p_brand")).groupBy("k", F.col("p_brand").alias("a")).agg(F.count("*").alias("authors"))
    official = index.groupBy("k").agg(F.sum("authors").alias("official"))
    alias = p.groupBy(F.substring("k", 1, 7).alias("k")).agg(F.count("*").alias("alias"))
    out = q.join(official, "k", "left").join(alias, "k", "left").join(index, ["k", "a"], "left").fillna(0, ["official", "alias", "authors"])
    via = F.when(F.col("official") > 0, "official").when(F.col("alias") > 0, "alias")
    return out.select("q", "official", "alias", linkage.tier(F.col("official"), F.col("alias"), F.col("authors")).alias("tier"), via.alias("via"))


@query(f"""WITH c AS (SELECT p_partkey, p_size, p_brand, {_K.format('p_name')} AS k FROM part), q AS (SELECT DISTINCT p_brand, substr({_K.format('p_name')}, 1, 5) AS q FROM part),
m AS (SELECT q.p_brand, q, p_partkey, p_size, CASE WHEN k = q THEN 1 WHEN starts_with(k, q) THEN 2 WHEN contains(k, q) THEN 3 END AS cls FROM q JOIN c USING (p_brand))
SELECT p_brand, q, p_partkey, cls::INTEGER AS cls, count(*) OVER (PARTITION BY p_brand, q, cls) = 1 AS alone FROM m WHERE cls IS NOT NULL QUALIFY row_number() OVER (PARTITION BY p_brand, q ORDER BY cls, p_size DESC, p_partkey) = 1""")
def title_ranker(spark, sf_dir):
    """Exact before prefix before substring, then popularity; a flag says whether the class had one candidate only."""
    p = table(spark, sf_dir, "part").withColumn("k", keys.ascii_key(F.col("p_name")))
    q = p.select("p_brand", F.substring("k", 1, 5).alias("q")).distinct()
    m = q.join(p.select("p_brand", "p_partkey", "p_size", "k"), "p_brand")
    cls = F.when(F.col("k") == F.col("q"), 1).when(F.startswith("k", F.col("q")), 2).when(F.contains("k", F.col("q")), 3)
    m = m.withColumn("cls", cls).where("cls is not null")
    m = m.withColumn("alone", F.count("*").over(Window.partitionBy("p_brand", "q", "cls")) == 1)
    rank = F.row_number().over(Window.partitionBy("p_brand", "q").orderBy("cls", F.desc("p_size"), "p_partkey"))
    return m.withColumn("r", rank).where("r = 1").select("p_brand", "q", "p_partkey", "cls", "alone")


_VOTES = """SELECT a.l_suppkey AS mine, b.o_custkey AS theirs, count(DISTINCT b.o_orderkey) AS shared FROM lineitem a JOIN orders b ON l_orderkey = o_orderkey GROUP BY ALL"""


def _votes(spark, sf_dir):
    """Orders that a supplier and a customer share, beside all that the customer has, so that weak votes go before they are shuffled again.

    Lines and orders are dealt by order, then votes by both ends: each task holds a share of the lines, however few the bytes of a file.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("theirs"))
    sized = o.join(o.groupBy("theirs").agg(F.count("*").alias("nt")), "theirs")
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("mine"))
    met = dealt(line, "l_orderkey").join(dealt(sized, "o_orderkey").hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    once = met.select("mine", "theirs", "nt", "o_orderkey").distinct()
    return dealt(once.select("mine", "theirs", "nt"), "mine", "theirs").groupBy("mine", "theirs", "nt").agg(F.count("*").alias("shared"))


@query(f"""WITH v AS ({_VOTES}), n AS (SELECT o_custkey AS theirs, count(*) AS nt FROM orders GROUP BY 1), f AS (SELECT mine, theirs, shared FROM v JOIN n USING (theirs) WHERE 2 * shared >= least(50, nt)),
b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY mine ORDER BY shared DESC, theirs) = 1)
SELECT mine, theirs, shared, CASE WHEN row_number() OVER (PARTITION BY theirs ORDER BY shared DESC, mine) = 1 THEN 'merged' ELSE 'sibling' END AS role FROM b""")
def attach_roles(spark, sf_dir):
    v = _votes(spark, sf_dir).withColumn("nm", F.lit(50))
    return linkage.attach_roles(v, "mine", "theirs", "shared", "nm", "nt").select("mine", "theirs", "shared", "role")


_MOVED = "CASE WHEN o_orderkey % 4 = 0 THEN o_custkey + 1 ELSE o_custkey - o_custkey % 2 END"
_ADOPTIONS = f"""SELECT * FROM (SELECT o_custkey AS mine, {_MOVED} AS theirs, count(*) AS shared FROM orders GROUP BY ALL) JOIN (SELECT o_custkey AS mine, count(*) AS n FROM orders GROUP BY 1) USING (mine) WHERE 2 * shared > n"""


@query(f"""WITH RECURSIVE v AS ({_ADOPTIONS}), g AS (SELECT 0 AS step, {{'s': 0::BIGINT, 'm': 0::BIGINT, 't': 0::BIGINT}} AS b, []::BIGINT[] AS um, []::BIGINT[] AS ut
UNION ALL SELECT step + 1, b2, list_append(um, b2.m), list_append(ut, b2.t) FROM (SELECT step, um, ut, min({{'s': -shared, 'm': mine, 't': theirs}}) AS b2 FROM g, v WHERE NOT list_contains(um, mine) AND NOT list_contains(ut, theirs) GROUP BY step, um, ut))
SELECT b.m AS mine, b.t AS theirs, -b.s AS shared FROM g WHERE step > 0""")
def greedy_adoption(spark, sf_dir):
    """One-to-one adoption of owners that share a strict majority of the older one's keys, best pairs first."""
    o = table(spark, sf_dir, "orders")
    votes = o.groupBy(F.col("o_custkey").alias("mine"), F.expr(_MOVED).alias("theirs")).agg(F.count("*").alias("shared"))
    n = o.groupBy(F.col("o_custkey").alias("mine")).agg(F.count("*").alias("n"))
    return linkage.one_to_one(votes.join(n, "mine").where("2 * shared > n"), "mine", "theirs", "shared")


@query("""WITH RECURSIVE o AS (SELECT o_orderkey AS k, o_custkey AS g, strftime(o_orderdate, '%Y-%m-%d') AS d, CASE WHEN o_orderkey % 60 = 0 THEN o_orderstatus END AS v FROM orders),
s AS (SELECT 0 AS i, k, g, d, v FROM o UNION ALL SELECT i + 1, k, g, d, coalesce(w, CASE WHEN min(w) OVER (PARTITION BY d) = max(w) OVER (PARTITION BY d) THEN min(w) OVER (PARTITION BY d) END)
  FROM (SELECT i, k, g, d, coalesce(v, CASE WHEN min(v) OVER (PARTITION BY g) = max(v) OVER (PARTITION BY g) THEN min(v) OVER (PARTITION BY g) END) AS w FROM s) WHERE i < 12)
SELECT k AS o_orderkey, g AS o_custkey, d AS day, v AS status FROM s WHERE i = 12""")
def spread_fixpoint(spark, sf_dir):
    """A status spreads over customers and days of orders until nothing changes (the SQL makes twelve passes)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.when(F.col("o_orderkey") % 60 == 0, F.col("o_orderstatus")).alias("status"))
    return linkage.spread(o, "o_orderkey", ["o_custkey", "day"], "status")


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n, max(l_partkey) AS p FROM lineitem GROUP BY ALL), c AS (SELECT * FROM l WHERE (k % 2 = 0 AND n > 2) OR (k % 2 = 1 AND n < 3)), t AS (SELECT * FROM l WHERE k % 2 = 1 OR n <= 2),
m AS (SELECT k, count(*) AS met, count_if(c.p <> t.p) AS clash FROM c JOIN t USING (k, n) GROUP BY k), a AS (SELECT k, min(n) AS lo, count(*) AS cn FROM c GROUP BY k), b AS (SELECT k, max(n) AS hi FROM t GROUP BY k)
SELECT k, CASE WHEN coalesce(met, 0) = 0 AND lo = hi + 1 THEN 'extend' WHEN coalesce(met, 0) = cn AND coalesce(clash, 0) = 0 THEN 'duplicate' ELSE 'kept' END AS verdict FROM a JOIN b USING (k) LEFT JOIN m USING (k)""")
def fold_verdicts(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.max("l_partkey").alias("p"))
    c = line.where("(k % 2 = 0 and n > 2) or (k % 2 = 1 and n < 3)")
    return linkage.fold_verdicts(c, line.where("k % 2 = 1 or n <= 2"), "k", "n", "p")


@query(f"""WITH p AS (SELECT p_partkey, p_brand, {_K.format('p_name')} AS k FROM part) SELECT p_partkey, count(*) OVER (PARTITION BY p_brand, k) > 1 AS clash, min(p_partkey) OVER (PARTITION BY k) AS owner FROM p""")
def name_collisions(spark, sf_dir):
    """Names that clash within their group, and the owner of the name over all groups; counted first, then joined."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", keys.ascii_key(F.col("p_name")).alias("k"))
    each = p.groupBy("k", "p_brand").agg(F.count("*").alias("n"), F.min("p_partkey").alias("o"))
    owner = each.groupBy("k").agg(F.min("o").alias("owner"))
    return p.join(each.select("k", "p_brand", "n"), ["k", "p_brand"]).join(owner, "k").select("p_partkey", (F.col("n") > 1).alias("clash"), "owner")


@query("""SELECT o_custkey, coalesce(max(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END), max(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END), max(o_orderkey)) AS cover,
(list(o_orderkey ORDER BY (o_orderstatus <> 'F'), o_totalprice DESC, o_orderkey))[1] AS choice FROM orders GROUP BY o_custkey""")
def source_priority_choice(spark, sf_dir):
    """The value of the best source that has one; and a choice by a struct of preferences."""
    of = lambda s: F.max(F.when(F.col("o_orderstatus") == s, F.col("o_orderkey")))
    rank = F.struct(F.col("o_orderstatus") != "F", -F.col("o_totalprice"), F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.coalesce(of("P"), of("O"), F.max("o_orderkey")).alias("cover"), F.min_by("o_orderkey", rank).alias("choice"))


@query("""WITH v AS (SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN 'Ex' ELSE l_linenumber::VARCHAR END AS number, l_partkey FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, number ORDER BY l_partkey) AS rn FROM v)
SELECT l_orderkey, number, min(l_partkey) AS l_partkey, CASE WHEN TRY_CAST(number AS INTEGER) >= 0 THEN 'volumes' ELSE 'special' END AS target FROM r WHERE rn = 1 GROUP BY ALL""")
def serving_split(spark, sf_dir):
    """Non-negative integers go to the serving table, other labels to a side table; the first of a number is exported."""
    number = F.when(F.col("l_linenumber") == 7, "Ex").otherwise(F.col("l_linenumber").cast("string"))
    v = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", number.alias("number")).agg(F.min("l_partkey").alias("l_partkey"))
    return v.withColumn("target", F.when(F.col("number").try_cast("int") >= 0, "volumes").otherwise("special"))


@query(f"""SELECT DISTINCT p_brand, unnest(list_distinct([p_name, {_K.format('p_name')}])) AS alias FROM part""")
def alias_table(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_brand", F.explode(keys.alias_variants(F.col("p_name"))).alias("alias")).distinct()


@query("""SELECT s_suppkey, CASE WHEN n >= 400 AND q > 25 THEN 'kept' WHEN n >= 400 THEN 'review' WHEN n IS NULL THEN 'unseen' ELSE 'held' END AS role FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n, avg(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey""")
def role_cascade(spark, sf_dir):
    by = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"), F.avg("l_quantity").alias("q"))
    role = F.when((F.col("n") >= 400) & (F.col("q") > 25), "kept").when(F.col("n") >= 400, "review").when(F.col("n").isNull(), "unseen").otherwise("held")
    return table(spark, sf_dir, "supplier").select("s_suppkey").join(by, "s_suppkey", "left").select("s_suppkey", role.alias("role"))


@query("""WITH old AS (SELECT o_orderkey AS id, o_custkey FROM orders WHERE o_orderkey % 9 <> 0), new AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 8 <> 0), g AS (SELECT * FROM old WHERE id NOT IN (SELECT id FROM new)),
s AS (SELECT o_custkey, min(id) AS succ FROM old WHERE id IN (SELECT id FROM new) GROUP BY 1)
SELECT id AS old_id, succ AS new_id, CASE WHEN succ IS NULL THEN 'retired' ELSE 'moved' END AS reason FROM g LEFT JOIN s USING (o_custkey)""")
def id_contract(spark, sf_dir):
    """Every previous id is present or redirected to a present one; what has no successor is reported as retired."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    old, new = o.where("id % 9 <> 0"), o.where("id % 8 <> 0").select("id")
    heir = old.join(new, "id", "left_semi").groupBy("o_custkey").agg(F.min("id").alias("new_id"))
    gone = old.join(new, "id", "left_anti").join(heir, "o_custkey", "left")
    return gone.select(F.col("id").alias("old_id"), "new_id", F.when(F.col("new_id").isNull(), "retired").otherwise("moved").alias("reason"))


__all__ = ["QUERIES"]
