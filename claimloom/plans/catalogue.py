"""The catalogue operators as named queries over the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.functions import keys
from claimloom.operators import claims, graph, linkage, runs
from claimloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- claims and their resolution -------------------------------------------------------------

ORDER = ["s4", "s0", "s1", "s2", "s3"]
_CLAIMS_SQL = """
SELECT 'part' AS entity, l_partkey::VARCHAR AS entity_id, 'ship_date' AS field, 's' || (l_suppkey % 5) AS source,
  CASE l_suppkey % 5 WHEN 3 THEN substr(min(d), 1, 4) WHEN 2 THEN substr(min(d), 1, 7) ELSE min(d) END AS value,
  CASE WHEN l_suppkey % 5 < 3 THEN 'open' ELSE 'restricted' END AS licence
FROM (SELECT *, strftime(CASE WHEN l_partkey % 11 = 0 THEN TIMESTAMP '1996-03-05' + to_days((7 * (l_suppkey % 5) * (l_partkey % 5))::INTEGER)
    WHEN l_partkey % 13 = 0 THEN TIMESTAMP '1997-08-01' + to_days((l_suppkey % 3)::INTEGER) ELSE l_shipdate END, '%Y-%m-%d') AS d
  FROM lineitem WHERE l_partkey % 7 <> 0 OR l_suppkey % 5 = 1) GROUP BY l_partkey, l_suppkey % 5
UNION ALL SELECT 'part', p_partkey::VARCHAR, 'brand', 's0', p_brand, 'open' FROM part
UNION ALL SELECT 'part', p_partkey::VARCHAR, 'brand', 's3', CASE WHEN p_partkey % 4 = 0 THEN p_type ELSE p_brand END, 'restricted' FROM part WHERE p_partkey % 3 = 0
"""


def part_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, in five sources of differing precision, assert a part's first ship date; two sources its brand."""
    s = (F.col("l_suppkey") % 5).cast("int")
    k = F.col("l_partkey")
    d = (
        F.when(k % 11 == 0, F.expr("date_add(date'1996-03-05', cast(7 * (l_suppkey % 5) * (l_partkey % 5) as int))"))
        .when(k % 13 == 0, F.expr("date_add(date'1997-08-01', cast(l_suppkey % 3 as int))"))
        .otherwise(F.to_date("l_shipdate"))
    )
    first = table(spark, sf_dir, "lineitem").where((k % 7 != 0) | (s == 1)).groupBy("l_partkey", s.alias("s")).agg(F.date_format(F.min(d), "yyyy-MM-dd").alias("d"))
    value = F.when(F.col("s") == 3, F.substring("d", 1, 4)).when(F.col("s") == 2, F.substring("d", 1, 7)).otherwise(F.col("d"))
    head = lambda key, field: [F.lit("part").alias("entity"), F.col(key).cast("string").alias("entity_id"), F.lit(field).alias("field")]
    dates = first.select(*head("l_partkey", "ship_date"), F.concat(F.lit("s"), "s").alias("source"), value.alias("value"), F.when(F.col("s") < 3, "open").otherwise("restricted").alias("licence"))
    part = table(spark, sf_dir, "part")
    own = part.select(*head("p_partkey", "brand"), F.lit("s0").alias("source"), F.col("p_brand").alias("value"), F.lit("open").alias("licence"))
    other = F.when(F.col("p_partkey") % 4 == 0, F.col("p_type")).otherwise(F.col("p_brand"))
    more = part.where("p_partkey % 3 = 0").select(*head("p_partkey", "brand"), F.lit("s3").alias("source"), other.alias("value"), F.lit("restricted").alias("licence"))
    return dates.unionAll(own).unionAll(more)


@query(f"""
WITH c AS ({_CLAIMS_SQL}), r AS (SELECT *, CASE source WHEN 's4' THEN 0 WHEN 's0' THEN 1 WHEN 's1' THEN 2 WHEN 's2' THEN 3 ELSE 4 END AS r FROM c),
g AS (SELECT entity, entity_id, field, list({{'r': r, 's': source, 'v': value}} ORDER BY r) AS c, list(value ORDER BY r) AS vs, count(DISTINCT source) AS n_sources,
  count(DISTINCT value) AS nv, min(length(value)) AS least, max(length(value)) AS finest FROM r GROUP BY ALL),
o AS (SELECT a.entity_id, a.field, max(abs(date_diff('day', a.value::DATE, b.value::DATE))) AS most, bool_and(date_diff('day', a.value::DATE, b.value::DATE) % 7 = 0) AS weekly, count(DISTINCT a.value) AS nd
  FROM r a JOIN r b ON a.entity_id = b.entity_id AND a.field = b.field AND a.value <> b.value AND length(a.value) = 10 AND length(b.value) = 10 WHERE a.field = 'ship_date' GROUP BY ALL),
b AS (SELECT g.*, CASE WHEN nv = 1 AND n_sources > 1 THEN 'agreed' WHEN nv = 1 THEN 'single_source' WHEN field <> 'ship_date' THEN 'conflict'
  WHEN len(list_distinct(list_transform(vs, lambda v: substr(v, 1, least)))) = 1 THEN 'agreed_coarse' WHEN o.nd IS NULL THEN
    CASE WHEN len(list_distinct(list_filter(vs, lambda v: length(v) = 10))) < 2 THEN 'single_source' END
  WHEN weekly AND most <= 42 THEN 'semantic_variance' WHEN weekly THEN 'escalated' WHEN most <= 7 THEN 'minor_variance' ELSE 'conflict' END AS basis
  FROM g LEFT JOIN o USING (entity_id, field)),
v AS (SELECT *, CASE WHEN nv > 1 AND basis = 'agreed_coarse' THEN list_filter(vs, lambda v: length(v) = finest)[1]
  WHEN nv > 1 AND field = 'ship_date' AND c[1].s = 's3' AND finest > 4 THEN list_filter(vs, lambda v: length(v) > 4)[1] ELSE vs[1] END AS val FROM b)
SELECT entity, entity_id, field, CASE WHEN pin THEN '1999-09-09' ELSE val END AS value,
  CASE WHEN pin THEN 1.0 ELSE CASE basis WHEN 'agreed' THEN 0.97 WHEN 'single_source' THEN 0.70 WHEN 'agreed_coarse' THEN 0.90 WHEN 'semantic_variance' THEN 0.88
    WHEN 'escalated' THEN 0.40 WHEN 'minor_variance' THEN 0.65 ELSE CASE WHEN field = 'ship_date' THEN 0.30 ELSE 0.50 END END END::DOUBLE AS confidence,
  CASE WHEN pin THEN 'manual_override' ELSE basis END AS basis, CASE WHEN pin THEN 1 ELSE len(list_filter(vs, lambda x: x = val)) END::INTEGER AS n_agree,
  CASE WHEN pin THEN 1 ELSE n_sources END::INTEGER AS n_sources,
  CASE WHEN NOT pin AND nv > 1 THEN array_to_string(list_transform(c, lambda x: x.s || '=' || x.v), ' | ') END AS notes
FROM (SELECT *, field = 'ship_date' AND entity_id::BIGINT % 97 = 0 AS pin FROM v)
""")
def resolve_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = part_claims(spark, sf_dir)
    pins = table(spark, sf_dir, "part").where("p_partkey % 97 = 0").select(
        F.lit("part").alias("entity"), F.col("p_partkey").cast("string").alias("entity_id"), F.lit("ship_date").alias("field"), F.lit("1999-09-09").alias("value")
    )
    return claims.resolve(c, ORDER, pins, year_sources=["s3"])


@query(f"SELECT * FROM ({_CLAIMS_SQL}) WHERE licence IN ('open')")
def licence_view(spark, sf_dir):
    return claims.licensed(part_claims(spark, sf_dir), ["open"])


@query(f"""WITH c AS ({_CLAIMS_SQL}) SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source = 's4' AND c.entity_id = p_partkey::VARCHAR)""")
def incremental_unclaimed(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("entity_id"))
    return claims.not_yet_claimed(parts, part_claims(spark, sf_dir), "s4").select("p_partkey")


@query(f"""WITH c AS ({_CLAIMS_SQL}), p AS (SELECT a.value AS x, b.value AS y FROM c a JOIN c b ON a.entity_id = b.entity_id AND a.field = b.field WHERE a.source = 's0' AND b.source = 's1')
SELECT count(*) AS both, count_if(x = y)::BIGINT AS agree, count_if(x <> y)::BIGINT AS disagree, round(count_if(x = y) / count(*), 6) AS rate FROM p""")
def agreement_rates(spark, sf_dir):
    c = part_claims(spark, sf_dir)
    a = c.where("source = 's0'").select("entity_id", "field", F.col("value").alias("x"))
    b = c.where("source = 's1'").select("entity_id", "field", F.col("value").alias("y"))
    return a.join(b, ["entity_id", "field"]).agg(
        F.count("*").alias("both"), F.count_if(F.expr("x = y")).alias("agree"), F.count_if(F.expr("x <> y")).alias("disagree"), F.round(F.count_if(F.expr("x = y")) / F.count("*"), 6).alias("rate")
    )


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN strftime(DATE '1999-01-01' + (p_partkey % 400)::INTEGER, '%Y-%m-%d') ELSE '1999-06' END AS value,
  CASE WHEN p_partkey % 3 = 0 THEN 'published' ELSE 'projected' END AS kind FROM part""")
def projected_replaced(spark, sf_dir):
    """A projected month gives way to a plausible real date that has come."""
    p = table(spark, sf_dir, "part").withColumn("projected", F.lit("1999-06"))
    real = F.when(F.col("p_partkey") % 3 == 0, F.date_format(F.expr("date_add(date'1999-01-01', cast(p_partkey % 400 as int))"), "yyyy-MM-dd"))
    p = p.withColumn("real", real)
    ok = F.col("real").isNotNull() & keys.dated_by(F.col("real"), "2024-01-01") & (F.abs(F.substring("real", 1, 4).cast("int") - F.substring("projected", 1, 4).cast("int")) <= 1)
    return p.select("p_partkey", F.when(ok, F.col("real")).otherwise(F.col("projected")).alias("value"), F.when(ok, "published").otherwise("projected").alias("kind"))


# --- sinks modelled as pure functions --------------------------------------------------------


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, 'X', o_totalprice * 2 FROM orders WHERE o_orderkey % 3 = 0""")
def upsert_last_wins(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return claims.upsert(o, new, ["o_orderkey"])


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def insert_first_wins(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return claims.first_wins(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS was, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'Z' ELSE o_orderstatus END AS now,
CASE WHEN o_orderkey % 10 = 0 THEN 'added' WHEN o_orderkey % 7 = 0 THEN 'removed' WHEN o_orderkey % 4 = 0 THEN 'changed' ELSE 'same' END AS change FROM orders WHERE NOT (o_orderkey % 10 = 0 AND o_orderkey % 7 = 0)""")
def snapshot_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    new = o.where("o_orderkey % 7 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, "Z").otherwise(F.col("o_orderstatus")))
    return claims.snapshot_diff(o.where("o_orderkey % 10 <> 0"), new, "o_orderkey", "o_orderstatus")


@query("""SELECT was, now, count(*) AS n FROM (SELECT o_orderstatus AS was, CASE WHEN o_orderkey % 4 = 0 THEN 'Z' ELSE o_orderstatus END AS now FROM orders) GROUP BY ALL""")
def transition_matrix(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    new = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, "Z").otherwise(F.col("o_orderstatus")))
    return claims.snapshot_diff(o, new, "o_orderkey", "o_orderstatus").groupBy("was", "now").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, 'k' || l_linenumber AS field, CASE l_linenumber % 2 WHEN 0 THEN l_returnflag ELSE l_linestatus END AS value FROM lineitem""")
def volume_to_claims(spark, sf_dir):
    """Wide rows become tall claims; the field and its value depend on the row."""
    r = table(spark, sf_dir, "lineitem")
    v = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag")).otherwise(F.col("l_linestatus"))
    return r.select("l_orderkey", F.concat(F.lit("k"), "l_linenumber").alias("field"), v.alias("value"))


# --- filters and gates -------------------------------------------------------------------------

#: table -> (rule, kind, condition); the conditions read alike in both engines.
_ROW_RULES = {
    "lineitem": [
        ("new_year_ship", "expected", "month(l_shipdate) = 1 AND day(l_shipdate) = 1"), ("tiny_quantity", "info", "l_quantity < 2"), ("full_discount", "honest", "l_discount >= 0.1"),
        ("returned_and_open", "defect", "l_returnflag = 'R' AND l_linestatus = 'O'"), ("no_tax", "honest", "l_tax = 0"), ("free_line", "defect", "l_extendedprice <= 0"), ("late_ship", "expected", "year(l_shipdate) > 2000"),
    ],
    "orders": [("cheap_order", "info", "o_totalprice < 1000"), ("unspecified", "honest", "o_orderpriority LIKE '4%'"), ("pending", "expected", "o_orderstatus = 'P'"), ("no_customer", "defect", "o_custkey IS NULL")],
    "customer": [("negative_balance", "honest", "c_acctbal < 0"), ("unnamed_customer", "defect", "coalesce(c_name, '') = ''"), ("rich_customer", "info", "c_acctbal > 9000")],
    "part": [("digit_names", "info", "p_name LIKE '%0%' OR p_name LIKE '%1%'"), ("brandless", "defect", "coalesce(p_brand, '') = ''"), ("markup_names", "defect", "p_name LIKE '%[[%' OR p_name LIKE '%{{%' OR p_name LIKE '%<ref%'"), ("huge_size", "expected", "p_size > 45")],
    "supplier": [("supplier_in_debt", "honest", "s_acctbal < 0")],
    "pages": [("plain_http", "expected", "url LIKE 'http:%'"), ("untitled_page", "defect", "html NOT LIKE '%<title>%'")],
    "labels": [("toxic_and_good", "defect", "toxic = 1 AND quality = 1")],
    "documents": [("empty_text", "defect", "coalesce(text, '') = ''"), ("wrong_length", "defect", "length(text) <> n_chars")],
}
_GROUP_RULES = [
    ("orders_no_lines", "defect", "SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"),
    ("duplicate_lines", "defect", "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"),
    ("parts_of_many_suppliers", "info", "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 3)"),
    ("customers_without_orders", "expected", "SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"),
    ("repeated_names", "honest", "SELECT count(*) FROM (SELECT 1 FROM part GROUP BY p_brand, p_name HAVING count(*) > 1)"),
    ("nations_without_suppliers", "info", "SELECT count(*) FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)"),
]
_AUDIT_SQL = [f"SELECT '{n}' AS rule, '{k}' AS kind, ({q})::BIGINT AS n" for n, k, q in _GROUP_RULES]
_AUDIT_SQL += [f"SELECT '{n}', '{k}', count_if({q})::BIGINT FROM {t}" for t, rules in _ROW_RULES.items() for n, k, q in rules]


@query(" UNION ALL ".join(_AUDIT_SQL))
def audit_rules(spark, sf_dir):
    """Assertion queries of four kinds: a table's row rules are counted in one pass over it, rules on groups by one aggregation each."""
    o, line, c, p, n, s = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer", "part", "nation", "supplier"))
    many = lambda df, name: df.agg(F.count_if(F.col("k") > 1).alias(name))
    counted = [
        o.join(line, o.o_orderkey == line.l_orderkey, "left_anti").agg(F.count("*").alias("orders_no_lines")),
        many(line.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("k")), "duplicate_lines"),
        line.groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("k")).agg(F.count_if(F.col("k") > 3).alias("parts_of_many_suppliers")),
        c.join(o, c.c_custkey == o.o_custkey, "left_anti").agg(F.count("*").alias("customers_without_orders")),
        many(p.groupBy("p_brand", "p_name").agg(F.count("*").alias("k")), "repeated_names"),
        n.join(s, n.n_nationkey == s.s_nationkey, "left_anti").agg(F.count("*").alias("nations_without_suppliers")),
    ]
    counted += [table(spark, sf_dir, t).agg(*[F.count_if(F.expr(q)).alias(name) for name, _, q in rules]) for t, rules in _ROW_RULES.items()]
    kinds = {name: kind for name, kind, _ in [*_GROUP_RULES, *(r for rules in _ROW_RULES.values() for r in rules)]}
    # A row a rule out of the one row a table.
    tall = [df.select(F.explode(F.array(*[F.struct(F.lit(x).alias("rule"), F.lit(kinds[x]).alias("kind"), F.col(x).alias("n")) for x in df.columns])).alias("r")).select("r.*") for df in counted]
    return reduce(DataFrame.unionAll, tall)


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN strftime(l_shipdate, '%m-%d') = '01-01' THEN strftime(l_shipdate, '%Y') WHEN l_shipdate > TIMESTAMP '2000-06-30' THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS d,
CASE WHEN strftime(l_shipdate, '%m-%d') = '01-01' THEN 'year' WHEN l_shipdate > TIMESTAMP '2000-06-30' THEN NULL ELSE 'day' END AS prec FROM lineitem""")
def clean_dates(spark, sf_dir):
    """Fake first-of-January precision is reduced to the year; dates past a cutoff go (ISO strings compared as text)."""
    d = F.date_format("l_shipdate", "yyyy-MM-dd")
    v = F.when(F.endswith(d, F.lit("-01-01")), F.substring(d, 1, 4)).when(F.to_timestamp(F.lit("2000-06-30")) < F.col("l_shipdate"), None).otherwise(d)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", v.alias("d"), keys.precision(v).alias("prec"))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN p_size > 45 THEN 'too large' WHEN p_type LIKE '%ECONOMY%' THEN 'class' WHEN p_retailprice < 950 THEN 'cheap' ELSE 'kept' END AS reason FROM part) GROUP BY reason""")
def drop_reasons(spark, sf_dir):
    reason = F.when(F.col("p_size") > 45, "too large").when(F.contains("p_type", F.lit("ECONOMY")), "class").when(F.col("p_retailprice") < 950, "cheap").otherwise("kept")
    return table(spark, sf_dir, "part").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 50 = 0)""")
def exclusion_cascade(spark, sf_dir):
    """An excluded entity takes its dependants along: anti-joins down the hierarchy."""
    nations = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 50 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(F.broadcast(nations), "c_nationkey", "left_anti").join(orders, "c_custkey", "left_anti").select("c_custkey")


_COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "supplier": "s_suppkey s_name s_nationkey s_acctbal", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice", "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority", "events": "event_id ts user_id event_type value props",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate", "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label", "pages": "page_id url html", "benchmark": "item_id text", "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}


@query(" UNION ALL ".join(f"SELECT '{t}' AS t, '{c}' AS c, count({c}) AS n, count(*) AS rows FROM {t}" for t, cs in _COLUMNS.items() for c in cs.split()))
def non_null_counts(spark, sf_dir):
    """Non-null values of every column of every table, one pass a table."""
    out = []
    for t in _COLUMNS:
        df = table(spark, sf_dir, t)
        one = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(f"n_{c}") for c in df.columns])
        out.append(one.select("rows", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(c).alias("c"), F.col(f"n_{c}").alias("n")) for c in df.columns])).alias("r")).select("r.*", "rows"))
    return reduce(DataFrame.unionAll, out)


# --- joins ---------------------------------------------------------------------------------------


@query("SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def three_way_join(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    # Counted per nation before the small joins.
    by = c.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return by.join(n, by.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("n_name", "r_name", "n")


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def left_join_count(spark, sf_dir):
    by = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(by, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("""SELECT c_custkey, (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) AS latest FROM customer""")
def latest_per_entity(spark, sf_dir):
    """A correlated ORDER BY ... LIMIT 1 as max_by and a left join."""
    by = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(by, "c_custkey", "left")


@query("SELECT s_suppkey FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49)")
def semi_join(spark, sf_dir):
    big = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"))
    return table(spark, sf_dir, "supplier").join(big, "s_suppkey", "left_semi").select("s_suppkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def incremental_anti(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(done, "o_orderkey", "left_anti").select("o_orderkey")


@query("""WITH u AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL HAVING count(*) = 1)
SELECT l_linenumber, count(*) AS n, sum(l_partkey)::BIGINT AS s FROM orders JOIN u ON l_orderkey = o_orderkey GROUP BY l_linenumber""")
def unique_key_join(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").withColumn("k", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    rows = line.select("k", F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").distinct().join(table(spark, sf_dir, "orders"), "o_orderkey", "left_semi")
    return linkage.unique_key_join(rows, line, "k", "l_partkey").groupBy("l_linenumber").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("s"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS old, o_orderkey FROM orders WHERE o_orderkey % 5 > 0), b AS (SELECT DISTINCT CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 7 ELSE o_custkey END AS new, o_orderkey FROM orders),
n AS (SELECT old, count(*) AS n FROM a GROUP BY old), v AS (SELECT old, new, count(*) AS shared FROM a JOIN b USING (o_orderkey) GROUP BY ALL)
SELECT old, new, shared, n FROM v JOIN n USING (old) WHERE 2 * shared > n""")
def majority_overlap(spark, sf_dir):
    """Owners of two snapshots that share a strict majority of the older one's keys."""
    o = table(spark, sf_dir, "orders")
    moved = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") % 7).otherwise(F.col("o_custkey")))
    return linkage.majority_overlap(o.where("o_orderkey % 5 > 0"), moved, "o_custkey", "o_orderkey")


@query("""SELECT c_custkey, coalesce(x, y, z) AS v, CASE WHEN x IS NOT NULL THEN 1 WHEN y IS NOT NULL THEN 2 WHEN z IS NOT NULL THEN 3 END::INTEGER AS via FROM customer
LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS x FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) a ON a.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS y FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1) b ON b.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS z FROM orders GROUP BY 1) c ON c.o_custkey = c_custkey""")
def cascade_fallback(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("c_custkey", F.col("o_custkey"))
    best = lambda df: df.groupBy("c_custkey").agg(F.min("o_orderkey").alias("v"))
    return linkage.cascade(table(spark, sf_dir, "customer").select("c_custkey"), [best(o.where("o_orderstatus = 'P'")), best(o.where("o_orderpriority like '1%'")), best(o)], "c_custkey", "v")


@query("""WITH s AS (SELECT DISTINCT substr(p_name, 1, 8) AS k FROM part WHERE length(p_name) > 8), n AS (SELECT DISTINCT p_name FROM part)
SELECT k, count(*) AS n FROM s JOIN n ON starts_with(p_name, k) GROUP BY k""")
def prefix_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    short = p.where("length(p_name) > 8").select(F.substring("p_name", 1, 8).alias("k")).distinct()
    return linkage.prefix_join(short, p.select("p_name").distinct(), "k", "p_name", 6).groupBy("k").agg(F.count("*").alias("n"))


@query("""WITH n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT substr(p_name, 1, 5) FROM part UNION SELECT DISTINCT substr(p_name, 1, 9) FROM part)
SELECT a.name, arg_max(b.name, length(b.name)) AS parent FROM n a JOIN n b ON starts_with(a.name, b.name) AND length(b.name) < length(a.name) AND length(b.name) >= 5 GROUP BY a.name""")
def longest_prefix(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    names = p.select(F.col("p_name").alias("name")).union(p.select(F.substring("p_name", 1, 5))).union(p.select(F.substring("p_name", 1, 9))).distinct()
    return linkage.longest_prefix(names, names, 5)


@query("""WITH n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT substr(p_name, 2) FROM part UNION SELECT DISTINCT c_name FROM customer)
SELECT a.name, b.name AS other, levenshtein(a.name, b.name)::INTEGER AS distance FROM n a JOIN n b ON a.name < b.name AND abs(length(a.name) - length(b.name)) <= 1 AND levenshtein(a.name, b.name) <= 1""")
def near_names(spark, sf_dir):
    p, c = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    names = p.select(F.col("p_name").alias("name")).union(p.select(F.expr("substr(p_name, 2)"))).union(c.select("c_name"))
    return linkage.near_names(names)


@query("""WITH d AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ' AS t FROM documents), b AS (SELECT item_id, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ' AS t FROM benchmark)
SELECT item_id, doc_id FROM d JOIN b ON contains(d.t, b.t)""")
def contamination(spark, sf_dir):
    """Benchmark passages contained in documents, whole words: an equi-join on the hash of the passage's first words, then the residual."""
    return linkage.contained(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "doc_id")


@query("""WITH i AS (SELECT p_partkey, trim(regexp_replace(lower(CASE p_partkey % 3 WHEN 0 THEN split_part(p_name, ' ', 1) WHEN 1 THEN p_name ELSE p_name || ' and old ' || p_name END), '[^a-z0-9]+', ' ', 'g')) AS k FROM part),
n AS (SELECT DISTINCT p_partkey AS q, trim(regexp_replace(lower(p_name || ' and old ' || p_name || ' by ' || p_type), '[^a-z0-9]+', ' ', 'g')) AS t FROM part WHERE p_size > 0)
SELECT p_partkey AS item, count(DISTINCT t) AS texts FROM i JOIN n ON contains(' ' || t || ' ', ' ' || k || ' ') GROUP BY p_partkey""")
def short_needles(spark, sf_dir):
    """Needles of one, two and more words found in names."""
    p = table(spark, sf_dir, "part")
    short = F.when(F.col("p_partkey") % 3 == 0, F.substring_index("p_name", " ", 1)).when(F.col("p_partkey") % 3 == 1, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" and old "), "p_name"))
    texts = p.select(F.concat("p_name", F.lit(" and old "), "p_name", F.lit(" by "), "p_type").alias("text")).distinct().withColumn("doc", F.xxhash64("text"))
    needles = p.select("p_partkey", short.alias("text"))
    # Equal needles are looked up once.
    once = linkage.contained(needles.select("text").distinct().withColumn("needle", F.col("text")), texts, "needle", "doc").groupBy("needle").agg(F.count("*").alias("texts"))
    return needles.join(once, needles.text == once.needle).select(F.col("p_partkey").alias("item"), "texts")


# --- aggregations ------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_having(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 3")
def distinct_having(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("n")).where("n > 3")


@query("SELECT count(*) AS groups, sum(n)::BIGINT AS in_groups FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 4)")
def nested_aggregate(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).where("n > 4").agg(F.count("*").alias("groups"), F.sum("n").alias("in_groups"))


@query("""SELECT l_orderkey, l_linenumber, min(strftime(l_shipdate, '%Y-%m-%d')) AS first, max(strftime(l_shipdate, '%Y-%m-%d')) AS last, max(l_partkey) AS part, bool_and(l_returnflag = 'N') AS all_n FROM lineitem GROUP BY ALL""")
def multi_aggregate(spark, sf_dir):
    d = F.date_format("l_shipdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(d).alias("first"), F.max(d).alias("last"), F.max("l_partkey").alias("part"), F.every(F.col("l_returnflag") == "N").alias("all_n"))


@query("""SELECT c_nationkey, arg_max(c_mktsegment, [n, -p]) AS c_mktsegment, max(n) AS n FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_custkey) AS p FROM customer GROUP BY ALL) GROUP BY c_nationkey""")
def mode_first_seen(spark, sf_dir):
    return runs.mode_first_seen(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_mktsegment", "c_custkey")


@query("""WITH t AS (SELECT CASE WHEN count(*) OVER (PARTITION BY c_nationkey) < 60 THEN 'other' ELSE n_name END AS g, c_mktsegment AS m FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT g, count_if(m = 'BUILDING')::BIGINT AS building, count_if(m = 'MACHINERY')::BIGINT AS machinery, count(*) AS total FROM t GROUP BY g UNION ALL SELECT 'total', count_if(m = 'BUILDING')::BIGINT, count_if(m = 'MACHINERY')::BIGINT, count(*) FROM t""")
def crosstab_other(spark, sf_dir):
    """Groups under a threshold fold to other; counted per nation first, so the fold needs no window over rows."""
    c = table(spark, sf_dir, "customer")
    by = c.groupBy("c_nationkey").agg(F.count_if(F.col("c_mktsegment") == "BUILDING").alias("b"), F.count_if(F.col("c_mktsegment") == "MACHINERY").alias("m"), F.count("*").alias("n"))
    n = table(spark, sf_dir, "nation")
    named = by.join(F.broadcast(n), by.c_nationkey == n.n_nationkey).withColumn("g", F.when(F.col("n") < 60, "other").otherwise(F.col("n_name")))
    sums = [F.sum(x).alias(y) for x, y in (("b", "building"), ("m", "machinery"), ("n", "total"))]
    return named.groupBy("g").agg(*sums).unionAll(named.agg(*sums).select(F.lit("total").alias("g"), "building", "machinery", "total"))


@query("SELECT p_brand, list_sort(list(p_size))[(count(*) // 2)::INTEGER + 1]::INTEGER AS upper, median(p_size)::DOUBLE AS mid FROM part GROUP BY p_brand")
def upper_median(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.groupBy("p_brand").agg(F.median("p_size").alias("mid")).join(runs.upper_median(p, ["p_brand"], "p_size").withColumnRenamed("p_size", "upper"), "p_brand")


@query("SELECT p_brand, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS types FROM part GROUP BY p_brand")
def ordered_string_aggregate(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), "|").alias("types"))


@query("SELECT o_orderstatus, round(avg(CASE WHEN o_totalprice > 150000 THEN 1.0 ELSE 0.0 END), 6) AS share, avg(CASE WHEN o_totalprice > 150000 THEN 1.0 ELSE 0.0 END) >= 0.2 AS ok FROM orders GROUP BY o_orderstatus")
def share_floor(spark, sf_dir):
    s = F.avg(F.when(F.col("o_totalprice") > 150000, 1.0).otherwise(0.0))
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.round(s, 6).alias("share"), (s >= 0.2).alias("ok"))


# --- windows --------------------------------------------------------------------------------------------

_LINES = "SELECT l_orderkey, l_linenumber, arg_min(l_returnflag, [l_partkey, l_suppkey]) AS l_returnflag FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_partkey, l_suppkey FROM lineitem) GROUP BY ALL"


def _one_line(spark, sf_dir):
    # Dealt by order once: the windows over an order's lines need no other shuffle.
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey").repartition("l_orderkey")
    return line.groupBy("l_orderkey", "l_linenumber").agg(F.min_by("l_returnflag", F.struct("l_partkey", "l_suppkey", "l_returnflag")).alias("l_returnflag"))


_LINES = _LINES.replace("arg_min(l_returnflag, [l_partkey, l_suppkey])", "(list(l_returnflag ORDER BY l_partkey, l_suppkey, l_returnflag))[1]")


@query(f"""WITH l AS ({_LINES}), m AS (SELECT *, CASE WHEN l_linenumber = lag(l_linenumber) OVER w + 1 AND l_returnflag = lag(l_returnflag) OVER w THEN 0 ELSE 1 END AS new FROM l WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)),
r AS (SELECT *, sum(new) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)::BIGINT AS run FROM m)
SELECT l_orderkey, run, l_returnflag, min(l_linenumber) AS first, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) AS contains, count(*) AS n FROM r GROUP BY ALL""")
def collapse_runs(spark, sf_dir):
    return runs.collapse_runs(_one_line(spark, sf_dir), ["l_orderkey"], "l_linenumber", ["l_returnflag"])


@query("""WITH e AS (SELECT user_id, event_id, (floor(value)::BIGINT % 4)::INTEGER AS n FROM events), m AS (SELECT *, CASE WHEN n = lag(n) OVER w + 1 THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS run FROM m)
SELECT user_id, run, min(n) AS first, count(*) AS n FROM r GROUP BY user_id, run HAVING count(*) >= 2""")
def arc_restart(spark, sf_dir):
    """Ascending-by-one stretches of at least two; a restart opens a new one."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.expr("cast(floor(value) % 4 as int)").alias("n"))
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = e.withColumn("go", F.col("n") == F.lag("n").over(w) + 1)
    return runs.run_ids(e, ["user_id"], [F.col("event_id")], F.col("go")).groupBy("user_id", "run").agg(F.min("n").alias("first"), F.count("*").alias("n")).where("n >= 2")


@query("""SELECT user_id, event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS heading FROM events""")
def heading_as_of(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("h", F.when(F.col("event_type") == "purchase", F.col("event_id"))).withColumn("p", F.struct("ts", "event_id"))
    return e.select("user_id", "event_id", runs.heading_at(e, ["user_id"], "p", "h").alias("heading"))


@query("""WITH s AS (SELECT s_nationkey, p_type, l_suppkey, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT s_nationkey, p_type, l_suppkey, n FROM s QUALIFY row_number() OVER (PARTITION BY s_nationkey, p_type ORDER BY n DESC, l_suppkey) = 1""")
def main_line(spark, sf_dir):
    """The main supplier of each (nation, type): most lines, then the smallest id."""
    line, s, p = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "part"))
    by = line.join(p, line.l_partkey == p.p_partkey).groupBy("l_suppkey", "p_type").agg(F.count("*").alias("n")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return runs.top_per_group(by, ["s_nationkey", "p_type"], [F.desc("n"), F.col("l_suppkey")]).select("s_nationkey", "p_type", "l_suppkey", "n")


@query("""WITH q AS (SELECT DISTINCT substr(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), 1, 6) AS q FROM part),
c AS (SELECT p_partkey, p_size, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS k FROM part)
SELECT q, p_partkey, (k = q) AS exact FROM q JOIN c ON starts_with(k, q) QUALIFY row_number() OVER (PARTITION BY q ORDER BY (k <> q), p_size DESC, p_partkey) = 1""")
def ranked_lookup(spark, sf_dir):
    """Normalised queries meet candidates by prefix; one is picked by a total order."""
    p = table(spark, sf_dir, "part").withColumn("k", keys.ascii_key(F.col("p_name")))
    q = p.select(F.substring("k", 1, 6).alias("q")).distinct()
    met = q.join(p.withColumn("h", F.substring("k", 1, 6)), F.col("q") == F.col("h"))
    best = runs.top_per_group(met, ["q"], [F.col("k") != F.col("q"), F.desc("p_size"), F.col("p_partkey")])
    return best.select("q", "p_partkey", (F.col("k") == F.col("q")).alias("exact"))


@query("""SELECT user_id, min(n) = 1 AND max(n) = count(*) AND count(DISTINCT n) = count(*) AS whole, count(*) AS n FROM (SELECT user_id, (event_id % 7 + 1)::BIGINT AS n FROM events) GROUP BY user_id""")
def label_run_is_whole(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 7 + 1).alias("n"))
    return e.groupBy("user_id").agg(((F.min("n") == 1) & (F.max("n") == F.count("*")) & (F.countDistinct("n") == F.count("*"))).alias("whole"), F.count("*").alias("n"))


@query("""SELECT c_nationkey, c_mktsegment, n, n - lag(n) OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment DESC) AS delta FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)""")
def release_delta(spark, sf_dir):
    by = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    return by.withColumn("delta", F.col("n") - F.lag("n").over(Window.partitionBy("c_nationkey").orderBy(F.desc("c_mktsegment"))))


# --- sorts and sets -------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 ELSE 1 END, o_totalprice DESC, length(o_orderkey::VARCHAR), o_orderkey LIMIT 50")
def custom_order_top(spark, sf_dir):
    """A report slice: custom class order, mixed directions, shorter ids first."""
    o = table(spark, sf_dir, "orders")
    return o.orderBy(F.when(F.col("o_orderstatus") == "P", 0).otherwise(1), F.desc("o_totalprice"), F.length(F.col("o_orderkey").cast("string")), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


@query("SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A' UNION SELECT p_partkey FROM part WHERE p_size = 7")
def union_distinct(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select(F.col("l_partkey").alias("k"))
    return a.union(table(spark, sf_dir, "part").where("p_size = 7").select("p_partkey")).distinct()


@query("SELECT t, count(*) AS n FROM (SELECT 'c' AS t, c_nationkey AS k FROM customer UNION ALL SELECT 's', s_nationkey FROM supplier) GROUP BY t")
def union_all_group(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("c").alias("t"), F.col("c_nationkey").alias("k"))
    return c.unionAll(table(spark, sf_dir, "supplier").select(F.lit("s"), "s_nationkey")).groupBy("t").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_suppkey FROM lineitem WHERE l_linestatus = 'O'")
def set_intersection(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return line.where("l_returnflag = 'A'").select(F.col("l_suppkey").alias("k")).intersect(line.where("l_linestatus = 'O'").select("l_suppkey"))


@query("SELECT o_custkey AS k FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_difference(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("k")).subtract(o.where("o_orderstatus = 'F'").select("o_custkey"))


# --- graphs -------------------------------------------------------------------------------------------------------


@query("""WITH RECURSIVE e AS (SELECT o_orderkey AS a, o_orderkey - CASE WHEN o_orderkey % 9 = 0 THEN 0 WHEN o_orderkey % 9 IN (4, 7) THEN 3 ELSE 1 END AS b FROM orders), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
w(a, b) AS (SELECT a, a FROM s UNION SELECT w.a, s.b FROM w JOIN s ON s.a = w.b) SELECT a AS node, min(b) AS component FROM w GROUP BY a""")
def connected_components(spark, sf_dir):
    """Orders linked to an earlier one (or to themselves) form components, named by their smallest node."""
    k = F.col("o_orderkey")
    back = F.when(k % 9 == 0, 0).when((k % 9).isin(4, 7), 3).otherwise(1)
    return graph.connected_components(table(spark, sf_dir, "orders").select(k.alias("src"), (k - back).alias("dst")))


@query("""WITH RECURSIVE m AS (SELECT o_orderkey AS old_id, CASE WHEN o_orderkey % 16 > 3 THEN o_orderkey - 3 END AS new_id FROM orders WHERE o_orderstatus <> 'P'), w(old_id, spot) AS (SELECT old_id, new_id FROM m WHERE new_id IS NOT NULL UNION ALL SELECT w.old_id, m.new_id FROM w JOIN m ON m.old_id = w.spot WHERE m.new_id IS NOT NULL)
SELECT old_id, min(spot) AS final_id FROM w GROUP BY old_id""")
def redirect_chains(spark, sf_dir):
    """Every retired id leads to its last successor, and no further than the first that is present."""
    o = table(spark, sf_dir, "orders")
    links = o.select(F.col("o_orderkey").alias("old_id"), F.when(F.col("o_orderkey") % 16 > 3, F.col("o_orderkey") - 3).alias("new_id"))
    return graph.collapse_chains(links, present=o.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("old_id")))


@query("""WITH d AS (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem WHERE l_quantity > 45 GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) = 1)
SELECT DISTINCT l.l_partkey, l.l_orderkey, coalesce(d.s, -1) AS spread FROM lineitem l LEFT JOIN d USING (l_partkey) WHERE l_quantity <= 5""")
def spread_once(spark, sf_dir):
    """A value that all of a group's donors share spreads to the group's other rows."""
    line = table(spark, sf_dir, "lineitem")
    d = line.where("l_quantity > 45").groupBy("l_partkey").agg(F.min("l_suppkey").alias("s"), F.countDistinct("l_suppkey").alias("k")).where("k = 1")
    return line.where("l_quantity <= 5").join(d, "l_partkey", "left").select("l_partkey", "l_orderkey", F.coalesce("s", F.lit(-1)).alias("spread")).distinct()


# --- scalar functions ------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, 'c_' || substr(sha256(lower(trim(c_name)) || '|' || c_nationkey), 1, 12) AS id, (('0x' || substr(sha256(c_name), 1, 8))::BIGINT & 2147483647)::BIGINT AS num FROM customer")
def hash_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", keys.natural_id("c_", F.col("c_name"), F.col("c_nationkey").cast("string")).alias("id"), keys.surrogate_int(F.col("c_name")).alias("num"))


@query("""WITH b AS (SELECT p_partkey, '978' || lpad(p_partkey::VARCHAR, 9, '0') AS b FROM part), c AS (SELECT *, ((10 - list_sum(list_transform(range(1, 13), lambda i: substr(b, i, 1)::INTEGER * CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END)) % 10) % 10)::INTEGER AS d FROM b)
SELECT p_partkey, d AS check_digit, b || d AS isbn, true AS valid FROM c""")
def check_digit(spark, sf_dir):
    b = F.concat(F.lit("978"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    d = keys.isbn13_check(b)
    isbn = F.concat(b, d.cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", d.alias("check_digit"), isbn.alias("isbn"), keys.isbn13_valid(isbn).alias("valid"))


@query("""SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS k1, regexp_replace(lower(p_name), '[^\\p{L}\\p{N}]', '', 'g') AS k2, lower(p_type) AS t FROM part""")
def text_keys(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", keys.ascii_key(F.col("p_name")).alias("k1"), keys.compact_key(F.col("p_name")).alias("k2"), F.lower("p_type").alias("t"))


@query("""SELECT s_suppkey, CASE WHEN substr(k, 1, 3) = '100' THEN 'C' WHEN substr(k, 1, 2) = '10' THEN 'B' WHEN substr(k, 1, 1) = '1' THEN 'A' END AS market FROM (SELECT s_suppkey, s_suppkey::VARCHAR AS k FROM supplier)""")
def prefix_market(spark, sf_dir):
    """Longest of the prefixes of length 3, 2 and 1 that a code table knows."""
    codes = spark.createDataFrame([("1", "A"), ("10", "B"), ("100", "C")], "code string, market string")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").cast("string").alias("k"))
    for n in (3, 2, 1):
        s = s.join(F.broadcast(codes.select(F.col("code").alias(f"c{n}"), F.col("market").alias(f"m{n}"))), F.substring("k", 1, n) == F.col(f"c{n}"), "left")
    return s.select("s_suppkey", F.coalesce("m3", "m2", "m1").alias("market"))


@query("""WITH a AS (SELECT o_custkey, max(strftime(o_orderdate, '%Y-%m')) AS last, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN n >= 10 AND c_acctbal < 0 THEN 'completed' WHEN n IS NULL THEN NULL WHEN (2000 - substr(last, 1, 4)::INTEGER) * 12 + 1 - substr(last, 6, 2)::INTEGER > 24 AND n < 8 THEN 'stalled'
WHEN (2000 - substr(last, 1, 4)::INTEGER) * 12 + 1 - substr(last, 6, 2)::INTEGER <= 24 THEN 'ongoing' WHEN n >= 10 THEN 'completed' ELSE 'ongoing' END AS status FROM customer LEFT JOIN a ON o_custkey = c_custkey""")
def line_status(spark, sf_dir):
    """One ordered rule chain over a pair of aggregates; the order of the branches matters."""
    a = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.date_format("o_orderdate", "yyyy-MM")).alias("last"), F.count("*").alias("n"))
    quiet = keys.months_between_iso(F.col("last"), F.lit("2000-01"))
    status = (
        F.when((F.col("n") >= 10) & (F.col("c_acctbal") < 0), "completed").when(F.col("n").isNull(), None).when((quiet > 24) & (F.col("n") < 8), "stalled")
        .when(quiet <= 24, "ongoing").when(F.col("n") >= 10, "completed").otherwise("ongoing")
    )
    return table(spark, sf_dir, "customer").join(a, "c_custkey", "left").select("c_custkey", status.alias("status"))


@query("""SELECT o_custkey, (list(o_orderpriority ORDER BY o_orderdate, CASE WHEN o_orderpriority LIKE '3%' THEN 0 ELSE 1 END, o_orderkey))[1] AS origin FROM orders GROUP BY o_custkey""")
def origin_pick(spark, sf_dir):
    rank = F.struct("o_orderdate", F.when(F.startswith("o_orderpriority", F.lit("3")), 0).otherwise(1), "o_orderkey")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min_by("o_orderpriority", rank).alias("origin"))


# --- semi-structured -------------------------------------------------------------------------------------------------------


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("""SELECT event_type, k, count(*) AS n FROM (SELECT event_type, unnest(json_keys(props)) AS k FROM events) GROUP BY ALL""")
def json_explode(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", F.explode(F.json_object_keys("props")).alias("k")).groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query("""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS links, array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ' ') AS targets FROM pages""")
def html_extract(spark, sf_dir):
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(links).cast("bigint").alias("links"), F.array_join(links, " ").alias("targets"))


@query("""SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS roles, count(*) AS n, max(length(text)) AS longest FROM conversations GROUP BY conv_id""")
def nested_turns(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("t"), F.count("*").alias("n"), F.max(F.length("text")).cast("bigint").alias("longest"))
    return c.select("conv_id", F.array_join("t.role", ">").alias("roles"), "n", "longest")


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n, round(sum(value), 3) AS v FROM events GROUP BY ALL""")
def event_windows(spark, sf_dir):
    """Extension: tumbling windows; claimloom.streaming has the same over a stream."""
    return table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").start.cast("timestamp_ntz").alias("hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("v"))
