"""Gates: assertion queries over a derived serving artifact and its predecessor, as tables of (rule, n), each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators import claims
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows
from claimloom.session import table

#: The artifact's series and volumes, made of parts and lines.
SERIES = """SELECT p_partkey AS id, p_brand AS work, CASE p_size % 4 WHEN 0 THEN 'ja' WHEN 1 THEN 'en' WHEN 2 THEN 'fr' ELSE 'de' END AS language, CASE p_size % 3 WHEN 0 THEN 'manga' WHEN 1 THEN 'manhwa' ELSE 'novel' END AS medium, CASE WHEN p_partkey % 97 = 0 THEN '' WHEN p_partkey % 89 = 0 THEN '[[' || p_name ELSE p_name END AS name,
 p_partkey % 6 = 0 AS is_omnibus, CASE WHEN p_partkey % 5 = 0 THEN p_partkey - 3 END AS orig_id, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE 'X' || (p_size % 4) END AS country, p_size AS volume_count FROM {part}"""
VOLUMES = """SELECT l_partkey AS id, l_linenumber - CASE WHEN l_orderkey % 500 = 0 THEN 9 ELSE 0 END AS number, CASE WHEN l_orderkey % 3 > 0 THEN substr(CAST(l_shipdate AS VARCHAR(30)), 1, 10) END AS day, CASE WHEN l_suppkey % 4 > 0 THEN l_orderkey END AS isbn, CASE WHEN l_orderkey % 40 = 0 THEN '' || l_linenumber WHEN l_orderkey % 41 = 0 THEN 'a <ref>' ELSE 'Title' END AS title,
 CASE WHEN l_orderkey % 7 = 0 THEN l_linenumber % 14 END AS parts FROM {lineitem}"""
VOLUMES_SPARK = VOLUMES.replace("CAST(l_shipdate AS VARCHAR(30))", "CAST(l_shipdate AS STRING)")
_SERIES_RULES = [
    ("empty names", "trim(name) = ''"), ("names with markup", "name LIKE '%{{%' OR name LIKE '%[[%' OR name LIKE '%<%'"), ("no country", "country IS NULL OR trim(country) = ''"), ("negative counts", "volume_count < 0"),
]
_VOLUME_RULES = [
    ("negative numbers", "number < 0"), ("new year dates", "day LIKE '%-01-01'"), ("titles with markup", "title LIKE '%[[%' OR title LIKE '%<ref%' OR title LIKE '%{{%'"), ("titles that repeat the number", "title = '' || number"),
    ("dates not of day precision", "length(day) <> 10"), ("compositions of wrong length", "parts < 1 OR parts > 12"),
]
_V = f"WITH s AS ({plain(SERIES)}), v AS ({plain(VOLUMES)})"


def _both(spark, sf_dir):
    return rows(spark, sf_dir, SERIES), rows(spark, sf_dir, VOLUMES_SPARK)


def _tall(df: DataFrame) -> DataFrame:
    """One row a rule out of one row of counts."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").alias("n")) for c in df.columns])).alias("r")).select("r.*")


@query(_V + " " + " UNION ALL ".join([f"SELECT '{n}' AS rule, count_if({q})::BIGINT AS n FROM s" for n, q in _SERIES_RULES] + [f"SELECT '{n}', count_if({q})::BIGINT FROM v" for n, q in _VOLUME_RULES] + [
    "SELECT 'single series with compositions', count(DISTINCT s.id) FROM s JOIN v USING (id) WHERE NOT is_omnibus AND parts IS NOT NULL", "SELECT 'omnibus series without one', count(*) FROM s WHERE is_omnibus AND NOT EXISTS (SELECT 1 FROM v WHERE v.id = s.id AND parts > 1)",
    "SELECT 'volume count is wrong', count(*) FROM s WHERE volume_count <> (SELECT count(*) FROM v WHERE v.id = s.id)", "SELECT 'licensed series without date and ISBN', count(*) FROM s WHERE language IN ('en', 'fr', 'de') AND NOT EXISTS (SELECT 1 FROM v WHERE v.id = s.id AND (day IS NOT NULL OR isbn IS NOT NULL))",
    "SELECT 'collapsible rows left', count(*) FROM v a JOIN v b ON a.id = b.id AND a.isbn = b.isbn AND coalesce(a.day, '') = coalesce(b.day, '') AND b.number = a.number + 1 JOIN s ON s.id = a.id WHERE language <> 'ja'",
]))
def artifact_contract(spark, sf_dir):
    """The artifact's contract: row rules in one pass a table, rules on groups from one aggregate of the volumes."""
    s, v = _both(spark, sf_dir)
    out = [_tall(s.agg(*[F.count_if(F.expr(q)).alias(n) for n, q in _SERIES_RULES])), _tall(v.agg(*[F.count_if(F.expr(q)).alias(n) for n, q in _VOLUME_RULES]))]
    by = v.groupBy("id").agg(F.count("*").alias("rows"), F.count("parts").alias("lists"), F.coalesce(F.max("parts"), F.lit(0)).alias("longest"), (F.count("day") + F.count("isbn")).alias("told"))
    each = s.join(by, "id", "left").fillna(0, ["rows", "lists", "longest", "told"])
    out.append(_tall(each.agg(
        F.count_if(~F.col("is_omnibus") & (F.col("lists") > 0)).alias("single series with compositions"), F.count_if(F.col("is_omnibus") & (F.col("longest") <= 1)).alias("omnibus series without one"),
        F.count_if(F.col("volume_count") != F.col("rows")).alias("volume count is wrong"), F.count_if(F.col("language").isin("en", "fr", "de") & (F.col("told") == 0)).alias("licensed series without date and ISBN"),
    )))
    same = ["id", "isbn", "day"]
    counted = v.where("isbn is not null").fillna("", ["day"]).groupBy(*same, "number").agg(F.count("*").alias("n"))
    after = counted.select(*same, (F.col("number") - 1).alias("number"), F.col("n").alias("m"))
    left = counted.join(after, [*same, "number"]).join(s.where("language <> 'ja'").select("id"), "id", "left_semi")
    out.append(_tall(left.agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).alias("collapsible rows left"))))
    return reduce(DataFrame.unionAll, out)


@query(f"""{_V} SELECT l.id FROM s l LEFT JOIN s o ON o.id = l.orig_id WHERE l.orig_id IS NOT NULL AND (o.id IS NULL OR o.work <> l.work OR o.language <> 'ja' OR o.language = l.language
OR (o.medium <> l.medium AND NOT (o.medium IN ('manga', 'manhwa') AND l.medium IN ('manga', 'manhwa') AND NOT EXISTS (SELECT 1 FROM s x WHERE x.work = l.work AND x.country = o.country AND x.medium = l.medium))))""")
def origin_references(spark, sf_dir):
    """Lines whose origin is missing, another work's, of the wrong language or another medium beyond the comic family."""
    s, _ = _both(spark, sf_dir)
    o = s.select(F.col("id").alias("orig_id"), F.col("work").alias("ow"), F.col("language").alias("ol"), F.col("medium").alias("om"), F.col("country").alias("oc"))
    own = s.select(F.col("work").alias("xw"), F.col("country").alias("xc"), F.col("medium").alias("xm"), F.lit(True).alias("has")).distinct()
    j = s.where("orig_id is not null").join(o, "orig_id", "left")
    j = j.join(own, (F.col("xw") == F.col("work")) & (F.col("xc") == F.col("oc")) & (F.col("xm") == F.col("medium")), "left")
    comic = ("manga", "manhwa")
    family = F.col("om").isin(*comic) & F.col("medium").isin(*comic) & F.col("has").isNull()
    bad = F.col("ow").isNull() | (F.col("ow") != F.col("work")) | (F.col("ol") != "ja") | (F.col("ol") == F.col("language")) | ((F.col("om") != F.col("medium")) & ~family)
    return j.where(bad).select("id")


_MOVES = "SELECT o_orderkey AS id, o_custkey AS work, CASE WHEN o_orderkey % 9 = 0 THEN 'volume' ELSE 'line' END AS kind, CASE WHEN o_orderkey % 8 > 0 THEN 'present' WHEN o_orderkey % 16 = 0 THEN 'moved' WHEN o_orderkey % 24 = 8 THEN 'retired' ELSE 'lost' END AS fate FROM {orders}"


@query(f"""WITH m AS ({plain(_MOVES)}), c AS (SELECT kind, count_if(fate = 'retired')::BIGINT AS retired, count_if(fate = 'moved')::BIGINT AS moved, count_if(fate = 'lost')::BIGINT AS lost FROM m WHERE work % 50 <> 7 GROUP BY kind)
SELECT kind, retired, moved, lost, CASE WHEN lost > 0 THEN 'lost ids' WHEN retired > CASE kind WHEN 'line' THEN 10 ELSE 100 END THEN 'too many retired' WHEN moved > 500 THEN 'too many moved' ELSE 'ok' END AS verdict FROM c""")
def id_caps(spark, sf_dir):
    """Retired and moved ids against their caps, what was excluded on purpose left out."""
    m = rows(spark, sf_dir, _MOVES).where("work % 50 <> 7")
    c = m.groupBy("kind").agg(*[F.count_if(F.col("fate") == f).alias(f) for f in ("retired", "moved", "lost")])
    cap = F.when(F.col("kind") == "line", 10).otherwise(100)
    return c.withColumn("verdict", F.when(F.col("lost") > 0, "lost ids").when(F.col("retired") > cap, "too many retired").when(F.col("moved") > 500, "too many moved").otherwise("ok"))


_PROVENANCE = "SELECT l_orderkey AS id, CASE l_suppkey % 4 WHEN 0 THEN 'DNB' WHEN 1 THEN 'loc' WHEN 2 THEN 'bnf' ELSE 'wiki' END AS source, CASE l_linenumber % 6 WHEN 0 THEN 'isbn' WHEN 1 THEN 'title' WHEN 2 THEN 'cover' WHEN 3 THEN 'pages' WHEN 4 THEN 'date' ELSE 'blurb' END AS field, CASE WHEN l_partkey % 50 = 0 THEN 'https://x.example' WHEN l_partkey % 51 = 0 THEN '//y' ELSE 'v' || l_partkey END AS value, CASE WHEN l_suppkey % 4 = 1 AND l_orderkey % 100 > 0 THEN 'us_gov_pd' ELSE 'cc0' END AS licence, CASE l_suppkey % 4 WHEN 0 THEN 'https://d-nb.info/' || l_orderkey || CASE WHEN l_orderkey % 90 = 0 THEN '/04' ELSE '' END WHEN 1 THEN 'https://lccn.loc.gov/' || l_orderkey ELSE 'http://ark/' || l_orderkey END AS url FROM {lineitem}"
_ALLOWED = {"dnb": ["isbn", "title", "pages", "date"], "loc": ["isbn", "title", "date"], "bnf": ["isbn", "pages"]}
_ALLOW_SQL = "(VALUES " + ", ".join(f"('{s}', '{f}')" for s, fs in _ALLOWED.items() for f in fs) + ") a(source, field)"


@query(f"""WITH c AS (SELECT *, lower(source) AS low FROM ({plain(_PROVENANCE)})), l AS (SELECT * FROM c WHERE low IN ('dnb', 'loc', 'bnf'))
SELECT 'field' AS rule, low AS source, count(*) AS n FROM l WHERE NOT EXISTS (SELECT 1 FROM {_ALLOW_SQL} WHERE a.source = low AND a.field = l.field) GROUP BY low UNION ALL SELECT 'link', low, count(*) FROM l WHERE contains(value, '://') OR starts_with(value, '//') GROUP BY low
UNION ALL SELECT 'licence', low, count(*) FROM l WHERE low = 'loc' AND licence <> 'us_gov_pd' GROUP BY low UNION ALL SELECT 'url', low, count(*) FROM l WHERE low = 'dnb' AND NOT regexp_matches(url, '^https://d-nb\\.info/[0-9]+$') GROUP BY low""")
def licence_gate(spark, sf_dir):
    """Library claims outside their source's field list, with links, wrong licences or wrong addresses."""
    c = rows(spark, sf_dir, _PROVENANCE).withColumn("source", F.lower("source")).where(F.col("source").isin(*_ALLOWED))
    allowed = reduce(lambda a, b: a | b, [(F.col("source") == s) & F.col("field").isin(*fs) for s, fs in _ALLOWED.items()])
    broken = F.array_compact(F.array(
        F.when(~allowed, "field"), F.when(F.contains("value", F.lit("://")) | F.startswith("value", F.lit("//")), "link"), F.when((F.col("source") == "loc") & (F.col("licence") != "us_gov_pd"), "licence"),
        F.when((F.col("source") == "dnb") & ~F.col("url").rlike("^https://d-nb\\.info/[0-9]+$"), "url"),
    ))
    return c.select("source", F.explode(broken).alias("rule")).groupBy("rule", "source").agg(F.count("*").alias("n"))


@query(f"""{_V}, w AS (SELECT work, language, medium, lower(name) AS name, id % 8 > 0 AS before FROM s), d AS (SELECT work, language, medium, name, count(*) AS now, count_if(before) AS was FROM w GROUP BY ALL),
f AS (SELECT language, CASE medium WHEN 'novel' THEN 'novel' ELSE 'comic' END AS family, name, work, bool_or(before) AS before FROM w GROUP BY ALL), g AS (SELECT language, family, name, count(*) AS works, count_if(before) AS was FROM f GROUP BY ALL)
SELECT 'within a work' AS rule, count_if(now > 1 AND now > greatest(was, 1))::BIGINT AS n FROM d UNION ALL SELECT 'between works', count_if(works > 1 AND works > was AND NOT (was > 1 AND works = was))::BIGINT FROM g""")
def new_name_collisions(spark, sf_dir):
    """Names that clash now and did not in the previous artifact, within a work and between works."""
    s, _ = _both(spark, sf_dir)
    w = s.select("work", "language", "medium", F.lower("name").alias("name"), (F.col("id") % 8 > 0).alias("before"))
    d = w.groupBy("work", "language", "medium", "name").agg(F.count("*").alias("now"), F.count_if("before").alias("was"))
    own = d.agg(F.count_if((F.col("now") > 1) & (F.col("now") > F.greatest("was", F.lit(1)))).alias("within a work"))
    family = F.when(F.col("medium") == "novel", "novel").otherwise("comic")
    g = w.groupBy("language", family.alias("family"), "name", "work").agg(F.bool_or("before").alias("b")).groupBy("language", "family", "name").agg(F.count("*").alias("works"), F.count_if("b").alias("was"))
    return _tall(own).unionAll(_tall(g.agg(F.count_if((F.col("works") > 1) & (F.col("works") > F.col("was"))).alias("between works"))))


@query("""SELECT l_returnflag AS market, count(*) AS volumes, count_if(l_discount > 0)::BIGINT AS dated, count(*) >= 10000 AND count_if(l_discount > 0) * 10 >= count(*) * 8 AS ok FROM lineitem GROUP BY l_returnflag""")
def market_floors(spark, sf_dir):
    """Counts and shares of each market against their floors."""
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("market")).agg(F.count("*").alias("volumes"), F.count_if(F.col("l_discount") > 0).alias("dated"))
    return m.withColumn("ok", (F.col("volumes") >= 10000) & (F.col("dated") * 10 >= F.col("volumes") * 8))


@query("SELECT 'same' AS change, count(*) AS n FROM customer")
def reload_same_ids(spark, sf_dir):
    """Ids made twice from the same rows, in another order, are the same."""
    from claimloom.functions import keys

    c = table(spark, sf_dir, "customer").select("c_custkey", keys.natural_id("c_", F.col("c_name"), F.col("c_mktsegment")).alias("id"))
    return claims.snapshot_diff(c, c.repartition(3, "id"), "c_custkey", "id").groupBy("change").agg(F.count("*").alias("n"))


_FIXES = "SELECT o_orderkey AS n, CASE WHEN o_orderkey % 6 = 0 THEN o_custkey + 100000 ELSE o_custkey END AS target, CASE o_orderkey % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'isbn' ELSE 'name' END AS field, CASE WHEN o_orderkey % 40 > 0 THEN 'v' || o_orderkey % 50 END AS value, CASE WHEN o_orderkey % 45 > 0 THEN '2024' END AS checked FROM {orders}"


@query(f"""WITH f AS ({plain(_FIXES)}), t AS (SELECT *, count(*) OVER (PARTITION BY target, field) AS times, count(DISTINCT value) OVER (PARTITION BY target, field) AS values FROM f)
SELECT n, target, field, CASE WHEN value IS NULL OR checked IS NULL THEN 'lacks ' || concat_ws(',', CASE WHEN value IS NULL THEN 'value' END, CASE WHEN checked IS NULL THEN 'checked' END) WHEN c_custkey IS NULL THEN 'stale target' WHEN times > 1 AND values > 1 THEN 'corrected twice' ELSE 'ok' END AS verdict FROM t LEFT JOIN customer ON c_custkey = target""")
def corrections_check(spark, sf_dir):
    """Corrections that lack keys, name nothing that exists, or contradict each other."""
    f = rows(spark, sf_dir, _FIXES)
    times = f.groupBy("target", "field").agg(F.count("*").alias("times"), F.count_distinct("value").alias("values"))
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("target"), F.lit(True).alias("known"))
    lacking = F.concat_ws(",", F.when(F.col("value").isNull(), "value"), F.when(F.col("checked").isNull(), "checked"))
    verdict = F.when(lacking != "", F.concat(F.lit("lacks "), lacking)).when(F.col("known").isNull(), "stale target").when((F.col("times") > 1) & (F.col("values") > 1), "corrected twice").otherwise("ok")
    return f.join(times, ["target", "field"]).join(known, "target", "left").select("n", "target", "field", verdict.alias("verdict"))


_EDITS = "SELECT s_suppkey AS n, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR(20)) ELSE 'isbn' || (s_suppkey % 40) END AS key, 'x' || s_suppkey AS value FROM {supplier}"
_TARGETS = "SELECT s_suppkey AS id, 'isbn' || (s_suppkey % 30) AS isbn FROM {supplier} WHERE s_suppkey < 900"


@query(f"""WITH e AS ({plain(_EDITS)}), t AS ({plain(_TARGETS)}), i AS (SELECT isbn, count(*) AS k, min(id) AS id FROM t GROUP BY isbn)
SELECT n, coalesce(a.id, CASE WHEN k = 1 THEN i.id END) AS target, CASE WHEN a.id IS NOT NULL THEN 'id' WHEN k = 1 THEN 'isbn' WHEN k > 1 THEN 'ambiguous' ELSE 'stale' END AS by FROM e LEFT JOIN t a ON a.id::VARCHAR = e.key LEFT JOIN i ON i.isbn = e.key""")
def volume_corrections(spark, sf_dir):
    """Corrections find their volume by id, else by an ISBN that one volume has; the rest fail."""
    e, t = rows(spark, sf_dir, _EDITS), rows(spark, sf_dir, _TARGETS)
    by_id = t.select(F.col("id").cast("string").alias("key"), F.col("id").alias("a"))
    by_isbn = t.groupBy(F.col("isbn").alias("key")).agg(F.count("*").alias("k"), F.min("id").alias("i"))
    j = e.join(by_id, "key", "left").join(by_isbn, "key", "left")
    how = F.when(F.col("a").isNotNull(), "id").when(F.col("k") == 1, "isbn").when(F.col("k") > 1, "ambiguous").otherwise("stale")
    return j.select("n", F.coalesce("a", F.when(F.col("k") == 1, F.col("i"))).alias("target"), how.alias("by"))


@query("SELECT count_if(o_orderstatus = 'F' AND o_orderpriority LIKE '1%')::BIGINT AS both, count_if(o_orderstatus = 'F' AND NOT o_orderpriority LIKE '1%')::BIGINT AS first_only, count_if(o_orderstatus = 'F' AND o_orderpriority LIKE '1%') = 0 AS disjoint FROM orders")
def disjoint_scopes(spark, sf_dir):
    """Whether two scopes share a row."""
    a, b = F.col("o_orderstatus") == "F", F.startswith("o_orderpriority", F.lit("1"))
    return table(spark, sf_dir, "orders").agg(F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("first_only"), (F.count_if(a & b) == 0).alias("disjoint"))


@query("""SELECT l_orderkey AS line, CASE WHEN l_orderkey % 4 = 0 THEN 'deferred' ELSE 'kept' END AS scope, count(*) AS n FROM lineitem GROUP BY ALL""")
def deferred_scopes(spark, sf_dir):
    """Lines that another stage owns are deferred to it."""
    line, owned = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("line")).agg(F.count("*").alias("n")), table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("line"))
    kept, deferred = line.join(owned, "line", "left_anti"), line.join(owned, "line", "left_semi")
    return kept.select("line", F.lit("kept").alias("scope"), "n").unionAll(deferred.select("line", F.lit("deferred"), "n"))


@query("""WITH s AS (SELECT c_nationkey, CASE WHEN count(*) OVER (PARTITION BY c_nationkey) < 60 AND c_nationkey NOT IN (3, 7) THEN 'other' ELSE c_nationkey::VARCHAR END AS g FROM customer) SELECT g, count(*) AS n FROM s GROUP BY g""")
def folded_groups(spark, sf_dir):
    """Small groups fold to other unless they are on a list."""
    n = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    g = F.when((F.col("n") < 60) & ~F.col("c_nationkey").isin(3, 7), "other").otherwise(F.col("c_nationkey").cast("string"))
    return n.groupBy(g.alias("g")).agg(F.sum("n").alias("n"))


@query("""WITH t AS (SELECT p_brand AS work, p_type AS medium, p_size AS number, p_partkey AS pages FROM part), m AS (SELECT work, count(DISTINCT number) AS vc, list_sort(list(pages)) AS p FROM t WHERE medium = 'ECONOMY' GROUP BY work), e AS (SELECT work, count(DISTINCT number) AS vc, list_sort(list(pages)) AS p FROM t WHERE medium = 'PROMO' GROUP BY work)
SELECT work, e.vc AS mine, m.vc AS theirs, (m.vc >= 4 AND e.vc <= 0.75 * m.vc AND len(e.p) >= 3 AND e.p[len(e.p) // 2 + 1] >= 1.3 * m.p[len(m.p) // 2 + 1]) AS collects FROM e JOIN m USING (work)""")
def collects_by_count(spark, sf_dir):
    """Editions with clearly fewer and thicker books than the main line, by upper medians."""
    from claimloom.operators import runs

    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("work"), F.col("p_type").alias("medium"), F.col("p_size").alias("number"), F.col("p_partkey").alias("pages"))
    n = p.groupBy("work", "medium").agg(F.count_distinct("number").alias("vc"), F.count("pages").alias("k")).join(runs.upper_median(p, ["work", "medium"], "pages"), ["work", "medium"])
    e, m = n.where("medium = 'PROMO'").drop("medium"), n.where("medium = 'ECONOMY'").select("work", F.col("vc").alias("theirs"), F.col("pages").alias("their_pages"))
    fits = (F.col("theirs") >= 4) & (F.col("vc") <= 0.75 * F.col("theirs")) & (F.col("k") >= 3) & (F.col("pages") >= 1.3 * F.col("their_pages"))
    return e.join(m, "work").select("work", F.col("vc").alias("mine"), "theirs", fits.alias("collects"))


@query("""WITH l AS (SELECT p_partkey AS id, p_brand AS work, p_type AS market, CASE WHEN p_size % 3 = 0 THEN 'manhwa' ELSE 'manga' END AS medium, CASE WHEN p_size % 5 = 0 THEN 'manhwa' ELSE CASE WHEN p_size % 3 = 0 THEN 'manhwa' ELSE 'manga' END END AS retag, p_name AS name FROM part), g AS (SELECT work, market, retag, name, count(*) AS n, min(id) AS head FROM l GROUP BY ALL)
SELECT id, l.retag, CASE WHEN l.medium <> l.retag AND n > 1 AND id <> head THEN 'fold' WHEN l.medium <> l.retag THEN 'retag' ELSE 'keep' END AS plan FROM l JOIN g USING (work, market, retag, name)""")
def retag_plan(spark, sf_dir):
    """Lines whose medium changes, folded where another of that name has it already."""
    medium = F.when(F.col("p_size") % 3 == 0, "manhwa").otherwise("manga")
    l = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("work"), F.col("p_type").alias("market"), medium.alias("medium"), F.when(F.col("p_size") % 5 == 0, "manhwa").otherwise(medium).alias("retag"), F.col("p_name").alias("name"))  # noqa: E741
    key = ["work", "market", "retag", "name"]
    g = l.groupBy(*key).agg(F.count("*").alias("n"), F.min("id").alias("head"))
    moved = F.col("medium") != F.col("retag")
    return l.join(g, key).select("id", "retag", F.when(moved & (F.col("n") > 1) & (F.col("id") != F.col("head")), "fold").when(moved, "retag").otherwise("keep").alias("plan"))


@query("""WITH c AS (SELECT DISTINCT l_orderkey AS line, l_partkey AS isbn, l_returnflag AS market FROM lineitem) SELECT isbn, market, count(*) AS lines, min(line) AS owner FROM c GROUP BY isbn, market HAVING count(*) > 1""")
def collision_claims(spark, sf_dir):
    """ISBNs in several lines of a market, as flags, with the line that owns each."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("line"), F.col("l_partkey").alias("isbn"), F.col("l_returnflag").alias("market")).distinct()
    return c.groupBy("isbn", "market").agg(F.count("*").alias("lines"), F.min("line").alias("owner")).where("lines > 1")


@query("""SELECT p_partkey AS id, 'openbd' AS source, f.field, CASE f.field WHEN 'pages' THEN p_size::VARCHAR ELSE 'cover/' || p_partkey END AS value FROM part, (VALUES ('pages'), ('cover')) f(field) WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') AND (f.field = 'pages' OR p_size % 2 = 0)
UNION ALL SELECT p_partkey, 'held', 'pages', '1' FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')""")
def enrichment_claims(spark, sf_dir):
    """What a source has on entities without its claims, as tall rows; those that have one already keep it."""
    p, done = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    wide = p.join(done, "p_partkey", "left_anti")
    two = F.array(F.struct(F.lit("pages").alias("field"), F.col("p_size").cast("string").alias("value")), F.struct(F.lit("cover").alias("field"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("cover/"), "p_partkey")).alias("value")))
    new = wide.select(F.col("p_partkey").alias("id"), F.lit("openbd").alias("source"), F.explode(two).alias("c")).select("id", "source", "c.*").where("value is not null")
    held = p.join(done, "p_partkey", "left_semi").select("p_partkey", F.lit("held"), F.lit("pages"), F.lit("1"))
    return new.unionAll(held)


@query("""WITH t AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT p_name || ' ' || p_type FROM part), p AS (SELECT a.name, arg_max(b.name, length(b.name)) AS parent FROM t a JOIN t b ON starts_with(a.name, b.name || ' ') AND length(b.name) >= 5 GROUP BY a.name), g AS (SELECT name, min(p_partkey) AS id, p_type AS kind FROM (SELECT p_name || ' ' || p_type AS name, p_partkey, p_type FROM part) GROUP BY ALL)
SELECT name, parent, 'side_story' AS relation FROM p UNION ALL SELECT name, (SELECT arg_min(h.name, h.id) FROM g h WHERE h.kind = g.kind) AS parent, 'same_group' FROM g WHERE id <> (SELECT min(h.id) FROM g h WHERE h.kind = g.kind)""")
def relations(spark, sf_dir):
    """Relations by longest title prefix and by shared groups, each to the group's primary."""
    from claimloom.operators import linkage

    p = table(spark, sf_dir, "part")
    names = p.select(F.col("p_name").alias("name")).union(p.select(F.concat_ws(" ", "p_name", "p_type"))).distinct()
    spaced = names.select(F.concat("name", F.lit(" ")).alias("name"))
    side = linkage.longest_prefix(spaced, spaced, 6).select(F.rtrim("name").alias("name"), F.rtrim("parent").alias("parent"), F.lit("side_story").alias("relation"))
    g = p.groupBy(F.concat_ws(" ", "p_name", "p_type").alias("name"), F.col("p_type").alias("kind")).agg(F.min("p_partkey").alias("id"))
    head = g.groupBy("kind").agg(F.min_by("name", "id").alias("parent"), F.min("id").alias("first"))
    return side.unionAll(g.join(head, "kind").where("id <> first").select("name", "parent", F.lit("same_group")))


