"""The rounds of a build as queries: intake, assembly, binding passes and what they hand on, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import dates, records
from claimloom.operators import linkage
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows
from claimloom.session import table


@query("""SELECT a.p_partkey AS id, CASE WHEN a.p_partkey % 4 > 0 THEN CASE WHEN a.p_partkey % 4 = 1 THEN 'kor' ELSE 'fre' END WHEN b.p_partkey % 4 = 1 THEN 'kor' WHEN b.p_partkey % 4 > 1 THEN 'fre' END AS origin FROM part a LEFT JOIN part b ON b.p_partkey = a.p_partkey - a.p_partkey % 7""")
def inherited_origin(spark, sf_dir):
    """A record without an origin takes its head's; one that states any keeps it, in scope or not."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 4 == 1, "kor").when(F.col("p_partkey") % 4 > 1, "fre").alias("own"), (F.col("p_partkey") - F.col("p_partkey") % 7).alias("head"))
    heads = p.select(F.col("id").alias("head"), F.col("own").alias("theirs"))
    return p.join(heads, "head", "left").select("id", F.coalesce("own", "theirs").alias("origin"))


_RETAG = "SELECT DISTINCT l_suppkey AS line, l_suppkey % 6 AS work, CASE WHEN l_suppkey % 4 = 0 THEN 'manhwa' ELSE 'manga' END AS proposed, CASE WHEN l_suppkey % 4 = 0 OR l_suppkey % 3 = 0 THEN 'manga' ELSE 'manhwa' END AS medium, l_partkey % 40 AS isbn FROM {lineitem}"


@query(f"""WITH l AS ({plain(_RETAG)}), n AS (SELECT line, count(*) AS n FROM l GROUP BY line), m AS (SELECT a.line, b.line AS other, count(*) AS shared FROM l a JOIN l b ON a.isbn = b.isbn AND a.work = b.work AND a.proposed = b.proposed AND a.line <> b.line GROUP BY ALL)
SELECT line, CASE WHEN line % 4 = 0 AND EXISTS (SELECT 1 FROM m WHERE m.line = n.line AND 2 * shared > n) THEN 'held-isbn' ELSE 'free' END AS state FROM n""")
def retag_guard(spark, sf_dir):
    """A line is not retagged into a medium where another line of its work has most of its ISBNs."""
    l = rows(spark, sf_dir, _RETAG)  # noqa: E741
    n = l.groupBy("line").agg(F.count("*").alias("n"))
    held = linkage.mostly_held(l, ["work", "proposed"], "line", "isbn").where("line % 4 = 0").withColumn("held", F.lit("held-isbn"))
    return n.join(held, "line", "left").select("line", F.coalesce("held", F.lit("free")).alias("state"))


_MEMBERS = "SELECT o_custkey AS g, o_orderkey % 4 = 0 AS announced, o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 2 END AS isbn, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 300 END AS pages, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS publisher FROM {orders}"


@query(f"""WITH m AS ({plain(_MEMBERS)}), o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY announced, id) AS r FROM m) SELECT g, arg_min(id, r) AS primary_id, arg_min(isbn, r) FILTER (isbn IS NOT NULL) AS isbn, arg_min(pages, r) FILTER (pages IS NOT NULL) AS pages, arg_min(publisher, r) FILTER (publisher IS NOT NULL) AS publisher, count(*) AS members FROM o GROUP BY g""")
def group_records(spark, sf_dir):
    """One record of a group's members: each field from the first member that has it, deposited ones first."""
    m = rows(spark, sf_dir, _MEMBERS)
    order = F.struct("announced", "id")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    return m.groupBy("g").agg(F.min_by("id", order).alias("primary_id"), first("isbn"), first("pages"), first("publisher"), F.count("*").alias("members"))


@query("""SELECT l_partkey AS isbn, min(l_orderkey) AS line, (list(l_linenumber ORDER BY l_orderkey, l_linenumber))[1] AS volume FROM lineitem WHERE l_returnflag <> 'A' GROUP BY l_partkey""")
def isbn_owners(spark, sf_dir):
    """The line and volume that own an ISBN of a market, whatever the order of rows."""
    line = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'A'")
    return line.groupBy(F.col("l_partkey").alias("isbn")).agg(F.min("l_orderkey").alias("line"), F.min_by("l_linenumber", F.struct("l_orderkey", "l_linenumber")).alias("volume"))


@query("""WITH l AS (SELECT p_partkey AS id, p_brand AS work, p_name AS name, CASE p_partkey % 4 WHEN 0 THEN 'Deluxe' WHEN 1 THEN 'Neu' END AS edition, p_partkey % 3 = 0 AS is_new FROM part), c AS (SELECT work, name, count(*) AS n FROM l GROUP BY ALL)
SELECT id, CASE WHEN is_new AND n > 1 AND edition IS NOT NULL THEN l.name || ' (' || edition || ')' ELSE l.name END AS name, is_new AND n > 1 AND edition IS NULL AS review FROM l JOIN c USING (work, name)""")
def named_editions(spark, sf_dir):
    """A new edition whose name is taken gets its marker; without one it is for review."""
    l = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("work"), F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 4 == 0, "Deluxe").when(F.col("p_partkey") % 4 == 1, "Neu").alias("edition"), (F.col("p_partkey") % 3 == 0).alias("is_new"))  # noqa: E741
    clash = l.groupBy("work", "name").agg((F.count("*") > 1).alias("taken"))
    both = F.col("is_new") & F.col("taken")
    return l.join(clash, ["work", "name"]).select("id", F.when(both & F.col("edition").isNotNull(), F.concat("name", F.lit(" ("), "edition", F.lit(")"))).otherwise(F.col("name")).alias("name"), (both & F.col("edition").isNull()).alias("review"))


@query("""WITH old AS (SELECT o_orderkey AS id, o_custkey AS isbn, o_orderpriority AS market FROM orders WHERE o_orderkey % 3 > 0), now AS (SELECT o_orderkey AS id, o_custkey AS isbn, o_orderpriority AS market FROM orders WHERE o_orderkey % 4 > 0), s AS (SELECT isbn, market, min(id) AS heir FROM now GROUP BY ALL), m AS (SELECT market, min(id) AS main FROM now GROUP BY market)
SELECT o.id AS old_id, coalesce(heir, main) AS new_id, CASE WHEN heir IS NOT NULL THEN 'isbn' ELSE 'main' END AS via FROM old o LEFT JOIN s USING (isbn, market) LEFT JOIN m USING (market) WHERE o.id NOT IN (SELECT id FROM now)""")
def market_redirects(spark, sf_dir):
    """Where a market's retired ids lead: the volume with their ISBN, else the market's main one."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("isbn"), F.col("o_orderpriority").alias("market"))
    now = o.where("id % 4 > 0")
    heirs, main = now.groupBy("isbn", "market").agg(F.min("id").alias("heir")), now.groupBy("market").agg(F.min("id").alias("main"))
    gone = o.where("id % 3 > 0").join(now.select("id"), "id", "left_anti").join(heirs, ["isbn", "market"], "left").join(main, "market", "left")
    return gone.select(F.col("id").alias("old_id"), F.coalesce("heir", "main").alias("new_id"), F.when(F.col("heir").isNotNull(), "isbn").otherwise("main").alias("via"))


@query("""WITH v AS (SELECT l_orderkey AS line, l_linenumber AS number, min(l_partkey) AS isbn FROM lineitem GROUP BY ALL) SELECT a.line - 1 AS public, a.number, a.isbn AS adopted, b.isbn AS held, CASE WHEN b.line IS NULL THEN 'moved' WHEN a.isbn = b.isbn THEN 'merged' ELSE 'clash' END AS fate FROM v a LEFT JOIN v b ON b.line = a.line - 1 AND b.number = a.number WHERE a.line % 2 = 1""")
def adoption_clashes(spark, sf_dir):
    """Volumes of a line that takes over a published id: moved, merged, or in conflict over an ISBN."""
    v = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("line"), F.col("l_linenumber").alias("number")).agg(F.min("l_partkey").alias("isbn"))
    mine = v.where("line % 2 = 1").select((F.col("line") - 1).alias("public"), "number", F.col("isbn").alias("adopted"))
    both = mine.join(v.select(F.col("line").alias("public"), "number", F.col("isbn").alias("held")), ["public", "number"], "left")
    return both.withColumn("fate", F.when(F.col("held").isNull(), "moved").when(F.col("adopted") == F.col("held"), "merged").otherwise("clash"))




@query("""SELECT p_partkey AS id, concat_ws('|', CASE WHEN p_size % 2 = 0 THEN p_name || ' : ' || p_type ELSE p_name END, CASE WHEN p_size % 3 = 0 THEN p_brand END) AS titles, CASE WHEN p_size % 5 > 0 THEN p_type ELSE '' END AS series, p_size % 4 = 1 AS cased FROM part""")
def record_titles(spark, sf_dir):
    """A record's titles (the full one replaces the reduced), its series without catalogue numbers, and single books in a case."""
    p = table(spark, sf_dir, "part")
    full = F.when(F.col("p_size") % 2 == 0, F.concat_ws(" : ", "p_name", "p_type"))
    every = F.array_compact(F.array(F.col("p_name"), full, F.when(F.col("p_size") % 3 == 0, F.col("p_brand")), F.col("p_name")))
    told = F.array_distinct(F.filter(every, lambda t: full.isNull() | (t != F.col("p_name"))))
    told = F.when(full.isNotNull(), told).otherwise(F.array_distinct(every))
    series = F.filter(F.array(F.when(F.col("p_size") % 5 > 0, F.col("p_type")).otherwise(F.concat(F.lit("Bestell-Nr. "), "p_size"))), lambda s: ~s.rlike("(?i)^(bestell-?nr|cat(alogue)? no)\\.? *[0-9]+"))
    extent = F.when(F.col("p_size") % 4 == 1, F.concat(F.col("p_size") + 100, F.lit(" Seiten"))).otherwise("9 Bände")
    return p.select(F.col("p_partkey").alias("id"), F.array_join(told, "|").alias("titles"), F.array_join(series, "|").alias("series"), records.extent_pages(extent).isNotNull().alias("cased"))


@query("""SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN p_size || '-' || (p_size + 3) WHEN 1 THEN 'special' WHEN 2 THEN 'special' WHEN 3 THEN p_size::VARCHAR ELSE 'special' END AS accepted FROM part""")
def number_acceptance(spark, sf_dir):
    """Numbers glued to a slash, hyphenated to a word or inside a quotation are parts of titles; ranges need a rising tail."""
    p = table(spark, sf_dir, "part")
    n = F.col("p_size").cast("string")
    s = F.when(F.col("p_partkey") % 5 == 0, F.concat(n, F.lit("–"), (F.col("p_size") + 3).cast("string"))).when(F.col("p_partkey") % 5 == 1, F.concat(F.lit("X/"), n)).when(F.col("p_partkey") % 5 == 2, F.concat(n, F.lit("-Step March"))).when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("Vol. 0"), n)).otherwise(F.concat(F.lit('"Sample ('), n, F.lit(')"')))
    d = dates.canonical_number(s)
    return p.select(F.col("p_partkey").alias("id"), d.alias("d")).select("id", F.when(F.col("d.kind") == "special", "special").otherwise(F.col("d.number")).alias("accepted"))


@query("""SELECT p_partkey AS id, f.field, CASE f.field WHEN 'volume_number' THEN p_size::VARCHAR ELSE (p_size + 100)::VARCHAR END AS value FROM part, (VALUES ('volume_number'), ('page_count')) f(field) WHERE (f.field = 'page_count' OR p_partkey % 2 = 0)""")
def xml_enrichment(spark, sf_dir):
    """Two claim fields out of keyed XML answers; what an answer lacks gives no claim."""
    p = rows(spark, sf_dir, """SELECT p_partkey AS id, '<r><n>' || CASE WHEN p_partkey % 2 = 0 THEN '' || p_size ELSE 'x' END || '</n><p>' || (p_size + 100) || ' p.</p></r>' AS x FROM {part}""")
    r = p.select("id", F.from_xml("x", "n string, p string").alias("r"))
    two = F.array(F.struct(F.lit("volume_number").alias("field"), F.nullif(F.regexp_extract("r.n", "^([0-9]+)$", 1), F.lit("")).alias("value")), F.struct(F.lit("page_count").alias("field"), F.nullif(F.regexp_extract("r.p", "^([0-9]+) p", 1), F.lit("")).alias("value")))
    return r.select("id", F.explode(two).alias("c")).select("id", "c.*").where("value is not null")


@query("""WITH i AS (SELECT l_partkey AS isbn, min(l_returnflag) AS medium FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_returnflag) = 1), t AS (SELECT p_name AS title, min(p_type) AS medium FROM part GROUP BY p_name HAVING count(DISTINCT p_type) = 1)
SELECT p_partkey AS line, coalesce(i.medium, t.medium) AS medium, CASE WHEN i.medium IS NOT NULL THEN 'isbn' WHEN t.medium IS NOT NULL THEN 'title' ELSE 'unresolved' END AS why FROM part LEFT JOIN i ON isbn = p_partkey LEFT JOIN t ON title = p_name""")
def resolved_media(spark, sf_dir):
    """A library line's medium by its ISBN, else by a title that has one medium only."""
    single = lambda df, key, value, name: df.groupBy(key).agg(F.min(value).alias(name), F.count_distinct(value).alias("k")).where("k = 1").drop("k")
    p = table(spark, sf_dir, "part")
    by_isbn = single(table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey"), "p_partkey", "l_returnflag", "a")
    by_title = single(p, "p_name", "p_type", "b")
    j = p.join(by_isbn, "p_partkey", "left").join(by_title, "p_name", "left")
    return j.select(F.col("p_partkey").alias("line"), F.coalesce("a", "b").alias("medium"), F.when(F.col("a").isNotNull(), "isbn").when(F.col("b").isNotNull(), "title").otherwise("unresolved").alias("why"))


@query()
def fuzzy_duplicates(spark, sf_dir):
    """Titles of a group that are alike by difflib; the ratio has no SQL, a test holds it against all pairs."""
    p = table(spark, sf_dir, "part")
    return linkage.similar_titles(p.select(F.col("p_type").alias("group"), F.concat_ws(" ", "p_name", "p_brand").alias("name")))


