"""Dates, numbers, identifiers and persons as queries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.functions import dates, keys, people, text, worded
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows

RAW = """SELECT o_orderkey AS id, o_custkey % 28 + 1 AS d, o_orderkey % 12 + 1 AS m, 1995 + o_custkey % 20 AS y, o_orderkey % 10 AS form, CASE WHEN o_custkey % 2 = 0 THEN 'EN' ELSE 'FR' END AS market,
 CASE o_orderkey % 12 + 1 WHEN 1 THEN 'January' WHEN 2 THEN 'Feb' WHEN 3 THEN 'march' WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sept' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' ELSE 'December' END AS word FROM {orders}"""
_R = f"WITH r AS (SELECT *, y::VARCHAR AS ys, lpad(m::VARCHAR, 2, '0') AS ms, lpad(d::VARCHAR, 2, '0') AS ds FROM ({plain(RAW)}))"


@query(f"""{_R} SELECT id, CASE form WHEN 0 THEN ys || '-' || ms || '-' || ds WHEN 1 THEN ys || '-' || ms WHEN 2 THEN ys || '-' || ms || '-' || ds WHEN 3 THEN ys || '-' || ms WHEN 4 THEN ys || '-02' WHEN 5 THEN NULL ELSE ys END AS compact FROM r""")
def compact_dates(spark, sf_dir):
    """Compact and partial dates, notes dropped, impossible days cut, impossible months refused."""
    r = rows(spark, sf_dir, RAW)
    y, m, d = (F.col(c).cast("string") for c in ("y", "m", "d"))
    pad = lambda c: F.lpad(c, 2, "0")
    s = F.expr("null")
    f = F.col("form")
    s = F.when(f == 0, F.concat(y, pad(m), pad(d))).when(f == 1, F.concat(y, F.lit("-"), m, F.lit(" (第9刷)"))).when(f == 2, F.concat_ws("-", y, m, d)).when(f == 3, F.concat(y, F.lit("-"), m, F.lit("-")))
    s = s.when(f == 4, F.concat(y, F.lit("-02-30"))).when(f == 5, F.concat(y, F.lit("-57"))).otherwise(y)
    return r.select("id", dates.parse_compact(s).alias("compact"))


@query(f"""{_R} SELECT id, CASE form WHEN 0 THEN ys || '-' || ms || '-' || ds WHEN 1 THEN ys || '-' || ms || '-' || ds WHEN 2 THEN ys || '-' || ms WHEN 3 THEN CASE WHEN d > 12 THEN ys || '-' || ms || '-' || ds ELSE ys || '-' || CASE WHEN market = 'EN' THEN ds ELSE ms END END
WHEN 4 THEN ys || '-' || ms || '-' || ds WHEN 5 THEN ys ELSE NULL END AS free, CASE form WHEN 0 THEN ys || '-' || ms || '-' || ds WHEN 1 THEN d || ' ' || word || ' ' || ys WHEN 2 THEN ys || '-' || ms WHEN 3 THEN ys || '-' || ms || '-' || ds WHEN 4 THEN word || ' ' || ys ELSE ys END AS flat,
m::INTEGER AS month FROM r""")
def free_dates(spark, sf_dir):
    """Free-text dates, date templates as text, month names."""
    r = rows(spark, sf_dir, RAW)
    y, m, d, w, f = F.col("y").cast("string"), F.col("m").cast("string"), F.col("d").cast("string"), F.col("word"), F.col("form")
    pad = lambda c: F.lpad(c, 2, "0")
    s = F.when(f == 0, F.concat(w, F.lit(" "), d, F.lit(", "), y)).when(f == 1, F.concat_ws(" ", d, w, y)).when(f == 2, F.concat_ws(" ", w, y)).when(f == 3, F.concat_ws("/", d, m, y)).when(f == 4, F.concat_ws("-", y, pad(m), pad(d))).when(f == 5, y).otherwise("soon")
    open_, close, bar = F.lit("{{"), F.lit("}}"), F.lit("|")
    t = F.when(f == 0, F.concat(open_, F.lit("start date|"), y, bar, m, bar, d, F.lit("|df=yes"), close)).when(f == 1, F.concat(open_, F.lit("Date|"), d, F.lit("er|"), w, bar, y, close)).when(f == 2, F.concat(open_, F.lit("dts|"), y, bar, m, close))
    t = t.when(f == 3, F.concat(open_, F.lit("date|"), d, bar, m, bar, y, close)).when(f == 4, F.concat(open_, F.lit("date-|"), w, F.lit(" "), y, close)).otherwise(y)
    return r.select("id", dates.parse_free(s, F.col("market")).alias("free"), dates.expand_template(t).alias("flat"), dates.month_index(w).cast("int").alias("month"))


@query(f"""{_R} SELECT id, CASE form WHEN 0 THEN ys || '-' || ms || '-' || ds WHEN 1 THEN ys || '-' || ms WHEN 2 THEN ys || '-' || ms WHEN 3 THEN CASE WHEN d > 12 THEN ys || '-' || ms || '-' || ds WHEN d = m THEN ys || '-' || ms || '-' || ds ELSE ys END ELSE ys END AS iso,
CASE form WHEN 0 THEN 'day' WHEN 1 THEN 'month' WHEN 2 THEN 'month' WHEN 3 THEN CASE WHEN d > 12 OR d = m THEN 'day' ELSE 'year' END ELSE 'year' END AS precision FROM r""")
def worded_dates(spark, sf_dir):
    """Dates in words of several languages with their precision; an impossible day leaves the month."""
    r = rows(spark, sf_dir, RAW)
    y, m, d, w, f = F.col("y").cast("string"), F.col("m").cast("string"), F.col("d").cast("string"), F.col("word"), F.col("form")
    s = F.when(f == 0, F.concat(w, F.lit(" "), d, F.lit(", "), y)).when(f == 1, F.concat(F.lit("31 "), F.when(F.col("m").isin(2, 4, 6, 9, 11), w).otherwise(F.lit("x")), F.lit(" "), y)).when(f == 2, F.concat_ws(" ", w, y)).when(f == 3, F.concat_ws("/", d, m, y)).otherwise(F.concat(F.lit("ca. "), y))
    s = F.when((f == 1) & ~F.col("m").isin(2, 4, 6, 9, 11), F.concat_ws(" ", w, y)).otherwise(s)
    return r.select("id", worded.iso_date(s).alias("iso")).select("id", "iso", keys.precision(F.col("iso")).alias("precision"))


NUMBERS = """SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part, CASE l_partkey % 9 WHEN 0 THEN 'Vol. 0' || l_linenumber WHEN 1 THEN l_linenumber || ' – ' || (l_linenumber + 3) WHEN 2 THEN l_linenumber || '.5' WHEN 3 THEN '—' WHEN 4 THEN 'Ex' || l_linenumber WHEN 5 THEN NULL WHEN 6 THEN 'Tome ' || l_linenumber
 WHEN 7 THEN '9-3' ELSE '00' || l_linenumber END AS label FROM {lineitem}"""


@query(f"""WITH n AS ({plain(NUMBERS)}) SELECT part % 9 AS form, label, CASE part % 9 WHEN 0 THEN line::VARCHAR WHEN 1 THEN line || '-' || (line + 3) WHEN 2 THEN line || '.5' WHEN 4 THEN 'Ex' || line WHEN 6 THEN line::VARCHAR WHEN 7 THEN '9-3' WHEN 8 THEN line::VARCHAR END AS number,
CASE part % 9 WHEN 1 THEN 'range' WHEN 2 THEN 'decimal' WHEN 3 THEN 'blank' WHEN 4 THEN 'special' WHEN 5 THEN 'blank' WHEN 7 THEN 'special' ELSE 'int' END AS kind, count(*) AS n FROM n GROUP BY ALL""")
def canonical_numbers(spark, sf_dir):
    """Canonical volume numbers and their kinds."""
    n = rows(spark, sf_dir, NUMBERS).withColumn("s", dates.canonical_number(F.col("label")))
    return n.groupBy((F.col("part") % 9).alias("form"), "label", F.col("s.number").alias("number"), F.col("s.kind").alias("kind")).agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT p_partkey AS id, p_size AS a, p_size + p_partkey % 7 AS b, p_partkey % 3 AS k FROM part),
e AS (SELECT id, CASE WHEN k = 2 AND b > a THEN list_transform(range(0, b - a + 1), lambda i: a + i + 0.5) WHEN k = 2 THEN [a + 0.5] ELSE list_transform(range(a, b + 1), lambda i: i::DOUBLE) END AS xs, CASE WHEN k = 1 AND b > a THEN [b + 0.5] WHEN k = 1 THEN [b + 0.5] ELSE [] END AS tail FROM p)
SELECT id, array_to_string(list_transform(list_concat(xs, tail), lambda x: printf('%.1f', x)), ' ') AS chapters FROM e""")
def chapter_lists(spark, sf_dir):
    """Chapter lists: ranges, halves at one end or both."""
    p = rows(spark, sf_dir, "SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN p_size || '-' || (p_size + p_partkey % 7) WHEN 1 THEN 'ch. ' || p_size || ' – ' || (p_size + p_partkey % 7) || '.5' ELSE p_size || '.5-' || (p_size + p_partkey % 7) || '.5' END AS s FROM {part}")
    return p.select("id", F.array_join(F.transform(text.chapter_numbers("s"), lambda x: F.format_string("%.1f", x)), " ").alias("chapters"))


PEOPLE = """SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN 'Ōda, Eiichirō' WHEN 1 THEN 'Eiichiro Oda' WHEN 2 THEN 'Park, Jin-hwan' WHEN 3 THEN 'Park Jin Hwan (Studio)' WHEN 4 THEN 'Kohske' ELSE 'Al' END AS a,
 CASE c_nationkey % 5 WHEN 0 THEN 'Eiichirou Oda' WHEN 1 THEN 'Jinhwan Park' WHEN 2 THEN 'Kōsuke Ito' WHEN 3 THEN 'Sakamoto, Oda' ELSE NULL END AS b FROM {customer}"""


@query(f"""WITH p AS ({plain(PEOPLE)}), k AS (SELECT id, a, b, CASE id % 6 WHEN 0 THEN 'oda:eiichiro oda' WHEN 1 THEN 'oda:eiichiro oda' WHEN 2 THEN 'park:jinhwan park' WHEN 3 THEN 'hwan:hwan jin park' WHEN 4 THEN 'kohske:kohske' END AS name,
CASE id % 6 WHEN 0 THEN 'oda/eiichiro' WHEN 1 THEN 'eiichiro/oda oda/eiichiro eiichirooda/' WHEN 2 THEN 'park/jinhwan' WHEN 3 THEN 'hwan/parkjin park/jinhwan parkjinhwan/' WHEN 4 THEN 'kohske/' ELSE 'al/' END AS parts FROM p)
SELECT id, name, list_aggregate(list_sort(string_split(parts, ' ')), 'string_agg', ' ') AS splits, coalesce(CASE WHEN id % 6 < 2 THEN starts_with(b, 'Eii') WHEN id % 6 IN (2, 3) THEN starts_with(b, 'Jin') WHEN id % 6 = 4 THEN starts_with(b, 'K') ELSE false END, false) AS same,
coalesce(CASE WHEN id % 6 < 2 THEN false WHEN id % 6 IN (2, 3) THEN starts_with(b, 'Jin') ELSE false END, false) AS same_full FROM k""")
def persons(spark, sf_dir):
    """Name keys, splits into family and given name, and two tests of whether names are one person's."""
    p = rows(spark, sf_dir, PEOPLE).withColumns({"k": people.person_key(F.col("a")), "q": people.person_key(F.col("b")), "s": people.person_splits(F.col("a")), "t": people.person_splits(F.col("b"))})
    told = F.array_join(F.array_sort(F.transform("s", lambda x: F.concat(x["family"], F.lit("/"), x["given"]))), " ")
    return p.select(
        "id", F.when(F.col("k.family").isNotNull(), F.concat(F.col("k.family"), F.lit(":"), F.array_join("k.tokens", " "))).alias("name"), told.alias("splits"),
        people.same_person(F.col("k"), F.col("q")).alias("same"), F.coalesce(F.arrays_overlap("s", "t"), F.lit(False)).alias("same_full"),
    )


@query("""SELECT s_suppkey AS id, replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(w, 'tsu', 'tu', 'g'), 'shi', 'si', 'g'), 'chi', 'ti', 'g'), 'ou', 'o'), 'll', 'l'), 'kk', 'k') AS romanised,
'978' || substr(b, 1, 9) || (10 - list_sum(list_transform(range(1, 13), lambda k: substr('978' || b, k, 1)::INT * CASE WHEN k % 2 = 1 THEN 1 ELSE 3 END)) % 10)::INT % 10 AS isbn13
FROM (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'toukko' WHEN 1 THEN 'matsushi' ELSE 'chillo' END AS w, lpad((s_suppkey * 37)::VARCHAR, 9, '0') AS b FROM supplier)""")
def romanised_and_isbn10(spark, sf_dir):
    """One romanisation a token; ISBN-10 to 13."""
    s = rows(spark, sf_dir, "SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'toukko' WHEN 1 THEN 'matsushi' ELSE 'chillo' END AS w, lpad(CAST(s_suppkey * 37 AS VARCHAR(12)), 9, '0') AS b FROM {supplier}")
    return s.select("id", people.romanised(F.col("w")).alias("romanised"), keys.isbn10_to_13(F.concat("b", F.lit("X"))).alias("isbn13"))


@query("""WITH p AS (SELECT p_partkey, p_name, p_size, CASE WHEN p_size % 3 = 0 THEN 'Ex' || p_size ELSE (p_size * 1.5)::VARCHAR END AS n FROM part)
SELECT p_partkey, row_number() OVER (ORDER BY try_cast(n AS DOUBLE) IS NULL, try_cast(n AS DOUBLE), n, p_partkey)::INTEGER AS numeric_place, row_number() OVER (ORDER BY lower(CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE p_name END), p_partkey)::INTEGER AS nocase_place FROM p""")
def orders_of_labels(spark, sf_dir):
    """Numbers before labels, and an order that ignores case; places by range-partitioned ranks would suffice at scale, the report is one list."""
    p = rows(spark, sf_dir, "SELECT p_partkey, p_name, p_size, CASE WHEN p_size % 3 = 0 THEN 'Ex' || p_size ELSE CAST(p_size * 1.5 AS DECIMAL(9, 1)) || '' END AS n FROM {part}")
    x = F.col("n").try_cast("double")
    shown = F.when(F.col("p_size") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return p.select("p_partkey", F.row_number().over(Window.orderBy(x.isNull(), x, "n", "p_partkey")).alias("numeric_place"), F.row_number().over(Window.orderBy(F.lower(shown), "p_partkey")).alias("nocase_place"))


@query("""WITH i AS (SELECT c_nationkey AS g, CASE WHEN c_custkey % 3 = 0 THEN 'w' || c_custkey END AS held, 'n' || c_custkey AS id, c_custkey FROM customer)
SELECT g, coalesce(arg_min(held, c_custkey) FILTER (held IS NOT NULL), min(id)) AS older FROM i GROUP BY g""")
def older_ids(spark, sf_dir):
    """Of a group's ids the one whose carried number is smallest; without one the first in order."""
    c = rows(spark, sf_dir, "SELECT c_nationkey AS g, CASE WHEN c_custkey % 3 = 0 THEN 'w' || c_custkey END AS held, 'n' || c_custkey AS id, c_custkey FROM {customer}")
    return c.groupBy("g").agg(F.coalesce(F.min_by("held", F.when(F.col("held").isNotNull(), F.col("c_custkey"))), F.min("id")).alias("older"))


@query("""WITH d AS (SELECT o_custkey AS g, o_orderkey % 4 > 0 AS deposited, CASE WHEN o_orderkey % 5 > 0 THEN (1998 + o_orderkey % 30) END AS y, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 8 = 0 THEN '2023-0' || (o_orderkey % 9 + 1) END AS planned, o_orderkey AS seq FROM orders),
a AS (SELECT g, bool_or(deposited) AS any_deposited, min(y) FILTER (deposited) AS first_year, arg_min(planned, seq) FILTER (planned IS NOT NULL) AS planned, greatest(coalesce(max(y), 0), coalesce(substr(arg_min(planned, seq) FILTER (planned IS NOT NULL), 1, 4)::INT, 0)) AS last_year FROM d GROUP BY g)
SELECT g, CASE WHEN any_deposited THEN first_year::VARCHAR WHEN last_year > 2024 THEN 'HELD' WHEN (2024 - substr(planned, 1, 4)::INT) * 12 + 6 - substr(planned, 6, 2)::INT > 12 THEN NULL ELSE planned END AS value,
CASE WHEN any_deposited THEN CASE WHEN first_year IS NOT NULL THEN 'published' END WHEN last_year > 2024 THEN NULL WHEN planned IS NOT NULL AND (2024 - substr(planned, 1, 4)::INT) * 12 + 6 - substr(planned, 6, 2)::INT <= 12 THEN 'projected' END AS type FROM a""")
def group_dates(spark, sf_dir):
    """A group's date: the first year of what was deposited, else the planned month, held in a future year and dropped when long past."""
    d = rows(spark, sf_dir, """SELECT o_custkey AS g, o_orderkey % 4 > 0 AS deposited, CASE WHEN o_orderkey % 5 > 0 THEN (1998 + o_orderkey % 30) END AS y, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 8 = 0 THEN '2023-0' || (o_orderkey % 9 + 1) END AS planned, o_orderkey AS seq FROM {orders}""")
    planned = F.min_by("planned", F.when(F.col("planned").isNotNull(), F.col("seq")))
    a = d.groupBy("g").agg(F.bool_or("deposited").alias("some"), F.min(F.when(F.col("deposited"), F.col("y"))).alias("first"), planned.alias("planned"), F.max("y").alias("y"))
    held = F.greatest(F.col("y").cast("int"), F.substring("planned", 1, 4).cast("int")) > 2024
    old = keys.months_between_iso(F.col("planned"), F.lit("2024-06")) > 12
    value = F.when(F.col("some"), F.col("first").cast("string")).when(held, "HELD").when(old, None).otherwise(F.col("planned"))
    kind = F.when(value.isNull() | (value == "HELD"), None).when(F.col("some"), "published").otherwise("projected")
    return a.select("g", value.alias("value"), kind.alias("type"))


_ORIGIN = ["JP", "KR", "CN", "TW"]


@query("""WITH l AS (SELECT l_partkey % 500 AS work, CASE l_suppkey % 4 WHEN 0 THEN 'manga' WHEN 1 THEN 'manhwa' WHEN 2 THEN 'manhua' ELSE 'novel' END AS medium, ['JP', 'KR', 'CN', 'TW', 'EN', 'DE'][l_linenumber % 6 + 1] AS market, CASE WHEN l_orderkey % 6 > 0 THEN strftime(l_shipdate, '%Y-%m') END AS d FROM lineitem WHERE l_linenumber < 3 OR l_suppkey % 4 = 3),
m AS (SELECT work, medium, market, min(d) AS d, list_position(['JP', 'KR', 'CN', 'TW'], market) AS p FROM l GROUP BY ALL),
o AS (SELECT work, medium, CASE WHEN medium = 'manhwa' AND bool_or(market = 'KR') THEN 'KR' WHEN medium = 'manhua' AND bool_or(market = 'CN') THEN 'CN' WHEN medium = 'manhua' AND bool_or(market = 'TW') THEN 'TW' ELSE coalesce(arg_min(market, d || p) FILTER (p > 0 AND d IS NOT NULL), arg_min(market, p) FILTER (p > 0)) END AS origin FROM m GROUP BY work, medium),
f AS (SELECT work, coalesce(arg_min(market, d || p) FILTER (d IS NOT NULL), arg_min(market, p)) AS origin FROM (SELECT work, market, min(d) AS d, any_value(p) AS p FROM m WHERE medium IN ('manga', 'manhwa', 'manhua') AND p > 0 GROUP BY work, market) GROUP BY work)
SELECT work, medium, coalesce(o.origin, CASE WHEN medium <> 'novel' THEN f.origin END) AS origin, o.origin IS NULL AND medium <> 'novel' AND f.origin IS NOT NULL AS by_family FROM o LEFT JOIN f USING (work)""")
def origin_markets(spark, sf_dir):
    """The origin of every (work, medium): a hint of the medium, the earliest dated, the fixed order; comics without one look across their family."""
    l = rows(spark, sf_dir, """SELECT l_partkey % 500 AS work, CASE l_suppkey % 4 WHEN 0 THEN 'manga' WHEN 1 THEN 'manhwa' WHEN 2 THEN 'manhua' ELSE 'novel' END AS medium, CASE l_linenumber % 6 WHEN 0 THEN 'JP' WHEN 1 THEN 'KR' WHEN 2 THEN 'CN' WHEN 3 THEN 'TW' WHEN 4 THEN 'EN' ELSE 'DE' END AS market,
        CASE WHEN l_orderkey % 6 > 0 THEN date_format(l_shipdate, 'yyyy-MM') END AS d FROM {lineitem} WHERE l_linenumber < 3 OR l_suppkey % 4 = 3""")  # noqa: E741
    place = F.array_position(F.array(*[F.lit(x) for x in _ORIGIN]), F.col("market"))
    m = l.groupBy("work", "medium", "market").agg(F.min("d").alias("d")).withColumn("p", place)
    has = lambda name: F.bool_or(F.col("market") == name)
    old = F.col("p") > 0
    dated = F.min_by("market", F.when(old & F.col("d").isNotNull(), F.struct("d", "p")))
    fixed = F.min_by("market", F.when(old, F.col("p")))
    o = m.groupBy("work", "medium").agg(
        F.when((F.col("medium") == "manhwa") & has("KR"), "KR").when((F.col("medium") == "manhua") & has("CN"), "CN").when((F.col("medium") == "manhua") & has("TW"), "TW").otherwise(F.coalesce(dated, fixed)).alias("own")
    )
    comic = m.where(F.col("medium").isin("manga", "manhwa", "manhua") & old).groupBy("work", "market", "p").agg(F.min("d").alias("d"))
    fam = comic.groupBy("work").agg(F.coalesce(dated, fixed).alias("family"))
    other = F.when(F.col("medium") != "novel", F.col("family"))
    return o.join(fam, "work", "left").select("work", "medium", F.coalesce("own", other).alias("origin"), (F.col("own").isNull() & other.isNotNull()).alias("by_family"))
