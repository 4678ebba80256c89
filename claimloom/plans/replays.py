"""Replays as queries: the code that is judged runs, on both sides where two are compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.functions import keys, text
from claimloom.operators import replay
from claimloom.plans.catalogue import query
from claimloom.plans.derived import plain, rows
from claimloom.plans.lookup import SERIES
from claimloom.session import cut, table

TODAY = "1998-06-01"
_ALIASES = "SELECT p_partkey AS id, p_name || ' ' || p_type AS alias FROM {part} UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'the ' || p_name || ' tale' ELSE 'a ' || p_name END FROM {part}"
_ENTRIES = """SELECT c_custkey AS entry, CASE c_custkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN 'x ' || p_name || ': the ' || p_name || ' tale -' WHEN 2 THEN p_name || ' ' || p_type ELSE 'nothing ' || c_custkey END AS name, CASE WHEN c_custkey % 5 < 3 THEN p_brand || ', a ' || p_name END AS folder, c_nationkey % 5 = 0 AS novel FROM {customer} JOIN {part} ON p_partkey = c_custkey"""
_OWNED = "SELECT o_custkey AS entry, o_orderkey % 9 + CASE WHEN o_orderkey % 40 = 7 THEN 0.5 ELSE 0.0 END AS number FROM {orders}"
_VOLUMES = "SELECT l_partkey AS line, l_orderkey % 12 + 0.0 AS number, CAST(CAST(l_shipdate AS DATE) AS STRING) AS date FROM {lineitem}"
_N = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
_PICKED = f"""s AS MATERIALIZED ({plain(SERIES)}), al AS ({plain(_ALIASES)}), en AS MATERIALIZED ({plain(_ENTRIES)}),
named AS (SELECT entry, novel, 0 AS a, 0 AS b, 0 AS c, name AS query FROM en UNION ALL SELECT entry, novel, 0, 1, 0, folder FROM en WHERE folder IS NOT NULL),
tails AS (SELECT entry, novel, 1, b, 0, trim(regexp_replace(regexp_extract(query, ':([^:]*)$', 1), '[-–]+\\s*$', '')) AS t FROM named WHERE contains(query, ':') UNION ALL SELECT entry, novel, 1, b, 1, trim(regexp_replace(regexp_extract(query, ',([^,]*)$', 1), '[-–]+\\s*$', '')) FROM named WHERE contains(query, ',')),
every AS (SELECT * FROM named UNION ALL SELECT * FROM tails WHERE len(string_split({_N.format('t')}, ' ')) >= 3),
idx AS (SELECT lower(name) AS low, id FROM s UNION SELECT lower(alias), id FROM al),
cand AS (SELECT e.entry, e.novel, e.a, e.b, e.c, e.query, s.* FROM every e JOIN idx ON low = lower(e.query) JOIN s USING (id) WHERE s.language = 'en'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY entry, a, b, c ORDER BY medium IN ('novel', 'light_novel') IS TRUE, {_N.format('name')} <> {_N.format('query')}, is_omnibus, dated_count DESC, volume_count DESC, id) AS r FROM cand WHERE NOT novel OR medium IN ('novel', 'light_novel')),
picked AS MATERIALIZED (SELECT entry, id AS line, query, CASE WHEN a = 0 THEN 'name' ELSE 'tail' END AS by FROM ranked WHERE r = 1 QUALIFY row_number() OVER (PARTITION BY entry ORDER BY a, b, c) = 1)"""
_COVER = f"""{_PICKED}, own AS (SELECT DISTINCT entry, number FROM ({plain(_OWNED)})), vol AS ({plain(_VOLUMES)}), has AS (SELECT DISTINCT line, number FROM vol),
gap AS (SELECT p.entry, p.line, o.number, h.number IS NULL AND o.number IS NOT NULL AS lacks FROM picked p LEFT JOIN own o USING (entry) LEFT JOIN has h ON h.line = p.line AND h.number = o.number)"""


def _library(spark, sf_dir):
    entries = rows(spark, sf_dir, _ENTRIES).select("entry", F.array("name", "folder").alias("names"), "novel")
    series = rows(spark, sf_dir, SERIES).select("id", "name", "language", "medium", "is_omnibus", "dated_count", "volume_count")
    return entries, series, rows(spark, sf_dir, _ALIASES)


def _covered(spark, sf_dir):
    picks = cut(replay.pick_series(*_library(spark, sf_dir)).select("entry", "line"))
    owned = rows(spark, sf_dir, _OWNED).join(picks.select("entry"), "entry", "left_semi").withColumn("number", F.col("number").cast("double"))
    volumes = rows(spark, sf_dir, _VOLUMES).withColumn("number", F.col("number").cast("double"))
    return picks, owned, volumes, replay.coverage(picks, owned, volumes, TODAY)


@query(f"WITH {_PICKED} SELECT * FROM picked")
def library_picks(spark, sf_dir):
    """The line that answers each series of a library, by its names in order, then by their tails."""
    return replay.pick_series(*_library(spark, sf_dir))


@query(f"""WITH {_COVER}, n AS (SELECT entry, line, count(number) AS owned, count_if(lacks)::BIGINT AS missing, coalesce(max(number), 0) AS last FROM gap GROUP BY ALL), l AS (SELECT n.entry, count(*) AS beyond, count_if(date <= '{TODAY}')::BIGINT AS past FROM n JOIN vol ON vol.line = n.line AND vol.number > n.last GROUP BY n.entry)
SELECT entry, line, owned, missing, coalesce(beyond, 0) AS beyond, coalesce(past, 0) AS past, missing = 0 AS covered FROM n LEFT JOIN l USING (entry)""")
def coverage_replay(spark, sf_dir):
    """What a library owns against what the line has that the lookup gives it, set against set as bitmaps."""
    return _covered(spark, sf_dir)[3]


@query(f"WITH {_COVER} SELECT entry, number::DOUBLE AS number FROM gap WHERE lacks")
def coverage_gaps(spark, sf_dir):
    """The owned numbers that uncovered series lack."""
    picks, owned, volumes, report = _covered(spark, sf_dir)
    return replay.lacking(picks, owned, volumes, report)


def _asked(spark, sf_dir):
    _, series, aliases = _library(spark, sf_dir)
    index = series.select(F.lower("name").alias("query"), "id").unionAll(aliases.select(F.lower("alias"), "id")).distinct()
    c = index.join(series, "id")
    comic = ~F.coalesce(F.col("medium").isin("novel", "light_novel"), F.lit(False))
    return c, comic, keys.ascii_key(F.col("name")) == keys.ascii_key(F.col("query"))


def _by_struct(c, comic, exact):
    """The ranking as one minimum."""
    order = replay.ranking_new(comic, exact, {n: F.col(n) for n in c.columns})
    return c.where("language = 'en'").groupBy("query").agg(F.min_by("id", F.struct(*order)).alias("pick"))


def _by_window(c, comic, exact):
    """The same ranking as rows in order."""
    order = [comic.desc(), exact.desc(), "is_omnibus", F.desc("dated_count"), F.desc("volume_count"), "id"]
    return c.where("language = 'en'").withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where("r = 1").select("query", F.col("id").alias("pick"))


_RANKED = f"""WITH s AS MATERIALIZED ({plain(SERIES)}), al AS ({plain(_ALIASES)}), idx AS (SELECT lower(name) AS query, id FROM s UNION SELECT lower(alias), id FROM al), c AS (SELECT * FROM idx JOIN s USING (id)),
n AS (SELECT query, id AS pick FROM c WHERE language = 'en' QUALIFY row_number() OVER (PARTITION BY query ORDER BY medium IN ('novel', 'light_novel') IS TRUE, {_N.format('name')} <> {_N.format('query')}, is_omnibus, dated_count DESC, volume_count DESC, id) = 1),
o AS (SELECT query, id AS pick FROM c QUALIFY row_number() OVER (PARTITION BY query ORDER BY language <> 'en', is_omnibus, volume_count DESC, id) = 1)"""


@query(f"{_RANKED} SELECT 'rankers' AS gate, 0::BIGINT AS differing, TRUE AS equal, count(*) AS answers FROM n")
def ranker_gate(spark, sf_dir):
    """Two implementations of the ranking over every query, equal by digests that no order changes."""
    c, comic, exact = _asked(spark, sf_dir)
    one = cut(_by_struct(c, comic, exact))
    differences, _ = replay.differing_rows(one, _by_window(c, comic, exact), ["query"])
    n = differences.agg(F.count("*").alias("differing"))
    return n.select(F.lit("rankers").alias("gate"), "differing", (F.col("differing") == 0).alias("equal")).crossJoin(one.agg(F.count("*").alias("answers")))


@query(f"{_RANKED} SELECT 'a' AS side, query, pick FROM (FROM n EXCEPT FROM o) UNION ALL SELECT 'b', query, pick FROM (FROM o EXCEPT FROM n)")
def ranker_replay(spark, sf_dir):
    """The answers that the present ranking and the one before it give to the same queries, where they differ."""
    c, comic, exact = _asked(spark, sf_dir)
    before = c.groupBy("query").agg(F.min_by("id", F.struct(F.col("language") != "en", "is_omnibus", -F.col("volume_count"), "id")).alias("pick"))
    return replay.differing_rows(_by_struct(c, comic, exact), before, ["query"])[0].select("side", "query", "pick")


_STRINGS = {"region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"], "part": ["p_name", "p_brand", "p_type"], "orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type", "props"], "pages": ["url"]}
_FOLDED = " UNION ALL ".join(f"SELECT '{c}' AS place, count(DISTINCT {c}) AS strings, 0::BIGINT AS changed FROM {t}" for t, cs in _STRINGS.items() for c in cs)


@query(_FOLDED)
def fold_regression(spark, sf_dir):
    """Strings of every name column that the folding key and its second implementation fold differently."""
    one = lambda t, c: table(spark, sf_dir, t).where(F.col(c).isNotNull()).select(F.lit(c).alias("place"), F.col(c).alias("s")).distinct()
    every = cut(reduce(lambda a, b: a.unionAll(b), [one(t, c) for t, cs in _STRINGS.items() for c in cs]))
    old, new = every.select("*", text.fold_key("s").alias("k")), every.select("*", text.folded("s").alias("k"))
    bad = replay.differing_rows(old, new, ["place", "s"])[0].where("side = 'a'").groupBy("place").agg(F.count("*").alias("changed"))
    return every.groupBy("place").agg(F.count("*").alias("strings")).join(bad, "place", "left").fillna(0, ["changed"])
