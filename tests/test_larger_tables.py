"""What larger tables bring: larger keys, ids that meet, many equal lines, small files that give one task."""

import difflib
import itertools
import random

import duckdb
import pytest
from test_catalogue import DIR, TABLES, rows

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers every plan)
from claimloom.functions import keys
from claimloom.operators import identity, intake, linkage, ranking
from claimloom.plans import catalogue, linking
from claimloom.sources import cache


def against_sql(spark, folder, name, **tables):
    """A query against its SQL where some tables are given as SQL over the smallest ones."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view small_{t} as select * from '{DIR}/{t}.parquet'")
        con.execute(f"copy ({tables.get(t, f'select * from small_{t}')}) to '{folder}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df, want = catalogue.QUERIES[name](spark, str(folder)), con.execute(catalogue.ORACLE_SQL[name])
    got = rows(df.columns, df.collect())
    assert got == rows([d[0] for d in want.description], want.fetchall())
    return got[1]


def test_control_numbers_of_keys_beyond_six_digits(spark, tmp_path):
    found = against_sql(spark, tmp_path, "record_extents", part="select p_partkey + 1000000 as p_partkey, * exclude (p_partkey) from small_part")
    assert len(found) == 200


def test_an_id_that_two_tables_export_has_a_row_each(spark, tmp_path):
    ids = lambda rows: spark.createDataFrame(rows, "id int, kind string")
    before = spark.createDataFrame([(1, "line", "b1"), (2, "line", "b1")], "id int, kind string, first_build string")
    redirects = spark.createDataFrame([(2, 1)], "old_id int, new_id int")
    got = [tuple(r) for r in intake.shipped_registry(before, ids([(1, "line"), (9, "line"), (1, "line"), (9, "line")]), redirects, "b2").collect()]
    assert sorted(got) == [(1, "line", "b1", "shipped")] * 2 + [(2, "line", "b1", "redirected")] + [(9, "line", "b2", "shipped")] * 2
    against_sql(spark, tmp_path, "shipped_ids", orders="select o_orderkey + 4000000 - 10 as o_orderkey, * exclude (o_orderkey) from small_orders")


def test_near_names_broadcasts_no_forms(spark):
    # A small file by Spark's estimate, as an explode's rows are not counted in it.
    plan = catalogue.QUERIES["near_names"](spark, DIR)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_mostly_held_equals_all_pairs(spark):
    dice = random.Random(4)
    for most in (3, 6, 12):
        keys = {(dice.randrange(3), line): {dice.randrange(12) for _ in range(dice.randrange(1, most))} for line in range(60)}
        nulls = {owner for owner in keys if owner[1] % 5 == 0}
        data = [(g, line, k) for (g, line), held in keys.items() for k in held] + [(g, line, None) for g, line in nulls]
        want = set()
        for (a, x), (b, y) in itertools.permutations(keys.items(), 2):
            if a[0] == b[0] and 2 * len(x & y) > len(x) + (a in nulls):
                want.add(a[1])
        got = [r.line for r in linkage.mostly_held(spark.createDataFrame(data, "work int, line int, isbn int"), ["work"], "line", "isbn").collect()]
        assert len(got) == len(set(got)) and set(got) == want and 0 < len(want) < 60


@pytest.mark.parametrize("name", ["record_identifiers", "record_numbers", "record_classes", "record_extents", "infoboxes", "volume_templates"])
def test_a_small_file_is_dealt_over_the_cores(spark, name):
    assert catalogue.QUERIES[name](spark, DIR).rdd.getNumPartitions() >= 8


def test_shared_votes_are_dealt_over_the_cores(spark):
    votes = linking._votes(spark, DIR)
    assert votes.rdd.getNumPartitions() >= 8
    assert votes.groupBy("mine", "theirs").count().where("count > 1").isEmpty()


def test_series_of_one_name_meet_queries_as_one_row(spark, tmp_path):
    found = against_sql(spark, tmp_path, "series_lookup", part="select p_partkey, CASE WHEN p_partkey % 5 > 0 THEN 'Hot bolt' ELSE p_name END as p_name, * exclude (p_partkey, p_name) from small_part")
    assert len(found) > 7
    # Queries join aggregated keys once; candidates are not joined again by their ids.
    plan = catalogue.QUERIES["series_lookup"](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1


def test_pages_of_the_same_words_are_one_candidate(spark):
    q = spark.createDataFrame([("hot bolt", ["hot", "bolt"]), ("ring", ["ring"]), ("red ring", ["red", "ring"])], "q string, words array<string>")
    pages = [(100 - i, ["hot", "bolt", "small"]) for i in range(50)] + [(7, ["bolt", "small", "hot", "hot"]), (3, ["a", "hot", "bolt", "small"]), (9, ["ring", "ring"]), (8, ["ring"]), (5, ["blue", "ring"])]
    best = cache.best_article(q, spark.createDataFrame(pages, "page long, words array<string>"))
    assert sorted(map(tuple, best.collect())) == [("hot bolt", 7, 2 / 3), ("ring", 8, 1.0)]
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Generate"):]


def test_nested_records_are_dealt_and_counted_without_a_key(spark, tmp_path):
    plan = catalogue.QUERIES["nested_load"](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "SortMergeJoin" not in plan
    # Tables of no rows are counted too, as in the SQL.
    assert len(against_sql(spark, tmp_path, "nested_load", lineitem="select * from small_lineitem where false")) == 5


def test_a_bound_value_is_worked_out_once(spark):
    df = spark.range(3).select(F.col("id"), keys.bound(F.rand(), lambda x: F.array(x, x)).alias("x"))
    assert all(r.x[0] == r.x[1] for r in df.collect())
    none = spark.range(1).select(keys.bound(F.lit(None).cast("string"), lambda s: F.coalesce(s, F.lit("none"))).alias("x"))
    assert none.first().x == "none"


def test_sets_look_at_one_line_of_a_kind():
    def first_fit(sets):
        lines = []
        for set_id, numbers in sets:
            fit = lambda held: not held & numbers or (len(held & numbers) == 1 and min(len(held), len(numbers)) >= 3)  # noqa: B023, E731
            at = next((line for line in lines if fit(line[1])), None)
            if at is None:
                lines.append(at := (set_id, set()))
            at[1].update(numbers)
            yield at[0]

    dice = random.Random(7)
    for most in (4, 9, 40):
        sets = [(i, {dice.randrange(most) for _ in range(dice.randrange(0, 5))}) for i in range(400)]
        lines = identity._Lines()
        assert [lines.place(i, list(numbers)) for i, numbers in sets] == list(first_fit(sets))
        assert sorted(i for alike in lines.alike.values() for i in alike) == list(range(len(lines.heads)))
    lines = identity._Lines()
    assert [lines.place(i, [1, 2, 3]) for i in range(20_000)] == list(range(20_000)) and len(lines.alike) == 1


def test_groups_of_the_same_names_compare_them_once(spark, monkeypatch):
    names = [f"{a} {b} {c}" for a in ("large", "small", "hot") for b in ("ring", "bolt", "rings") for c in ("x1", "x12")]
    met = []
    monkeypatch.setattr(linkage, "_similar_titles", lambda df, least, real=linkage._similar_titles: met.append(df.count()) or real(df, least))
    same = spark.createDataFrame([(g, n) for g in range(5) for n in names if g or n != names[0]], "group int, name string")
    want = {(g, a, b) for g in range(5) for a, b in itertools.permutations(names, 2) if a < b and difflib.SequenceMatcher(None, a, b).ratio() >= 0.8 and (g or names[0] not in (a, b))}
    assert {(r.group, r.name, r.other) for r in linkage.similar_titles(same).collect()} == want and met == [len(names)]


def test_shared_pages_give_what_a_page_for_each_query_gives(spark):
    dice = random.Random(12)
    words = ["the red", "red", "red ring", "a red ring", "ringer", "red & ring", "red and ring", "the red and ring", "redring two", "big red ring"]
    plain = lambda t: None if t is None else t.lower().replace(" ", "").replace("&", "")
    article = lambda t: None if t is None else plain(t.removeprefix("the ").removeprefix("a "))
    spaced = lambda t: None if t is None else " ".join(t.replace("&", " ").split())
    amp = lambda t: None if t is None else plain(t.replace("&", "and"))
    some = lambda *x: dice.choice(x)
    asked, given = [], []
    for page in range(60):
        for i in range(8):
            name, term = some(*words, None), some(*words)
            asked.append((page * 100 + i, page, plain(term), article(term), plain(name), article(name), some(0, 2, 3, 5), some(True, False), some(True, False), spaced(term), spaced(name), plain(name), term[:4].strip(), amp(term), some(5, 13, 21)))
        for i in range(dice.choice([1, 2, 4, 9])):
            title, synonym = some(*words), some(*words, None)
            given.append((page, page * 100 + i, i, some("ONE_SHOT", "MANGA", "MANGA", "MANGA"), some(None, 1, 2, 3, 5, 13, 21), some("RELEASING", "FINISHED"), some(None, 1, 2), [plain(title)], [article(title)], [plain(synonym)], [article(synonym)], some(True, False, False), [t for t in (spaced(title), spaced(synonym)) if t], [amp(title)]))
    q = spark.createDataFrame(asked, "q int, page int, k string, ak string, nk string, ank string, volume_count int, own_name boolean, fallback boolean, words string, nwords string, base string, arc string, amp string, orig_count int")
    c = spark.createDataFrame(given, "page int, id int, position int, format string, volumes int, status string, popularity int, pk array<string>, apk array<string>, sk array<string>, ask array<string>, echo boolean, titles array<string>, amps array<string>")
    own = lambda keys, name: F.array_compact(F.when(F.col("echo"), F.array_append(keys, F.col(name))).otherwise(F.col(keys)))
    pages = q.join(c, "page").withColumns({"sk": own("sk", "nk"), "ask": own("ask", "ank"), "titles": own("titles", "nwords"), "base": F.coalesce("base", F.lit("")), "words": F.coalesce("words", F.lit(""))})
    kinds = {}
    for shared, single in ((ranking.pick_shared, ranking.pick), (ranking.post_walk_shared, ranking.post_walk)):
        got, want = (sorted(map(tuple, df.collect())) for df in (shared(q, c), single(pages)))
        assert got == want
        for _, _, via in got:
            kinds[via] = kinds.get(via, 0) + 1
    assert set(kinds) == {"primary", "synonym", "article", "substring", "ceiling", "prefix", "arc", "amp", "origin"}, kinds


def test_picks_on_pages_with_many_alike_parts(spark, tmp_path):
    many = "select p_partkey + i * 20000 as p_partkey, * exclude (p_partkey, i) from small_part, range(20) r(i)"
    for name in ("title_picks", "post_walk_picks"):
        (folder := tmp_path / name).mkdir()
        assert against_sql(spark, folder, name, part=many)
