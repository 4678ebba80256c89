"""Branch tables of the operators on inline rows."""

import random

import pytest
from pyspark.sql import functions as F

from claimloom.functions import keys
from claimloom.operators import claims, graph, linkage, runs

ORDER = ["best", "second", "library"]


def resolved(spark, *values, field="release_date", overrides=None):
    rows = [("volume", "1", field, v, s) for s, v in values]
    df = spark.createDataFrame(rows, "entity string, entity_id string, field string, value string, source string")
    r = claims.resolve(df, ORDER, overrides, year_sources=["library"]).first()
    return r.value, r.basis, r.confidence, r.n_agree, r.n_sources


@pytest.mark.parametrize(
    "a, b, basis, confidence, value",
    [
        ("2015-04-01", "2015-04-01", "agreed", 0.97, "2015-04-01"),
        ("2015-04", "2015-04-09", "agreed_coarse", 0.90, "2015-04-09"),
        ("2015-04-01", "2015-04-08", "semantic_variance", 0.88, "2015-04-01"),
        ("2015-04-01", "2015-05-13", "semantic_variance", 0.88, "2015-04-01"),
        ("2015-04-01", "2015-05-20", "escalated", 0.40, "2015-04-01"),
        ("2015-04-01", "2015-04-04", "minor_variance", 0.65, "2015-04-01"),
        ("2015-04-01", "2015-04-11", "conflict", 0.30, "2015-04-01"),
        ("2015", "2016-01", "single_source", 0.70, "2015"),
    ],
)
def test_date_basis(spark, a, b, basis, confidence, value):
    got = resolved(spark, ("best", a), ("second", b))
    assert got[:3] == (value, basis, confidence)


def test_other_resolutions(spark):
    assert resolved(spark, ("best", "x"))[:3] == ("x", "single_source", 0.70)
    assert resolved(spark, ("best", "x"), ("second", "y"), field="title") == ("x", "conflict", 0.50, 1, 2)
    assert resolved(spark, ("library", "2015"), ("other", "2014-12-30"))[0] == "2014-12-30"
    pin = spark.createDataFrame([("volume", "1", "title", None)], "entity string, entity_id string, field string, value string")
    assert resolved(spark, ("best", "x"), field="title", overrides=pin) == (None, "manual_override", 1.0, 1, 1)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_keys(spark):
    lit = F.lit
    assert one(spark, keys.ascii_key(lit("  The--Cat: No.1 "))) == "the cat no 1"
    assert one(spark, keys.article_free_key(lit("The Émile"))) == "émile"
    assert one(spark, keys.ampersand_key(lit("A & B"))) == "aandb"
    assert one(spark, keys.deslug(lit("a-b_c"))) == "a b c"
    assert one(spark, keys.base_title(lit("Base: sub - more"))) == "Base"
    assert one(spark, keys.isbn10_to_13(lit("0-306-40615-2"))) == "9780306406157"
    assert one(spark, keys.isbn13_valid(lit("978-0-306-40615-7"))) and not one(spark, keys.isbn13_valid(lit("9780306406158")))
    assert one(spark, keys.stem(lit("Saga 12"))) == "Saga" and one(spark, keys.trailing_number(lit("Saga 12"))) == 12
    assert one(spark, keys.words_contain(lit("a big cat"), lit("Big Cat"))) and not one(spark, keys.words_contain(lit("bigcat"), lit("cat")))
    for text, want in (("Vol. 03", ("3", "int")), ("2,5", ("2.5", "fraction")), ("XIV", ("14", "roman")), ("extra", (None, "label"))):
        assert tuple(one(spark, keys.volume_number(lit(text)))) == want
    assert one(spark, keys.precision(lit("2015-04"))) == "month"
    assert one(spark, keys.alias_variants(lit("Base: sub"))) == ["Base", "Base: sub", "base sub"]


def test_graphs(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (7, 8), (9, 9), (None, 4)], "src long, dst long")
    assert {tuple(r) for r in graph.connected_components(e).collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 9)}
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("z", "x")], "old_id string, new_id string")
    got = dict(map(tuple, graph.collapse_chains(links).collect()))
    assert got == {"a": "c", "b": "c", "x": None, "y": None, "z": None}
    assert graph.connected_components(e.limit(0)).count() == 0


def test_components_of_a_path_in_any_order(spark):
    ids = list(range(200))
    random.Random(1).shuffle(ids)
    e = spark.createDataFrame([*zip(ids, ids[1:]), (900, 901)], "src long, dst long")
    got = dict(map(tuple, graph.connected_components(e, max_rounds=6).collect()))
    assert got == {i: 0 for i in ids} | {900: 900, 901: 900}


def test_near_names_equals_all_pairs(spark):
    names = ["martin", "martim", "marin", "artin", "smith", "smyth", "smit", "a", "b", "ab", "ba", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1:
            return False
        i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]

    got = {(r.name, r.other) for r in linkage.near_names(df).collect()}
    want = {(a, b) for a in names for b in names if a < b and near(a, b) and min(len(a), len(b)) > 0}
    assert {p for p in got if min(map(len, p))} == want


def test_runs(spark):
    rows = [("l", n, i) for n, i in ((1, "x"), (2, "x"), (3, "y"), (5, "y"), (6, None), (7, None))]
    df = spark.createDataFrame(rows, "line string, n int, isbn string")
    got = sorted((r["first"], r["contains"], r["n"]) for r in runs.collapse_runs(df, ["line"], "n", ["isbn"]).collect())
    assert got == [(1, "1,2", 2), (3, "3", 1), (5, "5", 1), (6, "6,7", 2)]


def test_sinks(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert {tuple(r) for r in claims.upsert(old, new, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert {tuple(r) for r in claims.insert_absent(old, new, ["k"]).collect()} == {(1, "a"), (2, "b"), (3, "d")}
    diff = {tuple(r) for r in claims.snapshot_diff(old, new, "k", "v").collect()}
    assert diff == {(1, "a", None, "removed"), (2, "b", "c", "changed"), (3, None, "d", "added")}


def test_one_to_one_equals_the_greedy_loop(spark):
    import random

    rng = random.Random(8)
    pairs = [(a, 100 + b, rng.randrange(6)) for a in range(15) for b in range(12) if rng.random() < 0.4]
    want, used = set(), set()
    for a, b, s in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if a not in used and b not in used:
            used |= {a, b}
            want.add((a, b, s))
    df = spark.createDataFrame(pairs, "a int, b int, s int")
    assert {tuple(r) for r in linkage.one_to_one(df, "a", "b", "s").collect()} == want


def test_spread_to_a_fixed_point(spark):
    rows = [(1, "w", "x", "v"), (2, "w", "y", None), (3, "u", "y", None), (4, "t", "z", None), (5, "q", "k", "1"), (6, "q", "k", "2"), (7, "q", "m", None)]
    df = spark.createDataFrame(rows, "id int, g string, h string, v string")
    got = {r.id: r.v for r in linkage.spread(df, "id", ["g", "h"], "v").collect()}
    assert got == {1: "v", 2: "v", 3: "v", 4: None, 5: "1", 6: "2", 7: None}


def test_one_to_one_follows_a_long_chain(spark):
    # Falling scores free one pair a round: 52 rounds.
    pairs = [(k // 2 + k % 2, 1000 + k // 2, 200 - k) for k in range(103)]
    df = spark.createDataFrame([*pairs, pairs[0], (None, 1000, 500), (None, None, 1)], "a int, b int, s int")
    assert {tuple(r) for r in linkage.one_to_one(df, "a", "b", "s").collect()} == set(pairs[::2])


def test_matching_equals_a_loop(spark):
    rng = random.Random(6)
    chain = [(i // 2 + i % 2, i // 2, 1000 - i) for i in range(600)]  # falling scores: one edge a round without jumps
    star = [(5000, 6000 + i, i) for i in range(300)] + [(7000 + i, 6000, i) for i in range(300)]
    other = [(rng.randrange(40) + 10_000, rng.randrange(40), rng.randrange(9)) for _ in range(500)]
    pairs = chain + star + [(a, b + 20_000, s) for a, b, s in other] + [(None, 1, 5), (1, None, 5), chain[0]]
    want, used_a, used_b = set(), set(), set()
    for a, b, s in sorted((p for p in pairs if None not in p), key=lambda p: (-p[2], p[0], p[1])):
        if a not in used_a and b not in used_b:
            used_a.add(a), used_b.add(b), want.add((a, b, s))
    got = linkage.one_to_one(spark.createDataFrame(pairs, "a int, b int, s int"), "a", "b", "s")
    assert {tuple(r) for r in got.collect()} == want


def test_prefixes_shorter_than_the_head(spark):
    short = spark.createDataFrame([("ab",), ("abcdefg",), ("abcdeX",), ("",), (None,), ("abcdef",)], "a string")
    long = spark.createDataFrame([("abc",), ("abcdefgh",), ("a",), (None,), ("",)], "b string")
    want = {(a, b) for (a,) in map(tuple, short.collect()) for (b,) in map(tuple, long.collect()) if a is not None and b is not None and b.startswith(a)}
    got = [tuple(r) for r in linkage.prefix_join(short, long, "a", "b", 6).select("a", "b").collect()]
    assert set(got) == want and len(got) == len(want)


def test_circles_end(spark):
    links = [(i, (i + 1) % 5) for i in range(5)] + [(10 + i, 11 + i) for i in range(90)] + [(200, 3)]
    got = dict(map(tuple, graph.collapse_chains(spark.createDataFrame(links, "old_id int, new_id int")).collect()))
    assert all(got[i] is None for i in range(5)) and all(got[10 + i] == 100 for i in range(90)) and len(got) == len(links)


def test_lines_of_disjoint_sets_equal_a_loop(spark):
    from claimloom.operators import identity

    rng = random.Random(9)
    rows = [(rng.choice(["x", "y", None]), i, [rng.randrange(30) for _ in range(rng.randrange(0, 6))]) for i in range(400)] + [("y", 999, None)]
    want, lines = set(), {}
    for sig, i, numbers in rows:
        own = set(numbers or [])
        for line in lines.setdefault(sig, []):
            both = len(line[1] & own)
            if not both or (both == 1 and min(len(line[1]), len(own)) >= 3):
                line[1] |= own
                break
        else:
            line = [i, set(own)]
            lines[sig].append(line)
        want.add((sig, i, line[0]))
    got = identity.merge_disjoint(spark.createDataFrame(rows, "signature string, set_id int, numbers array<int>").repartition(4))
    assert {tuple(r) for r in got.collect()} == want


def test_components_shuffle_no_edges_before_the_first_round(spark, monkeypatch):
    plans, real = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    e = spark.createDataFrame([(2, 1), (1, 2), (2, 3), (3, 2), (5, None)], "src long, dst long")
    assert {tuple(r) for r in graph.connected_components(e).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert "Exchange" not in plans[0]
