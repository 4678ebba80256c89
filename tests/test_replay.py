"""Coverage as bitmaps, and tables compared by digests."""

import random

import pytest
from pyspark.sql import functions as F

from claimloom.functions import text
from claimloom.operators import replay


def test_coverage_equals_sets(spark):
    rng = random.Random(3)
    owned = [(e, rng.choice([float(n), n + 0.5, n * 5000.0])) for e in range(30) for n in range(rng.randrange(0, 9))]
    volumes = [(l, rng.choice([float(n), n + 0.5, n * 5000.0]), rng.choice(["1990-01-01", "2020-01-01", None])) for l in range(8) for n in range(12)]
    picks = [(e, rng.randrange(10)) for e in range(33)]
    frames = spark.createDataFrame(picks, "entry int, line int"), spark.createDataFrame(owned, "entry int, number double"), spark.createDataFrame(volumes, "line int, number double, date string")
    report = replay.coverage(*frames, "2000-01-01")
    want = []
    for e, l in picks:
        own, has = {n for x, n in owned if x == e}, {n for x, n, _ in volumes if x == l}
        later = [d for x, n, d in volumes if x == l and n > max(own, default=0)]
        want.append((e, l, len(own), len(own - has), len(later), sum(d == "1990-01-01" for d in later), own <= has))
    assert sorted(map(tuple, report.collect())) == want
    gaps = {(e, n) for e, l in picks for n in {n for x, n in owned if x == e} - {n for x, n, _ in volumes if x == l}}
    assert {tuple(r) for r in replay.lacking(*frames, report).collect()} == gaps


def test_a_set_of_numbers_is_a_few_bytes(spark):
    # A bitmap of 4 KB an owner was what tasks of larger tables sorted.
    sets = replay.number_sets(spark.createDataFrame([(1, 0.0), (1, 6.3), (1, 6.4), (1, 6.4), (2, 3.0), (2, -1.0), (2, None)], "owner int, number double"), "owner", "number")
    assert sorted(map(tuple, sets.collect())) == [(1, 0, 1 - 2**63), (1, 1, 1), (2, 0, 1 << 30)]
    assert "ObjectHashAggregate" not in (plan := sets._jdf.queryExecution().executedPlan().toString()) and "SortAggregate" not in plan


def test_a_name_that_answers_comes_before_a_tail(spark):
    series = spark.createDataFrame([(1, "Alpha", "en", "manga", False, 2, 5), (2, "Alpha", "en", "novel", False, 9, 9), (3, "The old beta", "en", None, False, 1, 1), (4, "Gamma", "fr", None, False, 1, 1)], "id int, name string, language string, medium string, is_omnibus boolean, dated_count int, volume_count int")
    aliases = spark.createDataFrame([(3, "beta two")], "id int, alias string")
    entries = spark.createDataFrame([(1, ["ALPHA", "x"], False), (2, ["alpha"], True), (3, ["So: The Old Beta -", "Beta Two"], False), (4, ["So, the old beta"], False), (5, ["x: old beta"], False), (6, ["Gamma", None], False), (7, ["the old beta"], True)], "entry int, names array<string>, novel boolean")
    got = {r.entry: (r.line, r.by) for r in replay.pick_series(entries, series, aliases).collect()}
    assert got == {1: (1, "name"), 2: (2, "name"), 3: (3, "name"), 4: (3, "tail")}


@pytest.mark.parametrize("most", [10_000, 3])
def test_differing_rows(spark, most):
    rng = random.Random(1)
    a = [(i, rng.choice([None, "x", "y"]), rng.choice([None, 1, 2])) for i in range(3000)]
    b = [r for r in a if r[0] not in (5, 700)] + [(9001, "new", 1), a[44], (None, None, None)]
    b[10] = (b[10][0], b[10][2] and "x", None) if b[10] != (b[10][0], b[10][2] and "x", None) else (b[10][0], "other", 7)
    b[20] = (b[20][0], "changed", 1)
    rng.shuffle(b)
    one, two = (spark.createDataFrame(x, "k int, s string, n int").repartition(p) for x, p in ((a, 3), (b, 7)))
    from collections import Counter

    ca, cb = Counter(a), Counter(b)
    want = sorted([("a", *r) for r in (ca - cb).elements()] + [("b", *r) for r in (cb - ca).elements()], key=str)
    found, report = replay.differing_rows(one, two.select("n", "k", "s"), ["k"], most)
    assert sorted(((r.side, r.k, r.s, r.n) for r in found.collect()), key=str) == want
    levels = report.orderBy("level").collect()
    assert levels[0].ranges == 256 and 0 < levels[0].differing <= len(want) and (len(levels) > 1) == (most == 3) and levels[-1].rows < 200
    same, report = replay.differing_rows(one, one.repartition(5), ["k"], most)
    assert same.count() == 0 and report.first().differing == 0


def test_swapped_nulls_and_repeats_are_seen(spark):
    schema = "k int, x int, y int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    for a, b in (([(1, None, 2)], [(1, 2, None)]), ([(1, 1, 1)] * 2, [(1, 1, 1)]), ([(1, 1, 2), (2, 2, 1)], [(1, 2, 1), (2, 1, 2)]), ([(1, 0, 0)], [])):
        assert replay.differing_rows(frame(a), frame(b), ["k"])[0].count() > 0
    with pytest.raises(ValueError):
        replay.differing_rows(frame([]), spark.range(1), ["k"])


def test_the_second_folding_key(spark):
    rows = ["The Ünïcode & Co (film), Vol. 3", "Kōkō wo Shōjo, Bd. 4", "Die Stadt 12", "  the  THE x × 2", "Ａｂｃ 林田", "", None, "É’t’é-ouu 7.", "Tome 5 of it", "a\x98the\x9c b"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    for strip in (True, False):
        got = [r.k for r in df.select(text.folded("t", strip).alias("k")).collect()]
        assert got == [text.fold(r, strip) for r in rows]


def test_order_of_rows_does_not_matter(spark):
    a = spark.range(5000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    assert replay.differing_rows(a, a.orderBy("v"), ["id"])[0].isEmpty()
