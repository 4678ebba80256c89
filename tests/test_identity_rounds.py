import difflib
import random

import pytest
from pyspark.sql import functions as F

from claimloom.functions import wiki
from claimloom.operators import identity, linkage, runs, writes
from claimloom.sources import cache


def test_similar_titles_equal_all_pairs(spark):
    rng = random.Random(3)
    names = sorted({"".join(rng.choices("abcde ", k=rng.randrange(3, 16))).strip() or "x" for _ in range(70)} | {"one piece", "one pieces", "on piece", "wan pisu"})
    df = spark.createDataFrame([(i % 2, n) for i in range(2) for n in names], "group int, name string")
    got = {(r.group, r.name, r.other) for r in linkage.similar_titles(df).collect()}
    want = {(g, a, b) for g in range(2) for a in names for b in names if a < b and difflib.SequenceMatcher(None, a, b).ratio() >= 0.8}
    assert got == want and len(want) > 4
    for least in (0.6, 0.72, 0.9):
        got = {(r.group, r.name, r.other) for r in linkage.similar_titles(df.where("group = 0"), least).collect()}
        assert got == {(0, a, b) for a in names for b in names if a < b and difflib.SequenceMatcher(None, a, b).ratio() >= least}


def test_probed_ids_differ_and_keep_to_their_names(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(150)], "name string")
    a, b = ({r.name: r.id for r in identity.probed_ints(df, "name", bits=8).collect()} for df in (names, names.orderBy(F.desc("name"))))
    assert a == b and len(set(a.values())) == 150 and max(a.values()) < 256


def test_sets_merge_while_their_numbers_are_disjoint(spark):
    rows = [("s", 1, [1, 2, 3]), ("s", 2, [4, 5]), ("s", 3, [3, 8, 9]), ("s", 4, [1, 2]), ("t", 5, [1])]
    got = {(r.set_id, r.line) for r in identity.merge_disjoint(spark.createDataFrame(rows, "signature string, set_id long, numbers array<int>")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 5)}


def test_guards_that_never_settle_are_an_error(spark):
    with pytest.raises(RuntimeError):
        identity.settle(spark.createDataFrame([(1,)], "n int"), lambda df: df.select((F.col("n") + 1).alias("n")))


def test_needles_of_any_length(spark):
    docs = spark.createDataFrame([(1, "The quick, brown fox jumps over the lazy dog"), (2, ""), (3, None), (None, "fox"), (5, "foxes jump")], "doc long, text string")
    needles = spark.createDataFrame([("a", "fox"), ("b", "brown fox"), ("c", "brown fox jumps over"), ("d", "fox jumps over the lazy dog"), ("e", "lazy fox"), ("f", ""), ("g", None)], "item string, text string")
    got = {(r.item, r.doc) for r in linkage.contained(needles, docs, "item", "doc").collect()}
    assert got == {("a", 1), ("a", None), ("b", 1), ("c", 1), ("d", 1)}
    assert linkage.contained(needles.limit(0), docs, "item", "doc").count() == 0 and linkage.contained(needles, docs.limit(0), "item", "doc").count() == 0


def test_medians_are_upper_and_skip_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("a", 5), ("a", 9), ("b", None), ("c", 4), ("c", 2)], "g string, v int")
    assert {(r.g, r.v) for r in runs.upper_median(df, ["g"], "v").collect()} == {("a", 5), ("c", 4)}


def test_loading_twice_adds_nothing(spark):
    kind = "title string, medium string, volumes array<struct<number:int,isbn:string,day:string,contains:array<int>>>"
    one = [("A", "manga", [(1, "i1", "2001", [1, 2]), (2, None, None, [])]), ("A", "novel", [(1, "i2", None, [])])]
    a, b = (writes.load_records(spark.createDataFrame(x, kind)) for x in (one, one + one))
    for t, n in (("work", 1), ("line", 2), ("volume", 3), ("claim", 3), ("composition", 2)):
        assert sorted(map(tuple, a[t].collect())) == sorted(map(tuple, b[t].collect())) and a[t].count() == n


def test_batches_hold_every_key_once_and_no_more_than_asked(spark):
    b = cache.batches(spark.range(500).withColumnRenamed("id", "k"), "k", 20).collect()
    sizes = {}
    for r in b:
        sizes[r.bucket, r.part] = sizes.get((r.bucket, r.part), 0) + 1
    assert len({r.k for r in b}) == len(b) == 500 and max(sizes.values()) <= 20


def test_markup():
    text = "{{Graphic novel list/header}}{{Graphic novel list|VolumeNumber=—}}{{Graphic novel list|VolumeNumber=03|Title=A {{b|c}}|OriginalRelDate=March 3, 2010<ref>x</ref>|OriginalISBN=978-4-06-000001-0}}"
    (v,) = wiki.volume_records(text)
    assert (v["number"], v["title"], v["original_date"], v["announced"]) == ("3", "A c", "2010-03-03", False)
    assert wiki.volume_records(None) == [] and wiki.table_rows("") == [] and wiki.infobox_facts("no box") is None
    assert wiki.current_publisher("Tokyopop (former)<br />J-Novel Club") == "J-Novel Club" and wiki.english_publisher("{{English manga publisher|UK=X|NA=[[Viz|Viz Media]]}}") == "Viz Media"
    assert wiki.lead_link("''[[Weekly Jump]]'' ''[[One Piece (manga)|One Piece]]''", "One Piece") == "One Piece (manga)" and wiki.lead_link("x", "y") is None
    assert wiki.counted_numbers('<ol start="4"><li>a<li>b</ol>') == [4, 5] and wiki.names_back("The One Piece", None, "One Piece", None) and not wiki.names_back(None, "x", "y", "z")
    assert [wiki.isbn_market(i) for i in ("9784000000000", "9791090000000", "9798000000000", "9785", None)] == ["JP", "FR", "EN", None, None]
