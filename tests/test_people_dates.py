import pytest
from pyspark.sql import functions as F

from claimloom.functions import people, worded


@pytest.mark.parametrize(
    "text, want",
    [
        ("March 3, 2010", "2010-03-03"), ("3 mars 2010", "2010-03-03"), ("3. März 2010", "2010-03-03"), ("1er août 2012", "2012-08-01"),
        ("3 de enero de 2011", "2011-01-03"), ("2010年3月", "2010-03"), ("February 30, 2010", "2010-02"), ("Sept 2009", "2009-09"),
        ("ca. 1999", "1999"), ("2015-04-31", "2015-04"), ("04/05/2010", "2010"), ("25/12/2010", "2010-12-25"), ("5.4.2010", "2010-04-05"), ("", None), (None, None), ("soon", None),
    ],
)
def test_dates(text, want):
    assert worded.parse_date(text) == want


KEYS = [
    ("Émile  ZOLA", ("zola", ["emile", "zola"])), ("Zola, Émile", ("zola", ["emile", "zola"])), ("Al", None), ("Shin'ichi (x) Jean-Luc", ("jeanluc", ["jeanluc", "shinichi"])), ("Abcd", ("abcd", ["abcd"])), (None, None), ("", None),
    ("De la Cruz, Ana", ("delacruz", ["ana", "cruz", "de", "la"])), ("Oouchi, Yuu", ("oochi", ["oochi", "yu"])), (", Ana Bo", ("", ["ana", "bo"])), ("\x98The\x9c Man", ("man", ["man", "the"])), ("E\u0301mile Zola", ("zola", ["emile", "zola"])),
    ("Ắn Đo", ("o", ["an", "o"])), ("林田 球", None), ("A B", ("b", ["a", "b"])),
]
PAIRS = [
    ("Hayashida, Kyū", "Q Hayashida", True), ("Umino, Chika", "Chica Umino", True), ("Kōsuke", "Kohske", True), ("Sakamoto, Akira", "Akira Toriyama", False), ("Al", "Al", False), (None, "Ana Bo", False),
    ("Jin Hwan Park", "Jinhwan Park", True), ("Tanaka, Ai", "Tanoka, Ei", True), ("Tana, Ai", "Tano, Ei", False), ("Ito, Ai", "Ito, Ei", False),
]


def test_names(spark):
    df = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(KEYS)], "i int, n string").select("i", people.person_key(F.col("n")).alias("k"))
    assert [r.k and (r.k.family, r.k.tokens) for r in df.orderBy("i").collect()] == [k for _, k in KEYS]
    pairs = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(PAIRS)], "i int, a string, b string").withColumns({"p": people.person_key(F.col("a")), "q": people.person_key(F.col("b"))})
    assert [(r.x, r.y) for r in pairs.select("i", people.same_person(F.col("p"), F.col("q")).alias("x"), people.same_person(F.col("q"), F.col("p")).alias("y")).orderBy("i").collect()] == [(w, w) for _, _, w in PAIRS]
    names = ["Park Jin Hwan", "Chu-Gong", "Chugong", "Park, Jin-hwan", None, "", "Ana López", "López, Ana", "X", "A, B, C"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select("i", people.person_splits(F.col("n")).alias("s")).orderBy("i")
    got = [[(s.family, s.given) for s in r.s] for r in df.collect()]
    assert got[0] == [("hwan", "parkjin"), ("park", "jinhwan"), ("parkjinhwan", "")] and got[1] == got[2] == [("chugong", "")] and got[3] == [("park", "jinhwan")]
    assert got[4] == got[5] == [] and set(got[6]) & set(got[7]) == {("lopez", "ana")} and got[8] == [("x", "")] and got[9] == [("a", "bc")]


def test_words_of_dates(spark):
    assert spark.range(1).select(worded.iso_date(F.lit("3 mars 2010")).alias("d")).first().d == "2010-03-03"
