"""Each rule of the market gates, broken once and kept once."""

from pyspark.sql import functions as F

from claimloom.operators import market_gates as G

CLAIM = "entity_id int, field string, value string, source string, licence string, source_url string"
VOLUME = "volume int, line int, isbn string, date string, date_type string, future boolean"
LINE = "line int, key string, market string, medium string, work int, name string, role string, tier string, via string, exported boolean, is_main boolean, link_work int, truth_work int, explicit boolean, cluster int, carried boolean"


def told(df):
    return {r.rule: r.n for r in df.collect()}


def line(id, **more):
    base = dict(key=f"k{id}", market="DE", medium="comic", work=1, name="n", role="linked", tier="high", via="official", exported=True, is_main=True, link_work=1, truth_work=None, explicit=False, cluster=id, carried=False)
    return (id, *(base | more).values())


def test_claims(spark):
    url = "https://r/1"
    claims = spark.createDataFrame([
        (1, "title", "t", "lib", "cc0", url), (2, "title", "t", "lib", "by", url), (3, "title", "t", "lib", None, url), (4, "title", "t", "lib", "cc0", None), (5, "title", "t", "lib", "cc0", "http://r/1"), (6, "cover", "t", "lib", "cc0", url),
        (7, "release_date", "2001", "lib", "cc0", url), (8, "release_date", "2001-02", "lib", "cc0", url), (9, "release_date", None, "lib", "cc0", url), (10, "projected_date", "2001-12", "lib", "cc0", url), (11, "projected_date", "2001-22", "lib", "cc0", url), (12, "cover", "x", "other", None, None),
    ], CLAIM)
    assert told(G.claim_rules(claims, "lib", "cc0", "https://r/")) == {"claim not licensed": 2, "claim without a record": 2, "claim of another field": 1, "published date not a year": 2, "projected date not a month": 1}
    records = spark.createDataFrame([(url, True, True, "5")], "source_url string, authority boolean, set_record boolean, level string")
    assert told(G.record_rules(claims, records, "lib")) == {"claim of no record of its own": 2, "date of a set": 5, "published date of a planned record": 3}


def test_volumes(spark):
    volumes = spark.createDataFrame([
        (1, 1, "a", "2010-05", "projected", False), (2, 1, "b", "2001-05", "projected", False), (3, 1, "c", "2010", "projected", False), (4, 1, None, None, "published", False), (5, 1, None, "2001", None, True), (6, 1, "d", "2011", "published", False),
        (7, 1, "d", "2011", "published", False), (8, 2, "e", "2011", "published", False), (9, 2, "e", "2011", "published", False), (10, 3, "d", "2011", "published", False), (11, 3, "d", "2011", "published", False),
    ], VOLUME)
    claims = spark.createDataFrame([(1, "release_date", "2010", "lib", None, None), (8, "isbn13", "e", "wiki", None, None), (9, "isbn13", "e", "wiki", None, None), (6, "isbn13", "d", "lib", None, None)], CLAIM)
    lines = spark.createDataFrame([line(1), line(2), line(3, market="FR")], LINE)
    got = told(G.volume_rules(volumes, claims, lines, "DE", "wiki", "2010-06-01"))
    assert got == {"projected long ago": 1, "projected not to the month": 1, "type without a date, or a date without": 2, "volume of a later year's announcement": 1, "projected although published": 1, "isbn twice in a line": 1}


def test_lines(spark):
    lines = spark.createDataFrame([
        line(1), line(2, role="merged", tier="none"), line(3, tier="low"), line(4, tier="low", via="correction"), line(5, role="review"), line(6, role="review", exported=False, carried=True), line(7, truth_work=2), line(8, truth_work=1), line(9, name="é"),
        line(10, is_main=False), line(11, key="bad", tier="low", role="kept", work=9), line(12, key="bad2", link_work=9, exported=False, role="linked"), line(13, role=None),
    ], LINE)
    volumes = spark.createDataFrame([(1, 1, "a", None, None, False), (2, 2, "b", None, None, False)], VOLUME)
    before = spark.createDataFrame([(1, True, ["a"]), (2, True, ["b", "c"]), (10, True, []), (6, True, []), (99, False, [])], "line int, is_main boolean, isbns array<string>")
    must_not = spark.createDataFrame([("bad", 9), ("bad2", 9), ("k1", 9)], "key string, wrong_work int")
    labels = spark.createDataFrame([("k1", 1), ("k7", 3), ("k3", 1)], "key string, expected_work int")
    got = told(G.line_rules(lines, volumes, before, must_not, labels))
    assert got == {
        "shipped against the policy": 3, "linked against the truth": 1, "published line demoted": 1, "name not composed": 1, "published line gone": 2, "published line lost its place or an isbn": 2, "linked to a work known as wrong": 2, "precision": 1,
    }
    assert told(G.line_rules(lines, volumes, before, must_not, labels, 0.5))["precision"] == 0


def test_created_works(spark):
    lines = spark.createDataFrame([
        line(1, work=1, explicit=True), line(2, work=2, cluster=50), line(3, work=8, cluster=50, exported=False, explicit=True), line(4, work=3), line(5, work=4, medium="novel", explicit=True), line(6, work=1, market="JP"), line(7, work=2, market="JP", medium="manhwa"),
    ], LINE)
    one = lambda column, *ids: spark.createDataFrame([(i,) for i in ids], f"{column} int")
    got = told(G.created_rules(one("work", 1, 2, 3, 4), lines, "JP", one("work", 1), one("line", 1, 3, 70, 71), one("old", 70), flood=2))
    assert got == {"made without explicit origin": 1, "made without a comic": 1, "made beside a line of the home market": 1, "published line gone": 2, "novel in a work without a comic": 1, "flood": 1}


def test_lists_and_moved_isbns(spark):
    takes = spark.createDataFrame([("a", 1, 1, 2, 3), ("b", 2, 2, 3, 9), ("c", 3, 0, 0, 4), ("d", 4, 1, 4, 4)], "key string, id int, shared int, mine int, theirs int")
    lists = G.gate_lists(takes, spark.createDataFrame([("d", 4)], "key string, id int"), spark.createDataFrame([("x", "review")], "key string, shape string"))
    assert sorted(map(tuple, lists.collect())) == [("corrections_skipped", "review:x"), ("taken_weak", "a:1")]
    volumes = spark.createDataFrame([(1, 1, None, None, None, False), (2, 1, "a", None, None, False), (3, 1, "b", None, None, False)], VOLUME)
    was = spark.createDataFrame([(1, "a"), (2, "a"), (3, "gone"), (9, "a")], "volume int, isbn string")
    assert sorted(map(tuple, G.moved_isbns(was, volumes).collect())) == [(1, "a", 2)]
    assert G.claim_rules(volumes.select(*[F.lit(None).cast("string").alias(c) for c in ("field", "value", "source", "licence", "source_url")]), "x", "y", "z").count() == 5
