"""Binding in rounds, collisions, ids handed on, and ids shown without a binding."""

import random

from claimloom.operators import binding as B

LINE = "line string, work string, language string, medium string, main boolean, bound long, pinned boolean, name string, local_name string, volume_count int, year_began int"
ALIAS = "line string, pos int, alias string, language string, kind string"
PAGE = "family string, term_key string, id long, position int, format string, volumes int, status string, popularity int, year int, pk array<string>, apk array<string>, sk array<string>, ask array<string>, titles array<string>"


def line(id, work, language="ja", medium="manga", main=True, bound=None, pinned=False, name=None, local=None, count=5, year=2000):
    return (id, work, language, medium, main, bound, pinned, name or id, local, count, year)


def page(family, term_key, id, title=None, synonym="", volumes=None, year=None, popularity=0, format="MANGA"):
    k = title or term_key
    return (family, term_key, id, id, format, volumes, "FINISHED", popularity, year, [k], [k], [synonym], [synonym], [k])


def sets(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_native_lines_in_need(spark):
    lines = spark.createDataFrame([
        line("a", "w1"), line("b", "w1", medium="novel"), line("c", "w1", "en"), line("d", "w2"), line("e", "w2", bound=4), line("f", "w3", main=False), line("g", "w4", pinned=True), line("h", "w5", medium="artbook"),
        line("i", "w6", "en", "novel"), line("j", "w6"), line("k", "w7", "ko"),
    ], LINE)
    assert [r.line for r in B.unbound_native(lines, "ja").orderBy("line").collect()] == ["b", "j"]


def test_terms_of_a_native_line(spark):
    lines = spark.createDataFrame([line("a", "w", name="Kimi  to–Boku", local="君と僕"), line("b", "w", name="!!!", local="君と僕")], LINE)
    aliases = spark.createDataFrame([
        ("a", 1, "Toi et moi", "fr", "official"), ("a", 2, "You and Me", "en", "official"), ("a", 3, "kimi to boku", "ja", "official"), ("a", 4, "List of Kimi chapters", "en", "alias"), ("a", 5, "One", "en", "alias"),
        ("a", 6, "ONE", "en", "alias"), ("a", 7, "Two", "en", "alias"), ("a", 8, "Three", "en", "alias"), ("a", 9, "Four", "en", "alias"), ("z", 1, "of no line", "en", "alias"),
    ], ALIAS)
    got = B.native_terms(lines, aliases, "ja").orderBy("line", "place").collect()
    assert [(r.line, r.place, r.term, r.own, r.kind) for r in got] == [
        ("a", 1, "Kimi to-Boku", True, "name"), ("a", 2, "君と僕", False, "native"), ("a", 3, "You and Me", False, "official"), ("a", 4, "Toi et moi", False, "official"),
        ("a", 5, "One", False, "alias"), ("a", 6, "Two", False, "alias"), ("a", 7, "Three", False, "alias"), ("b", 1, "君と僕", False, "native"),
    ]


def test_rounds_stop_at_the_first_term_that_binds(spark):
    lines = B.unbound_native(spark.createDataFrame([line("first", "w1"), line("second", "w2", local="native two"), line("third", "w3"), line("none", "w4"), line("old", "w5")], LINE), "ja")
    aliases = spark.createDataFrame([("third", 1, "other", "en", "official"), ("third", 2, "late", "en", "alias"), ("old", 1, "young", "en", "alias"), ("first", 1, "later", "en", "official")], ALIAS)
    pages = spark.createDataFrame([
        page("comic", "first", 1), page("comic", "later", 9), page("comic", "nativetwo", 2, volumes=5), page("comic", "second", 20, title="secondseason"), page("comic", "other", 30, format="ONE_SHOT"), page("comic", "late", 3, year=2003),
        page("comic", "old", 40, year=1960), page("comic", "young", 4, year=1999), page("novel", "none", 5), page("comic", "none", 6, volumes=1),
    ], PAGE)
    found = B.bind(lines, B.native_terms(lines, aliases, "ja"), pages)
    got = [(r.line, r["round"], r.place, r.id, r.kind) for r in found.orderBy("line").collect()]
    assert got == [("first", 1, 1, 1, "name"), ("old", 3, 2, 4, "alias"), ("second", 1, 2, 2, "native"), ("third", 3, 3, 3, "alias")]


def test_picks_that_are_withheld(spark):
    rows = [("a", "w1", "comic", 1), ("b", "w2", "comic", 2), ("c", "w3", "comic", 2), ("d", "w4", "comic", 4), ("e", "w4", "comic", 4), ("f", "w5", "comic", 5), ("g", "w5", "comic", 6), ("h", "w6", "comic", 7), ("i", "w6", "novel", 7), ("j", "w7", "comic", 8), ("k", "w8", "comic", 2)]
    lines = spark.createDataFrame([r[:3] for r in rows], "line string, work string, family string")
    found = spark.createDataFrame([(r[0], r[3]) for r in rows], "line string, id long")
    taken = spark.createDataFrame([(1, "w9"), (1, "w8"), (6, "w0")], "id long, work string")
    got = {r.line: r.note for r in B.withheld(found, lines, taken).collect()}
    group, picked, held = {r[0]: r[1:3] for r in rows}, {r[0]: r[3] for r in rows}, {1: "w8", 6: "w0"}
    for l, i in picked.items():
        own = [o for o in picked if group[o] == group[l]]
        others = [o for o in picked if picked[o] == i and group[o] != group[l]]
        want = held.get(i) or (min(o for o in own if o != l) if len({picked[o] for o in own}) > 1 else min(others, default=None))
        assert got[l] == want


def test_contested_ids_are_handed_on(spark):
    rng = random.Random(8)
    choices = [(l, p, rng.randrange(25), rng.randrange(6)) for l in range(40) for p in range(rng.randrange(0, 7))]
    taken = {3, 7}
    first, holder = {}, {}
    for l, p, i, c in sorted(choices, key=lambda x: x[1]):
        if i not in taken:
            first.setdefault((l, i), (p, c))
    asks = {l: sorted((p, i, c) for (x, i), (p, c) in first.items() if x == l) for l in range(40)}
    free = list(range(40))
    while free:  # one line at a time
        l = free.pop()
        if asks[l]:
            p, i, c = asks[l].pop(0)
            if i not in holder or (c, l) < holder[i][:2]:
                if i in holder:
                    free.append(holder[i][1])
                holder[i] = (c, l, p)
            else:
                free.append(l)
    out = B.assign(spark.createDataFrame(choices, "line int, place int, id int, claim int"), spark.createDataFrame([(t,) for t in taken], "id int"))
    assert sets(out) == sorted(((l, i, p) for i, (_, l, p) in holder.items()), key=str)


def test_works_through_two_catalogues(spark):
    lines = spark.createDataFrame([line("a", "w1", "fr", "manhua", name="Alpha"), line("b", "w1", "de", "manhua", name="Beta"), line("c", "w2", "de", "manhua", name="Sun & Moon"), line("d", "w3", "de", "manhua", name="Gamma"), line("e", "w3", "en", "manga"), line("f", "w4", "fr", "manhua", bound=3)], LINE)
    aliases = spark.createDataFrame([("b", 1, "Native", "zh", "official"), ("b", 2, "Na tive", "zh", "romanized"), ("a", 3, "ALPHA", "en", "alias"), ("a", 4, "Else", "en", "alias")], ALIAS)
    ranked = B.unvoiced_works(lines, ("manhwa", "manhua"), "fr")
    assert sorted((r.work, r.line, r.rank) for r in ranked.collect()) == [("w1", "a", 1), ("w1", "b", 2), ("w2", "c", 1)]
    terms = B.work_terms(ranked, aliases, ("ko", "zh"))
    assert [r.term for r in terms.where("work = 'w1'").orderBy("place").collect()] == ["Alpha", "alpha", "Beta", "beta", "Native", "Na tive", "Else"]
    pages = spark.createDataFrame([page("TW", "beta", 5), page("TW", "else", 6), (*page("CN", "sunmoon", 7)[:9], ["sunandmoon"], ["sunandmoon"], [""], [""], ["sun and moon"])], PAGE)
    works = ranked.where("rank = 1").selectExpr("work", "array('CN', 'TW') AS countries", "cast(null as int) AS year_began")
    got = [(r.work, r.country, r.id, r.via) for r in B.bind_works(works, terms, pages).orderBy("work").collect()]
    assert got == [("w1", "TW", 5, "primary"), ("w2", "CN", 7, "amp")]


def test_ids_that_are_only_shown(spark):
    lines = spark.createDataFrame([
        line("a", "w1", "en", "novel", bound=1, name="Zero"), line("b", "w1", "en", name="Zero (Truth)"), line("c", "w2", "en", name="Zero: Other"), line("d", "w3", "en", bound=2, name="Two"), line("e", "w3", "en", "novel", bound=3, name="Two"),
        line("f", "w3", "en", name="Two - Side"), line("g", "w4", "en", "novel", name="Picnic"), line("h", "w5", "en", "novel", name="Seen"), line("i", "w6", "ja", "novel", name="Picnic"),
    ], LINE)
    adapted = spark.createDataFrame([("g", 50), ("h", 51), ("b", 52), ("i", 53)], "line string, id long")
    got = sets(B.shown_instead(lines, adapted, spark.createDataFrame([("h",)], "line string")))
    assert got == [("b", 1, "parent"), ("g", 50, "medium")]
