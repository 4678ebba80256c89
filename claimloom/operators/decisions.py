"""The decision plan for pooled lines: which work each line of a library goes to, or why to none.

Lines are first placed one by one (attached, corrected, linked by title). What is left is pooled and clustered by
shared titles, and each cluster is decided by a cascade of rules. One rule looks back: a cluster whose titles meet
those of a work that an earlier cluster of this build has created goes to review. Run as a loop in the order of keys,
every decision may hang on all before it. Here the rule becomes a graph of conflicts between clusters, found by
equi-joins on runs of words, and first_come() decides all clusters at once that no undecided one comes before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.keys import ascii_key
from claimloom.operators.identity import shared_key_clusters
from claimloom.session import cut, dealt, release

#: Letters of a title's key at least, and of a run of words that counts inside another title.
LEAST_KEY, LEAST_RUN = 5, 7
#: Lengths of the heads by which a key is looked for inside others.
_HEADS = (LEAST_KEY, 8, 13)
COMIC, NOVEL = ("comic", "manhwa", "manhua"), "novel"


def first_come(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, taken): in order, a node is taken unless one that is taken comes before it on an edge (early, late).

    nodes: node, fixed (taken in any case). Edges lead from earlier to later nodes, so they form no circle. Each round decides every node that a taken
    one comes before, and every node that no undecided one comes before. A node behind a single undecided one is taken if and only if that is not, so chains of
    such nodes are followed by pointer jumping and decided with their heads, however long they are. The first undecided node is always decided, so
    the rounds end.
    """
    state = cut(nodes.groupBy("node").agg(F.bool_or("fixed").alias("fixed")).select("node", F.when(F.col("fixed"), True).alias("taken")))
    left = cut(edges.select("early", "late").where("early <> late").distinct())
    while True:
        met = left.join(state.select(F.col("node").alias("early"), F.col("taken").alias("before")), "early")
        seen = met.groupBy(F.col("late").alias("node")).agg(F.bool_or("before").alias("blocked"), F.count_if(F.col("before").isNull()).alias("waits"), F.min(F.when(F.col("before").isNull(), F.col("early"))).alias("on"))
        j = state.join(seen, "node", "left").withColumns({"blocked": F.coalesce("blocked", F.lit(False)), "waits": F.coalesce("waits", F.lit(0))})
        known = F.when(F.col("taken").isNotNull(), F.col("taken")).when(F.col("blocked"), False).when(F.col("waits") == 0, True)
        one = known.isNull() & (F.col("waits") == 1)
        chain = cut(j.select("node", known.alias("taken"), F.when(one, F.col("on")).otherwise(F.col("node")).alias("to"), one.alias("flip")))
        release(state)
        while not chain.where("`to` <> node").isEmpty():
            ahead = chain.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("flip").alias("turn"))
            moved = cut(chain.join(ahead, "to").select("node", "taken", F.col("next").alias("to"), (F.col("flip") != F.col("turn")).alias("flip"), (F.col("next") != F.col("to")).alias("moved")))
            release(chain)
            chain = moved
            if chain.where("moved").isEmpty():
                break
        heads = chain.where("taken is not null").select(F.col("node").alias("to"), F.col("taken").alias("head"))
        new = cut(chain.join(heads, "to", "left").select("node", F.coalesce("taken", F.when(F.col("head").isNotNull(), F.col("head") != F.col("flip"))).alias("taken")))
        open_ = new.where("taken is null").select(F.col("node").alias("late"))
        done = open_.isEmpty()
        # Only what undecided nodes still hang on: nodes that are not taken block nothing.
        kept = None if done else cut(left.join(open_, "late").join(new.where("not coalesce(taken, true)").select(F.col("node").alias("early")), "early", "left_anti"))
        release(chain, left)
        state, left = new, kept
        if done:
            return state


def folded(title: Column) -> Column:
    return F.replace(ascii_key(title), F.lit(" "), F.lit(""))


def words(title: Column) -> Column:
    """Words of a title one space apart, without a leading article."""
    return F.regexp_replace(ascii_key(title), "^the ", "")


def title_keys(lines: DataFrame) -> DataFrame:
    """(key, kind, fold): 't' for titles, native titles and the name, 'o' for original titles, which only meet within a source."""
    both = F.concat(
        F.transform(F.array_compact(F.concat("titles", "native", F.array("name"))), lambda t: F.struct(F.lit("t").alias("kind"), folded(t).alias("fold"))),
        F.transform(F.array_compact("orig"), lambda t: F.struct(F.concat(F.lit("o:"), "source").alias("kind"), folded(t).alias("fold"))),
    )
    return lines.select("key", F.explode(both).alias("k")).select("key", "k.*").where(F.length("fold") >= LEAST_KEY).distinct()


def link(groups: DataFrame, works: DataFrame) -> DataFrame:
    """(g, tier, work): the work that a group's titles name, by official titles first, then by others; null if several do.

    groups: g, titles, authors; works: work, titles (official), aliases, authors. A tier is high if one work has an official title
    of the group and shares an author, medium if one has, low if one has it as an alias only, ambiguous if several do.
    A title keeps the smallest and the greatest of its works, so that titles of many lines and many works give no pairs.
    """
    said = groups.select("g", F.explode(F.array_distinct(F.transform(F.array_compact("titles"), folded))).alias("fold")).where(F.length("fold") >= LEAST_KEY)
    spelled = works.select("work", F.explode(F.array_compact("titles")).alias("title"), F.lit(True).alias("official")).unionAll(works.select("work", F.explode(F.array_compact("aliases")), F.lit(False)))
    by = lambda o: F.when(F.col("official") == o, F.col("work"))
    known = spelled.select("work", folded(F.col("title")).alias("fold"), "official").groupBy("fold").agg(F.min(by(True)).alias("a"), F.max(by(True)).alias("z"), F.min(by(False)).alias("b"), F.max(by(False)).alias("y"))
    each = said.join(known, "fold").groupBy("g").agg(F.min("a").alias("a"), F.max("z").alias("z"), F.min("b").alias("b"), F.max("y").alias("y"))
    named = F.col("a").isNotNull()
    one = each.select("g", named.alias("official"), F.when(named, F.col("a")).otherwise(F.col("b")).alias("work"), F.when(named, F.col("z")).otherwise(F.col("y")).alias("last"))
    one = one.select("g", "official", F.when(F.col("work") == F.col("last"), F.col("work")).alias("work"))
    authors = groups.select("g", F.col("authors").alias("mine")).join(one, "g").join(works.select("work", F.col("authors").alias("theirs")), "work", "left")
    tier = (
        F.when(F.col("work").isNull(), "ambiguous").when(~F.col("official"), "low")
        .when(F.coalesce(F.arrays_overlap("mine", "theirs"), F.lit(False)), "high").otherwise("medium")
    )
    return authors.select("g", tier.alias("tier"), "work")


def _runs(text: Column) -> Column:
    """All runs of whole words of a title that are long enough."""
    w = F.split(text, " ")
    every = F.flatten(F.transform(F.sequence(F.lit(1), F.size(w)), lambda i: F.transform(F.sequence(F.lit(1), F.size(w) - i + 1), lambda n: F.array_join(F.slice(w, i, n), " "))))
    return F.array_distinct(F.filter(every, lambda r: F.length(F.replace(r, F.lit(" "), F.lit(""))) >= LEAST_RUN))


def conflicts(early: DataFrame, late: DataFrame) -> DataFrame:
    """(early, late) of clusters whose titles meet: equal keys, equal original titles, or all words of one as a run in the other.

    early, late: c, title, orig (whether an original title). What one cluster has as an original title counts as its title when
    it is early, and only among originals when it is late. A title meets others under its whole words, once for each run of words.
    """
    e, l = ({"k": folded(F.col("title")), "w": words(F.col("title"))} for _ in range(2))
    a = early.select(F.col("c").alias("early"), e["k"].alias("k"), e["w"].alias("w"), F.col("orig").alias("eo")).where(F.length("k") >= LEAST_KEY).distinct()
    b = late.select(F.col("c").alias("late"), l["k"].alias("k"), l["w"].alias("w"), F.col("orig").alias("lo")).where(F.length("k") >= LEAST_KEY).distinct()
    titles = b.where(~F.col("lo"))
    before = F.col("early") < F.col("late")
    same = a.join(titles, "k").where(before).select("early", "late")
    original = a.where("eo").join(b.where("lo"), "k").where(before).select("early", "late")
    inside = a.select("early", F.explode(_runs(F.col("w"))).alias("w")).join(titles.select("late", "w"), "w").where(before).select("early", "late")
    around = a.select("early", "w").join(titles.select("late", F.explode(_runs(F.col("w"))).alias("w")), "w").where(before).select("early", "late")
    return same.unionAll(original).unionAll(inside).unionAll(around).distinct()


def _contain(short: DataFrame, long: DataFrame) -> DataFrame:
    """(c, work) where the key a of short occurs inside the key b of long: by the hash of a's head among those of b's pieces."""
    n = F.coalesce(*[F.when(F.length("a") >= h, h) for h in reversed(_HEADS)])
    left = short.select("*", n.alias("n")).withColumn("h", F.xxhash64(F.substr("a", F.lit(1), F.col("n"))))
    met = None
    for h in _HEADS:
        pieces = F.expr(f"array_distinct(transform(sequence(1, length(b) - {h} + 1), i -> xxhash64(substr(b, i, {h}))))")
        found = left.where(F.col("n") == h).join(long.where(F.length("b") >= h).select("*", F.explode(pieces).alias("h")), "h").where(F.contains("b", "a"))
        met = found.select("c", "work") if met is None else met.unionAll(found.select("c", "work"))
    return met


def known_hits(clusters: DataFrame, works: DataFrame) -> DataFrame:
    """(c, work): works of the build's own market whose official title contains a title of the cluster or lies in one; any work, by equal originals.

    clusters: c, title, orig; works: work, titles, native (whether a work of the build's market).
    """
    t = clusters.select("c", folded(F.col("title")).alias("k"), "orig").where(F.length("k") >= LEAST_KEY).distinct()
    w = works.select("work", "native", F.explode(F.array_compact("titles")).alias("title")).select("work", "native", folded(F.col("title")).alias("k")).where(F.length("k") >= LEAST_KEY).distinct()
    mine, own = t.where(~F.col("orig")), w.where("native")
    out = _contain(mine.select("c", F.col("k").alias("a")), own.select("work", F.col("k").alias("b")))
    out = out.unionAll(_contain(own.select("work", F.col("k").alias("a")), mine.select("c", F.col("k").alias("b"))))
    return out.unionAll(t.where("orig").join(w, "k").select("c", "work")).distinct()


def decide(lines: DataFrame, works: DataFrame, links: DataFrame, reviews: DataFrame, joins: DataFrame) -> DataFrame:
    """(key, cluster, role, work, reason, medium) of every line.

    lines: key, source, market, name, titles, native, orig, authors (arrays), medium, medium_why, medium_guess, explicit, comic, role and work of
    lines that are attached by ISBN (else null), published (the work that the line was published under, else null), opens (it has a first volume).
    works: work, titles, aliases, authors, native, guarded (a work of the home market that no line may be linked to), library (made by an
    earlier build). Corrections: links (key, work, override), reviews (key, why), joins (a, b: lines whose clusters are one).
    """
    lines = cut(dealt(lines, "key"))
    flags = works.select("work", "guarded", "library")
    # One by one.
    single = link(lines.where("role is null").select(F.col("key").alias("g"), F.concat("titles", "orig", "native").alias("titles"), "authors"), works)
    corrected = links.join(works.select("work"), "work").select(F.col("key").alias("g"), F.col("work").alias("corrected"), "override")
    s = lines.join(single.withColumnsRenamed({"g": "key", "work": "found"}), "key", "left").join(corrected.withColumnRenamed("g", "key"), "key", "left")
    tier = F.coalesce("tier", F.lit("none"))
    target = F.when(F.col("role").isNotNull(), F.col("work")).when(F.col("corrected").isNotNull(), F.col("corrected")).when(tier.isin("high", "medium"), F.col("found"))
    s = s.withColumn("target", target).join(flags.select(F.col("work").alias("target"), "guarded"), "target", "left")
    linked = F.col("role").isNull() & F.col("target").isNotNull()
    stopped = linked & F.coalesce("guarded", F.lit(False)) & ~F.coalesce("override", F.lit(False))
    first = F.when(stopped, "guarded").when(F.col("role").isNull() & F.col("target").isNull() & tier.isin("low", "ambiguous"), tier)
    medium = F.coalesce("medium", F.when(F.col("corrected").eqNullSafe(F.col("target")) & ~stopped & F.col("target").isNotNull(), F.col("medium_guess")))
    missing = F.when(medium.isNull(), F.coalesce("medium_why", F.lit("no-class-signal")))
    s = s.withColumns({"why": F.concat_ws("+", first, missing), "_medium": medium, "by_hand": F.col("corrected").isNotNull()})
    at = F.when(F.col("why") != "", "review").when(F.col("role").isNotNull(), F.col("role")).when(linked, "linked")
    s = s.withColumns({"at": at, "to": F.when(F.col("why") == "", F.col("target"))}).drop("medium", "role", "work").withColumnRenamed("_medium", "medium")
    placed = cut(s.drop("target", "found", "tier", "corrected", "override", "guarded"))
    pool = placed.where("at is null")

    # Clusters of the pool.
    known_keys = cut(title_keys(placed))
    mine = pool.join(known_keys.groupBy("key").agg(F.collect_list(F.concat_ws(":", "kind", "fold")).alias("keys")), "key", "left").withColumn("keys", F.coalesce("keys", F.array().cast("array<string>")))
    pooled_joins = joins.join(pool.select(F.col("key").alias("a")), "a", "left_semi").join(pool.select(F.col("key").alias("b")), "b", "left_semi")
    grouped = shared_key_clusters(mine.select(F.col("key").alias("line"), "keys"), "line", F.col("keys"), pooled_joins).withColumnsRenamed({"line": "key", "component": "c"})
    member = cut(pool.join(grouped, "key").join(reviews.groupBy("key").agg(F.min("why").alias("told")), "key", "left").join(flags.select(F.col("work").alias("published"), F.col("library").alias("shelf")), "published", "left"))
    comic = F.col("medium").isin(*COMIC)
    c = member.groupBy("c").agg(
        F.count("*").alias("n"), F.bool_or(F.col("published").isNotNull()).alias("carried"), F.min_by("told", F.when(F.col("told").isNotNull(), F.col("key"))).alias("told"),
        F.bool_or("explicit").alias("explicit"), F.bool_or("comic").alias("comic"), F.min(F.when(F.col("shelf"), F.col("published"))).alias("frozen"),
        F.bool_or(F.col("published").isNotNull() & ~F.coalesce("shelf", F.lit(True))).alias("elsewhere"), F.min(F.when(comic & (F.col("market") == "EN"), F.col("key"))).alias("english"),
        F.min(F.when(comic, F.col("key"))).alias("any_comic"), F.flatten(F.collect_set(F.concat("titles", "orig", "native"))).alias("titles"), F.flatten(F.collect_set("authors")).alias("authors"),
    )
    c = cut(c)
    together = link(c.where("n > 1").select(F.col("c").alias("g"), "titles", "authors"), works).join(flags.select("work", "guarded"), "work", "left")
    together = together.select(F.col("g").alias("c"), F.col("tier").alias("c_tier"), F.col("work").alias("c_work"), F.coalesce("guarded", F.lit(False)).alias("c_guarded"))
    held_keys = known_keys.join(placed.where("at is not null and at <> 'review' and `to` is not null").select("key"), "key", "left_semi").select("kind", "fold").distinct()
    siblings = known_keys.join(member.select("key", "c"), "key").join(held_keys, ["kind", "fold"], "left_semi").select("c", F.lit(True).alias("sibling")).distinct()
    spelled = F.concat(
        F.transform(F.array_compact(F.concat("titles", "native", F.array("name"))), lambda t: F.struct(t.alias("title"), F.lit(False).alias("orig"))),
        F.transform(F.array_compact("orig"), lambda t: F.struct(t.alias("title"), F.lit(True).alias("orig"))),
    )
    spelled = cut(member.select("c", F.explode(spelled).alias("t")).select("c", "t.*").distinct())
    native_too = member.select("c", F.explode(F.array_compact("native")).alias("title")).select("c", "title", F.lit(True).alias("orig"))
    # Works of one title hit alike.
    heads = works.select("work", "native", F.explode(F.array_compact("titles")).alias("title")).groupBy("native", "title").agg(F.min("work").alias("work"))
    hits = known_hits(spelled.unionAll(native_too), heads.select("work", "native", F.array("title").alias("titles"))).select("c", F.lit(True).alias("hit")).distinct()
    good = F.coalesce("c_tier", F.lit("none"))
    outcome = (
        F.when(F.col("told").isNotNull() & ~F.col("carried"), F.concat(F.lit("review|correction: "), "told"))
        .when(good.isin("high", "medium") & ~F.col("c_guarded"), "linked|").when(good != "none", F.concat(F.lit("review|cluster-"), F.when(F.col("c_guarded"), "guarded").otherwise(good)))
        .when(F.col("frozen").isNotNull(), "new_work|frozen").when(F.col("sibling"), "review|linked-sibling-key").when(F.col("hit"), "review|containment")
        .when(~F.col("explicit"), "unlinked|no-explicit-origin").when(~F.col("comic"), "unlinked|no-comic").when(F.col("elsewhere"), "review|carried-elsewhere")
        .when(F.col("any_comic").isNull(), "held|novel-without-comic").otherwise("new_work|")
    )
    c = cut(c.join(together, "c", "left").join(siblings, "c", "left").join(hits, "c", "left").withColumn("outcome", outcome))

    # The rule that looks back: only these are open to it, and only works that are made count.
    open_ = c.where(F.col("outcome").isin("new_work|", "unlinked|no-explicit-origin", "unlinked|no-comic", "review|carried-elsewhere", "held|novel-without-comic"))
    makers = c.where(F.col("outcome").startswith("new_work|"))
    edges = cut(conflicts(spelled.join(makers.select("c"), "c", "left_semi"), spelled.join(open_.select("c"), "c", "left_semi")))
    rivals = edges.join(makers.select(F.col("c").alias("late")), "late", "left_semi")
    made = first_come(makers.select(F.col("c").alias("node"), (F.col("outcome") == "new_work|frozen").alias("fixed")), rivals).where("taken").select(F.col("node").alias("early"))
    late = edges.join(made, "early").select(F.col("late").alias("c"), F.lit(True).alias("behind")).distinct()
    c = c.join(late, "c", "left").withColumn("outcome", F.when(F.col("behind"), "review|containment").otherwise(F.col("outcome")))
    made_id = F.concat(F.lit("w:"), F.coalesce("english", "any_comic"))
    c = c.select("c", F.split_part("outcome", F.lit("|"), F.lit(1)).alias("c_role"), F.nullif(F.split_part("outcome", F.lit("|"), F.lit(2)), F.lit("")).alias("c_why"),
                 F.when(F.col("outcome") == "linked|", F.col("c_work")).when(F.col("outcome") == "new_work|frozen", F.col("frozen")).when(F.col("outcome") == "new_work|", made_id).alias("c_to"))
    pooled = member.select("key", "c").join(c, "c")
    out = placed.join(pooled, "key", "left").select("*", F.coalesce("at", "c_role").alias("role"), F.coalesce("to", "c_to").alias("work"), F.coalesce(F.nullif("why", F.lit("")), "c_why").alias("reason"))
    return _afterwards(cut(out), works)


def _afterwards(d: DataFrame, works: DataFrame) -> DataFrame:
    """Fragments go to review, published lines keep their work, novels of works without a comic are held."""
    novel = F.coalesce(F.col("medium") == NOVEL, F.lit(False))
    d = d.withColumn("novel", novel)
    carried = d.where("published is not null").select(F.col("published").alias("work"), "market", "novel", F.lit(True).alias("has")).distinct()
    d = d.join(carried, ["work", "market", "novel"], "left")
    by_title = (F.col("role") == "sibling") | (F.col("role") == "linked") & ~F.col("by_hand")
    fragment = F.col("has") & F.col("published").isNull() & by_title & ~F.col("opens")
    fragment = F.coalesce(fragment, F.lit(False))
    d = d.withColumns({"_f": fragment, "reason": F.when(fragment, F.concat_ws("+", "reason", F.lit("fragment"))).otherwise(F.col("reason"))})
    d = d.withColumns({"role": F.when(F.col("_f"), "review").otherwise(F.col("role")), "work": F.when(~F.col("_f"), F.col("work"))})
    exist = works.select(F.col("work").alias("published"), F.lit(True).alias("exists"))
    made = d.where("role = 'new_work'").select(F.col("work").alias("published"), F.lit(True).alias("exists"))
    d = d.join(exist.unionAll(made).distinct(), "published", "left")
    kept = F.coalesce(F.col("exists") & F.col("role").isin("review", "unlinked", "held"), F.lit(False))
    d = d.withColumn("_k", kept).withColumns({"work": F.when(F.col("_k"), F.col("published")).otherwise(F.col("work")), "reason": F.when(F.col("_k"), F.concat(F.coalesce("reason", F.lit("")), F.lit(";kept"))).otherwise(F.col("reason")), "role": F.when(F.col("_k"), "kept").otherwise(F.col("role"))})
    d = cut(d)
    shown = F.col("role").isin("linked", "new_work", "kept", "merged", "sibling")
    drawn = d.where(shown & (F.col("medium").isNotNull() & ~F.col("novel") | (F.col("role") == "new_work"))).select("work", F.lit(True).alias("drawn")).where("work is not null").distinct()
    d = d.join(drawn, "work", "left")
    hold = F.col("novel") & F.col("role").isin("linked", "sibling") & F.col("published").isNull() & F.col("drawn").isNull()
    d = d.withColumns({"_h": hold, "reason": F.when(hold, "novel-without-comic").otherwise(F.col("reason"))})
    d = d.withColumn("role", F.when(F.col("_h"), "held").otherwise(F.col("role")))
    work = F.when(F.col("role").isin("linked", "new_work", "kept", "merged", "sibling"), F.col("work"))
    return d.select("key", F.col("c").alias("cluster"), "role", work.alias("work"), "reason", "medium")


def adoptions(decided: DataFrame, lines: DataFrame, works: DataFrame) -> DataFrame:
    """(work, public, conflict): works whose lines were published under a library work take that work's id, the smallest of several.

    It is a conflict where two works would take one id, or the id belongs to a work of this build.
    """
    was = lines.select("key", "published").join(works.where("library").select(F.col("work").alias("published")), "published", "left_semi")
    moved = decided.where("work is not null and role <> 'new_work'").join(was, "key").where("published <> work").groupBy("work").agg(F.min("published").alias("public"))
    made = decided.where("role = 'new_work'").select(F.col("work").alias("public"), F.lit(True).alias("made")).distinct()
    takers = moved.groupBy("public").agg(F.count("*").alias("takers"))
    return moved.join(takers, "public").join(made, "public", "left").select("work", "public", ((F.col("takers") > 1) | F.coalesce("made", F.lit(False))).alias("conflict"))


def line_roles(lines: DataFrame, works: DataFrame, links: DataFrame) -> DataFrame:
    """(line, role, work, via) of a library's lines after linking, each by itself.

    lines: line, role and target (attached by ISBN, else null), tier, link_work, via, differ (the authors speak against link_work), published (the work it was
    published under). An attached line has its target. Others are linked, in review or unlinked by their tier; a correction (links: line, work) links a line
    whatever its tier; a work out of scope takes none. A published line that the linker has merely lost keeps its work, but not where authors speak against it.
    works: work, out_of_scope.
    """
    known = works.select("work", "out_of_scope")
    hand = links.join(known.select("work"), "work", "left_semi").groupBy("line").agg(F.min("work").alias("by_hand"))
    j = lines.join(hand, "line", "left")
    fresh = F.col("role").isNull()
    by_tier = F.when(F.col("tier").isin("high", "medium"), "linked").when(F.col("tier").isin("low", "ambiguous"), "review").otherwise("unlinked")
    linked = F.when(F.col("by_hand").isNotNull(), "linked").otherwise(by_tier)
    j = j.withColumns({"at": F.when(fresh, linked).otherwise(F.col("role")), "to": F.when(~fresh, F.col("target")).when(linked == "linked", F.coalesce("by_hand", "link_work")), "how": F.when(fresh & F.col("by_hand").isNotNull(), "correction").otherwise(F.col("via"))})
    j = j.join(known.select(F.col("work").alias("to"), "out_of_scope"), "to", "left")
    gone = fresh & (F.col("at") == "linked") & F.coalesce("out_of_scope", F.lit(False))
    j = j.withColumns({"_gone": gone}).withColumns({"at": F.when(F.col("_gone"), "out_of_scope").otherwise(F.col("at")), "to": F.when(~F.col("_gone"), F.col("to"))})
    j = j.join(known.select(F.col("work").alias("published"), F.lit(True).alias("exists")), "published", "left")
    against = F.coalesce(F.col("differ") & (F.col("link_work") == F.col("published")), F.lit(False))
    keep = fresh & F.col("at").isin("review", "unlinked") & F.coalesce("exists", F.lit(False)) & ~against
    return j.select("line", F.when(keep, "kept").otherwise(F.col("at")).alias("role"), F.when(keep, F.col("published")).otherwise(F.col("to")).alias("work"), F.col("how").alias("via"))
