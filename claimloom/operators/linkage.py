"""Record linkage: joins by overlap, prefix, edit distance and tiers, each as an equi-join plus a residual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unique_key_join(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Joins only where the key occurs exactly once on the right."""
    once = right.groupBy(key).agg(F.count("*").alias("__n"), F.min(value).alias(value)).where("__n = 1").drop("__n")
    return left.join(once, key)


def majority_overlap(old: DataFrame, new: DataFrame, owner: str, key: str) -> DataFrame:
    """old and new owners that share a strict majority of the old owner's keys: old, new, shared, n; ties are kept out.

    Keys held by a single pair are aggregated before the ranking shuffle.
    """
    a = old.select(F.col(owner).alias("old"), key).distinct()
    b = new.select(F.col(owner).alias("new"), key).distinct()
    sizes = a.groupBy("old").agg(F.count("*").alias("n"))
    votes = a.join(b, key).groupBy("old", "new").agg(F.count("*").alias("shared"))
    won = votes.join(sizes, "old").where(F.col("shared") * 2 > F.col("n"))
    w = Window.partitionBy("old")
    return won.withColumn("best", F.max("shared").over(w)).where("shared = best").withColumn("ties", F.count("*").over(w)).where("ties = 1").select("old", "new", "shared", "n")


def mostly_held(rows: DataFrame, within: list[str], line: str, key: str) -> DataFrame:
    """(line) of lines more than half of whose rows have a key that one other line of the same `within` holds too; rows are distinct.

    Lines with equal keys (128 bits of the set) are one class: where it has several lines, no other line need be looked at. A line alone in its
    class meets one line of each other class, under the rarest of its keys: as many as it could not do without one of.
    """
    owner = [*within, line]
    bits = [F.bit_xor(F.when(F.col(key).isNotNull(), F.xxhash64(F.lit(seed), key))).alias(f"__x{seed}") for seed in (1, 2)]
    sets = rows.groupBy(*owner).agg(F.count("*").alias("__n"), F.count(key).alias("__size"), *bits).where("__size > 0")
    classes = sets.groupBy(*within, "__size", "__x1", "__x2").agg(F.count("*").alias("__lines"), F.min(line).alias("__rep"))
    each = sets.join(classes, [*within, "__size", "__x1", "__x2"])
    twins = each.where("__lines > 1 and 2 * __size > __n").select(line)
    keyed = rows.where(F.col(key).isNotNull()).select(*owner, key)
    reps = keyed.join(classes.select(*within, F.col("__rep").alias(line)), owner, "left_semi").withColumnRenamed(line, "__other")
    alone = keyed.join(each.where("__lines = 1").select(*owner, "__n", "__size"), owner)
    often = reps.groupBy(*within, key).agg(F.count("*").alias("__df"))
    ranked = alone.join(often, [*within, key]).withColumn("__p", F.row_number().over(Window.partitionBy(*owner).orderBy("__df", key)))
    heads = ranked.where(F.col("__p") <= F.col("__size") - F.floor(F.col("__n") / 2)).select(*owner, key)
    met = heads.join(reps, [*within, key]).where(F.col(line) != F.col("__other")).select(*owner, "__other").distinct()
    shared = alone.join(met, owner).join(reps, [*within, "__other", key]).groupBy(*owner, "__other", "__n").agg(F.count("*").alias("__shared"))
    return twins.unionAll(shared.where("2 * __shared > __n").select(line)).distinct()


def cascade(rows: DataFrame, tables: list[DataFrame], key: str, value: str) -> DataFrame:
    """The value of the first table that knows the key, and which one that was."""
    out = rows
    for i, t in enumerate(tables):
        out = out.join(t.select(F.col(key), F.col(value).alias(f"__v{i}")), key, "left")
    hit = F.lit(None).cast("int")
    for i in reversed(range(len(tables))):
        hit = F.when(F.col(f"__v{i}").isNotNull(), i + 1).otherwise(hit)
    return out.withColumn(value, F.coalesce(*[F.col(f"__v{i}") for i in range(len(tables))])).withColumn("via", hit).drop(*[f"__v{i}" for i in range(len(tables))])


def prefix_join(short: DataFrame, long: DataFrame, a: str, b: str, head: int) -> DataFrame:
    """Rows of long whose b starts with a of short: an equi-join on a head of a, at most `head` characters, then the residual.

    A shorter a meets b under all of itself; an empty one is met by every b that is not null.
    """
    left = short.where(F.col(a).isNotNull()).withColumn("__h", F.substring(a, 1, head))
    heads = F.transform(F.sequence(F.lit(0), F.least(F.length(b), F.lit(head))), lambda n: F.substr(F.col(b), F.lit(1), n))
    right = long.where(F.col(b).isNotNull()).withColumn("__h", F.explode(heads))
    # A longer a has a head of its own length only, so a pair meets once.
    return left.join(right, "__h").where(F.startswith(F.col(b), F.col(a))).drop("__h")


def longest_prefix(rows: DataFrame, names: DataFrame, least: int) -> DataFrame:
    """For each name of rows the longest other known name that it starts with (name, parent)."""
    known = names.select(F.col("name").alias("parent")).distinct()
    heads = rows.select("name").distinct().withColumn("parent", F.explode(F.expr(f"transform(sequence({least}, greatest(length(name) - 1, {least})), i -> substr(name, 1, i))")))
    found = heads.where(F.length("parent") < F.length("name")).join(known, "parent")
    return found.groupBy("name").agg(F.max_by("parent", F.length("parent")).alias("parent"))


def near_names(names: DataFrame, distance: int = 1) -> DataFrame:
    """Pairs of different names within an edit distance, without comparing all pairs.

    Names that many edits apart become equal when each loses at most as many letters, so a name meets the others under the hash
    of itself and of what is left of it. A prefix that all names share brings none together.
    """
    shorter = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substr(x, F.lit(1), i - 1), F.substr(x, i + 1)))
    forms = F.array("name")
    for _ in range(distance):
        forms = F.array_distinct(F.concat(forms, F.flatten(F.transform(F.filter(forms, lambda x: F.length(x) > 0), shorter))))
    probe = names.where(F.col("name").isNotNull()).select("name").distinct().select("name", F.explode(forms).alias("form")).select("name", F.xxhash64("form").alias("form"))
    # The forms are many times what Spark estimates of the names: a broadcast of them would not fit the driver.
    met = probe.hint("merge").join(probe.select(F.col("name").alias("other"), "form"), "form").where("name < other").select("name", "other").distinct()
    return met.withColumn("distance", F.levenshtein("name", "other", distance)).where("distance >= 0")


def contained(needles: DataFrame, texts: DataFrame, item: str, doc: str, head: int = 4) -> DataFrame:
    """(item, doc) of needles whose words occur as a run in a text, whole words only; both tables have a column text.

    A needle meets the texts that hold its first words (at most `head`), by their hash; only these pairs carry their texts. The
    runs of a text have the lengths that occur among the heads. Needles and texts without a word are contained in nothing.
    """
    from claimloom.functions.keys import ascii_key

    w = needles.select(item, ascii_key(F.col("text")).alias("key")).where("key <> ''").withColumn("w", F.split("key", " "))
    hashed = F.coalesce(*[F.when(F.size("w") >= k, F.xxhash64(*[F.get("w", F.lit(j)) for j in range(k)])) for k in range(head, 0, -1)])
    heads = w.select(item, "key", F.least(F.size("w"), F.lit(head)).alias("n"), hashed.alias("h"))
    lengths = sorted(r.n for r in heads.select("n").distinct().collect())
    keyed = texts.select(doc, ascii_key(F.col("text")).alias("words")).where("words <> ''")
    split = keyed.select(doc, F.split("words", " ").alias("w"))
    met = None
    for k in lengths:
        runs = F.expr(f"transform(sequence(0, size(w) - {k}), i -> xxhash64({', '.join(f'w[i + {j}]' for j in range(k))}))")
        every = split.where(F.size("w") >= k).select(doc, F.explode(F.array_distinct(runs)).alias("h"))
        found = every.join(heads.where(F.col("n") == k).select("h", item), "h").select(doc, item)
        met = found if met is None else met.unionAll(found)
    if met is None:
        return heads.join(keyed, F.lit(False)).select(item, doc)
    pairs = met.distinct().join(heads.select(F.col(item).alias("__i"), "key"), F.col(item).eqNullSafe(F.col("__i")))
    pairs = pairs.join(keyed.select(F.col(doc).alias("__d"), "words"), F.col(doc).eqNullSafe(F.col("__d")))
    inside = F.contains(F.concat(F.lit(" "), "words", F.lit(" ")), F.concat(F.lit(" "), "key", F.lit(" ")))
    return pairs.where(inside).select(item, doc).distinct()


def tier(official: Column, alias: Column, authors: Column) -> Column:
    """Confidence tier of a link from the number of candidates by official name, by alias and by shared authors."""
    return (
        F.when((official == 1) & (authors > 0), "high").when(official == 1, "medium").when((official == 0) & (alias == 1), "low")
        .when((official > 1) | (alias > 1), "ambiguous").otherwise("none")
    )


def attach_roles(votes: DataFrame, mine: str, theirs: str, shared: str, n_mine: str, n_theirs: str) -> DataFrame:
    """Each of mine goes to the one it shares most with, if that is half of the smaller side; the best of a target merges, others are siblings."""
    fits = votes.where(F.col(shared) * 2 >= F.least(n_mine, n_theirs))
    best = fits.withColumn("__r", F.row_number().over(Window.partitionBy(mine).orderBy(F.desc(shared), F.asc(theirs)))).where("__r = 1").drop("__r")
    nth = F.row_number().over(Window.partitionBy(theirs).orderBy(F.desc(shared), F.asc(mine)))
    return best.withColumn("role", F.when(nth == 1, "merged").otherwise("sibling"))


def one_to_one(pairs: DataFrame, a: str, b: str, score: str) -> DataFrame:
    """Greedy one-to-one matching by score, then ids: the same pairs that taking the best free pair again and again gives.

    A pair with nothing better at either end is taken. One with a single better pair is taken if and only if that is not, so chains of such pairs
    are followed by pointer jumping, however long they are; the rest waits for the next round. A score may stand at an end that holds very many
    pairs: only the two best of an end are looked for, by aggregates. Pairs with a null end are left out; of equal ends the best score counts.
    """
    from claimloom.session import cut, release

    left = cut(pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.max(score).alias("s")))
    rank, taken = F.struct((-F.col("s")).alias("s"), "a", "b"), None
    while not left.isEmpty():  # the best pair of all is taken in every round
        marked = left
        for end in ("a", "b"):
            first = left.groupBy(end).agg(F.min(rank).alias(f"{end}1"))
            second = left.join(first, end).where(rank != F.col(f"{end}1")).groupBy(end).agg(F.min(rank).alias(f"{end}2"))
            marked = marked.join(first, end).join(second, end, "left")
        tops = {end: rank == F.col(f"{end}1") for end in ("a", "b")}
        nexts = {end: F.coalesce(rank == F.col(f"{end}2"), F.lit(False)) for end in ("a", "b")}
        hangs = F.when(tops["a"] & nexts["b"], F.col("b1")).when(tops["b"] & nexts["a"], F.col("a1"))
        on = F.coalesce(hangs, rank)
        state = cut(marked.select("a", "b", "s", on["a"].alias("pa"), on["b"].alias("pb"), hangs.isNotNull().alias("flip"), (tops["a"] & tops["b"]).alias("best")))
        while True:
            ahead = state.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("pa").alias("qa"), F.col("pb").alias("qb"), F.col("flip").alias("turn"))
            moved = cut(state.join(ahead, ["pa", "pb"]).select("a", "b", "s", F.col("qa").alias("pa"), F.col("qb").alias("pb"), (F.col("flip") != F.col("turn")).alias("flip"), "best", ((F.col("pa") != F.col("qa")) | (F.col("pb") != F.col("qb"))).alias("moved")))
            release(state)
            state = moved
            if state.where("moved").isEmpty():
                break
        roots = state.where("best").select(F.col("a").alias("pa"), F.col("b").alias("pb"))
        won = cut(state.join(roots, ["pa", "pb"], "left_semi").where("not flip").select("a", "b", "s"))
        release(state)
        taken = won if taken is None else taken.unionAll(won)
        left = cut(left.join(won.select("a"), "a", "left_anti").join(won.select("b"), "b", "left_anti"))
    found = taken if taken is not None else left
    return found.select(F.col("a").alias(a), F.col("b").alias(b), F.col("s").alias(score))


def spread(rows: DataFrame, row: str, groups: list[str], value: str) -> DataFrame:
    """Fills null values from groups whose known values agree, group column by group column, until nothing changes; every round but the last fills one."""
    from claimloom.session import cut

    state = cut(rows)
    while True:
        new = state
        for g in groups:
            agreed = new.where(F.col(value).isNotNull()).groupBy(g).agg(F.min(value).alias("__v"), F.max(value).alias("__w")).where("__v = __w").select(g, "__v")
            new = new.join(agreed, g, "left").withColumn(value, F.coalesce(value, "__v")).drop("__v")
        new = cut(new.select(*rows.columns))
        filled = new.where(F.col(value).isNotNull()).count()
        if filled == state.where(F.col(value).isNotNull()).count():
            return new
        state = new


def fold_verdicts(candidate: DataFrame, target: DataFrame, key: str, number: str, isbn: str) -> DataFrame:
    """Whether a candidate line extends its target, duplicates it, or is kept apart: key, verdict."""
    c = candidate.groupBy(key).agg(F.min(number).alias("lo"), F.count("*").alias("n"))
    t = target.groupBy(key).agg(F.max(number).alias("hi"))
    both = candidate.select(key, number, F.col(isbn).alias("x")).join(target.select(key, number, F.col(isbn).alias("y")), [key, number])
    met = both.groupBy(key).agg(F.count("*").alias("met"), F.count_if(F.col("x") != F.col("y")).alias("clash"))
    all_ = c.join(t, key).join(met, key, "left").fillna(0, ["met", "clash"])
    verdict = F.when((F.col("met") == 0) & (F.col("lo") == F.col("hi") + 1), "extend").when((F.col("met") == F.col("n")) & (F.col("clash") == 0), "duplicate").otherwise("kept")
    return all_.select(key, verdict.alias("verdict"))


@F.pandas_udf(T.DoubleType())
def difflib_ratio(a, b):
    """Similarity of two strings as Python's difflib gives it; what it works out of the second is kept while that stays."""
    import difflib

    import numpy as np
    import pandas as pd

    match, last, out = difflib.SequenceMatcher(None), None, np.zeros(len(a))
    x, y = a.tolist(), b.tolist()
    for i in sorted(range(len(y)), key=y.__getitem__):
        if y[i] != last:
            match.set_seq2(last := y[i])
        match.set_seq1(x[i])
        out[i] = match.ratio()
    return pd.Series(out)


def _pieces(name: Column, size: int) -> Column:
    """The runs of so many letters of a name, each numbered among its equals."""
    each = F.when(F.length(name) >= size, F.transform(F.sequence(F.lit(1), F.length(name) - size + 1), lambda i: F.substr(name, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))
    return F.transform(each, lambda x, i: F.concat(x, F.lit("\x00"), F.size(F.filter(F.slice(each, F.lit(1), i + 1), lambda y: y == x)).cast("string")))


def similar_titles(names: DataFrame, least: float = 0.8) -> DataFrame:
    """(group, name, other, ratio): pairs of different names of a group whose difflib ratio reaches `least` (over a half).

    The ratio is 2 M / (n + m) with M letters in matching blocks, at most n + m - 2 M + 1 of them, and a block of k letters holds k - 1 pairs of neighbours.
    So alike names share M letters and 3 M - (n + m) - 1 pairs of neighbours, repeats counted. Names meet on one of the rarest pairs that either
    cannot do without (on letters, where both are so short that no pair need be shared), both counts are checked, and only what is left is compared.
    Where the groups hold much the same names, all names meet once instead of once a group.
    """
    own = names.select("group", "name").where("group is not null and name is not null and name <> ''").distinct()
    together = own.select("name").distinct().count()
    apart = own.groupBy("group").count().agg(F.coalesce(F.sum(F.col("count").cast("double") ** 2), F.lit(0.0))).first()[0]
    if together**2 >= apart:
        return _similar_titles(own, least)
    alike = _similar_titles(own.select(F.lit(0).alias("group"), "name").distinct(), least).drop("group")
    return own.join(alike, "name").join(own.withColumnRenamed("name", "other"), ["group", "other"]).select("group", "name", "other", "ratio")


def _similar_titles(names: DataFrame, least: float) -> DataFrame:
    from claimloom.session import dealt

    n = names.withColumn("n", F.length("name"))
    n = n.withColumns({"letters": _pieces(F.col("name"), 1), "pairs": _pieces(F.col("name"), 2)})
    held = lambda total: F.ceil(total * (least / 2) - 1e-9)  # noqa: E731  # letters in matching blocks
    bound = lambda total: 3 * held(total) - total - 1
    # From this n + m on some pair is shared; where the ratio asks for too little, never.
    enough = lambda t: all(3 * -(-(x * least / 2 - 1e-9) // 1) - x - 1 >= 1 for x in range(t, t + 200))
    short = next((t for t in range(2, 200) if enough(t)), 1 << 30)
    shortest = F.ceil(F.col("n") * least / (2 - least) - 1e-9)  # of its partners
    kinds = [
        # No partner of more letters than `short` allows is met on letters, and none of fewer on pairs.
        ("letters", F.col("n") + shortest < short, held(F.col("n") + shortest)),
        ("pairs", F.floor(F.col("n") * (2 - least) / least + 1e-9) + F.col("n") >= short, F.greatest(F.ceil((1.5 * least - 1) * F.greatest(F.col("n") + shortest, F.lit(short)) - 1 - 1e-9), F.lit(1))),
    ]
    met = None
    for kind, some, share in kinds:
        own = n.where(some).select("group", "name", "n", F.explode(kind).alias("token"), F.greatest(F.size(kind) - share + 1, F.lit(1)).alias("first"))
        often = own.groupBy("group", "token").agg(F.count("*").alias("df"))
        place = F.row_number().over(Window.partitionBy("group", "name").orderBy("df", "token"))
        # Few heads make many pairs: dealt by number, so that they are not gathered in one task for being small.
        heads = dealt(own.join(often, ["group", "token"]).withColumn("p", place).where("p <= first").select("group", "token", "name", "n"), "group", "token")
        other = heads.select("group", "token", F.col("name").alias("other"), F.col("n").alias("m"))
        fits = (F.col("name") < F.col("other")) & (2 * F.least("n", "m") >= least * (F.col("n") + F.col("m")) - 1e-9)
        found = heads.hint("merge").join(other, ["group", "token"]).where(fits).select("group", "name", "other").distinct()
        met = found if met is None else met.unionAll(found)
    sides = [n.select("group", F.col("name").alias(a), F.col("n").alias(f"n_{a}"), F.col("letters").alias(f"l_{a}"), F.col("pairs").alias(f"p_{a}")) for a in ("name", "other")]
    pairs = met.distinct().join(sides[0], ["group", "name"]).join(sides[1], ["group", "other"])
    total = F.col("n_name") + F.col("n_other")
    common = lambda k: F.size(F.array_intersect(f"{k}_name", f"{k}_other"))
    left = pairs.where((common("l") >= held(total)) & (common("p") >= bound(total))).select("group", "name", "other")
    return dealt(left, "other").withColumn("ratio", difflib_ratio("name", "other")).where(F.col("ratio") >= least)
