"""Binding lines to ids of an outside catalogue in rounds of search terms, and what happens to ids that several lines pick.

lines: line, work, language, medium, main, bound (the id it has, or null), pinned (never bind), name, local_name, volume_count, year_began.
aliases: line, pos, alias, language, kind ('official', 'romanized' or 'alias'). pages: family, term_key and the candidate columns of
ranking.pick without those of the query, with year: what a search for a term gave, bounded by the size of a result page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import keys
from claimloom.operators import ranking
from claimloom.session import cut

#: Aliases of a line that are searched at most; years that a candidate may start apart from a line.
ALIASES, YEARS = 3, 3
NOVELS, COMICS = ("novel", "light_novel"), ("manga", "manhwa", "manhua", "webtoon")
ROUNDS = (("name", "native"), ("official",), ("alias",))


def family(medium: Column) -> Column:
    """'novel' or 'comic' (a line without a medium is one); any other medium is a family of its own."""
    return F.when(medium.isin(*NOVELS), "novel").when(medium.isNull() | medium.isin(*COMICS), "comic").otherwise(medium)


def searchable(title: Column) -> Column:
    """A title as it is searched: dashes as hyphens, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(title, "[‐-―]", "-"), "\\s+", " "))


def unbound_native(lines: DataFrame, language: str) -> DataFrame:
    """Main lines of a language without an id, whose work has neither an English nor a bound line of their family (comic or novel)."""
    f = lines.withColumn("family", family(F.col("medium")))
    served = f.where("language = 'en' or bound is not null").select("work", "family").distinct()
    mine = f.where((F.col("language") == language) & F.col("main") & F.col("bound").isNull() & ~F.col("pinned") & F.col("family").isin("comic", "novel"))
    return mine.join(served, ["work", "family"], "left_anti")


def unvoiced_works(lines: DataFrame, media: tuple[str, ...], first: str) -> DataFrame:
    """Main lines (with `rank`) of works that have no English comic line and a main line in `media` without an id; lines in language `first` lead."""
    english = lines.where((F.col("language") == "en") & F.col("medium").isin(*COMICS)).select("work").distinct()
    mine = lines.where(F.col("main") & F.col("medium").isin(*media) & ~F.col("pinned")).join(english, "work", "left_anti")
    open_ = mine.where("bound is null").select("work").distinct()
    order = Window.partitionBy("work").orderBy(F.col("language") != first, "line")
    return mine.join(open_, "work", "left_semi").withColumn("rank", F.row_number().over(order))


def _numbered(terms: DataFrame, owner: str, by: Column, *order: str) -> DataFrame:
    """One term a key in order, numbered; terms without a key go."""
    t = terms.withColumn("term_key", keys.compact_key(F.col("term"))).where("term_key <> ''")
    first = t.withColumn("_r", F.row_number().over(Window.partitionBy(owner, by).orderBy(*order))).where("_r = 1").drop("_r")
    return first.withColumn("place", F.row_number().over(Window.partitionBy(owner).orderBy(*order)))


def native_terms(lines: DataFrame, aliases: DataFrame, language: str) -> DataFrame:
    """(line, place, term, term_key, own, kind): name, native title, official aliases (the line's language, then English, then others), a few others."""
    base = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("name").alias("term"), F.lit("name").alias("kind")), F.struct(F.lit(1).alias("a"), F.lit(0).alias("b"), F.col("local_name").alias("term"), F.lit("native").alias("kind")))
    own = lines.select("line", F.explode(base).alias("t")).select("line", "t.*")
    mine = aliases.join(lines.select("line"), "line", "left_semi")
    tongue = F.when(F.col("language") == language, 2).when(F.col("language") == "en", 3).otherwise(4)
    official = mine.where("kind = 'official'").select("line", tongue.alias("a"), F.col("pos").alias("b"), F.col("alias").alias("term"), F.lit("official").alias("kind"))
    listed = F.lower("alias").rlike("^(list of|liste des|liste der) ")
    rest = mine.where((F.col("kind") == "alias") & ~listed).select("line", F.lit(9).alias("a"), F.col("pos").alias("b"), F.col("alias").alias("term"), F.lit("alias").alias("kind"))
    t = _numbered(own.unionAll(official).unionAll(rest).withColumn("term", searchable(F.col("term"))), "line", F.col("term_key"), "a", "b")
    nth = F.row_number().over(Window.partitionBy("line", "kind").orderBy("place"))
    return t.withColumn("_n", nth).where(f"kind <> 'alias' or _n <= {ALIASES}").select("line", "place", "term", "term_key", (F.col("kind") == "name").alias("own"), "kind")


def work_terms(lines: DataFrame, aliases: DataFrame, tongues: tuple[str, ...]) -> DataFrame:
    """(work, place, term, term_key, own, volume_count) of works met through unvoiced_works: each line's name, the name spelled out and without an
    edition, with that line's volumes; the first native and the first romanized title, and a few aliases, with the first line's."""
    name = searchable(F.col("name"))
    spelled = F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))
    plain = F.regexp_replace(name, "(?i)[ :-]+(deluxe|collector.?s|perfect|complete|omnibus) edition$", "")
    forms = F.array(*[F.struct(F.lit(i).alias("c"), t.alias("term"), F.lit(own).alias("own")) for i, (t, own) in enumerate(((name, True), (spelled, True), (plain, False)))])
    each = lines.select("work", F.lit(0).alias("a"), F.col("rank").alias("b"), F.explode(forms).alias("t"), "volume_count").select("work", "a", "b", "t.*", "volume_count")
    lead = lines.where("rank = 1").select("work", F.col("volume_count").alias("vc"))
    met = aliases.join(lines.select("line", "work", "rank"), "line").join(lead, "work")
    tongue = F.col("language").isin(*tongues)
    titles = met.where(tongue & F.col("kind").isin("official", "romanized")).withColumn("_n", F.row_number().over(Window.partitionBy("work", "kind").orderBy(F.col("rank") != 1, "line", "pos"))).where("_n = 1")
    titles = titles.select("work", F.when(F.col("kind") == "official", 1).otherwise(2).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("c"), searchable(F.col("alias")).alias("term"), F.lit(False).alias("own"), F.col("vc").alias("volume_count"))
    others = met.where((F.col("kind") == "alias") & ~F.lower("alias").rlike("^(list of|liste des|liste der) ")).select("work", F.lit(9).alias("a"), F.col("rank").alias("b"), F.col("pos").alias("c"), searchable(F.col("alias")).alias("term"), F.lit(False).alias("own"), F.col("vc").alias("volume_count"))
    # A name may come in two spellings of one key; other terms only with keys of their own.
    by = F.when(F.col("a") < 9, F.col("term")).otherwise(F.col("term_key"))
    t = each.unionByName(titles).unionByName(others).withColumn("term_key", keys.compact_key(F.col("term")))
    used = t.where("a < 9").select("work", "term_key").distinct()
    t = t.where("a < 9").unionByName(t.where("a = 9").join(used, ["work", "term_key"], "left_anti"))
    t = _numbered(t.drop("term_key"), "work", by, "a", "b", "c")
    nth = F.row_number().over(Window.partitionBy("work", F.col("a") == 9).orderBy("place"))
    return t.withColumn("_n", nth).where(f"a < 9 or _n <= {ALIASES}").select("work", "place", "term", "term_key", "own", "volume_count")


def picks(terms: DataFrame, pages: DataFrame, owner: str) -> DataFrame:
    """(owner, place, id, via): what each term's page answers, each ranked for itself, candidates of other years left out after the pick.

    terms: owner, place, family, term, term_key, own, volume_count, year_began.
    """
    q = F.struct(owner, "place")
    page = terms.withColumns({"q": q, "k": F.col("term_key"), "ak": keys.article_free_key(F.col("term")), "own_name": F.col("own"), "fallback": F.lit(False)}).join(pages, ["family", "term_key"])
    page = cut(page)
    found = ranking.pick(page).select(F.col(f"q.{owner}").alias(owner), F.col("q.place").alias("place"), "id", "via")
    year = page.select(owner, "place", "id", "year", "year_began").distinct()
    return found.join(year, [owner, "place", "id"]).where(ranking.year_fits(F.col("year"), F.col("year_began"), YEARS)).select(owner, "place", "id", "via")


def bind(lines: DataFrame, terms: DataFrame, pages: DataFrame, rounds: tuple[tuple[str, ...], ...] = ROUNDS) -> DataFrame:
    """(line, round, place, id, via, kind) of lines that a term binds: rounds of kinds of terms, each for the lines still unbound.

    Only terms of lines that no earlier round has bound are searched, so `pages` may be read, or fetched, a round at a time.
    """
    left = cut(terms.join(lines.select("line", "family", "volume_count", "year_began"), "line"))
    done = None
    for number, kinds in enumerate(rounds, 1):
        now = left.where(F.col("kind").isin(*kinds))
        hits = picks(now, pages, "line").join(now.select("line", "place", "kind"), ["line", "place"])
        won = hits.groupBy("line").agg(F.min_by(F.struct("place", "id", "via", "kind"), "place").alias("h")).select("line", F.lit(number).alias("round"), "h.*")
        won = cut(won)
        done = won if done is None else done.unionAll(won)
        left = left.join(won.select("line"), "line", "left_anti")
    return done


def bind_works(works: DataFrame, terms: DataFrame, pages: DataFrame, countries: int = 2) -> DataFrame:
    """(work, country, place, id, via): the first country whose pages bind a term, by the ranker, then by '&' read as 'and'.

    works: work, countries (array, in order), year_began; pages: family holds the country.
    """
    left, done = works, None
    for i in range(countries):
        now = left.where(F.size("countries") > i).select("work", F.get("countries", F.lit(i)).alias("family"), "year_began").join(terms, "work")
        now = cut(now)
        ranked = cut(picks(now, pages, "work"))
        first = ranked.groupBy("work").agg(F.min_by(F.struct("place", "id", "via"), "place").alias("h"))
        walked = now.join(first, "work", "left_anti")
        amp = lambda c: keys.ampersand_key(c)
        page = walked.withColumns({"q": F.struct("work", "place"), "k": F.col("term_key"), "own_name": F.lit(False), "words": F.lower("term"), "amp": amp(F.col("term")), "base": F.lit(""), "arc": F.lit(""), "orig_count": F.lit(None).cast("int")})
        page = page.join(pages, ["family", "term_key"]).withColumns({"amps": F.transform("titles", amp)})
        late = ranking.post_walk(page).where("via = 'amp'").select(F.col("q.work").alias("work"), F.col("q.place").alias("place"), "id", "via")
        second = late.groupBy("work").agg(F.min_by(F.struct("place", "id", "via"), "place").alias("h"))
        won = cut(first.unionAll(second).join(now.select("work", F.col("family").alias("country")).distinct(), "work").select("work", "country", "h.*"))
        done = won if done is None else done.unionAll(won)
        left = left.join(won.select("work"), "work", "left_anti")
    return done


def withheld(found: DataFrame, lines: DataFrame, taken: DataFrame) -> DataFrame:
    """found with `note`: null where the pick stands, else the work that has the id, or the first other line that stands against it.

    found: line, id; lines: line, work, family; taken: id, work. Main lines of one work and family that agree bind together; where they disagree
    none does; an id that lines of several works or families picked binds none of them.
    """
    f = found.join(lines.select("line", "work", "family"), "line")
    held = taken.groupBy("id").agg(F.min("work").cast("string").alias("holder"))
    own = f.groupBy("work", "family").agg(F.count_distinct("id").alias("ids"), F.array_sort(F.array_distinct(F.collect_list("line"))).alias("mains"))  # main lines of one work
    # Of each id the first line of each of the two first groups is enough to name an opponent.
    groups = f.groupBy("id", "work", "family").agg(F.min("line").alias("head"))
    firsts = groups.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy("head"))).where("_r <= 2")
    rivals = firsts.groupBy("id").agg(F.min_by(F.struct("head", "work", "family"), "_r").alias("one"), F.min(F.when(F.col("_r") == 2, F.col("head"))).alias("two"))
    j = f.join(held, "id", "left").join(own, ["work", "family"]).join(rivals, "id")
    mine = (F.col("one.work") == F.col("work")) & (F.col("one.family") == F.col("family"))
    other = F.when(mine, F.col("two")).otherwise(F.col("one.head"))
    note = F.when(F.col("holder").isNotNull(), F.col("holder")).when(F.col("ids") > 1, F.array_min(F.array_remove("mains", F.col("line"))).cast("string")).otherwise(other.cast("string"))
    return found.join(j.select("line", note.alias("note")), "line")


def assign(choices: DataFrame, taken: DataFrame) -> DataFrame:
    """(line, id, place): ids handed on until nobody is refused: a line asks for its choices in order, an id stays with the best claim.

    choices: line, place, id, claim (smaller is better; ties to the smaller line); taken: id. In each round all free lines ask at once for the first
    choice that has not refused them. The outcome does not hang on the order of asking, so it is that of a loop over single lines.
    """
    live = cut(choices.join(taken.select("id").distinct(), "id", "left_anti").groupBy("line", "id").agg(F.min_by(F.struct("place", "claim"), "place").alias("c")).select("line", "id", "c.place", "c.claim"))
    while True:
        asked = live.groupBy("line").agg(F.min_by(F.struct("id", "place", "claim"), "place").alias("c")).select("line", "c.*")
        best = F.row_number().over(Window.partitionBy("id").orderBy("claim", "line"))
        asked = cut(asked.withColumn("_r", best))
        refused = asked.where("_r > 1").select("line", "id")
        if refused.isEmpty():
            return asked.select("line", "id", "place")
        live = cut(live.join(refused, ["line", "id"], "left_anti"))


def shown_instead(lines: DataFrame, adapted: DataFrame, seen: DataFrame) -> DataFrame:
    """(line, id, via) for English lines without an id: their parent's (the name before its first cut, bound in the same work to one id only), or for
    novels without a parent the id that the comic's page for their name gives, unless their own page has their title.

    lines as above; adapted: line, id (what ranking.pick found on the comic pages); seen: line (its own page holds an equal title).
    """
    cut_at = F.regexp_extract(searchable(F.col("name")), "^(.+?)( \\(|: | - | / )", 1)
    english = lines.where("language = 'en'")
    bound = english.where("bound is not null").select("work", keys.compact_key(searchable(F.col("name"))).alias("key"), "bound").groupBy("work", "key").agg(F.count_distinct("bound").alias("n"), F.min("bound").alias("id"))
    open_ = english.where("bound is null").withColumn("key", F.nullif(keys.compact_key(cut_at), F.lit("")))
    j = open_.join(bound, ["work", "key"], "left")
    parent = j.where("n = 1").select("line", "id", F.lit("parent").alias("via"))
    rest = j.where(F.col("n").isNull() & F.col("medium").isin(*NOVELS)).join(seen, "line", "left_anti").join(adapted, "line").select("line", adapted["id"], F.lit("medium").alias("via"))
    return parent.unionAll(rest)
