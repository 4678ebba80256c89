"""Identity: which rows are one thing, which id they keep, and where an old id went."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.graph import connected_components
from claimloom.session import cut, dealt, release


def probed_ints(names: DataFrame, column: str, bits: int = 31, max_rounds: int = 64) -> DataFrame:
    """(column, id): the lowest bits of a name's hash; of equal ids the first name keeps it, the others are salted again.

    Which id a name gets follows from the names alone, not from their order in the table.
    """
    def hashed(salt: Column) -> Column:
        text = F.when(salt == 0, F.col(column)).otherwise(F.concat(column, F.lit("#"), salt.cast("string")))
        return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint").bitwiseAND((1 << bits) - 1)

    open_, done = names.select(column).distinct(), None
    for salt in range(max_rounds):
        tried = open_.withColumn("id", hashed(F.lit(salt)))
        if done is not None:
            tried = tried.join(done.select("id", F.lit(True).alias("taken")), "id", "left")
        else:
            tried = tried.withColumn("taken", F.lit(None).cast("boolean"))
        first = F.row_number().over(Window.partitionBy("id").orderBy(column)) == 1
        state = cut(tried.withColumn("won", F.col("taken").isNull() & first).select(column, "id", "won"))
        new = state.where("won").select(column, "id")
        done = new if done is None else done.unionAll(new)
        open_ = state.where("not won").select(column)
        if open_.isEmpty():
            return done
    raise RuntimeError(f"names still clash after {max_rounds} salts")


def shared_key_clusters(rows: DataFrame, row: str, keys: Column, joins: DataFrame | None = None) -> DataFrame:
    """(row, component): rows that share any of their keys, or that joins (a, b) force together; components are named by their smallest row.

    Rows are linked to the smallest row of each key, so a frequent key gives no pairs.
    """
    each = rows.select(row, F.explode(keys).alias("key")).distinct()
    heads = each.groupBy("key").agg(F.min(row).alias("head"))
    links = each.join(heads, "key").select(F.col("head").alias("src"), F.col(row).alias("dst"))
    links = links.unionAll(rows.select(F.col(row), F.col(row)))
    if joins is not None:
        links = links.unionAll(joins.select("a", "b"))
    return connected_components(links).withColumnRenamed("node", row)


def twins(rows: DataFrame) -> DataFrame:
    """(id, component) of records that are one physical volume: rows id, isbn, number, parent, title.

    A shared ISBN joins nothing if it stands on records with different numbers (a box), or on a member of another set than its
    first record's under another title (a collision).
    """
    one = rows.where("isbn is not null")
    first = one.groupBy("isbn").agg(F.min_by(F.struct("parent", "title"), "id").alias("f"), F.count_distinct("number").alias("numbers"), F.min("id").alias("head"))
    met = one.join(first, "isbn")
    strange = F.col("parent").isNotNull() & F.col("f.parent").isNotNull() & (F.col("parent") != F.col("f.parent")) & (F.col("title") != F.col("f.title"))
    bad = met.groupBy("isbn").agg(F.bool_or((F.col("numbers") > 1) | F.coalesce(strange, F.lit(False))).alias("bad")).where("bad").select("isbn")
    links = met.join(bad, "isbn", "left_anti").select(F.col("head").alias("src"), F.col("id").alias("dst"))
    return connected_components(links.unionAll(rows.select("id", "id"))).withColumnRenamed("node", "id")


class _Lines:
    """The lines of one signature so far: their numbers as bits, and of the lines that hold the same numbers the first on top of a heap."""

    def __init__(self) -> None:
        self.heads: list[object] = []
        self.held: list[int] = []
        self.alike: dict[int, list[int]] = {}
        self.bit: dict[object, int] = {}

    def place(self, set_id: object, numbers: list) -> object:
        own = 0
        for n in set(numbers):
            own |= 1 << self.bit.setdefault(n, len(self.bit))
        size = own.bit_count()

        def fits(held: int) -> bool:
            # Nothing shared, or one number where both sides have three at least.
            shared = (held & own).bit_count()
            return shared == 0 or (shared == 1 and min(size, held.bit_count()) >= 3)

        # Where lines hold the same numbers, only the first of each kind is looked at.
        if 2 * len(self.alike) < len(self.heads):
            at = min((lines[0] for held, lines in self.alike.items() if fits(held)), default=len(self.heads))
        else:
            at = next((i for i, held in enumerate(self.held) if fits(held)), len(self.heads))
        if at == len(self.heads):
            self.heads.append(set_id)
            self.held.append(0)
            self.alike.setdefault(0, [])
            heapq.heappush(self.alike[0], at)
        before, now = self.held[at], self.held[at] | own
        if now != before:
            lines = self.alike[before]
            if lines[0] == at:
                heapq.heappop(lines)
            else:
                lines.remove(at)
                heapq.heapify(lines)
            if not lines:
                del self.alike[before]
            heapq.heappush(self.alike.setdefault(now, []), at)
            self.held[at] = now
        return self.heads[at]


def merge_disjoint(sets: DataFrame) -> DataFrame:
    """(signature, set_id, line): sets of one signature merge while their numbers stay disjoint, or share one number between sets of three or more.

    sets: signature, set_id, numbers (array). Each set joins the first line that it fits, in the order of ids. Sets stream through in that order: a task
    keeps the numbers of a signature's lines as bits, never its sets, and where many lines hold the same numbers a set looks at one of each kind.
    """
    kind = {f.name: f.dataType.simpleString() for f in sets.schema}

    def run(batches):
        import pyarrow as pa

        now, lines = object(), _Lines()
        for batch in batches:
            heads = []
            for signature, set_id, numbers in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if signature != now:
                    now, lines = signature, _Lines()
                heads.append(lines.place(set_id, numbers or []))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(heads, batch.column(1).type)], names=["signature", "set_id", "line"])

    ordered = dealt(sets.select("signature", "set_id", "numbers"), "signature").sortWithinPartitions("signature", "set_id")
    return ordered.mapInArrow(run, f"signature {kind['signature']}, set_id {kind['set_id']}, line {kind['set_id']}")


def split_sections(rows: DataFrame) -> DataFrame:
    """rows id, parent, section, number with `line`: where a set's sections repeat numbers, each section is a line of its own."""
    several = rows.where("number is not null").groupBy("parent", "number").agg(F.count_distinct(F.coalesce("section", F.lit(""))).alias("n"))
    clash = several.groupBy("parent").agg((F.max("n") > 1).alias("clash"))
    own = F.coalesce("clash", F.lit(False)) & (F.coalesce("section", F.lit("")) != "")
    return rows.join(clash, "parent", "left").withColumn("line", F.when(own, F.concat_ws("#", "parent", "section")).otherwise(F.col("parent").cast("string"))).drop("clash")


def winner(votes: DataFrame, key: str, candidate: str, new: Column) -> DataFrame:
    """(key, winner, ambiguous) of votes (key, candidate, shared, n): a strict majority and the most; of equals the only new one, else none.

    `new` says of a row whether its candidate is new in this build.
    """
    fits = votes.where("2 * shared > n")
    top = fits.groupBy(key).agg(F.max("shared").alias("top"))
    tied = fits.join(top, key).where("shared = top").withColumn("fresh", new)
    each = tied.groupBy(key).agg(F.count("*").alias("ties"), F.count_if("fresh").alias("fresh"), F.min(candidate).alias("one"), F.min(F.when(F.col("fresh"), F.col(candidate))).alias("new_one"))
    won = F.when(F.col("ties") == 1, F.col("one")).when(F.col("fresh") == 1, F.col("new_one"))
    return each.select(key, won.alias("winner"), won.isNull().alias("ambiguous"))


def line_ids(built: DataFrame, carried: DataFrame, minted: Column) -> DataFrame:
    """(key, id, via) of built lines: the id its own key mints if that is carried, else a carried id it has evidence for, else the minted one.

    built: key, isbns (array), name, publisher; carried: id, isbns, name, publisher. Evidence: two shared ISBNs, or one and the name and publisher.
    A carried id goes to the line that shares most with it, then the smallest key; of several ids a line takes the smallest.
    """
    b = built.withColumn("own", minted)
    kept = b.join(carried.select(F.col("id").alias("own")), "own", "left_semi").select("key", F.col("own").alias("id"), F.lit("continuity").alias("via"))
    rest = b.join(kept.select("key"), "key", "left_anti")
    free = carried.join(kept.select("id"), "id", "left_anti")
    x = rest.select("key", "name", "publisher", F.explode("isbns").alias("isbn")).distinct()
    y = free.select("id", F.col("name").alias("name2"), F.col("publisher").alias("publisher2"), F.explode("isbns").alias("isbn")).distinct()
    met = x.join(y, "isbn").groupBy("key", "id").agg(F.count("*").alias("shared"), F.bool_or((F.col("name") == F.col("name2")) & (F.col("publisher") == F.col("publisher2"))).alias("same"))
    met = met.where((F.col("shared") >= 2) | F.col("same"))
    best = met.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("shared"), "key"))).where("r = 1")
    taken = best.groupBy("key").agg(F.min("id").alias("id")).withColumn("via", F.lit("lookup"))
    other = rest.join(taken.select("key"), "key", "left_anti").select("key", F.col("own").alias("id"), F.lit("minted").alias("via"))
    return kept.unionByName(taken).unionByName(other)


def same_edition(a: Column, b: Column, dated_a: Column, dated_b: Column) -> Column:
    """Evidence that two lines are one edition: shared ISBNs if a strict majority of the smaller side; without ISBNs shared dated volumes, two at least."""
    shared, dated = F.size(F.array_intersect(a, b)), F.size(F.array_intersect(dated_a, dated_b))
    fewer = F.least(F.size(dated_a), F.size(dated_b))
    by_isbn = F.when(shared * 2 > F.least(F.size(a), F.size(b)), shared).otherwise(0)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), by_isbn).when((fewer >= 2) & (dated * 2 > fewer), dated).otherwise(0)


def settle(rows: DataFrame, guard, max_rounds: int = 5) -> DataFrame:
    """Applies a guard (rows -> rows) until it changes nothing; an error if that takes more than so many passes."""
    state = cut(rows)
    for _ in range(max_rounds):
        new = cut(guard(state))
        changed = not new.exceptAll(state).isEmpty()
        release(state)
        state = new
        if not changed:
            return state
    raise RuntimeError(f"guards did not settle in {max_rounds} passes")
