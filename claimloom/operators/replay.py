"""Replays that run what they judge: the lookup of a library's series, its coverage as bitmaps, and equality of two implementations' rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import keys
from claimloom.session import cut, release

#: Volume numbers are placed in bitmaps in tenths.
TENTHS = 10


def ranking_new(comic: Column, exact: Column, s: dict[str, Column]) -> list[Column]:
    """Order of English candidates: comics first, then exact names, no omnibus, more dated volumes, more volumes, smaller id."""
    return [~comic, ~exact, s["is_omnibus"], -s["dated_count"], -s["volume_count"], s["id"]]


def pick_series(entries: DataFrame, series: DataFrame, aliases: DataFrame) -> DataFrame:
    """(entry, line, query, by) of entries that a line answers: each name in order, then what stands behind its last colon or comma, if that has three words.

    entries: entry, names (array, in order), novel (it sees novels only); series: id, name, language, medium, is_omnibus, dated_count, volume_count; aliases: id, alias.
    """
    named = entries.select("entry", "novel", F.posexplode("names").alias("i", "query")).where("query is not null")
    tail = lambda sep: F.trim(F.regexp_replace(F.substring_index("query", sep, -1), "[-–]+\\s*$", ""))
    tails = named.select("entry", "novel", "i", F.posexplode(F.array(*[F.when(F.contains("query", F.lit(sep)), tail(sep)) for sep in (":", ",")])).alias("j", "query"))
    tails = tails.where(F.size(F.split(keys.ascii_key(F.col("query")), " ")) >= 3)
    every = named.select("entry", "novel", F.struct(F.lit(0).alias("a"), F.col("i").alias("b"), F.lit(0).alias("c")).alias("turn"), "query")
    every = every.unionAll(tails.select("entry", "novel", F.struct(F.lit(1).alias("a"), F.col("i").alias("b"), F.col("j").alias("c")).alias("turn"), "query"))
    index = series.select(F.lower("name").alias("low"), "id").unionAll(aliases.select(F.lower("alias").alias("low"), "id")).distinct()
    # A query is looked up once, whoever asks.
    asked = every.select("query").distinct().withColumn("low", F.lower("query")).join(index, "low").select("query", "id").join(series.where("language = 'en'"), "id")
    comic = ~F.coalesce(F.col("medium").isin("novel", "light_novel"), F.lit(False))
    exact = keys.ascii_key(F.col("name")) == keys.ascii_key(F.col("query"))
    order = F.struct(*ranking_new(comic, exact, {c: F.col(c) for c in series.columns}))
    best = asked.groupBy("query").agg(F.min_by("id", order).alias("any"), F.min_by("id", F.when(~comic, order)).alias("prose"))
    hit = every.join(best, "query").withColumn("line", F.when(F.col("novel"), F.col("prose")).otherwise(F.col("any"))).where("line is not null")
    first = hit.groupBy("entry").agg(F.min_by(F.struct("line", "query", F.when(F.col("turn.a") == 0, "name").otherwise("tail").alias("by")), "turn").alias("h"))
    return first.select("entry", "h.*")


def number_sets(rows: DataFrame, owner: str, number: str) -> DataFrame:
    """(owner, bucket, numbers): each owner's numbers as bitmaps of 64 bits, partly built before the shuffle.

    An owner holds few numbers: Spark's own bitmaps are 4 KB each, whatever they hold.
    """
    at = (F.col(number) * TENTHS).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    return rows.where(F.col(number) >= 0).groupBy(owner, F.shiftright(at, 6).alias("bucket")).agg(F.bit_or(bit).alias("numbers"))


def coverage(picks: DataFrame, owned: DataFrame, volumes: DataFrame, today: str) -> DataFrame:
    """(entry, line, owned, missing, beyond, past, covered): what a library owns against what the picked line has.

    picks: entry, line; owned: entry, number; volumes: line, number, date. A set lacks as many numbers of another as their union is larger than it, so
    only bitmaps meet; beyond and past count the line's volumes behind the last one owned, and those of them that are out.
    """
    own = number_sets(owned, "entry", "number")
    wanted = picks.join(own, "entry", "left").select("entry", "line", F.coalesce("bucket", F.lit(0)).alias("bucket"), "numbers")
    have = number_sets(volumes.join(picks.select("line").distinct(), "line", "left_semi"), "line", "number")
    sides = wanted.select("entry", "line", "bucket", "numbers", F.lit(True).alias("mine")).unionAll(wanted.join(have.withColumnRenamed("numbers", "h"), ["line", "bucket"]).select("entry", "line", "bucket", "h", F.lit(False)))
    n = lambda c: F.coalesce(F.bit_count(c), F.lit(0))
    union = sides.groupBy("entry", "line", "bucket").agg(F.bit_or("numbers").alias("all"), F.bit_or(F.when(F.col("mine"), F.col("numbers"))).alias("own"), F.bit_or(F.when(~F.col("mine"), F.col("numbers"))).alias("has"))
    counted = union.groupBy("entry", "line").agg(F.sum(n(F.col("own"))).alias("owned"), F.sum(n(F.col("all")) - n(F.col("has"))).alias("missing"))
    last = picks.join(owned.groupBy("entry").agg(F.max("number").alias("last")), "entry", "left").fillna(0, ["last"])
    later = last.join(volumes, "line").where("number > last").groupBy("entry").agg(F.count("*").alias("beyond"), F.count_if(F.col("date") <= today).alias("past"))
    out = counted.join(later, "entry", "left").fillna(0, ["beyond", "past"])
    return out.select("entry", "line", "owned", "missing", "beyond", "past", (F.col("missing") == 0).alias("covered"))


def lacking(picks: DataFrame, owned: DataFrame, volumes: DataFrame, report: DataFrame) -> DataFrame:
    """(entry, number): the numbers that lines lack, looked up only for entries that the report finds uncovered."""
    bad = report.where("not covered").select("entry", "line")
    return bad.join(owned, "entry").join(volumes.select("line", "number"), ["line", "number"], "left_anti").select("entry", "number").distinct()


def _digests(rows: DataFrame, columns: list[str], bits: int, among: DataFrame | None) -> DataFrame:
    """(range, n, total, mixed) of ranges of hashed keys: sums and xors of row hashes, which no order changes."""
    flags = [F.col(c).isNull() for c in columns]
    keyed = rows.withColumn("_range", F.shiftrightunsigned("_hash", 64 - bits))
    if among is not None:
        keyed = keyed.join(F.broadcast(among), F.shiftrightunsigned("_range", 8) == F.col("_parent"), "left_semi")
    h = F.xxhash64(*columns, *flags)
    return keyed.groupBy("_range").agg(F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64(F.lit(1), *reversed(columns), *flags)).alias("mixed"))


def differing_rows(a: DataFrame, b: DataFrame, key: list[str], most: int = 10_000, levels: int = 4) -> tuple[DataFrame, DataFrame]:
    """(differences, report): rows that only one of two tables has, as often as it has them more; equal tables shuffle nothing but digests.

    Both tables fall into 256 ranges of hashed keys. Ranges whose digests (count, sum and xor of row hashes) agree are equal; those that differ are
    parted into 256 again until they hold at most `most` rows, and only their rows are compared. differences: side ('a' or 'b') and the columns;
    report: level, ranges, differing, rows in these.
    """
    spark, columns = a.sparkSession, sorted(a.columns)
    if columns != sorted(b.columns):
        raise ValueError(f"{columns} are not {sorted(b.columns)}")
    known = [F.col(k).isNull() for k in key]
    sides = [cut(x.select(*columns).withColumn("_hash", F.xxhash64(*key, *known))) for x in (a, b)]
    among, steps = None, []
    for level in range(1, levels + 1):
        one, two = (_digests(x, columns, 8 * level, among) for x in sides)
        both = one.join(two.select("_range", F.col("n").alias("m"), F.col("total").alias("t"), F.col("mixed").alias("x")), "_range", "full")
        same = F.col("n").eqNullSafe(F.col("m")) & F.col("total").eqNullSafe(F.col("t")) & F.col("mixed").eqNullSafe(F.col("x"))
        both = cut(both.select("_range", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("rows"), same.alias("same")))
        s = both.agg(F.count("*").alias("ranges"), F.count_if(~F.col("same")).alias("differing"), F.coalesce(F.sum(F.when(~F.col("same"), F.col("rows"))), F.lit(0)).alias("rows")).first()
        steps.append((level, s.ranges, s.differing, s.rows))
        bad = both.where("not same").select(F.col("_range").alias("_parent"))
        if s.rows <= most or level == levels or s.differing > 4096:  # a bounded list of ranges is what is broadcast
            break
        among = bad
    rows = [x.withColumn("_range", F.shiftrightunsigned("_hash", 64 - 8 * level)).join(bad.withColumnRenamed("_parent", "_range"), "_range", "left_semi").select(*columns) for x in sides]
    only = lambda x, y, side: x.exceptAll(y).select(F.lit(side).alias("side"), *columns)
    differences = cut(only(rows[0], rows[1], "a").unionAll(only(rows[1], rows[0], "b")))
    release(*sides)
    return differences, spark.createDataFrame(steps, "level int, ranges long, differing long, rows long")
