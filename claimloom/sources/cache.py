"""Reading remote sets through caches: what to fetch, in which batches and pages, and what to make of what came back.

No client is included: requests and their answers are tables, so every rule about them (age, retries, stops, completeness) is a plan over
tables that a fetching job reads and writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import dealt


def to_fetch(wanted: DataFrame, cache: DataFrame, key: str, max_age: int, negative_age: int, fresh: bool = False) -> DataFrame:
    """(key, reason) of wanted keys whose cached answer (age in days, found) is absent, too old or forced; 'nothing there' may be older."""
    c = cache.groupBy(key).agg(F.min("age").alias("age"), F.max("found").alias("found"))
    j = wanted.select(key).distinct().join(c, key, "left")
    limit = F.when(F.col("found"), max_age).otherwise(negative_age)
    reason = F.when(F.col("age").isNull(), "absent").when(F.lit(fresh), "forced").when(F.col("age") > limit, "stale")
    return j.select(key, reason.alias("reason")).where("reason is not null")


def batches(keys: DataFrame, key: str, size: int) -> DataFrame:
    """Keys with the batch each is asked for in: at most `size` a batch, dealt by the key's hash, so batches are made without one global order."""
    n = keys.count()
    buckets = max(1, -(-n // max(1, size // 2)))
    dealt = keys.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(key)) - 1
    return dealt.select(key, "bucket", F.floor(place / size).cast("int").alias("part"))


def answered(wanted: DataFrame, normalised: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """(key, answer): a wanted key's answer through the server's own spelling of it (normalised: key, to; answers: to, answer)."""
    n = wanted.select(key).distinct().join(normalised.select(key, "to"), key, "left").withColumn("to", F.coalesce("to", key))
    return n.join(answers.select("to", "answer"), "to", "left").select(key, "answer")


def best_article(queries: DataFrame, pages: DataFrame) -> DataFrame:
    """(q, page, score) of the page that holds every word of a query, most of its own words asked for, then the smallest page id.

    queries: q, words (array); pages: page, words (array). Candidates are met by the query's longest word. Pages of the same words
    are one candidate, and of those with as many words only the smallest id is kept, so no list of candidates is sorted.
    """
    pivot = F.reduce("words", F.lit(""), lambda a, w: F.when((F.length(w) > F.length(a)) | ((F.length(w) == F.length(a)) & (w < a)), w).otherwise(a))
    q = queries.select("q", F.col("words").alias("want"), pivot.alias("word"))
    kinds = dealt(pages, "page").groupBy(F.array_sort(F.array_distinct("words")).alias("got")).agg(F.min("page").alias("page"))
    met = q.join(kinds.select("page", "got", F.explode("got").alias("word")), "word").where(F.size(F.array_except("want", "got")) == 0)
    least = met.groupBy("q", F.size("got").alias("n"), F.size(F.array_distinct("want")).alias("asked")).agg(F.min("page").alias("page"))
    best = least.groupBy("q").agg(F.min(F.struct("n", "page", (F.col("asked") / F.col("n")).alias("score"))).alias("b"))
    return best.select("q", "b.page", "b.score")


def request_fates(log: DataFrame, retries: int = 3, stop_after: int = 3) -> DataFrame:
    """A log of requests (source, seq, url, status) with what became of each: ok, retry, gave_up, or not_sent once a source refused too often in a row.

    A refusal is 403 or 429. Once a source has stopped it stays stopped.
    """
    refused = F.col("status").isin(403, 429)
    w = Window.partitionBy("source").orderBy("seq")
    marked = log.withColumn("refused", refused).withColumn("island", F.sum((~refused).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    streak = F.sum(F.col("refused").cast("int")).over(Window.partitionBy("source", "island").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
    counted = marked.withColumn("streak", streak)
    before = F.max(F.col("streak") >= stop_after).over(w.rowsBetween(Window.unboundedPreceding, -1))
    tries = F.row_number().over(Window.partitionBy("source", "url").orderBy("seq"))
    fate = F.when(F.coalesce(before, F.lit(False)), "not_sent").when(F.col("status") == 200, "ok").when(tries >= retries, "gave_up").otherwise("retry")
    return counted.select("source", "seq", "url", "status", fate.alias("fate"))


def whole_sets(pages: DataFrame, totals: DataFrame, previous: DataFrame, key: str = "query") -> DataFrame:
    """Result sets all or nothing: a query's new rows where as many different ones came as were announced, else its previous rows, marked degraded.

    pages: query, id; totals: query, total; previous: query, id.
    """
    got = pages.select(key, "id").distinct()
    n = got.groupBy(key).agg(F.count("*").alias("n"))
    good = totals.join(n, key, "left").withColumn("whole", F.coalesce(F.col("n"), F.lit(0)) == F.col("total"))
    new = got.join(good.where("whole").select(key), key, "left_semi").withColumn("degraded", F.lit(False))
    old = previous.select(key, "id").join(good.where("not whole").select(key), key, "left_semi").withColumn("degraded", F.lit(True))
    return new.unionByName(old)


def page_ladder(slices: DataFrame, fails_above: Column, sizes: tuple[int, ...] = (100, 50, 25)) -> DataFrame:
    """Slices with the page size that works for them, or null where even the smallest fails and the slice must be cut by key prefix."""
    fits = [F.when(F.lit(s) <= fails_above, F.lit(s)) for s in sizes]
    return slices.withColumn("page_size", F.coalesce(*fits)).withColumn("pages", F.ceil(F.col("total") / F.col("page_size")))


def halved(batch: DataFrame, key: str, bad: Column) -> DataFrame:
    """(key, calls, ok): a batch that fails is halved until what fails is one key; calls counts the requests that a key was part of.

    batch: batch, place (from 0), size (a power of two), key. Every enclosing half of a bad key fails.
    """
    levels = 8
    out = batch.withColumn("bad", bad)
    for i in range(levels):
        half = Window.partitionBy("batch", F.shiftrightunsigned(F.col("place"), levels - i))
        out = out.withColumn(f"f{i}", F.max("bad").over(half) & (F.lit(1 << (levels - i)) <= F.col("size")))
    calls = sum((F.col(f"f{i}").cast("int") for i in range(levels)), F.lit(1))
    return out.select("batch", key, calls.alias("calls"), (~F.col("bad")).alias("ok"))


def channel_union(channels: list[tuple[str, DataFrame]], key: str) -> tuple[DataFrame, DataFrame]:
    """(rows, report): all channels' rows, the first channel's record of a key winning, and each channel's rows, new keys and repeats."""
    every = None
    for i, (name, df) in enumerate(channels):
        one = df.withColumn("channel", F.lit(name)).withColumn("rank", F.lit(i))
        every = one if every is None else every.unionByName(one, allowMissingColumns=True)
    place = every.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("rank")))
    report = place.groupBy("channel").agg(F.count("*").alias("rows"), F.count_if(F.col("n") == 1).alias("new_keys"))
    return place.where("n = 1").drop("n", "rank"), report
