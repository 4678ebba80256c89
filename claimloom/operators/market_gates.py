"""The rules of a market's gate: what a library's source may claim, which lines may ship, which works a build may make.

Each function reads each of its tables once for all rules and gives (rule, n): how many rows break it. All but `flood` and `precision` must be 0;
these two give 1 where a bound is passed.

claims: entity_id, field, value, source, licence, source_url. volumes: volume, line, isbn, date (text cut to its precision), date_type, future (from an
announcement of a later year). lines: line, key, market, medium, work, name, role, tier, via, exported, is_main, link_work, truth_work, explicit,
cluster, carried. before: line, is_main, isbns (array) of lines that were published.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = ("title", "isbn13", "page_count", "release_date", "projected_date", "publisher")
SHIPPED, DEMOTED = ("merged", "sibling", "kept"), ("held", "review", "unlinked")
COMIC = ("comic", "manhwa", "manhua", "webtoon")
YEAR, MONTH = "^[12][0-9]{3}$", "^[12][0-9]{3}-[01][0-9]$"


@F.pandas_udf(T.BooleanType())
def composed(names):
    """Whether a string is in composed form (NFC)."""
    import unicodedata

    return names.map(lambda s: s is None or unicodedata.is_normalized("NFC", s))


def _tall(one: DataFrame) -> DataFrame:
    return one.unpivot([], one.columns, "rule", "n")


def _count(rules: dict[str, Column]) -> list[Column]:
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in rules.items()]


def _rows(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n")


def claim_rules(claims: DataFrame, source: str, licence: str, url: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """What a source's claims may be: licensed, with the url of their record, bibliographic, published years, projected months."""
    field, value = F.col("field"), F.coalesce("value", F.lit(""))
    return _tall(claims.where(F.col("source") == source).agg(*_count({
        "claim not licensed": ~F.col("licence").eqNullSafe(F.lit(licence)),
        "claim without a record": ~F.startswith(F.coalesce("source_url", F.lit("")), F.lit(url)),
        "claim of another field": ~field.isin(*fields),
        "published date not a year": (field == "release_date") & ~value.rlike(YEAR),
        "projected date not a month": (field == "projected_date") & ~value.rlike(MONTH),
    })))


def volume_rules(volumes: DataFrame, claims: DataFrame, lines: DataFrame, market: str, base: str, today: str) -> DataFrame:
    """What dates and ISBNs of volumes may be. today: a date, YYYY-MM-DD; base: the source whose own repeats of an ISBN are its own affair."""
    projected = F.col("date_type") == "projected"
    late = F.date_format(F.add_months(F.to_date(F.lit(today)), -12), "yyyy-MM")
    own = _tall(volumes.agg(*_count({
        "projected long ago": projected & (F.col("date") < late), "projected not to the month": projected & ~F.coalesce("date", F.lit("")).rlike(MONTH),
        "type without a date, or a date without": F.col("date_type").isNull() != F.col("date").isNull(), "volume of a later year's announcement": F.col("future"),
    })))
    dated = claims.where("field = 'release_date'").select(F.col("entity_id").alias("volume")).distinct()
    outranked = volumes.where(projected).join(dated, "volume", "left_semi")
    told = claims.where((F.col("field") == "isbn13") & (F.col("source") == base)).select(F.col("entity_id").alias("volume"), F.col("value").alias("isbn"), F.lit(True).alias("told")).distinct()
    here = volumes.where("isbn is not null").join(lines.where(F.col("market") == market).select("line"), "line", "left_semi").join(told, ["volume", "isbn"], "left")
    twice = here.groupBy("line", "isbn").agg(F.count("*").alias("n"), F.count_if(F.col("told").isNull()).alias("added")).where("n > 1 and added > 0")
    return own.unionAll(_rows("projected although published", outranked)).unionAll(_rows("isbn twice in a line", twice))


def line_rules(lines: DataFrame, volumes: DataFrame, before: DataFrame, must_not: DataFrame, labels: DataFrame, least: float = 0.95) -> DataFrame:
    """What lines may ship, and whether lines of before are whole. must_not: key, wrong_work; labels: key, expected_work (hand-made)."""
    linked = F.col("tier").isin("high", "medium")
    ships = F.col("role").isin(*SHIPPED) | (F.col("role") == "linked") & (linked | (F.col("via") == "correction"))
    own = _tall(lines.agg(*_count({
        "shipped against the policy": F.col("exported") & ~F.coalesce(ships, F.lit(False)), "linked against the truth": linked & (F.col("link_work") != F.col("truth_work")),
        "published line demoted": F.col("carried") & ~F.col("exported") & F.col("role").isin(*DEMOTED), "name not composed": ~composed("name"),
    })))
    now = lines.where("exported").select("line", F.col("is_main").alias("main_now"))
    gone = before.join(now, "line", "left_anti")
    b = before.join(now, "line")
    lost = b.select("line", F.explode("isbns").alias("isbn")).join(volumes.select("line", "isbn").distinct(), ["line", "isbn"], "left_anti").select("line").distinct()
    lesser = b.where("is_main <> main_now").select("line").union(lost).distinct()
    wrong = lines.join(must_not, "key").where((linked | F.col("exported")) & ((F.col("link_work") == F.col("wrong_work")) | (F.col("work") == F.col("wrong_work"))))
    judged = lines.where(linked).join(labels, "key").agg(F.count("*").alias("n"), F.count_if(F.col("link_work").eqNullSafe(F.col("expected_work"))).alias("right"))
    precise = judged.select(F.lit("precision").alias("rule"), F.when((F.col("n") > 0) & (F.col("right") < least * F.col("n")), 1).otherwise(0).cast("long").alias("n"))
    parts = [own, _rows("published line gone", gone), _rows("published line lost its place or an isbn", lesser), _rows("linked to a work known as wrong", wrong.select("key").distinct()), precise]
    return reduce(DataFrame.unionAll, parts)


def record_rules(claims: DataFrame, records: DataFrame, source: str) -> DataFrame:
    """Claims by the record that they cite. records: source_url, authority (made by the source itself), set_record, level (of encoding)."""
    mine = claims.where(F.col("source") == source).join(records, "source_url", "left")
    return _tall(mine.agg(*_count({
        "claim of no record of its own": ~F.coalesce("authority", F.lit(False)), "date of a set": F.col("field").isin("release_date", "projected_date") & F.col("set_record"),
        "published date of a planned record": (F.col("field") == "release_date") & F.col("level").isin("5", "8"),
    })))


def created_rules(created: DataFrame, lines: DataFrame, home: str, before_works: DataFrame, before_lines: DataFrame, redirects: DataFrame, flood: int = 25) -> DataFrame:
    """Works that a build makes. created: work; before_works: work, before_lines: line, redirects: old (what was published, and where ids went on)."""
    shown = lines.where("exported")
    explicit = lines.where("explicit").select("cluster").distinct()
    backed = shown.join(explicit, "cluster", "left_semi").select("work").union(shown.where("explicit").select("work")).distinct()
    drawn = shown.where(F.col("medium").isin(*COMIC)).select("work").distinct()
    at_home = shown.where((F.col("market") == home) & ~F.coalesce(F.col("medium").isin("manhwa", "manhua", "webtoon"), F.lit(False))).select("work").distinct()
    gone = before_lines.join(shown.select("line"), "line", "left_anti").join(redirects.select(F.col("old").alias("line")), "line", "left_anti")
    fresh = created.join(before_works, "work", "left_anti").select("work").distinct().agg(F.count("*").alias("n"))
    return reduce(DataFrame.unionAll, [
        _rows("made without explicit origin", created.join(backed, "work", "left_anti")), _rows("made without a comic", created.join(drawn, "work", "left_anti")),
        _rows("made beside a line of the home market", created.join(at_home, "work", "left_semi")), _rows("published line gone", gone),
        _rows("novel in a work without a comic", shown.where("medium = 'novel'").join(drawn, "work", "left_anti")),
        fresh.select(F.lit("flood").alias("rule"), F.when(F.col("n") > flood, 1).otherwise(0).cast("long").alias("n")),
    ])


def moved_isbns(carried: DataFrame, volumes: DataFrame) -> DataFrame:
    """(volume, isbn, now): volumes of before (volume, isbn) that are here without their ISBN while another volume has it."""
    here = volumes.select("volume", F.col("isbn").alias("own"))
    bare = carried.join(here, "volume").where(~F.col("own").eqNullSafe(F.col("isbn")))
    other = volumes.where("isbn is not null").groupBy("isbn").agg(F.min("volume").alias("now"))
    return bare.join(other, "isbn").select("volume", "isbn", "now")


def gate_lists(takes: DataFrame, confirmed: DataFrame, skipped: DataFrame) -> DataFrame:
    """(list, item): what a reviewer must see: ids taken without a strict majority of ISBNs and not confirmed, and corrections that could not act.

    takes: key, id, shared, mine, theirs; confirmed: key, id; skipped: key, shape.
    """
    weak = takes.where("not (2 * shared > least(mine, theirs)) and least(mine, theirs) > 0").join(confirmed, ["key", "id"], "left_anti")
    return weak.select(F.lit("taken_weak").alias("list"), F.concat_ws(":", "key", "id").alias("item")).unionAll(skipped.select(F.lit("corrections_skipped"), F.concat_ws(":", "shape", "key")))
