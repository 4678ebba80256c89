"""Claims: every source's assertion about (entity, entity_id, field), and their resolution to one value.

One grouped pass decides each field. A group holds one claim a source, so what is collected is
bounded by the number of sources, never by the corpus. Overrides are joined on the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["entity", "entity_id", "field"]
WEEK_DAYS, MINOR_DAYS = 42, 7


def licensed(claims: DataFrame, licences: list[str]) -> DataFrame:
    return claims.where(F.col("licence").isin(licences))


def ranked(source: Column, order: list[str]) -> Column:
    """Rank of a source in an order of precedence; unknown ones come last."""
    out = F.lit(99)
    for i, s in reversed(list(enumerate(order))):
        out = F.when(source == s, i).otherwise(out)
    return out


def day_offsets(dates: Column) -> Column:
    """Day distances of all pairs of different values among full dates; others are left out."""
    days = F.filter(F.transform(F.array_distinct(dates), lambda d: F.when(F.length(d) == 10, F.unix_date(d.try_cast("date")))), lambda x: x.isNotNull())
    pairs = F.flatten(F.transform(days, lambda a: F.transform(days, lambda b: F.abs(a - b))))
    return F.array_distinct(F.filter(pairs, lambda x: x > 0))


def date_basis(values: Column) -> Column:
    """Why several different partial dates of a field agree or don't."""
    least = F.array_min(F.transform(values, F.length))
    compatible = F.size(F.array_distinct(F.transform(values, lambda v: F.substring(v, F.lit(1), least)))) == 1
    full = F.size(F.filter(F.array_distinct(values), lambda v: (F.length(v) == 10) & v.try_cast("date").isNotNull()))
    offsets = day_offsets(values)
    weekly, most = F.forall(offsets, lambda o: o % 7 == 0), F.array_max(offsets)
    return (
        F.when(compatible, "agreed_coarse")
        .when(full < 2, "single_source")
        .when(weekly & (most <= WEEK_DAYS), "semantic_variance")
        .when(weekly, "escalated")
        .when(most <= MINOR_DAYS, "minor_variance")
        .otherwise("conflict")
    )


def resolve(claims: DataFrame, order: list[str], overrides: DataFrame | None = None, date_fields: str = "date$", year_sources: list[str] = ()) -> DataFrame:
    """One row per field: value, confidence, basis, n_agree, n_sources, notes.

    claims: entity, entity_id, field, value, source (one value a source and field); overrides: the key and value.
    """
    rows = claims.select(*KEY, "value", "source", ranked(F.col("source"), order).alias("r"))
    # Sources are counted in the collected list: a distinct aggregate beside it would shuffle every claim a second time.
    each = rows.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("r", "source", "value"))).alias("c"))
    each = each.withColumn("n_sources", F.size(F.array_distinct("c.source")))
    values = F.transform("c", lambda x: x.value)
    is_date = F.col("field").rlike(date_fields)
    each = each.withColumn("v", values).withColumn("one", F.size(F.array_distinct("v")) == 1)
    basis = F.when(F.col("one"), F.when(F.col("n_sources") > 1, "agreed").otherwise("single_source")).when(is_date, date_basis(F.col("v"))).otherwise("conflict")
    each = each.withColumn("basis", basis)
    finest = F.array_max(F.transform("v", F.length))
    longest = F.filter("c", lambda x: F.length(x.value) == finest)[0].value
    finer = F.filter("c", lambda x: F.length(x.value) > 4)
    bare = is_date & F.col("c")[0].source.isin(list(year_sources)) & (F.length(F.col("c")[0].value) == 4) & (F.size(finer) > 0)
    value = F.when(~F.col("one") & (F.col("basis") == "agreed_coarse"), longest).when(~F.col("one") & bare, F.get(finer, 0).value).otherwise(F.col("c")[0].value)
    each = each.withColumn("value", value)
    confidence = (
        F.when(F.col("basis") == "agreed", 0.97).when(F.col("basis") == "single_source", 0.70).when(F.col("basis") == "agreed_coarse", 0.90)
        .when(F.col("basis") == "semantic_variance", 0.88).when(F.col("basis") == "escalated", 0.40).when(F.col("basis") == "minor_variance", 0.65)
        .when(is_date, 0.30).otherwise(0.50)
    )
    notes = F.when(~F.col("one"), F.array_join(F.transform("c", lambda x: F.concat(x.source, F.lit("="), x.value)), " | "))
    agree = F.size(F.filter("v", lambda v: v == F.col("value")))
    out = each.select(*KEY, "value", confidence.alias("confidence"), "basis", agree.alias("n_agree"), F.col("n_sources").cast("int").alias("n_sources"), notes.alias("notes"))
    if overrides is None:
        return out
    pins = overrides.select(*KEY, F.col("value").alias("pin"), F.lit(True).alias("pinned"))
    p = F.coalesce("pinned", F.lit(False))
    return out.join(pins, KEY, "left").select(
        *KEY,
        F.when(p, F.col("pin")).otherwise(F.col("value")).alias("value"),
        F.when(p, 1.0).otherwise(F.col("confidence")).alias("confidence"),
        F.when(p, "manual_override").otherwise(F.col("basis")).alias("basis"),
        F.when(p, 1).otherwise(F.col("n_agree")).alias("n_agree"),
        F.when(p, 1).otherwise(F.col("n_sources")).alias("n_sources"),
        F.when(~p, F.col("notes")).alias("notes"),
    )


def first_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the first in order (insert-if-absent within a batch)."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def insert_absent(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    return old.unionByName(new.join(old.select(*key), key, "left_anti"))


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New rows displace old ones of the same key."""
    return new.unionByName(old.join(new.select(*key), key, "left_anti"))


def not_yet_claimed(entities: DataFrame, claims: DataFrame, source: str, key: str = "entity_id") -> DataFrame:
    """Entities that a source has not asserted anything about: the incremental scan."""
    return entities.join(claims.where(F.col("source") == source).select(key).distinct(), key, "left_anti")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, field: str) -> DataFrame:
    """key, old and new value, and added, removed, changed or same, with null-safe comparison."""
    a = old.select(F.col(key).alias("k"), F.col(field).alias("was"), F.lit(1).alias("o"))
    b = new.select(F.col(key).alias("k"), F.col(field).alias("now"), F.lit(1).alias("n"))
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("was").eqNullSafe(F.col("now")), "same").otherwise("changed")
    return a.join(b, "k", "full").select(F.col("k").alias(key), "was", "now", change.alias("change"))
