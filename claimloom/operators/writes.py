"""Keyed writes as pure functions of snapshots: loads, conditional updates, re-keying, adoption, merging and undoing.

Every function returns the new state of a table, so running a stage again gives the same rows, and undoing it is
dropping its source's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import keys


def load_records(records: DataFrame) -> dict[str, DataFrame]:
    """Nested records (title, medium, volumes of (number, isbn, day, contains)) as work, line, volume, claim and composition rows.

    Ids are hashes of natural keys and every table has one row a key, so loading the same records again adds nothing.
    """
    work = keys.natural_id("w_", F.col("title"))
    line = keys.natural_id("l_", F.col("title"), F.col("medium"))
    v = records.select(F.col("title"), "medium", work.alias("work"), line.alias("line"), F.explode("volumes").alias("v"))
    v = v.withColumn("volume", keys.natural_id("v_", F.col("line"), F.col("v.number").cast("string")))
    claim = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"v.{n}").cast("string").alias("value")) for n in ("isbn", "day")]))
    claims = v.select("volume", claim.alias("c")).where("c.value is not null").groupBy(F.col("volume").alias("entity_id"), "c.field").agg(F.min("c.value").alias("value"))
    return {
        "work": v.groupBy(F.col("work").alias("id")).agg(F.min("title").alias("title")),
        "line": v.groupBy(F.col("line").alias("id")).agg(F.min("work").alias("work"), F.min("medium").alias("medium")),
        "volume": v.groupBy(F.col("volume").alias("id")).agg(F.min("line").alias("line"), F.min("v.number").alias("number")),
        "claim": claims,
        "composition": v.select(F.col("volume").alias("id"), F.explode("v.contains").alias("part")).distinct(),
    }


def update_or_ignore(rows: DataFrame, key: list[str], moved: dict[str, Column], order: list[Column]) -> DataFrame:
    """Re-keys rows; where a moved row would clash with one that has the key already (or an earlier one), it goes."""
    own = F.struct(*[F.col(k) for k in key])
    out = rows.withColumn("__old", own).withColumns(moved)
    stays = (F.struct(*[F.col(k) for k in key]) == F.col("__old")).cast("int")
    w = Window.partitionBy(*key).orderBy(-stays, *order)
    return out.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__old")


def fill_empty(rows: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Empty columns take the other side's values; `filled` lists which did."""
    b = other.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns])
    both = rows.join(b, F.col(key) == F.col("__k"), "left")
    filled = F.array_compact(F.array(*[F.when(F.col(c).isNull() & F.col(f"__{c}").isNotNull(), F.lit(c)) for c in columns]))
    return both.select(*[c for c in rows.columns if c not in columns], *[F.coalesce(c, f"__{c}").alias(c) for c in columns], F.array_join(filled, ",").alias("filled"))


def fates(new: DataFrame, old: DataFrame, key: list[str], isbn: str) -> DataFrame:
    """What a load does with each volume: added, same, filled (the old one had no ISBN), clash (another ISBN) or repeated."""
    a = new.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(isbn)))
    b = old.groupBy(*key).agg(F.min(isbn).alias("__old"), F.lit(True).alias("__held"))
    x, y = F.col(isbn), F.col("__old")
    fate = F.when(F.col("__n") > 1, "repeated").when(F.col("__held").isNull(), "added").when(y.isNull() & x.isNotNull(), "filled").when(x.isNull() | (x == y), "same").otherwise("clash")
    return a.join(b, key, "left").withColumn("fate", fate).drop("__n", "__old", "__held")


def unload(rows: DataFrame, source: str) -> DataFrame:
    """The table as if a source's stage had never run."""
    return rows.where(~F.col("source").eqNullSafe(F.lit(source)))


def claim_upsert(old: DataFrame, new: DataFrame, key: list[str], owner: str) -> DataFrame:
    """New claims replace those of the same owner and add absent ones, but never displace another owner's row."""
    ranked = old.withColumn("__p", F.when(F.col("source") == owner, 2).otherwise(0)).unionByName(new.withColumn("__p", F.lit(1)))
    best = Window.partitionBy(*key).orderBy("__p", "source", "value")
    return ranked.withColumn("__n", F.row_number().over(best)).where("__n = 1").drop("__n", "__p")


def renamed_ids(rows: DataFrame, column: str, renames: DataFrame) -> DataFrame:
    """A referencing column under new ids (old_id, new_id)."""
    m = renames.select(F.col("old_id").alias("__o"), F.col("new_id").alias("__n"))
    return rows.join(m, F.col(column) == F.col("__o"), "left").withColumn(column, F.coalesce("__n", column)).drop("__o", "__n")


def merge_lines(volumes: DataFrame, merges: DataFrame, line: str = "line", number: str = "number") -> DataFrame:
    """Volumes of a merged line move to the line that is kept, unless that has the number: fate kept, moved or dropped.

    merges: old_id, new_id; of several moved volumes with one number the smallest id moves.
    """
    v = volumes.join(merges.select(F.col("old_id").alias(line), "new_id"), line, "left")
    target = F.coalesce("new_id", line)
    stays = F.col("new_id").isNull()
    w = Window.partitionBy(target, number).orderBy((~stays).cast("int"), "id")
    place = F.row_number().over(w)
    return v.withColumn("fate", F.when(stays, "kept").when(place == 1, "moved").otherwise("dropped")).withColumn(line, target).drop("new_id")


def pinned(rows: DataFrame, pins: DataFrame, key: str, value: str) -> DataFrame:
    """A resolver's values under hand-set ones; a pin of null unsets the value."""
    p = pins.select(F.col(key).alias("__k"), F.col(value).alias("__v"), F.lit(True).alias("__pin"))
    return rows.join(p, F.col(key) == F.col("__k"), "left").withColumn(value, F.when(F.coalesce("__pin", F.lit(False)), F.col("__v")).otherwise(F.col(value))).drop("__k", "__v", "__pin")
