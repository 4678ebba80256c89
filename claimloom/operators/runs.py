"""Ordered-group operators as windows: runs, restarts, as-of headings, ranked picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def run_ids(rows: DataFrame, key: list[str], order: list[Column], continues: Column, name: str = "run") -> DataFrame:
    """Numbers the stretches of rows in which each row continues the one before; continues may use lag columns."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn(name, F.sum(F.when(F.coalesce(continues, F.lit(False)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def collapse_runs(rows: DataFrame, key: list[str], number: str, same: list[str]) -> DataFrame:
    """Consecutive numbers with equal `same` columns fold to one row: first number, contains (joined), n."""
    w = Window.partitionBy(*key).orderBy(number)
    go_on = F.col(number) == F.lag(number).over(w) + 1
    for c in same:
        go_on = go_on & F.col(c).eqNullSafe(F.lag(c).over(w))
    marked = rows.withColumn("__go", go_on)
    return (
        run_ids(marked, key, [F.col(number)], F.col("__go"))
        .groupBy(*key, "run", *same)
        .agg(F.min(number).alias("first"), F.array_join(F.transform(F.sort_array(F.collect_list(number)), lambda x: x.cast("string")), ",").alias("contains"), F.count("*").alias("n"))
    )


def top_per_group(rows: DataFrame, key: list[str], order: list[Column], k: int = 1, name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(name) <= k)


def heading_at(rows: DataFrame, key: list[str], position: str, heading: str) -> Column:
    """The nearest heading at or before each row."""
    return F.last(heading, ignorenulls=True).over(Window.partitionBy(*key).orderBy(position).rowsBetween(Window.unboundedPreceding, 0))


def upper_median(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """The upper median of each key: the value at place n div 2 of its sorted values, nulls left out.

    Values are counted first, so what a key sorts are its different values with their running counts, never its rows.
    """
    each = rows.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*key)
    upto = F.sum("__n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = each.withColumns({"__upto": upto, "__half": F.floor(F.sum("__n").over(w) / 2)})
    return placed.where((F.col("__upto") > F.col("__half")) & (F.col("__upto") - F.col("__n") <= F.col("__half"))).select(*key, value)


def mode_first_seen(rows: DataFrame, key: list[str], value: str, position: str) -> DataFrame:
    """The most frequent value a key; of equally frequent ones the first seen."""
    each = rows.groupBy(*key, value).agg(F.count("*").alias("n"), F.min(position).alias("p"))
    return each.groupBy(*key).agg(F.max_by(value, F.struct(F.col("n"), -F.col("p"))).alias(value), F.max("n").alias("n"))


def renumbered(rows: DataFrame, key: list[str], number: str, isbn: str, day: str) -> DataFrame:
    """Collapses runs of consecutive numbers with one ISBN and no two dates, and numbers a line that has any anew: key, number, contains, day.

    Lines without such a run keep their numbers. The date test is against the previous row only.
    """
    w = Window.partitionBy(*key).orderBy(number)
    dates = F.coalesce(F.col(day) == F.lag(day).over(w), F.lit(True))
    go = (F.col(number) == F.lag(number).over(w) + 1) & (F.col(isbn) == F.lag(isbn).over(w)) & dates
    runs_ = run_ids(rows.withColumn("__go", go), key, [F.col(number)], F.col("__go"))
    each = runs_.groupBy(*key, "run").agg(F.min(number).alias("__first"), F.count("*").alias("__n"), F.array_join(F.array_sort(F.collect_list(number)), ",").alias("contains"), F.min_by(day, F.when(F.col(day).isNotNull(), F.col(number))).alias(day))
    line = Window.partitionBy(*key)
    some = F.max("__n").over(line) > 1
    return each.select(*key, F.when(some, F.row_number().over(line.orderBy("__first"))).otherwise(F.col("__first")).cast("int").alias(number), "contains", day)


def heading_stack(rows: DataFrame, key: list[str], position: str, level: str, heading: str, levels: int = 3) -> DataFrame:
    """rows with `stack`: for each level the nearest heading at or before the row that no shallower one has closed, joined by ' > '."""
    w = Window.partitionBy(*key).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    at = {n: F.max(F.when(F.col(level) == n, F.col(position))).over(w) for n in range(1, levels + 1)}
    name = {n: F.last(F.when(F.col(level) == n, F.col(heading)), ignorenulls=True).over(w) for n in range(1, levels + 1)}
    out = rows.withColumns({**{f"__at{n}": c for n, c in at.items()}, **{f"__h{n}": c for n, c in name.items()}})
    def holds(n: int) -> Column:
        shallower = [F.coalesce(F.col(f"__at{n}") > F.col(f"__at{m}"), F.lit(True)) for m in range(1, n)]
        alive = F.col(f"__at{n}").isNotNull()
        for c in shallower:
            alive = alive & c
        return F.when(alive, F.col(f"__h{n}"))

    joined = F.concat_ws(" > ", *[holds(n) for n in range(1, levels + 1)])
    return out.withColumn("stack", joined).drop(*[f"__{p}{n}" for n in range(1, levels + 1) for p in ("at", "h")])


def one_per_number(rows: DataFrame, key: list[str], number: str, order: list[Column], one_shot: Column) -> DataFrame:
    """rows with number and fate: kept, dropped_duplicate_number or dropped_unnumbered; the only volume of a one-shot line is number 1."""
    w = Window.partitionBy(*key)
    alone = (F.count("*").over(w) == 1) & one_shot
    out = rows.withColumn("__alone", alone)
    n = F.when(F.col(number).isNull() & F.col("__alone"), F.lit("1")).otherwise(F.col(number))
    out = out.withColumn(number, n)
    place = F.row_number().over(Window.partitionBy(*key, number).orderBy(*order))
    return out.withColumn("fate", F.when(F.col(number).isNull(), "dropped_unnumbered").when(place > 1, "dropped_duplicate_number").otherwise("kept")).drop("__alone")
