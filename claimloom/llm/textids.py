"""Numbers that stand for texts, no two texts under one number.

A text's number is a 64-bit hash. Among very many texts some two share one, so a second hash of every text looks for such numbers first: a row of 24
bytes a text, pre-aggregated, is all that is shuffled. The few numbers that several texts share give way to a hash of both hashes, so what tells texts
apart has 128 bits, while everything that joins, sorts or groups them goes on with one long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shared numbers that are expected at most: 10^13 texts share some 2,700,000, 10^11 texts 270.
MOST = 1 << 20


def first_half(text: Column) -> Column:
    return F.xxhash64(text)


def second_half(text: Column) -> Column:
    return F.xxhash64(F.lit("second"), text)


def numbers_of(docs: DataFrame) -> Callable[[Column], Column]:
    """The number of a text, as a function of its column; null for a null text. It holds for the texts of docs (column text)."""
    halves = docs.where("text is not null").select(first_half(F.col("text")).alias("a"), second_half(F.col("text")).alias("b"))
    shared = [r.a for r in halves.groupBy("a").agg(F.min("b").alias("x"), F.max("b").alias("y")).where("x <> y").select("a").limit(MOST + 1).collect()]
    if len(shared) > MOST:
        raise RuntimeError(f"more than {MOST} texts share the first half of their hash")

    def number(text: Column) -> Column:
        own = first_half(text)
        if shared:
            own = F.when(own.isin(shared), F.xxhash64(own, second_half(text))).otherwise(own)
        return F.when(text.isNotNull(), own)

    return number
