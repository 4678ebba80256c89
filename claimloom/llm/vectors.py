"""What the two vector searches share: which rows take part, and a query set against all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import cut

#: Queries of a block; a block is what is broadcast at once.
BLOCK = 4096
#: Rows that are looked at together.
ROWS = 2048


def whole(embedding: Column) -> Column:
    """Not null, not empty, and without a null or non-finite component."""
    def fine(x: Column) -> Column:
        y = x.cast("double")
        return y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf"))

    return embedding.isNotNull() & (F.size(embedding) > 0) & F.coalesce(F.forall(embedding, fine), F.lit(False))


def taking_part(vectors: DataFrame, zero: bool) -> DataFrame:
    """vec_id, embedding (doubles) of the rows that take part: whole, of the most frequent length, zero only if asked for."""
    rows = vectors.where(F.col("vec_id").isNotNull() & whole(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    if not zero:
        rows = rows.where(F.exists("embedding", lambda x: x != 0))
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (length.d if length else 0))


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0), dtype=dtype)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row inner products, summed in one fixed order so that equal vectors tie exactly."""
    out = np.zeros(len(q), dtype=q.dtype)
    for k in range(q.shape[1]):
        out += q[:, k] * x[:, k]
    return out


def keep_best(owner: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of each owner's k best, by score, then smaller id; a pair counts once."""
    order = np.lexsort((ids, -scores, owner))
    o, i = owner[order], ids[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (i[1:] != i[:-1])
    order = order[new]
    o = owner[order]
    start = np.searchsorted(o, o)
    return order[np.arange(len(order)) - start < k]


def merge_best(found: DataFrame, key: str, k: int) -> DataFrame:
    """The k best of each key by score, then smaller vec_id, with rank from 1; a pair counts once."""
    best = found.groupBy(key, "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy(key).orderBy(F.desc("score"), F.asc("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def in_blocks(
    queries: DataFrame, rows: DataFrame, search: Callable[[np.ndarray, np.ndarray, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Runs search over all rows once for each block of at most BLOCK queries (key long, embedding).

    Blocks stream through the driver one at a time; each is broadcast, and what it finds is checkpointed, before the next.
    """
    spark, out = queries.sparkSession, None
    block: list = []

    def flush() -> None:
        nonlocal out
        sent = spark.sparkContext.broadcast((np.array([b[0] for b in block], dtype=np.int64), np.array([b[1] for b in block], dtype=np.float64)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from search(*sent.value, batches)

        found = cut(rows.mapInArrow(run, schema))
        sent.destroy()
        out = found if out is None else out.union(found)
        block.clear()

    for row in queries.toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == BLOCK:
            flush()
    if block:
        flush()
    return out if out is not None else spark.createDataFrame([], schema)
