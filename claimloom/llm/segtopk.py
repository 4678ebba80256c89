"""Exact top-k of integer inner products, pruned by multi-resolution segment statistics.

Components x become floor(SCALE * x). A vector's segments of some length have a mean and a deviation; for two
vectors the sum over segments of length * ((mean - mean')^2 + (deviation - deviation')^2) never exceeds their
squared distance. With both norms known this bounds the inner product from above. A row of the
table is tried against a query with few long segments first, then with more short ones; only where both
bounds reach the query's k-th best score so far is the product computed. Bounds carry a margin for
rounding and a bound equal to the k-th score is not pruned, so ties are exact.

Queries go in blocks against all rows; each task keeps k results a query, and these are merged.
Null vectors, those with null or non-finite components, of another length than most, or without vec_id take
no part; zero vectors do. Repeated rows count once, and an id never finds itself. An id with several vectors is
a query by the largest, and as a candidate counts once with its best score. Products are exact
integers; those beyond +-(2^63 - 1), which no long holds, count as that, so they tie. An empty table gives no row. Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.vectors import ROWS, in_blocks, keep_best, matrix, merge_best, taking_part

SCALE = 1024
K = 10
QUERY_EVERY = 100
#: Longs end here; a product beyond is this much, with its sign.
MOST = 2**63 - 1
#: Segments a vector, coarse to fine.
LEVELS = (4, 16)


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of a row's segments, each times the root of its length, side by side."""
    size = -(-x.shape[1] // segments)
    padded = np.zeros((len(x), size * segments))
    padded[:, : x.shape[1]] = x
    parts = padded.reshape(len(x), segments, size)
    return np.concatenate((parts.mean(axis=2), parts.std(axis=2)), axis=1) * np.sqrt(size)


def least_squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All pairs' lower bounds from the statistics of one level."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T


def _component(x: float, scale: int) -> int:
    """floor(scale * x); a double of 2^53 or more is whole, and its product may leave the doubles."""
    return int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale)


def _search(k: int, scale: int, levels: tuple[int, ...]):
    def run(ids: np.ndarray, vectors: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            q = np.floor(vectors * scale)
            qn = (q * q).sum(axis=1)
        stats = [segment_statistics(q, s) for s in levels]
        owner, best_id, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        floor = np.full(len(q), -np.inf)
        for batch in batches:
            all_rows, all_ids = matrix(batch.column(1)), batch.column(0).to_numpy()
            for lo in range(0, len(all_ids), ROWS):
                raw, own = all_rows[lo : lo + ROWS], all_ids[lo : lo + ROWS]
                with np.errstate(over="ignore"):
                    x = np.floor(raw * scale)
                    xn = (x * x).sum(axis=1)
                    wide = len(x) > 0 and not np.sqrt(qn.max()) * np.sqrt(xn.max()) < 2.0**52
                if wide:
                    # Integers of any size, one query at a time.
                    whole = [[_component(v, scale) for v in row] for row in raw]
                    for i, vector in enumerate(vectors):
                        at = np.flatnonzero(own != ids[i])
                        one = [_component(v, scale) for v in vector]
                        score = np.array([min(MOST, max(-MOST, sum(map(int.__mul__, one, whole[t])))) for t in at], dtype=np.int64)
                        kept = keep_best(np.zeros(len(at), dtype=np.int64), own[at], score, k)
                        yield _batch(np.full(len(kept), ids[i]), own[at][kept], score[kept])
                    continue
                # Rows and queries that the coarse bound rules out altogether never get a fine one.
                at_q, at_x = np.arange(len(q)), np.arange(len(x))
                alive = ids[:, None] != own[None, :]
                for level, s in zip(stats, levels):
                    least = least_squared_distances(level[at_q], segment_statistics(x[at_x], s))
                    both = qn[at_q][:, None] + xn[at_x][None, :]
                    alive &= (both - least) / 2 + 1e-9 * both + 1e-6 >= floor[at_q][:, None]
                    rows, columns = alive.any(axis=1), alive.any(axis=0)
                    at_q, at_x, alive = at_q[rows], at_x[columns], alive[rows][:, columns]
                i_all, j_all = np.nonzero(alive)
                i_all, j_all = at_q[i_all], at_x[j_all]
                for a in range(0, len(i_all), 1 << 18):
                    i, j = i_all[a : a + (1 << 18)], j_all[a : a + (1 << 18)]
                    score = np.einsum("ij,ij->i", q[i], x[j])
                    ok = score >= floor[i]
                    i, j, score = i[ok], j[ok], score[ok]
                    owner, best_id, best = np.append(owner, i), np.append(best_id, own[j]), np.append(best, score)
                    kept = keep_best(owner, best_id, best, k)
                    owner, best_id, best = owner[kept], best_id[kept], best[kept]
                    full = np.bincount(owner, minlength=len(q)) >= k
                    last = np.append(np.flatnonzero(np.diff(owner)), len(owner) - 1) if len(owner) else owner
                    low = np.full(len(q), -np.inf)
                    low[owner[last]] = best[last]
                    floor = np.where(full, low, -np.inf)
        yield _batch(ids[owner], best_id, best.astype(np.int64))

    def _batch(query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(ids, pa.int64()), pa.array(score.tolist(), pa.int64())], names=["query_id", "vec_id", "score"])

    return run


def integer_top_k(
    vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, scale: int = SCALE, levels: tuple[int, ...] = LEVELS
) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose vec_id is divisible by `every`."""
    rows = taking_part(vectors, zero=True)
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("embedding").alias("embedding"))
    found = in_blocks(queries, rows, _search(k, scale, levels), "query_id long, vec_id long, score long")
    return merge_best(found, "query_id", k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""
