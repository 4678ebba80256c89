"""Approximate nearest neighbours by cross-polytope hashing.

For the largest inner product a vector x becomes the unit vector (x, sqrt(M^2 - |x|^2)) / M with M the upper end of its
norm band, the next power of ``BAND``, so that a few long vectors leave the buckets of the others as they are; a query q becomes (q, 0) / |q|. Padded with zeros to a power of two that leaves room, vectors go through a
pseudo-rotation, three rounds of random signs and a fast Hadamard transform; the hash is the signed
axis that lies nearest. Each band has buckets of its own, and a query probes those of every band. ``TABLES`` independent rotations give as many tables. A row lies in one bucket a
table; a query looks into the ``PROBES`` buckets whose axes lie nearest to it. What it meets there is reranked by
the exact inner product of the original vectors in double precision.

A bucket larger than ``CELL`` rows or queries is dealt in cells of a row part and a query part, so no task
holds a whole one. Equal query vectors are searched once. Of equal rows a batch keeps the k + 1 smallest
ids, all that a list of k can hold, so copies don't flood a bucket. Queries that met fewer than k rows
are compared with all rows, in blocks.

Null and zero vectors, those with null or non-finite components, of another length than most, or without vec_id
take no part. Repeated rows count once, and an id never finds itself; an id with several vectors is a query by the largest.
An empty table gives no row. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.vectors import exact_products, in_blocks, keep_best, matrix, merge_best, taking_part
from claimloom.session import cut, release

K = 20
QUERY_EVERY = 20
TABLES = 16
PROBES = 14
CELL = 8192
SEED = 4711
#: Norms of a band differ by this factor at most. A power of it is moved up a little, so that unit vectors lie under their own M.
BAND = 1.25


def hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, t: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, t])
    for _ in range(3):
        x = hadamard(x * rng.choice(np.array([-1.0, 1.0], dtype=np.float32), x.shape[1]))
    return x


def padded(x: np.ndarray, extra: np.ndarray) -> np.ndarray:
    size = 1 << x.shape[1].bit_length()
    out = np.zeros((len(x), size), dtype=np.float32)
    out[:, : x.shape[1]], out[:, x.shape[1]] = x, extra
    return out


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, max(x.shape[1], 1), dtype=np.int32), pa.array(np.ascontiguousarray(x).ravel()))


def lengths(x: np.ndarray) -> np.ndarray:
    """Norms, safe where squares leave the range of doubles."""
    most = np.abs(x).max(axis=1)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def bands(norms: np.ndarray) -> np.ndarray:
    """The band of each norm: norms of band i are at most BAND ** i."""
    return np.ceil(np.log(norms) / np.log(BAND) - 1e-6).astype(np.int64)


def _index(tables: int, copies: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1))
            _, same = np.unique(x, axis=0, return_inverse=True)
            kept = keep_best(same.ravel(), ids, np.zeros(len(ids)), copies)
            ids, x = ids[kept], x[kept]
            band = bands(lengths(x))
            y = x / BAND ** band.astype(np.float64)[:, None]
            unit = padded(y, np.sqrt(np.maximum(0, 1 - (y**2).sum(axis=1))))
            codes = np.zeros((len(x), tables), dtype=np.int64)
            for t in range(tables):
                r = rotated(unit, t)
                axis = np.argmax(np.abs(r), axis=1)
                codes[:, t] = (t << 32) + 2 * axis + (r[np.arange(len(r)), axis] < 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(band), _lists(codes), _lists(x.astype(kind))], names=["vec_id", "band", "axes", "embedding"])

    return run


def _bucket():
    return F.xxhash64("axis", "band")


def _probe(tables: int, probes: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = matrix(batch.column(1))
            unit = padded(q / lengths(q)[:, None], np.zeros(len(q)))
            axes = []
            for t in range(tables):
                r = rotated(unit, t)
                both = np.stack((r, -r), axis=2).reshape(len(r), -1)
                axes.append((t << 32) + np.argsort(-both, axis=1, kind="stable")[:, :probes])
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(np.concatenate(axes, axis=1).astype(np.int64)), _lists(q.astype(kind))], names=["key", "axes", "embedding"])

    return run


def _rerank(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's best k among the rows: positions of queries, ids, scores."""
    owner, found, score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    for a in range(0, len(q), 512):
        rough = q[a : a + 512] @ x.T
        if rough.shape[1] > k:
            least = np.partition(rough, -k, axis=1)[:, -k]
            i, j = np.nonzero(rough >= (least - 1e-9 * (1 + np.abs(rough).max()))[:, None])
        else:
            i, j = np.nonzero(np.ones(rough.shape, dtype=bool))
        s = exact_products(q[a + i], x[j])
        kept = keep_best(a + i, ids[j], s, k)
        owner, found, score = np.append(owner, (a + i)[kept]), np.append(found, ids[j][kept]), np.append(score, s[kept])
    return owner, found, score


def _meet(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table({"key": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        x, q = matrix(rows.column("embedding").combine_chunks()), matrix(queries.column("embedding").combine_chunks())
        owner, ids, score = _rerank(q, x, rows.column("vec_id").to_numpy(), k)
        return pa.table({"key": pa.array(queries.column("key").to_numpy()[owner]), "vec_id": pa.array(ids), "score": pa.array(score)})

    return run


def _scan(k: int):
    def run(keys: np.ndarray, q: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                owner, ids, score = _rerank(q, matrix(batch.column(1)), batch.column(0).to_numpy(), k)
                yield pa.RecordBatch.from_arrays([pa.array(keys[owner]), pa.array(ids), pa.array(score)], names=["key", "vec_id", "score"])

    return run


def neighbours(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, tables: int = TABLES, probes: int = PROBES, cell: int = CELL) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose vec_id is divisible by `every`."""
    rows = taking_part(vectors, zero=False)
    # Vectors travel as wide as they came.
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind, real = ("float", np.float32) if single else ("double", np.float64)
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("embedding").alias("embedding"))
    members = cut(asked.select(F.col("vec_id").alias("query_id"), F.xxhash64("embedding").alias("key"), "embedding"))
    queries = members.groupBy("key").agg(F.min("embedding").alias("embedding"))
    # Every row is turned once; the query itself may be met, so one more than k is looked for.
    indexed = cut(rows.mapInArrow(_index(tables, k + 1, real), f"vec_id long, band long, axes array<long>, embedding array<{kind}>"))
    index = indexed.select("vec_id", "embedding", "band", F.explode("axes").alias("axis")).withColumn("bucket", _bucket())
    # Norms of doubles span some 6,400 bands at most.
    found_bands = sorted(r.band for r in indexed.select("band").distinct().collect())
    asking = cut(queries.mapInArrow(_probe(tables, probes, real), f"key long, axes array<long>, embedding array<{kind}>"))
    probe = asking.select("key", "embedding", F.explode("axes").alias("axis"))
    probe = probe.withColumn("band", F.explode(F.array(*[F.lit(b).cast("long") for b in found_bands]) if found_bands else F.expr("cast(array() as array<long>)"))).withColumn("bucket", _bucket())
    # A row a bucket: tables x twice the padded length x bands of norms, whatever the number of rows.
    parts = index.groupBy("bucket").agg(F.ceil(F.count("*") / cell).cast("int").alias("rows_in"))
    asks = probe.groupBy("bucket").agg(F.ceil(F.count("*") / cell).cast("int").alias("asks_in"))
    grid = cut(parts.join(asks, "bucket"))
    left = index.join(F.broadcast(grid), "bucket").withColumns(
        {"part": F.pmod(F.xxhash64("vec_id"), F.col("rows_in")).cast("int"), "ask": F.explode(F.sequence(F.lit(0), F.col("asks_in") - 1))}
    )
    right = probe.join(F.broadcast(grid), "bucket").withColumns(
        {"ask": F.pmod(F.xxhash64("key"), F.col("asks_in")).cast("int"), "part": F.explode(F.sequence(F.lit(0), F.col("rows_in") - 1))}
    )
    where = ["bucket", "part", "ask"]
    met = (
        left.select(*where, "vec_id", "embedding").groupBy(*where).cogroup(right.select(*where, "key", "embedding").groupBy(*where))
        .applyInArrow(_meet(k + 1), "key long, vec_id long, score double")
    )
    best = cut(merge_best(met, "key", k + 1).drop("rank"))
    total = rows.select("vec_id").distinct().count()
    enough = best.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min(k + 1, total))
    short = queries.join(enough, "key", "left_anti").select("key", "embedding")
    more = in_blocks(short, rows, _scan(k + 1), "key long, vec_id long, score double")
    found = members.select("query_id", "key").join(best.select("key", "vec_id", "score").union(more), "key").where("query_id <> vec_id")
    out = cut(merge_best(found.drop("key"), "query_id", k).select("query_id", "rank", "vec_id", "score"))
    release(members, indexed, asking, grid, best)
    return out
