"""Sparse text features for classifiers that train on the driver and score on the executors.

A text is the set of its words (lower-cased runs of letters and digits), of their prefixes of some
lengths, and of one bin per shape measure. All are 64-bit hashes; a classifier keeps those that its bounded sample shows to matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm import textvec as tv
from claimloom.session import cut

_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, dtype=np.int64)
_DIGIT[48:58] = 1
_MARK = np.zeros(256, dtype=np.int64)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = 1
_EDGES = np.array([0.0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.18, 0.25, 0.35, 0.45, 0.55, 0.65, 0.75, 0.85, 0.95])


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def word_sets(column: pa.Array, shapes: bool = False, prefixes: tuple[int, ...] = (), known: Vocabulary | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """lo, hi, then row and hash of each different feature, and the words of each row.

    With a vocabulary only its words are listed (all count for the shapes), so few are left to sort.
    """
    data, offsets = tv.raw(column)
    for w in tv.words(column, alnum=True, prefixes=prefixes):
        n = np.diff(w.starts)
        own = np.repeat(np.arange(len(n), dtype=np.uint64), n)
        row = np.concatenate((own, *[own[i] for i, _ in w.heads]))
        found = np.concatenate((w.hashes, *[h for _, h in w.heads]))
        different = _different(row, found, len(n)) if shapes else None
        if known is not None:
            maybe = known.maybe(found)
            row, found = row[maybe], found[maybe]
        key = found ^ tv.mix(row + np.uint64(1))
        order = np.argsort(key)
        new = np.ones(len(order), dtype=bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        first = order[new]
        rows, hashes = row[first].astype(np.int64), found[first]
        if shapes:
            b, at = data[offsets[w.lo] : offsets[w.hi]], offsets[w.lo : w.hi + 1] - offsets[w.lo]
            size = np.maximum(np.diff(at), 1)
            share = [np.diff(np.concatenate(([0], np.cumsum(c[b])))[at]) / size for c in (_UPPER, _DIGIT, _MARK)]
            share.append(different / np.maximum(n, 1))
            for k, x in enumerate(share):
                bins = np.searchsorted(_EDGES, x, side="right").astype(np.uint64)
                rows = np.concatenate((rows, np.arange(len(n))))
                hashes = np.concatenate((hashes, tv.mix(bins + np.uint64(1000 * (k + 1)))))
        yield w.lo, w.hi, rows, hashes, n


def sampled(docs: DataFrame, group: str, shapes: bool, prefixes: tuple[int, ...] = ()) -> DataFrame:
    """features (their hashes as binary) and group of the rows of a sample; checkpointed, as it is read several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, rows, hashes, _ in word_sets(batch.column(0), shapes, prefixes):
                order = np.argsort(rows, kind="stable")
                data = pa.Array.from_buffers(
                    pa.large_binary(),
                    hi - lo,
                    [None, pa.py_buffer(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=hi - lo)))).astype(np.int64) * 8), pa.py_buffer(hashes[order].tobytes())],
                )
                yield pa.RecordBatch.from_arrays([data.cast(pa.binary()), batch.column(1).slice(lo, hi - lo)], names=["features", "part"])

    return cut(docs.select("text", F.col(group).cast("int").alias("part")).mapInArrow(run, "features binary, part int"))


def _different(row: np.ndarray, found: np.ndarray, rows: int) -> np.ndarray:
    """Different features of each row: one sort of plain numbers, the row above 44 bits of the hash."""
    key = (row << np.uint64(44)) | (found & np.uint64((1 << 44) - 1))
    key.sort()
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    return np.bincount((key[new] >> np.uint64(44)).astype(np.int64), minlength=rows)


class Vocabulary:
    """Feature hashes, sorted, with a small table that rules most others out at once."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes.astype(np.uint64))
        self.table = np.zeros(1 << 18, dtype=bool)
        self.table[(self.hashes & np.uint64((1 << 18) - 1)).astype(np.int64)] = True

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        return self.table[(hashes & np.uint64((1 << 18) - 1)).astype(np.int64)]

    def find(self, rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and feature numbers of the hashes that belong."""
        if not len(self.hashes):
            return rows[:0], rows[:0]
        maybe = self.maybe(hashes)
        rows, hashes = rows[maybe], hashes[maybe]
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        ok = self.hashes[at] == hashes
        return rows[ok], at[ok]


def contrasts(sample: DataFrame, least: int, most: int, z_least: float) -> np.ndarray:
    """The features whose share differs most between any group and the rest, by their z value.

    Counted where the sample lies; at most `most` hashes come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column(1).to_numpy()
            for g in np.unique(part):
                own = [np.frombuffer(batch.column(0)[int(i)].as_buffer(), np.int64) for i in np.flatnonzero(part == g)]
                names, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.full(len(names), g, dtype=np.int32)), pa.array(n)], names=["feature", "part", "n"])

    sizes = {r.part: r.n for r in sample.groupBy("part").agg(F.count("*").alias("n")).collect()}
    every = sum(sizes.values())
    counted = sample.mapInArrow(run, "feature long, part int, n long").groupBy("feature").agg(
        F.sum("n").alias("total"), *[F.sum(F.when(F.col("part") == g, F.col("n")).otherwise(0)).alias(f"n{g}") for g in sizes]
    )
    z, p = F.lit(0.0), F.col("total") / every
    for g, size in sizes.items():
        if size < every:
            inside, outside = F.col(f"n{g}"), F.col("total") - F.col(f"n{g}")
            spread = F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / size + 1 / (every - size)))
            z = F.greatest(z, F.abs(inside / size - outside / (every - size)) / spread)
    best = counted.where(F.col("total") >= least).select("feature", z.alias("z")).where(F.col("z") > z_least).orderBy(F.desc("z"), "feature").limit(most)
    return np.array([r.feature for r in best.collect()], dtype=np.int64).view(np.uint64)


def known_features(sample: DataFrame, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and feature number of what belongs to the vocabulary, and each row's group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [words.find(np.zeros(1, dtype=np.int64).repeat(len(x)), x)[1] for x in (np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([np.sort(x).astype(np.int32).tobytes() for x in own], pa.binary()), batch.column(1)], names=["at", "part"])

    found = sorted((bytes(r[0]), r[1]) for r in sample.mapInArrow(run, "at binary, part int").collect())
    lists = [np.frombuffer(x, dtype=np.int32) for x, _ in found]
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return rows, np.concatenate(lists).astype(np.int64) if lists else rows, np.array([g for _, g in found], dtype=np.int64)
