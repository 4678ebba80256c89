"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts (label 1) are the positives; texts of the corpus whose label is not looked at are
the unlabelled ones, toxic ones among them. With the class prior p the classifier minimises

    p * E_pos[loss(+)] + max(0, E_unl[loss(-)] - p * E_pos[loss(-)])

whose second part estimates the risk on clean texts without a single clean label; where it would turn
negative, its gradient is reversed, which keeps a flexible model from fitting the unlabelled texts. The
prior is the share of label 1 among all labelled training rows. Loss is logistic, the model linear over
the words and word prefixes whose shares differ most between the positives and all unlabelled texts.

Positives are at most ``POSITIVES`` texts, chosen by a hash of their ids. Unlabelled are all texts outside fold 0, repeated rows and null ids too: their
features are counted where they lie, each different set of features that the model knows is kept once with the number of texts that have it, and every step
of the descent sums risk and gradient over these sets in Spark, a number a feature coming back. Every whole text is scored where it lies: no shuffle.

Rows of fold 0 (crc32 of the id's text mod 5) never serve in training. Null and empty texts get the score of a text without words. With no positive at all every score is
the prior (0 without labels). Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm import textvec as tv
from claimloom.llm.features import Vocabulary, held_out, word_sets
from claimloom.session import cut, release

#: Bounds of the labelled sample and of the model; steps of the descent and their length.
POSITIVES = 4000
FEATURES = 4096
STEPS, LENGTH = 60, 0.1
DECAY = 1e-3
#: Texts that a feature needs, and its least z value between positives and unlabelled texts.
LEAST, CONTRAST = 5, 5.0
#: Feature counts that a task holds at once.
HELD = 1 << 20
#: Bytes of the word prefixes that are features besides the words.
PREFIXES = (5, 6, 7, 8)


@dataclass
class Model:
    words: Vocabulary
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.bias)
        for w in tv.words(column, alnum=True, prefixes=PREFIXES):
            own = np.repeat(np.arange(w.hi - w.lo), np.diff(w.starts))
            hits = [self.words.find(own, w.hashes), *[self.words.find(own[i], h) for i, h in w.heads]]
            rows, at = (np.concatenate(x) for x in zip(*hits))
            # A text is a set: what it repeats counts once.
            rows, at = np.divmod(np.unique(rows * max(len(self.weights), 1) + at), max(len(self.weights), 1))
            out[w.lo : w.hi] += np.bincount(rows, self.weights[at], minlength=w.hi - w.lo)
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _counted(texts: DataFrame) -> DataFrame:
    """(feature, n): in how many texts each feature occurs, summed in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            names, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            return names, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        for batch in batches:
            for _, _, _, hashes, _ in word_sets(batch.column(0), prefixes=PREFIXES):
                held.append(np.unique(hashes, return_counts=True))
                if sum(len(h) for h, _ in held) > HELD:
                    names, n = merged()
                    held = [(names, n)]
                    if len(names) > HELD // 2:
                        yield pa.RecordBatch.from_arrays([tv.signed(names), pa.array(n)], names=["feature", "n"])
                        held = []
        if held:
            names, n = merged()
            yield pa.RecordBatch.from_arrays([tv.signed(names), pa.array(n)], names=["feature", "n"])

    return texts.select("text").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _separating(positive: DataFrame, every: DataFrame, least: int = LEAST, most: int = FEATURES, z_least: float = CONTRAST) -> np.ndarray:
    """The features whose share differs most between positives and unlabelled texts, by their z value; at most `most` come to the driver."""
    sizes = [df.count() for df in (positive, every)]
    if not all(sizes):
        return np.zeros(0, dtype=np.uint64)
    a, b = _counted(positive).withColumnRenamed("n", "p"), _counted(every).withColumnRenamed("n", "u")
    both = b.join(a, "feature", "left").withColumn("p", F.coalesce("p", F.lit(0))).where(F.col("p") + F.col("u") >= least)
    share = (F.col("p") + F.col("u")) / sum(sizes)
    spread = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / sizes[0] + 1 / sizes[1]))
    z = F.abs(F.col("p") / sizes[0] - F.col("u") / sizes[1]) / spread
    best = both.select("feature", z.alias("z")).where(F.col("z") > z_least).orderBy(F.desc("z"), "feature").limit(most)
    return np.array([r.feature for r in best.collect()], dtype=np.int64).view(np.uint64)


def _sets(texts: DataFrame, words: Vocabulary) -> DataFrame:
    """(at, n): the different sets of known features (their numbers, 32 bits each) and how many texts have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, int] = {}
            for lo, hi, rows, hashes, _ in word_sets(batch.column(0), prefixes=PREFIXES, known=words):
                rows, at = words.find(rows, hashes)
                order = np.lexsort((at, rows))
                cuts = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=hi - lo)))) * 4
                data = at[order].astype("<i4").tobytes()
                for i in range(hi - lo):
                    key = data[cuts[i] : cuts[i + 1]]
                    found[key] = found.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["at", "n"])

    return texts.select("text").mapInArrow(run, "at binary, n long").groupBy("at").agg(F.sum("n").alias("n"))


def _arrays(sets: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature number of every feature of a column of sets."""
    lists = [np.frombuffer(x.as_buffer(), "<i4") for x in sets]
    return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, dtype=np.int64)


def _risk(rows: np.ndarray, at: np.ndarray, n: np.ndarray, w: np.ndarray, b: float, sign: float) -> tuple[float, np.ndarray]:
    """Summed loss of calling rows, n texts each, positive (sign 1) or negative (-1), and its gradient by weight and bias."""
    f = sign * (b + np.bincount(rows, w[at], minlength=len(n)))
    slope = -sign * n / (1 + np.exp(np.clip(f, -500, 500)))
    return float(n @ np.logaddexp(0, -f)), np.append(np.bincount(at, slope[rows], minlength=len(w)), slope.sum())


def _unlabelled_risk(sets: DataFrame, w: np.ndarray, b: float) -> tuple[float, np.ndarray]:
    """_risk of calling all unlabelled texts negative, summed over the sets where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(w) + 2)
        for batch in batches:
            loss, slope = _risk(*_arrays(batch.column(0)), batch.column(1).to_numpy().astype(float), w, b, -1.0)
            total += np.append(slope, loss)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["k", "v"])

    out = np.zeros(len(w) + 2)
    for r in sets.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r.k] = r.v
    return float(out[-1]), out[:-1]


def constant(prior: float) -> Model:
    """Without positives, or with nothing but: the prior for every text."""
    share = min(max(prior, 1e-6), 1 - 1e-6)
    return Model(Vocabulary(np.zeros(0)), np.zeros(0), float(np.log(share / (1 - share))))


def train(words: Vocabulary, positive: pa.Array, sets: DataFrame, prior: float, steps: int = STEPS, length: float = LENGTH, decay: float = DECAY) -> Model:
    """Full-batch Adam on the non-negative risk; positive: sets of known features, sets: those of all unlabelled texts with their numbers."""
    rows, at = _arrays(positive)
    one, every = np.ones(len(positive)), sets.agg(F.sum("n").alias("n")).first().n
    w, b = np.zeros(len(words.hashes)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        u_loss, u_slope = _unlabelled_risk(sets, w, b)
        p_loss, p_slope = _risk(rows, at, one, w, b, -1.0)
        _, up = _risk(rows, at, one, w, b, 1.0)
        share = prior / len(one)
        clean, down = u_loss / every - share * p_loss, u_slope / every - share * p_slope
        grad = (share * up + down if clean >= 0 else -down) + decay * np.append(w, 0.0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = length * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return Model(words, w, b)


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES) -> Model:
    """Trains on the rows of labels outside fold 0: on at most so many positive texts and all unlabelled ones."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    counts = known.agg(F.count("*").alias("n"), F.sum(F.col("toxic").cast("long")).alias("t")).first()
    prior = (counts.t or 0) / counts.n if counts.n else 0.0
    # At most `positives` ids are broadcast, so no text of the corpus is shuffled to find theirs; of rows with one id one trains.
    toxic = known.where("toxic = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives)
    chosen = cut(docs.select("doc_id", "text").join(F.broadcast(toxic), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")))
    every = docs.where(~held_out(F.col("doc_id")))
    if not 0 < prior < 1 or chosen.isEmpty():
        return constant(prior)
    words = Vocabulary(_separating(chosen, every))
    sets = cut(_sets(every, words))
    # One row a different set of a bounded sample.
    positive = [(bytes(r.at), r.n) for r in _sets(chosen, words).collect()]
    model = train(words, pa.array([at for at, n in sorted(positive) for _ in range(n)], pa.binary()), sets, prior)
    release(chosen, sets)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = sent.value.scores(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, that score under one half."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sent.value.scores(batch.column(text)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
