"""Mixing to target weights with soft domain membership.

A multinomial classifier, trained by numpy on a bounded sample of the labelled table, gives every
document the posterior of each domain. Document rates r >= 0 are then fitted by least squares so that the
expected tokens of each domain, sum of r * tokens * posterior, meet the target weight times all tokens.

The fit is projected gradient descent on the rates, from 1: each step moves every rate against the gradient and sets
what turns negative to 0. Distances of the domains' totals are measured in the metric that makes the first steps' curvature 1, so a small
domain moves as fast as a large one and a step of length 1 never overshoots; steps have momentum, which is given up where it points uphill.
A step is known by c numbers, one a domain, and its momentum. Tasks hold no rates: they replay the steps so far on the tokens and posteriors of
their documents and return the domains' totals, so a pass shuffles a few numbers and a lost task is just run again. It ends
when the totals meet their targets or the projected gradient vanishes (then no rates are nearer); a fit that
doesn't get there in STEPS_MOST steps warns with its residual.

Tokens of a document are its words (runs of letters and digits). Rates turn into whole copies by a hash
of id and text, so copies average the rate. Null and empty texts have no tokens; their rate follows from
their posteriors. Without labels, or with one domain, every posterior is certain and rates only meet
the total. Repeated rows are documents of their own; extra columns, whatever their names, are carried along; null ids are mixed too but do not train.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm import textvec as tv
from claimloom.llm.features import Vocabulary, contrasts, known_features, sampled, word_sets
from claimloom.session import cut

#: Bounds of the training sample and of the model.
LABELLED = 8000
FEATURES = 2048
STEPS = 300
#: The fit ends at this sum of the domains' shares off target, or where the rates' mean move is less than a tenth of it.
TOLERANCE = 1e-5
STEPS_MOST = 150
#: Posteriors are never 0, so a weight of 0 could only be approached by leaving documents out; a hundredth is met.
TARGETS = {"fine": 0.9, "rough": 0.09, "toxic": 0.01}


def label_domains() -> Column:
    """Domains of the labels table: toxic, else rough (quality 0), else fine."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "rough").when(F.col("quality") == 1, "fine")


@dataclass
class Posteriors:
    words: Vocabulary
    weights: np.ndarray  # feature x domain
    bias: np.ndarray

    def of(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for lo, hi, rows, hashes, n in word_sets(column, shapes=True, known=self.words):
            rows, at = self.words.find(rows, hashes)
            f = np.stack([b + np.bincount(rows, w[at], minlength=hi - lo) for w, b in zip(self.weights.T, self.bias)], axis=1)
            e = np.exp(f - f.max(axis=1, keepdims=True))
            yield lo, hi, e / e.sum(axis=1, keepdims=True), n


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> Posteriors:
    """Trains on labelled (doc_id, domain); rows of other domains and ids that occur twice are left out."""
    known = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    once = docs.where("doc_id is not null").groupBy("doc_id").count().where("count = 1").select("doc_id")
    # At most LABELLED ids are broadcast, so no text of the corpus is shuffled to find theirs.
    picked = known.join(once, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    number = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")) - 1
    sample = sampled(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").withColumn("domain", number), "domain", True)
    words, c = Vocabulary(contrasts(sample, 3, FEATURES, 3.0)), len(domains)
    row, at, y = known_features(sample, words)
    if not len(y):
        return Posteriors(Vocabulary(np.zeros(0)), np.zeros((0, c)), np.zeros(c))
    goal = np.eye(c)[y]
    w, b = np.zeros((len(words.hashes), c)), np.log((goal.sum(axis=0) + 0.5) / (len(y) + 0.5 * c))
    m, v = np.zeros((len(w) + 1, c)), np.zeros((len(w) + 1, c))
    for step in range(1, STEPS + 1):
        f = b + np.stack([np.bincount(row, w[at, k], minlength=len(y)) for k in range(c)], axis=1)
        e = np.exp(f - f.max(axis=1, keepdims=True))
        g = (e / e.sum(axis=1, keepdims=True) - goal) / len(y)
        grad = np.vstack([np.stack([np.bincount(at, g[row, k], minlength=len(w)) for k in range(c)], axis=1) + 2e-4 * w, g.sum(axis=0)])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Posteriors(words, w, b)


Step = tuple[np.ndarray, float]


def rates_of(p: np.ndarray, steps: list[Step]) -> tuple[np.ndarray, np.ndarray]:
    """Rates of documents with posteriors p after these steps, and the point where the last one began."""
    rate = start = ahead = np.ones(len(p))
    for direction, momentum in steps:
        start = ahead
        new = np.maximum(0.0, start - p @ direction)
        rate, ahead = new, new + momentum * (new - rate)
    return rate, start


def _matrix(column: pa.Array, c: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, c)


def _totals(members: DataFrame, steps: list[Step], c: int, curvature: bool = False) -> np.ndarray:
    """All tokens, tokens moved by the last step, expected tokens a domain; on request tokens for each two domains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + c + c * c)
        for batch in batches:
            p, tokens = _matrix(batch.column(1), c), batch.column(0).to_numpy().astype(np.float64)
            rate, start = rates_of(p, steps)
            total[0] += tokens.sum()
            total[1] += tokens @ np.abs(rate - start)
            total[2 : 2 + c] += p.T @ (tokens * rate)
            if curvature:
                total[2 + c :] += ((p * tokens[:, None]).T @ p).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total)], names=["k", "v"])

    out = np.zeros(2 + c + c * c)
    for r in members.select("tokens", "posteriors").mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r.k] = r.v
    return out


def fit_rates(members: DataFrame, targets: np.ndarray) -> tuple[list[Step], np.ndarray]:
    """The steps of the descent, and the shares off target, for members (tokens, posteriors)."""
    c, steps = len(targets), []
    first = _totals(members, steps, c, True)
    every = first[0]
    if not every:
        return steps, np.zeros(c)
    # Domains that no document tells apart have no curvature between them; they move together.
    metric = np.linalg.pinv(first[2 + c :].reshape(c, c) / every, rcond=1e-9, hermitian=True)
    shares = ahead = first[2 : 2 + c] / every
    speed = 1.0
    while np.abs(shares - targets).sum() > TOLERANCE:
        if len(steps) == STEPS_MOST:
            warnings.warn(f"rates did not settle: shares off target by {(shares - targets).tolist()}", RuntimeWarning, stacklevel=2)
            break
        direction = metric @ (ahead - targets)
        now = _totals(members, [*steps, (direction, 0.0)], c)
        new = now[2 : 2 + c] / every
        if direction @ (new - shares) > 0:
            speed = 1.0
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        momentum = (speed - 1) / faster
        steps.append((direction, momentum))
        ahead, shares, speed = new + momentum * (new - shares), new, faster
        if now[1] / every <= TOLERANCE / 10:
            break
    return steps, shares - targets


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """A row per row of docs: doc_id, text_hash, tokens, posteriors (in the order of targets), rate, copies.

    Targets are non-negative; they are scaled to sum to one.
    """
    targets = targets or TARGETS
    domains = list(targets)
    goal = np.array([targets[d] for d in domains], dtype=float)
    if (goal < 0).any() or not goal.sum():
        raise ValueError("targets must be non-negative and not all zero")
    model = fit(docs, labelled, domains)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    c = len(domains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, p, n in sent.value.of(batch.column(2)):
                lists = pa.ListArray.from_arrays(np.arange(0, p.size + 1, c, dtype=np.int32), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(n.astype(np.int64)), lists],
                    names=["doc_id", "text_hash", "tokens", "posteriors"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    members = cut(
        docs.select("doc_id", F.md5("text").alias("text_hash"), "text").mapInArrow(
            weigh, f"doc_id {kind}, text_hash string, tokens long, posteriors array<double>"
        )
    )
    steps, _ = fit_rates(members, goal / goal.sum())

    def rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate, _ = rates_of(_matrix(batch.column(3), c), steps)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], names=["doc_id", "text_hash", "tokens", "posteriors", "rate"])

    out = members.mapInArrow(rates, f"doc_id {kind}, text_hash string, tokens long, posteriors array<double>, rate double")
    chance = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    return out.withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """docs, all columns, each row as often as its copies say."""
    # Equal rows get equal copies, so one decision per id and text (by 128 bits of it) serves all of them.
    ident, digest, copies, copy = tv.free_names(docs.columns, "id", "hash", "copies", "copy")
    chosen = mixed(docs, labelled, targets).groupBy("doc_id", "text_hash").agg(F.first("copies").alias(copies))
    chosen = chosen.withColumnsRenamed({"doc_id": ident, "text_hash": digest}).where(F.col(copies) > 0)
    both = docs.join(chosen, docs["doc_id"].eqNullSafe(chosen[ident]) & F.md5(docs["text"]).eqNullSafe(chosen[digest]))
    return both.withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).select(*[docs[f"`{c}`"] for c in docs.columns])
