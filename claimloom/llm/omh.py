"""Near-duplicate texts by Order MinHash, checked by banded alignment.

A text is its sequence of five-word shingles (k-mers) over lower-cased runs of letters and digits,
each labelled with its occurrence for the sketches and the prefix filter so that repeats count. Every sketch takes the ``ELL`` smallest
labelled k-mers under one permutation and keeps them in text order; two texts are compared if any of
their ``SKETCHES`` sketches agree. Candidates are verified exactly: the alignment of the two sequences of
k-mers without labels keeps M of them in order, and the texts are near-duplicates if
M / (n + m - M) is at least ``SIMILARITY``. No alignment that good leaves the diagonal by more than the
k-mers it drops, so matches outside that band are not looked at.

Equal texts form one node before anything else, so a group of copies costs one comparison. In a
bucket of sketches the texts are first compared with the most central one, then, unless they have
joined a class, with the next; after ``LEADER_ROUNDS`` rounds the texts of buckets that still hold several classes
are compared across classes wherever an exact filter on their rarest k-mers allows the
similarity, so no link is lost to the leaders and a large group of loosely similar texts costs no square.

Texts without a word (null and empty ones too) have no k-mer and are near-duplicates of nothing but
equal texts with words are; a text of one to four words is one k-mer of all its words.
Repeated rows, equal ids and null ids are allowed; other columns are never read, and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm import textvec as tv
from claimloom.llm.textids import numbers_of
from claimloom.operators.graph import connected_components
from claimloom.session import cut

K = 5
ELL = 4
SKETCHES = 16
SIMILARITY = 0.8
LEADER_ROUNDS = 2

_RNG = np.random.default_rng(77)
_ODD = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(1, 2**63, 64, dtype=np.uint64)


def _kmers(column: pa.Array, labels: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for w in tv.words(column, alnum=True):
        s, at = tv.shingles(w, K)
        yield w.lo, tv.labelled(s, at) if labels else s, at


def order_sketches(s: np.ndarray, at: np.ndarray, sketches: int, ell: int) -> np.ndarray:
    """One row per text with its sketches; rows of texts without k-mers mean nothing."""
    size = np.diff(at)
    row = np.repeat(np.arange(len(size)), size)
    # All but some twenty k-mers a text can be left out of the selection; where that leaves too few, none are.
    bound = np.where(size > 24, (2.0**64) * 20 / np.maximum(size, 1), 2.0**64 - 2048).astype(np.uint64)
    out = np.zeros((len(size), sketches), dtype=np.uint64)
    limit = bound[row]
    for r in range(sketches):
        v = s * _ODD[r] + _ADD[r]
        v ^= v >> np.uint64(32)
        v *= _ODD[-1 - r]
        low = v <= limit
        short = np.bincount(row[low], minlength=len(size)) < np.minimum(size, ell)
        if short.any():
            low |= short[row]
        at_low = np.flatnonzero(low)
        order = at_low[np.lexsort((v[at_low], row[at_low]))]
        begin = np.searchsorted(row[order], np.arange(len(size)))
        take = np.minimum(np.diff(np.append(begin, len(order))), ell)
        chosen = np.sort(order[tv.ragged(begin, take)])
        place = np.arange(len(chosen)) - np.repeat(np.concatenate(([0], np.cumsum(take)[:-1])), take)
        part = tv.mix(s[chosen] + np.uint64(r + 1)) * tv.powers(tv._WORD_MULT, ell + 1)[place + 1]
        full = take > 0
        if full.any():
            out[full, r] = tv.mix(np.add.reduceat(part, np.concatenate(([0], np.cumsum(take[full])[:-1]))))
    return out


def _repeats_aligned(a: np.ndarray, b: np.ndarray, need: float) -> int:
    """Length of the longest common subsequence, k-mers may repeat; 0 where a bound says it is below need.

    A row of the dynamic programme is one number with a bit for each place of b (Hyyrö).
    """
    ends = np.zeros(2, dtype=np.int64)
    for k, step in enumerate((1, -1)):
        short = min(len(a), len(b))
        same = a[::step][:short] == b[::step][:short]
        ends[k] = short if same.all() else np.argmin(same)
        a, b = (a[ends[0] :], b[ends[0] :]) if not k else (a[: len(a) - ends[1]], b[: len(b) - ends[1]])
    both = int(ends.sum())
    ka, na = np.unique(a, return_counts=True)
    kb, nb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if both + np.minimum(na[i], nb[j]).sum() < need - 1e-9:
        return 0
    places: dict[int, list[int]] = {}
    for at, x in enumerate(b.tolist()):
        places.setdefault(x, []).append(at)
    often: dict[int, int] = {}
    full = (1 << len(b)) - 1
    row = full
    for x in a.tolist():
        at = places.get(x)
        if at is None:
            continue
        if len(at) == 1:
            met = row & (1 << at[0])
        else:
            if x not in often:
                bits = np.zeros(len(b), dtype=np.uint8)
                bits[at] = 1
                often[x] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            met = row & often[x]
        row = ((row + met) | (row - met)) & full
    return both + len(b) - row.bit_count()


def aligned_similarity(a: np.ndarray, b: np.ndarray, at_least: float = SIMILARITY) -> float:
    """M / (n + m - M) for the longest common subsequence M; 0 where it is below at_least.

    Where no k-mer repeats in a text, the best alignment is the longest increasing run of positions in the band.
    """
    n, m = len(a), len(b)
    need = at_least * (n + m) / (1 + at_least)
    if not n or not m or min(n, m) < need - 1e-9:
        return 0.0
    if len(np.unique(a)) < n or len(np.unique(b)) < m:
        kept = _repeats_aligned(a, b, need)
        score = kept / (n + m - kept)
        return score if score >= at_least - 1e-12 else 0.0
    order = np.argsort(b, kind="stable")
    found = np.minimum(np.searchsorted(b[order], a), m - 1)
    j = order[found]
    i = np.flatnonzero(b[j] == a)
    j = j[i]
    near = np.abs(i - j) <= n + m - 2 * need + 1e-9
    j = j[near]
    if len(j) < need - 1e-9:
        return 0.0
    if len(j) > 1 and (np.diff(j) < 0).any():
        from bisect import bisect_left

        tails: list[int] = []
        for x in j.tolist():
            k = bisect_left(tails, x)
            if k == len(tails):
                tails.append(x)
            else:
                tails[k] = x
        kept = len(tails)
    else:
        kept = len(j)
    score = kept / (n + m - kept)
    return score if score >= at_least - 1e-12 else 0.0


def _sketch(sketches: int, ell: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, s, at in _kmers(batch.column(1)):
                n, full = len(at) - 1, np.diff(at) > 0
                grid = order_sketches(s, at, sketches, ell)[full]
                lists = pa.ListArray.from_arrays(np.arange(0, grid.size + 1, sketches, dtype=np.int32), tv.signed(grid.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n).filter(pa.array(full)), batch.column(2).slice(lo, n).filter(pa.array(full)), lists],
                    names=["doc_id", "node", "sketch"],
                )

    return run


def _kmer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, s, at in _kmers(batch.column(1), labels=False):
            # Without labels, for the alignment; the prefix filter labels them again.
            data = pa.Array.from_buffers(
                pa.large_binary(), len(at) - 1, [None, pa.py_buffer((at * 8).astype(np.int64)), pa.py_buffer(s.tobytes())]
            )
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(at) - 1), data.cast(pa.binary())], names=["node", "kmers"])


def _verify(at_least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [
                aligned_similarity(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), at_least)
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64())], names=["a", "b", "similarity"])

    return run


def verified_pairs(pairs: DataFrame, kmers: DataFrame, at_least: float = SIMILARITY) -> DataFrame:
    """Exact similarity of each pair (a, b); 0 for those below at_least."""
    left = kmers.select(F.col("node").alias("a"), F.col("kmers").alias("ka"))
    right = kmers.select(F.col("node").alias("b"), F.col("kmers").alias("kb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ka", "kb")
    return joined.mapInArrow(_verify(at_least), "a long, b long, similarity double")


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            k = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.uint64)
            # In a row of its own a k-mer gets the same label in every text.
            k = tv.labelled(k, np.array([0, len(k)])).view(np.int64)
            of = pa.array(np.full(len(k), i))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(k), pa.array(np.full(len(k), len(k)))], names=["node", "component", "kmer", "n"])


def possible_pairs(open_nodes: DataFrame, kmers: DataFrame, at_least: float) -> DataFrame:
    """All pairs (a, b) of open nodes of different classes that can be similar enough, by an exact prefix filter.

    With a text's k-mers ordered from rare to frequent, two texts as similar as asked share one among the first
    few of both, early enough for the rest to make up the overlap. Texts that only share what a large
    group has in common don't meet, however large the group.
    """
    rows = open_nodes.join(kmers, "node").select("node", "component", "kmers").mapInArrow(_explode, "node long, component long, kmer long, n long")
    rows = cut(rows)
    often = rows.groupBy("kmer").agg(F.count("*").alias("df"))
    order = Window.partitionBy("node").orderBy("df", "kmer")
    ranked = rows.join(often, "kmer").withColumn("pos", F.row_number().over(order))
    heads = ranked.where(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * at_least - 1e-9) + 1).where("df > 1")
    several = heads.groupBy("kmer").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("kmer")
    heads = cut(heads.join(several, "kmer", "left_semi").select("kmer", "node", "component", "n", "pos"))
    other = heads.select("kmer", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("n").alias("m"), F.col("pos").alias("q"))
    overlap = 1 + F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("q"))
    fits = overlap >= (F.col("n") + F.col("m")) * (at_least / (1 + at_least)) - 1e-6
    return heads.join(other, "kmer").where((F.col("node") < F.col("b")) & (F.col("component") != F.col("cb")) & fits).select(F.col("node").alias("a"), "b")


def near_duplicate_classes(
    docs: DataFrame, number: Callable[[Column], Column], sketches: int = SKETCHES, ell: int = ELL, at_least: float = SIMILARITY, rounds: int = LEADER_ROUNDS
) -> tuple[DataFrame, DataFrame]:
    """(nodes, links): a row per different text, and every verified link between different texts.

    number: that of a text, from textids.numbers_of(docs).
    nodes: node, first_id (smallest doc_id of the text), first_rows (rows of the text with that id), class_node, class_id.
    links: a, b, similarity.
    """
    text = docs.select("doc_id", "text", number(F.col("text")).alias("node")).where("text is not null")
    rows = text.mapInArrow(_sketch(sketches, ell), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, sketch array<long>")
    nodes = cut(
        rows.groupBy("node", "doc_id")
        .agg(F.count("*").alias("n"), F.first("sketch").alias("sketch"))
        .groupBy("node")
        .agg(F.min(F.struct("doc_id", "n")).alias("m"), F.first("sketch").alias("sketch"))
        .select("node", F.col("m.doc_id").alias("first_id"), F.col("m.n").alias("first_rows"), "sketch")
    )
    buckets = nodes.select("node", "first_id", F.posexplode("sketch").alias("r", "bucket")).select("node", "first_id", F.xxhash64("r", "bucket").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    # The most central text of a bucket leads it: the one that meets the most others. A text has as many rows as sketches at most.
    weight = F.sum("size").over(Window.partitionBy("node"))
    members = cut(buckets.join(shared, "bucket").select("bucket", "node", "first_id", F.struct(-weight, F.col("node")).alias("rank")))
    wanted = members.select(F.col("node").alias("n"), "first_id").distinct()
    members = members.select("bucket", "node", "rank")
    own = text.join(wanted, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("first_id"))).select("node", "text")
    kmers = cut(own.mapInArrow(_kmer_rows, "node long, kmers binary").dropDuplicates(["node"]))
    tried = links = labels = None
    for turn in range(rounds + 1):
        state = members.withColumn("component", F.col("node")) if labels is None else members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        if turn < rounds:
            lead = state.groupBy("bucket").agg(F.min(F.struct("rank", "component")).alias("lead"))
            pairs = state.join(lead, "bucket").where("component <> lead.component").select(F.col("lead.rank.node").alias("a"), F.col("node").alias("b"))
        else:
            mixed = state.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
            open_nodes = state.join(mixed.select("bucket"), "bucket", "left_semi").select("node", "component").distinct()
            pairs = possible_pairs(open_nodes, kmers, at_least)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        checked = cut(verified_pairs(pairs, kmers, at_least))
        tried = checked if tried is None else tried.union(checked)
        new = checked.where("similarity > 0")
        links = new if links is None else links.union(new)
        if turn < rounds - 1:
            # The leader has met all; the next in rank leads the rest, and the last round compares what is left.
            members = _without_leaders(members)
        if not turn or not new.isEmpty():
            labels = connected_components(links, "a", "b")
    classed = nodes.drop("sketch").join(labels, "node", "left").withColumn("class_node", F.coalesce("component", "node")).drop("component")
    heads = classed.groupBy("class_node").agg(F.min("first_id").alias("class_id"))
    return cut(classed.join(heads, "class_node")), links


def _without_leaders(members: DataFrame) -> DataFrame:
    lead = members.groupBy("bucket").agg(F.min("rank").alias("lead"), F.count("*").alias("n")).where("n > 2")
    return cut(members.join(lead, "bucket").where("rank <> lead").select("bucket", "node", "rank"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """A row per row of docs: doc_id, class_id (smallest doc_id of its class), kept, n_links.

    kept marks the row that stays: one with the class's smallest id. Texts without a word have a null
    class_id and are kept. n_links counts the verified links of the row's text to different texts.
    """
    number = numbers_of(docs)
    nodes, links = near_duplicate_classes(docs, number, **options)
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    known = nodes.join(degree, "node", "left").select("node", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows = docs.select("doc_id", number(F.col("text")).alias("node"))
    return rows.join(known, "node", "left").select(
        "doc_id", "class_id", (F.col("class_id").isNull() | F.col("class_id").eqNullSafe(F.col("doc_id"))).alias("kept"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each class: that of the smallest doc_id; rows without a word all stay."""
    number = numbers_of(docs)
    nodes, _ = near_duplicate_classes(docs, number, **options)
    heads = nodes.where(F.col("first_id").eqNullSafe(F.col("class_id")))
    heads = heads.groupBy("class_node").agg(F.min(F.struct("node", "first_id", "first_rows")).alias("h")).select("h.*")
    node, first, rows = tv.free_names(docs.columns, "node", "first", "rows")
    heads = heads.select(F.col("node").alias(node), F.col("first_id").alias(first), F.col("first_rows").alias(rows))
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike("[A-Za-z0-9]|[^\\x00-\\x7F]")
    marked = docs.where(~wordless)
    key = [number(marked["text"]) == heads[node], marked["doc_id"].eqNullSafe(heads[first])]
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = marked.join(heads, key)
    once, again = kept.where(F.col(rows) == 1), kept.where(F.col(rows) > 1).dropDuplicates([node])
    return once.select(*columns).union(again.select(*columns)).union(docs.where(wordless).select(*columns))
