"""Repeated passages by sparse suffix arrays.

A document is its words (as str.split() gives them). Suffixes are retained only where content selects
them: at positions whose ``SEED``-word hash is the smallest of some ``WINDOW`` neighbouring positions.
Every run of ``LENGTH`` words then holds a retained suffix within its first ``WINDOW`` words, at the same
place in all its copies. The retained suffixes of all texts are sorted by their first ``LENGTH - WINDOW + 1`` words
(words in the order of their fingerprints), and each is compared with its neighbours: those that share these
words with the one before or behind go on. They are extended left and right to the runs of ``LENGTH`` words that they stand
for, up to ``WINDOW - 1`` words to either side; these are sorted again, ties by (doc_id, text hash, position), and
neighbours that agree in all their words repeat. Overlapping runs merge into maximal passages.

A passage that so many rows hold that they would fill a sort partition by themselves is dealt over several by a salt; its first
occurrence is found by partial aggregates and sent to all tasks. Which passages are treated so follows from a sample and
changes no result.

The first occurrence, by (doc_id, text hash, position), is kept; others go, in the same text too where they start
``LENGTH`` words behind it or more. Equal texts form one text first, and their copies are passages as a whole.
Documents under ``LENGTH`` words, null and empty ones have no passage. Rows that repeat with id and text
are one document; null ids sort first. Neighbours are equal where 96 bits of their words' fingerprints are. Other columns are
never read, and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm import textvec as tv
from claimloom.llm.textids import numbers_of
from claimloom.session import cut, release

LENGTH = 50
WINDOW = 16
SEED = 8
#: One row in so many serves to find the passages that are dealt over several partitions, at most HOT_MARKS a partition.
SAMPLE = 64
HOT_MARKS = 4


def _selected(w: tv.Words, seed: int, window: int) -> np.ndarray:
    """Selected word positions of a slice; runs that cross rows only add positions."""
    return tv.minima(tv.runs(w.hashes, seed), window)


def _samples(length: int, window: int, seed: int):
    prefix = length - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for w in tv.words(batch.column(1)):
                n = np.diff(w.starts)
                at = _selected(w, seed, window)
                row = np.searchsorted(w.starts, at, side="right") - 1
                fits = at + prefix <= w.starts[row + 1] if len(at) else np.zeros(0, dtype=bool)
                at, row = at[fits], row[fits]
                own = nodes[w.lo : w.hi]
                marks = tv.runs(w.hashes, prefix)[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((marks.view(np.int64), own))),
                        pa.array(np.concatenate((own[row], own))),
                        pa.array(np.concatenate((at - w.starts[row], -1 - n)).astype(np.int32)),
                    ],
                    names=["mark", "node", "pos"],
                )

    return run


def _windows(length: int, window: int, seed: int):
    """Runs of `length` words whose smallest seed lies at a surviving position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy())
            begin = np.concatenate(([0], np.cumsum(sizes)))
            for w in tv.words(batch.column(2)):
                seeds = tv.runs(w.hashes, seed)
                low = tv.sliding(seeds, window, np.minimum)
                row = np.repeat(np.arange(w.hi - w.lo), sizes[w.lo : w.hi])
                alive = np.zeros(len(w.hashes), dtype=bool)
                alive[values[begin[w.lo] : begin[w.hi]] + w.starts[row]] = True
                s = np.flatnonzero(alive[: len(seeds)])
                # Each of the `window` runs that a surviving suffix can stand for: is its smallest seed this one?
                x = (s[:, None] - np.arange(window)[None, :]).ravel()
                s = np.repeat(s, window)
                ok = (x >= 0) & (x < len(low))
                x, s = x[ok], s[ok]
                x = np.unique(x[low[x] == seeds[s]])
                of = np.searchsorted(w.starts, x, side="right") - 1
                ok = x + length <= w.starts[of + 1] if len(x) else np.zeros(0, dtype=bool)
                x, of = x[ok], of[ok]
                at = pa.array(of + w.lo)
                other = (tv.runs(tv.mix(w.hashes + np.uint64(1)), length)[x] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [tv.signed(tv.runs(w.hashes, length)[x]), pa.array(other), batch.column(0).take(at), batch.column(1).take(at), pa.array((x - w.starts[of]).astype(np.int32))],
                    names=["mark", "other", "doc_id", "node", "pos"],
                )

    return run


def _neighbours(apart: int, hot: np.ndarray):
    """Rows mark, other, node, pos in sorted order -> node, pos, leads of those that repeat.

    Only the first row of the current run of equal rows is remembered from batch to batch. Runs that lie in several partitions
    have their first row in `hot` (mark, other, node, pos, by mark and other).
    """
    known = np.rec.fromarrays(hot[:2], names="mark,other") if hot.shape[1] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            mark, other, node, pos = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
            new = np.ones(len(mark), dtype=bool)
            new[1:] = (mark[1:] != mark[:-1]) | (other[1:] != other[:-1])
            new[0] = last is None or (mark[0], other[0]) != last[:2]
            group = np.cumsum(new)
            heads = np.flatnonzero(new)
            head_node = np.concatenate(([last[2] if last else 0], node[heads]))
            head_pos = np.concatenate(([last[3] if last else 0], pos[heads]))
            if known is not None:
                mine = np.rec.fromarrays((mark[heads], other[heads]), names="mark,other")
                at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                found = known[at] == mine
                head_node[1:] = np.where(found, hot[2][at], head_node[1:])
                head_pos[1:] = np.where(found, hot[3][at], head_pos[1:])
            own, first = head_node[group] == node, head_pos[group]
            later = ~(own & (pos == first)) & (~own | (pos >= first + apart))
            repeats = np.bincount(group[later], minlength=len(head_node)) > 0
            tell = repeats.copy()
            tell[0] &= not told
            told = bool(repeats[group[-1]] or (not group[-1] and told))
            last = (mark[-1], other[-1], head_node[group[-1]], head_pos[group[-1]])
            leads = np.concatenate((np.ones(int(tell.sum()), dtype=bool), np.zeros(int(later.sum()), dtype=bool)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((head_node[tell], node[later]))), pa.array(np.concatenate((head_pos[tell], pos[later])).astype(np.int32)), pa.array(leads)],
                names=["node", "pos", "leads"],
            )

    return run


def _repeating(rows: DataFrame, order: list[str], apart: int) -> DataFrame:
    """(node, pos, leads) of the rows (mark, other, node, pos and what else orders them) whose mark and other occur again.

    leads marks the first by `order`; in its text others count from `apart` words behind it. The rows are sorted over all partitions by mark;
    a mark that would fill a good part of one is dealt by a salt, and its first row, found by partial aggregates, is sent along.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64("node", "pos")
    counted = cut(rows.where(F.pmod(spread, F.lit(SAMPLE)) == 0).groupBy("mark").agg(F.count("*").alias("n")).where("n > 1"))
    least = max(2, (counted.agg(F.sum("n")).first()[0] or 0) // (HOT_MARKS * parts))
    # At most HOT_MARKS a partition, as they hold that share of the sample each.
    hot = counted.where(F.col("n") > least).select("mark", F.lit(True).alias("hot"))
    marks = [r.mark for r in hot.collect()]
    first = rows.where(F.col("mark").isin(marks)).groupBy("mark", "other").agg(F.min(F.struct(*order)).alias("head"))
    heads = np.array(sorted((r.mark, r.other, r.node, r.pos) for r in first.select("mark", "other", "head.node", "head.pos").collect()), dtype=np.int64).reshape(-1, 4).T
    dealt = rows.join(F.broadcast(hot), "mark", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(spread, F.lit(4096))).otherwise(0).cast("int"))
    sorted_rows = dealt.repartitionByRange(parts, "mark", "salt").sortWithinPartitions("mark", "other", *order)
    return sorted_rows.select("mark", "other", "node", "pos").mapInArrow(_neighbours(apart, heads), "node long, pos int, leads boolean")


def _union(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal stretches [from, to) that runs of so many words from these starts cover."""
    starts = np.unique(starts)
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.concatenate(([0], gap + 1))].tolist(), (starts[np.concatenate((gap, [len(starts) - 1]))] + length).tolist()))


def _without(spans: list[tuple[int, int]], holes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for a, b in spans:
        for c, d in holes:
            if c < b and d > a:
                if c > a:
                    out.append((a, c))
                a = max(a, d)
        if a < b:
            out.append((a, b))
    return out


def _spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pick, start, size, kept = [], [], [], []
            for i, (first, later) in enumerate(zip(batch.column(1), batch.column(2))):
                gone = _union(np.asarray(later.as_py(), dtype=np.int64), length)
                for spans, stays in ((gone, False), (_without(_union(np.asarray(first.as_py(), dtype=np.int64), length), gone), True)):
                    for a, b in spans:
                        pick.append(i), start.append(a), size.append(b - a), kept.append(stays)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(pick, pa.int64())), pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(kept, pa.bool_())],
                names=["node", "start_word", "n_words", "kept"],
            )

    return run


def text_spans(docs: DataFrame, number: Callable[[Column], Column], length: int = LENGTH, window: int = WINDOW, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(spans by text, texts): node, start_word, n_words, kept; and node, first_id, n_words, copies. number: textids.numbers_of(docs)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.where("text is not null").select("doc_id", number(F.col("text")).alias("node"))
    heads = cut(
        rows.groupBy("node", "doc_id").agg(F.lit(1).alias("one")).groupBy("node").agg(F.min(F.struct("doc_id")).alias("m"), F.count("*").alias("copies"))
        .select("node", F.col("m.doc_id").alias("first_id"), "copies")
    )
    own = docs.where("text is not null").select("doc_id", "text", number(F.col("text")).alias("node"))
    wanted = heads.select(F.col("node").alias("n"), "first_id")
    # One row of each text; ids spread even a very large group of copies over the tasks.
    single = own.join(wanted, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    samples = cut(single.select("node", "text").mapInArrow(_samples(length, window, seed), "mark long, node long, pos int"))
    sizes = samples.where("pos < 0").groupBy("node").agg(F.max(-1 - F.col("pos")).alias("n_words"))
    suffixes = samples.where("pos >= 0").withColumn("other", F.lit(0))
    alive = _repeating(suffixes, ["node", "pos"], 1).groupBy("node").agg(F.sort_array(F.collect_set("pos")).alias("pos"))
    alive = alive.join(heads.select("node", "first_id"), "node").select(F.col("node").alias("n"), "first_id", "pos")
    joined = single.join(alive, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("first_id"))).select("doc_id", "node", "text", "pos")
    runs = cut(joined.mapInArrow(_windows(length, window, seed), f"mark long, other int, doc_id {kind}, node long, pos int"))
    found = _repeating(runs, ["doc_id", "node", "pos"], length)
    each = found.groupBy("node").agg(
        F.collect_set(F.when(F.col("leads"), F.col("pos"))).alias("first"), F.collect_set(F.when(~F.col("leads"), F.col("pos"))).alias("later")
    )
    texts = cut(heads.join(sizes, "node"))
    copied = texts.where(F.col("copies") > 1).where(F.col("n_words") >= length).select("node", F.col("n_words").alias("whole"))
    none = F.expr("cast(array() as array<int>)")
    each = each.join(copied, "node", "full").select(
        "node",
        F.when(F.col("whole").isNotNull(), F.sequence(F.lit(0), F.col("whole") - length)).otherwise(F.col("first")).alias("first"),
        F.coalesce("later", none).alias("later"),
    )
    spans = cut(each.mapInArrow(_spans(length), "node long, start_word int, n_words int, kept boolean"))
    release(samples, runs, heads)
    return spans, texts


def repeated_passages(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """A row per passage of a document: doc_id, start_word, n_words, kept (the first occurrence).

    A copy of an earlier document is one passage of all its words.
    """
    number = numbers_of(docs)
    spans, texts = text_spans(docs, number, length, **options)
    copied = texts.where(F.col("copies") > 1).where(F.col("n_words") >= length)
    own = spans.join(texts.select("node", F.col("first_id").alias("doc_id")), "node").select("doc_id", "start_word", "n_words", "kept")
    rows = docs.where("text is not null").select("doc_id", number(F.col("text")).alias("node")).distinct()
    later = rows.join(copied.select("node", "first_id", "n_words"), "node").where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    return own.union(later.select("doc_id", F.lit(0).alias("start_word"), "n_words", F.lit(False).alias("kept")))


def _cut_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: text, starts, sizes, then the rest; text loses the words of the given spans."""
    for batch in batches:
        raw = batch.column(0)
        texts: list = raw.to_pylist()
        for w in tv.words(raw):
            for i in range(w.lo, w.hi):
                starts = batch.column(1)[i].as_py()
                if starts and texts[i] is not None:
                    data, at = texts[i].encode(), w.starts[i - w.lo]
                    out, done = [], 0
                    for a, n in sorted(zip(starts, batch.column(2)[i].as_py())):
                        out.append(data[done : w.first[at + a]])
                        done = w.last[at + a + n - 1]
                    texts[i] = b"".join([*out, data[done:]]).decode()
        yield pa.RecordBatch.from_arrays([pa.array(texts, raw.type), *batch.columns[3:]], names=[batch.schema.names[0], *batch.schema.names[3:]])


def without_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """docs with every later occurrence of a passage cut from its text (n_chars, if there, follows).

    No row goes: a text that is a passage as a whole is left empty.
    """
    number = numbers_of(docs)
    spans, texts = text_spans(docs, number, length, **options)
    gone = spans.where("not kept").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("start_word", "n_words"))).alias("g"))
    plan = texts.join(gone, "node", "left").where((F.col("copies") > 1) | F.col("g").isNotNull())
    key, first, size, gone, starts, sizes = tv.free_names(docs.columns, "key", "first", "size", "gone", "starts", "sizes")
    plan = plan.select(F.col("node").alias(key), F.col("first_id").alias(first), F.col("n_words").alias(size), F.col("g").alias(gone))
    both = docs.join(plan, number(docs["text"]) == plan[key], "left")
    copy = ~F.col(first).eqNullSafe(F.col("doc_id")) & F.col(key).isNotNull() & (F.col(size) >= length)
    starts_of = F.when(copy, F.array(F.lit(0))).otherwise(F.col(f"{gone}.start_word"))
    sizes_of = F.when(copy, F.array(F.col(size))).otherwise(F.col(f"{gone}.n_words"))
    others = [c for c in docs.columns if c != "text"]
    ready = both.select("text", starts_of.alias(starts), sizes_of.alias(sizes), *[F.col(f"`{c}`") for c in others])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [docs.schema["text"], *(docs.schema[c] for c in others)])
    out = ready.mapInArrow(_cut_text, kinds)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
