"""Packing token sequences by cutting-stock column generation.

A document's ids (and a closing id) are cut at multiples of the capacity; what remains, a piece of 1 to
capacity - 1 ids, is an item of the cutting-stock problem: few lengths, many items each. The histogram
of lengths is all the driver sees. A linear program over patterns (multisets of lengths that fill a
sequence) is solved by column generation: the simplex prices every length, a knapsack dynamic programme
finds the patterns that these prices favour, until none adds a filled sequence or nearly all tokens are
in patterns. Rounded down, then up as far as items last, patterns are
assigned to documents by their rank within their length. The few items that are left are
laid end to end and cut where sequences end; the very last sequence is split into powers of two, so no
padding is left anywhere.

Ranks come from counts per partition and length, summed over the partitions before, never from a global sort.
Null texts are empty; an empty document has only its closing id. Repeated rows are documents of their own;
null ids are carried. An empty table gives no piece. Other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm import tokens
from claimloom.session import cut

CAPACITY = 1024
CLOSING_ID = 0
#: Bounds of the linear program: simplex steps, and the share of all tokens not in patterns at which it ends.
PIVOTS = 2000
GAP = 0.005


def _knapsack(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Least price of items that fill each capacity exactly (inf: none do), and the item that comes last."""
    best, last = np.full(capacity + 1, np.inf), np.full(capacity + 1, -1)
    best[0] = 0
    for c in range(1, capacity + 1):
        k = int(np.searchsorted(sizes, c, side="right"))
        if k:
            value = best[c - sizes[:k]] + prices[:k]
            i = int(np.argmin(value))
            best[c], last[c] = value[i], i
    return best, last


def _pattern(last: np.ndarray, sizes: np.ndarray, c: int, m: int) -> np.ndarray:
    out = np.zeros(m)
    while c > 0:
        out[last[c]] += 1
        c -= sizes[last[c]]
    return out


def solve_patterns(counts: np.ndarray, capacity: int = CAPACITY, pivots: int = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """counts[s] items of size s -> (patterns, uses): whole uses of patterns over sizes 0 .. capacity - 1.

    The program is: as many filled sequences as the items of each size allow. Every pattern fills a sequence to the last id.
    """
    sizes = np.flatnonzero(counts[:capacity])
    sizes = sizes[sizes > 0]
    m = len(sizes)
    if not m:
        return np.zeros((0, capacity), dtype=np.int64), np.zeros(0, dtype=np.int64)
    need = counts[sizes].astype(float)
    basis, inverse, x = np.eye(m), np.eye(m), need.copy()  # at first all items are left over
    filled = np.zeros(m)  # of the basis: 1 for a pattern, 0 for leftovers of a size
    bound, done = float((sizes * need).sum() / capacity), 0
    large = (sizes / capacity) ** 2

    prices = np.zeros(m)

    def enter(column: np.ndarray, gain: float) -> bool:
        """A simplex step; columns are sparse, so plain sums serve better than a matrix product."""
        nonlocal x, inverse, prices
        own = np.flatnonzero(column)
        d = (inverse[:, own] * column[own]).sum(axis=1)
        ok = np.flatnonzero(d > 1e-9)
        if not len(ok):
            return False
        out = ok[np.argmin(x[ok] / d[ok])]
        step = x[out] / d[out]
        x = np.maximum(x - step * d, 0)
        x[out] = step
        row = inverse[out] / d[out]
        prices = prices + (gain - (prices[own] * column[own]).sum()) * row
        inverse -= d[:, None] * row
        inverse[out] = row
        basis[:, out], filled[out] = column, gain
        return True

    while done < pivots and (filled * x).sum() < bound * (1 - GAP):
        low = int(np.argmin(prices))
        if prices[low] < -1e-7:
            unit = np.zeros(m)
            unit[low] = 1
            if enter(unit, 0.0):
                done += 1
                continue
        spare = np.zeros(m)
        for j in np.flatnonzero(filled == 0):
            spare[np.argmax(basis[:, j])] = x[j]
        entered = 0
        # Among patterns that pay, those of large and plentiful items first.
        for favour in (0.2 * large * (0.2 + spare / max(spare.max(), 1)), np.zeros(m)):
            cost = np.maximum(prices, 0) - favour
            best, last = _knapsack(cost, sizes, capacity)
            around = cost + best[capacity - sizes]
            for k in np.argsort(around, kind="stable")[:16]:
                if not np.isfinite(around[k]):
                    break
                column = _pattern(last, sizes, capacity - sizes[k], m)
                column[k] += 1
                if (prices * column).sum() < 1 - 1e-7 and enter(column, 1.0):
                    entered += 1
            if entered:
                break
        if not entered:
            break
        done += entered
    full = np.flatnonzero(filled)
    grid, share = basis[:, full].astype(np.int64), x[full]
    uses, left = np.floor(share + 1e-9).astype(np.int64), counts[sizes].astype(np.int64)
    for p in range(len(full)):  # rounding errors of the simplex must not overdraw a length
        a = grid[:, p] > 0
        uses[p] = max(0, min(int(uses[p]), int((left[a] // grid[a, p]).min())))
        left -= uses[p] * grid[:, p]
    for p in np.argsort(-(share - np.floor(share)), kind="stable"):
        a = grid[:, p] > 0
        more = int((left[a] // grid[a, p]).min())
        uses[p] += more
        left -= more * grid[:, p]
    patterns = np.zeros((len(full), capacity), dtype=np.int64)
    patterns[:, sizes] = grid.T
    return patterns[uses > 0], uses[uses > 0]


class Plan(NamedTuple):
    """Where the item of a length and rank goes: sorted keys (length, first rank), then sequence, offset, how often a sequence."""

    key: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    times: np.ndarray
    used: np.ndarray  # ranks placed by patterns, by length
    shift: np.ndarray  # where the leftovers of a length start when laid end to end
    first_left: int  # sequence of the first leftover id
    ends: np.ndarray  # ids before each cut of the leftovers


_RANK_BITS = 44


def make_plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    patterns, uses = solve_patterns(counts, capacity)
    rows, base = [], 0
    used = np.zeros(capacity + 1, dtype=np.int64)
    for pattern, n in zip(patterns, uses):
        offset = 0
        for s in np.flatnonzero(pattern)[::-1]:
            rows.append(((int(s) << _RANK_BITS) + int(used[s]), base, offset, int(pattern[s])))
            used[s] += n * pattern[s]
            offset += s * pattern[s]
        base += int(n)
    rows.append((capacity << _RANK_BITS, base, 0, 1))
    used[capacity] = counts[capacity]
    base += int(counts[capacity])
    rows.sort()
    left = (counts - used) * np.arange(capacity + 1)
    total = int(left.sum())
    ends = list(range(0, total // capacity * capacity + 1, capacity))
    for bit in range(capacity.bit_length(), -1, -1):
        if (total % capacity) >> bit & 1:
            ends.append(ends[-1] + (1 << bit))
    table = np.array(rows, dtype=np.int64)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], used, np.concatenate(([0], np.cumsum(left)[:-1])), base, np.array(ends, dtype=np.int64))


def _pieces(file: str, capacity: int, closing: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = tokens.worker(file)
        for batch in batches:
            for lo, hi, ids, at in source.ids(batch.column(1)):
                pick, start, length, crc, total, rest = [], [], [], [], [], []
                for i in range(hi - lo):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(closing)).astype("<u4")
                    for a in range(0, len(own), capacity):
                        part = own[a : a + capacity]
                        pick.append(lo + i), start.append(a), length.append(len(part)), total.append(len(own))
                        crc.append(zlib.crc32(part))
                        small = part.astype("<u2") if not (part >> 16).any() else part
                        rest.append(small.tobytes() if len(part) < capacity else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(pick, pa.int64())), *[pa.array(v, pa.int64()) for v in (start, length, crc, total)], pa.array(rest, pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
                )
            # Else Arrow keeps what its largest batches took, and a worker lives as long as its executor.
            pa.default_memory_pool().release_unused()

    return run


def _place(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(plan.key, (length << _RANK_BITS) + rank, side="right") - 1
            inside = rank < plan.used[length]
            k = np.where(inside, rank - (plan.key[at] & ((1 << _RANK_BITS) - 1)), 0)
            sequence = plan.sequence[at] + k // plan.times[at]
            offset = plan.offset[at] + k % plan.times[at] * length
            late = plan.shift[length] + (rank - plan.used[length]) * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.where(inside, sequence, -1)), pa.array(np.where(inside, offset, late))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "uid", "sequence_id", "offset"],
            )

    return run


def _cut_rest(plan: Plan):
    """Leftovers are cut where the sequences they run through end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pick, out = [], []
            for i, (start, length, total, late, data) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(1, 6)])):
                ids = np.frombuffer(data, dtype="<u2" if len(data) == 2 * length else "<u4").astype("<u4")
                done = 0
                while done < length:
                    s = int(np.searchsorted(plan.ends, late + done, side="right")) - 1
                    n = int(min(length - done, plan.ends[s + 1] - late - done))
                    pick.append(i)
                    out.append((start + done, n, zlib.crc32(ids[done : done + n]), total, plan.first_left + s, late + done - int(plan.ends[s])))
                    done += n
            columns = list(zip(*out)) if out else [[] for _ in range(6)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(pick, pa.int64())), *[pa.array(c, pa.int64()) for c in columns]],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, file: str | None = None, capacity: int = CAPACITY, closing: int = CLOSING_ID) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = "start long, length long, ids_crc32 long, doc_tokens long"
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(file or tokens.default_file(), capacity, closing), f"doc_id {kind}, {numbers}, ids binary")
    pieces = cut(pieces.withColumn("uid", F.monotonically_increasing_id()))  # written: a table is not read again in the same partitions
    light = pieces.drop("ids").withColumn("pid", F.shiftright("uid", 33))
    by_part = cut(light.groupBy("length", "pid").agg(F.count("*").alias("n")))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length
        counts[r.length] = r.n
    plan = make_plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = by_part.select("length", "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    local = F.row_number().over(Window.partitionBy("length", "pid").orderBy("uid")) - 1
    ranked = light.withColumn("local", local).join(shift, ["length", "pid"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("local") + F.col("shift")).alias("rank"), "uid")
    placed = ranked.mapInArrow(_place(plan), f"doc_id {kind}, {numbers}, rank long, uid long, sequence_id long, offset long")
    final = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    # What rounding leaves: rows whose number the lengths and patterns bound, not the corpus.
    rest = placed.where("sequence_id < 0").select("doc_id", "start", "length", "doc_tokens", "offset", F.col("uid").alias("u"))
    rest = rest.join(pieces.select("uid", "ids"), F.col("u") == F.col("uid")).select("doc_id", "start", "length", "doc_tokens", "offset", "ids")
    late = rest.mapInArrow(_cut_rest(plan), f"doc_id {kind}, {numbers}, sequence_id long, offset long")
    return placed.where("sequence_id >= 0").select(*final).union(late.select(*final))
