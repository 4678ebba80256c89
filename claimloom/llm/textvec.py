"""Words, word hashes and window hashes of whole Arrow batches, without a Python object per word.

A string column is read as its bytes and offsets; every step is a few passes of numpy over the
bytes or the words of a slice of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_RNG = np.random.default_rng(20240601)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_WORD_MULT = np.uint64(0xD6E8FEB86659FD93)
#: White space as str.split() sees it, in UTF-8: single bytes, then longer sequences.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LONG_SPACE = {
    0xC2: [(0x85,), (0xA0,)],
    0xE1: [(0x9A, 0x80)],
    0xE2: [(0x80, x) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)] + [(0x81, 0x9F)],
    0xE3: [(0x80, 0x80)],
}
#: Letters, digits and everything beyond ASCII.
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words(NamedTuple):
    """The words of rows lo to hi of a column; starts[i] to starts[i + 1] are those of row lo + i."""

    lo: int
    hi: int
    hashes: np.ndarray
    starts: np.ndarray
    first: np.ndarray  # of each word, its byte in the row's text
    last: np.ndarray  # and the byte behind it
    heads: tuple = ()  # for each prefix length asked for: the words that long, and their prefixes' hashes


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """Names for columns of one's own that clash with none of the given, in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers_of(mult: int, size: int) -> np.ndarray:
    out = np.full(size, mult, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(mult: np.uint64, n: int) -> np.ndarray:
    return _powers_of(int(mult), 1 << max(10, int(n).bit_length()))[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return data, offsets if len(offsets) else np.zeros(1, dtype=np.int64)


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole rows of at most so many bytes; a longer row is a run of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def _spaces(b: np.ndarray) -> np.ndarray:
    space = _SPACE[b]
    for lead, tails in _LONG_SPACE.items():
        at = np.flatnonzero(b == lead)
        for tail in tails:
            p = at[at + len(tail) < len(b)]
            for k, x in enumerate(tail, 1):
                p = p[b[p + k] == x]
            for k in range(len(tail) + 1):
                space[p + k] = True
    return space


def words(column: pa.Array, alnum: bool = False, limit: int = SLICE_BYTES, prefixes: tuple[int, ...] = ()) -> Iterator[Words]:
    """Words as str.split() gives them, or lower-cased (ASCII) runs of letters and digits."""
    data, offsets = raw(column)
    for lo, hi in row_slices(offsets, limit):
        b, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        if alnum:
            inside, b = _ALNUM[b], _LOWER[b]
        else:
            inside = ~_spaces(b)
        head = inside.copy()
        head[1:] &= ~inside[:-1]
        cuts = at[:-1][at[:-1] < len(b)]
        head[cuts] = inside[cuts]
        first = np.flatnonzero(head)
        kept = np.flatnonzero(inside)
        begin = np.searchsorted(kept, first)
        size = np.diff(np.append(begin, len(kept)))
        pos = np.arange(len(kept)) - np.repeat(begin, size)
        value = _BYTE[b[kept]]
        heads = []
        if len(kept):
            value *= powers(_MULT, int(size.max()))[pos]
            h = mix(np.add.reduceat(value, begin) + size.astype(np.uint64))
            total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(value))) if prefixes else value
            for n in prefixes:
                long = np.flatnonzero(size >= n)
                heads.append((long, mix(total[begin[long] + n] - total[begin[long]] + np.uint64(n << 32))))
        else:
            h = np.zeros(0, dtype=np.uint64)
        starts = np.searchsorted(first, at)
        row = np.repeat(np.arange(hi - lo), np.diff(starts))
        yield Words(lo, hi, h, starts, first - at[row], first + size - at[row], tuple(heads))


def runs(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of so many words; out[i] covers h[i : i + length], across rows too."""
    n = len(h)
    if n < length:
        return np.zeros(0, dtype=np.uint64)
    up = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * powers(_WORD_MULT, n), out=up[1:])
    down = _powers_of(pow(int(_WORD_MULT), -1, 2**64), 1 << max(10, n.bit_length()))[: n - length + 1]
    return mix((up[length:] - up[: n - length + 1]) * down)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1 ... for sizes[0] numbers, then the same from starts[1]."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return np.arange(total) + shift


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles row by row, and each row's start among them.

    A row with fewer than k words but at least one has a single shingle of all its words.
    """
    n = np.diff(w.starts)
    full = runs(w.hashes, k)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out = np.zeros(int(count.sum()), dtype=np.uint64)
    at = np.concatenate(([0], np.cumsum(count)))
    long = n >= k
    out[ragged(at[:-1][long], count[long])] = full[ragged(w.starts[:-1][long], count[long])]
    for i in np.flatnonzero((n > 0) & ~long):
        out[at[i]] = runs(w.hashes[w.starts[i] : w.starts[i + 1]], int(n[i]))[0]
    return out, at


def labelled(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shingles labelled with their occurrence: the second of two equal ones in a row differs."""
    row = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
    key = s ^ mix(row + np.uint64(1))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    nth = np.empty(len(s), dtype=np.uint64)
    nth[order] = (np.arange(len(s)) - start).astype(np.uint64)
    return np.where(nth > 0, mix(s + nth * _MULT), s)


def sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op (minimum or maximum) over every run of so many values, by doubling."""
    if len(x) < width:
        return x[:0]
    out, done = x, 1
    while done < width:
        step = min(done, width - done)
        out = op(out[:-step] if step else out, out[step:])
        done += step
    return out


def minima(x: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the smallest value of at least one run of so many values."""
    low = sliding(x, width, np.minimum)
    if not len(low):
        return np.zeros(0, dtype=np.int64)
    edge = np.zeros(width - 1, dtype=x.dtype)
    best = sliding(np.concatenate((edge, low, edge)), width, np.maximum)
    return np.flatnonzero(best == x)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))
