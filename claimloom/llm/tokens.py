"""Token ids of whole Arrow columns, equal to those of a byte-level BPE tokenizer file.

Byte-level BPE never merges across pre-tokens, and pre-tokens repeat. The pre-tokens of a slice are cut
and hashed by numpy over its code points; each different one goes through the tokenizer once and its ids
are kept in a bounded table. Texts with characters outside a range whose classes all Unicode versions
agree on, or with the file's special tokens spelled out, go through the tokenizer as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from claimloom.llm import textvec as tv

_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4
_SAFE = 0x250
_CLASS = np.full(_SAFE, _OTHER, dtype=np.uint8)
for _c in range(_SAFE):
    _kind = unicodedata.category(chr(_c))
    if _kind[0] == "L":
        _CLASS[_c] = _LETTER
    elif _kind[0] == "N":
        _CLASS[_c] = _NUMBER
    elif chr(_c).isspace() and _c not in (0x1C, 0x1D, 0x1E, 0x1F):
        _CLASS[_c] = _SPACE
_CODE = np.random.default_rng(9).integers(1, 2**63, _SAFE, dtype=np.uint64)
#: Pre-tokens kept at once, and table slots for them.
_MOST, _SLOTS = 1 << 20, 1 << 21


def default_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pre_tokens(c: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in code points c of texts that start at at[:-1]."""
    n = len(c)
    k = _CLASS[c]
    head = np.zeros(n + 1, dtype=bool)
    head[at[:-1]] = True
    head = head[:n]
    before = np.empty(n, dtype=np.uint8)
    before[1:], before[:1] = k[:-1], 0
    before[head] = 0
    space = k == _SPACE
    blank = np.zeros(n, dtype=bool)
    blank[1:] = c[:-1] == 32
    start = k != before
    start[~space & (before == _SPACE) & blank & ~head] = False
    # The last of several spaces before a word stands apart from the others.
    ends = np.zeros(n, dtype=bool)
    ends[:-1] = space[:-1] & ~space[1:] & ~head[1:]
    start |= ends
    start |= head
    quote = np.flatnonzero((c == 39) & start)
    # A quote behind an absorbed blank is no start; what follows decides about the others.
    stop = at[np.searchsorted(at, quote, side="right")] if len(quote) else quote

    def char(d: int) -> np.ndarray:
        p = quote + d
        return np.where(p < stop, c[np.minimum(p, n - 1)], 0)

    one, two = char(1), char(2)
    single = np.isin(one, [ord(x) for x in "stmd"])
    double = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for mask, size in ((single, 1), (double & ~single, 2)):
        q = quote[mask]
        start[q + 1] = False
        after = q + 1 + size
        ok = after < stop[mask]
        after = after[ok]
        start[after[k[after] == _LETTER]] = True
    return np.flatnonzero(start)


def _merger(file: str):
    """A faster merging of the file's own vocabulary, for pre-tokens set apart by line feeds.

    It merges by the rank of the result, which equals the file's rule where ids follow the order of its
    merges; None for other files.
    """
    import json

    import tiktoken

    with open(file) as f:
        model = json.load(f)["model"]
    vocabulary = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [vocabulary.get("".join(p), -1) for p in pairs]
    if any(a >= b for a, b in zip(ids, ids[1:])):
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    parts = {x for p in pairs for x in p} | {"".join(p) for p in pairs} | set(shown)
    ranks = {bytes(shown[x] for x in t): i for t, i in vocabulary.items() if t in parts}
    return tiktoken.Encoding("own", pat_str=r"[^\n]+|\n", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class TokenIds:
    """ids(column) gives (lo, hi, ids of rows lo to hi, their starts), without special tokens."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merger = _merger(file)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(_SLOTS, dtype=np.uint64)
        self.entry = np.full(_SLOTS, -1, dtype=np.int32)
        self.pool, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.begin, self.size, self.count = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64), 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry numbers, -1 for hashes that aren't there."""
        slot = (h & np.uint64(_SLOTS - 1)).astype(np.int64)
        out = self.entry[slot]
        todo = np.flatnonzero((out >= 0) & (self.keys[slot] != h))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (_SLOTS - 1)
            out[todo] = self.entry[slot[todo]]
            todo = todo[(out[todo] >= 0) & (self.keys[slot[todo]] != h[todo])]
        return out

    def _add(self, hashes: np.ndarray, words: list[str]) -> None:
        """Ids of new pre-tokens: one call for all, set apart by line feeds, whose id occurs in no other pre-token."""
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        blank = np.array([w.isspace() for w in words], dtype=bool)
        order = np.concatenate((np.flatnonzero(~blank), np.flatnonzero(blank)))
        lines = "\n".join([w for w in words if not w.isspace()])
        flat = np.array(self.merger(lines) if self.merger else self.tokenizer.encode(lines, add_special_tokens=False).ids, dtype=np.uint32)
        stops = np.append(np.flatnonzero(flat == feed), len(flat))
        size = np.diff(np.concatenate(([-1], stops))) - 1
        flat = flat[flat != feed]
        if blank.all():
            size = size[:0]
        for e in self.tokenizer.encode_batch([w for w in words if w.isspace()], add_special_tokens=False):
            flat, size = np.append(flat, np.array(e.ids, dtype=np.uint32)), np.append(size, len(e.ids))
        assert len(size) == len(words)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        while self.count + len(words) > len(self.begin):
            self.begin, self.size = np.append(self.begin, np.zeros_like(self.begin)), np.append(self.size, np.zeros_like(self.size))
        self.pool[self.used : self.used + len(flat)] = flat
        own = slice(self.count, self.count + len(words))
        self.begin[own] = self.used + np.concatenate(([0], np.cumsum(size)[:-1]))
        self.size[own] = size
        number, h = np.arange(self.count, self.count + len(words), dtype=np.int32), hashes[order]
        self.used, self.count = self.used + len(flat), self.count + len(words)
        slot = (h & np.uint64(_SLOTS - 1)).astype(np.int64)
        while len(h):
            free = np.flatnonzero(self.entry[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.keys[slot[put]], self.entry[slot[put]] = h[put], number[put]
            rest = np.ones(len(h), dtype=bool)
            rest[put] = False
            h, number, slot = h[rest], number[rest], (slot[rest] + 1) & (_SLOTS - 1)

    def _plain(self, data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = data.decode()
        c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        if not len(c):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(at), dtype=np.int64)
        start = pre_tokens(c, at)
        size = np.diff(np.append(start, len(c)))
        value = _CODE[c] * tv.powers(tv._MULT, int(size.max()))[tv.ragged(np.zeros_like(size), size)]
        h = tv.mix(np.add.reduceat(value, start) + size.astype(np.uint64))
        found = self._find(h)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = np.unique(h[missing], return_index=True)
            if self.count + len(new) > _MOST:
                self._clear()
                new, first = np.unique(h, return_index=True)
                missing = np.arange(len(h))
            spots = missing[first]
            for i in range(0, len(spots), 20_000):
                part = spots[i : i + 20_000]
                words = [text[a:b] for a, b in zip(start[part].tolist(), (start[part] + size[part]).tolist())]
                self._add(h[part], words)
            found = self._find(h)
        n = self.size[found]
        total = np.concatenate(([0], np.cumsum(n)))
        return self.pool[tv.ragged(self.begin[found], n)], total[np.searchsorted(start, at)]

    def ids(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        data, offsets = tv.raw(column)
        for lo, hi in tv.row_slices(offsets):
            b, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            odd = np.flatnonzero(b >= 0xC9)  # lead bytes from U+0240 on
            rows = set((np.searchsorted(at, odd, side="right") - 1).tolist())
            whole = b.tobytes()
            for s in self.special:
                p = whole.find(s.encode())
                while p >= 0:
                    rows.add(int(np.searchsorted(at, p, side="right")) - 1)
                    p = whole.find(s.encode(), p + 1)
            if not rows:
                chars = np.concatenate(([0], np.cumsum((b & 0xC0) != 0x80)))[at]
                yield lo, hi, *self._plain(whole, chars)
                continue
            for i in range(lo, hi):
                part = whole[at[i - lo] : at[i - lo + 1]]
                if i - lo in rows:
                    own = np.array(self.tokenizer.encode(part.decode(), add_special_tokens=False).ids, dtype=np.uint32)
                    yield i, i + 1, own, np.array([0, len(own)])
                else:
                    yield i, i + 1, *self._plain(part, np.array([0, len(part.decode())]))


@lru_cache(maxsize=2)
def worker(file: str) -> TokenIds:
    """One table a Python worker."""
    return TokenIds(file)
