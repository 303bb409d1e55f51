"""An FM-index over whole numbers, on NumPy arrays: suffix order, wavelet-matrix ranks, backward search, sampled positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def suffix_order(text: np.ndarray, bits: int) -> np.ndarray:
    """Start positions of all suffixes in order; a suffix that ends comes before those that go on. Symbols are below 2**bits."""
    n = len(text)
    base = (1 << bits) + 1  # symbols and the end
    depth = 1
    while base ** (depth + 1) < 1 << 63:
        depth += 1
    key = np.zeros(n, np.int64)
    padded = np.concatenate((text.astype(np.int64) + 1, np.zeros(depth, np.int64)))
    for k in range(depth):
        key *= base
        key += padded[k : k + n]
    order = np.argsort(key)
    slots = np.arange(n)
    sorted_key = key[order]
    rank = np.zeros(n + 1, np.int64)
    while True:
        fresh = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
        starts = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank[order[slots]] = starts + 1  # 0 is past the end
        tied = ~fresh | np.concatenate((~fresh[1:], [False]))
        slots, starts = slots[tied], starts[tied]
        if not len(slots):
            return order
        here = order[slots]
        second = starts * (n + 1) + rank[np.minimum(here + depth, n)]
        by = np.argsort(second)
        order[slots] = here[by]
        sorted_key = second[by]
        depth *= 2


class FMIndex:
    """Over ``text`` (symbols below 2**bits, 0 only as a separator, which also ends it). ``sampled`` marks positions that are stored;
    there must be one at or before each position, with no separator between."""

    def __init__(self, text: np.ndarray, bits: int, sampled: np.ndarray):
        self.n, self.bits = len(text), bits
        order = suffix_order(text, bits)
        last = text[order - 1]  # the symbol before each suffix
        self.marked = sampled[order]
        self.mark_rank = np.concatenate(([0], np.cumsum(self.marked, dtype=np.int32)))
        self.positions = order[self.marked]
        self.zeros, self.ones = [], []
        for level in range(bits - 1, -1, -1):
            bit = (last >> level) & 1
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.n - int(ones[-1]))
            on = bit.astype(bool)
            last = np.concatenate((last[~on], last[on]))
        before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << bits))))[: 1 << bits]
        symbols = np.arange(1 << bits)
        self.base = before - self._down(symbols, np.zeros(1 << bits, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            on = (symbols >> (self.bits - 1 - k)) & 1
            one = ones[at]
            at = np.where(on, zeros + one, at - one)
        return at

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [from, to) of right-aligned phrases; empty ones where a phrase doesn't occur."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        width = phrases.shape[1]
        for step in range(width):
            live = live[(sizes[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = phrases[live, width - 1 - step]
            base = self.base[symbol]
            low[live] = base + self._down(symbol, low[live])
            high[live] = base + self._down(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, walking back to the nearest sampled one."""
        out = np.empty(len(rows), np.int64)
        live, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(live):
            done = self.marked[at]
            out[live[done]] = self.positions[self.mark_rank[at[done]]] + steps
            live, at = live[~done], at[~done]
            symbol, down = np.zeros(len(at), np.int64), at
            for ones, zeros in zip(self.ones, self.zeros):
                one = ones[down]
                on = ones[down + 1] > one
                symbol = symbol * 2 + on
                down = np.where(on, zeros + one, down - one)
            at = self.base[symbol] + down
            steps += 1
        return out


def occurrences(index: FMIndex, phrases: np.ndarray, sizes: np.ndarray, block: int = 500_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrase numbers, positions) of every occurrence, in blocks."""
    low, high = index.search(phrases, sizes)
    found = np.flatnonzero(high > low)
    counts = (high - low)[found]
    ends = np.cumsum(counts)
    at = 0
    while at < len(found):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at] - counts[at]) + block, "right")))
        c = counts[at:to]
        which = np.repeat(found[at:to], c)
        rows = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + low[which]
        yield which, index.locate(rows)
        at = to
