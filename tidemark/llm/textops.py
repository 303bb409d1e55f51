"""Vectorised words, word hashes and n-gram hashes over the UTF-8 bytes of an Arrow column of texts.

A word's hash is a polynomial over its bytes modulo 2**64, taken from one running sum over the whole buffer, so the cost
is a few array operations a byte and no Python object a word. Hashes are 64 bits wide and equal in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Fixed character classes, as bytes of UTF-8.
WHITE = bytes([0x20, *range(0x09, 0x0E)])
#: [\x00-\x2F\x3A-\x60\x7B-\x7F], what separates lower-cased alphanumeric words.
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two xor-multiply rounds); works on a copy."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, _U)
    out[0] = 1
    have = 1
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * _U(pow(base, have, 1 << 64))
        have += take
    return out


class _Powers:
    """Powers of the base and of its inverse; a worker keeps those for buffers up to MOST bytes, longer ones are worked out anew."""

    MOST = 1 << 22
    up = _powers(_BASE, 2)
    down = _powers(_INVERSE, 2)

    @classmethod
    def at_least(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) >= n:
            return cls.up, cls.down
        made = _powers(_BASE, n + n // 16), _powers(_INVERSE, n + n // 16)
        if n <= cls.MOST:
            cls.up, cls.down = made
        return made


class Alphabet:
    """Which bytes separate words, and the value of each other byte; ``lower`` folds A-Z before anything else."""

    def __init__(self, separators: bytes, lower: bool):
        fold = np.arange(256, dtype=np.uint8)
        if lower:
            fold[65:91] += 32
        inside = np.ones(256, bool)
        inside[list(separators)] = False
        self.fold, self.inside = fold, inside[fold]
        self.value = mix(np.arange(1, 257, dtype=_U))[fold]


SPACED = Alphabet(WHITE, lower=False)
SPACED_LOWER = Alphabet(WHITE, lower=True)
ALNUM_LOWER = Alphabet(NOT_ALNUM, lower=True)


class Words:
    """Words of some texts: ``start`` and ``end`` (bytes), ``hash``, and ``first`` (index of each text's first word, then their number)."""

    __slots__ = ("start", "end", "hash", "first", "buffer", "text_at", "running", "down")

    def __init__(self, buffer: np.ndarray, text_at: np.ndarray, alphabet: Alphabet):
        n = len(buffer)
        self.buffer, self.text_at = buffer, text_at
        inside = alphabet.inside[buffer]
        breaks = np.zeros(n + 1, bool)
        breaks[text_at] = True
        before, after = np.empty(n, bool), np.empty(n, bool)
        if n:
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
        self.start = np.flatnonzero(inside & (~before | breaks[:-1]))
        self.end = np.flatnonzero(inside & (~after | breaks[1:])) + 1
        up, self.down = _Powers.at_least(n + 1)
        running = np.zeros(n + 1, _U)
        values = alphabet.value[buffer]
        values *= up[:n]
        np.cumsum(values, out=running[1:])
        self.running = running
        self.hash = mix((running[self.end] - running[self.start]) * self.down[self.start])
        self.first = np.searchsorted(self.start, text_at)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def beginnings(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first ``size`` bytes of words that have more, and which words those are."""
        which = np.flatnonzero(self.end - self.start > size)
        at = self.start[which]
        return mix((self.running[at + size] - self.running[at]) * self.down[at] + _U(size)), which


_STEP = _U(0xD1342543DE82EF95)


def ngrams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's n-grams, in text order, and the index of each text's first one. Texts of fewer words have none."""
    total = len(hashes)
    if total < n:
        return np.empty(0, _U), np.zeros(len(first), np.int64)
    rolled = np.zeros(total - n + 1, _U)
    for k in range(n):
        rolled *= _STEP
        rolled += hashes[k : total - n + 1 + k]
    counts = np.diff(first)
    grams = np.maximum(counts - (n - 1), 0)
    at = np.zeros(len(first), np.int64)
    np.cumsum(grams, out=at[1:])
    keep = np.ones(total - n + 1, bool)
    owner_end = np.repeat(first[1:], counts)[: total - n + 1]
    keep &= np.arange(total - n + 1) + n <= owner_end
    return mix(rolled[keep] + _U(n)), at


def sequence_hash(hashes: np.ndarray) -> np.ndarray:
    """One hash for a whole short word sequence, apart from any n-gram's by its length."""
    h = 0
    for x in hashes.tolist():
        h = (h * int(_STEP) + x) & 0xFFFFFFFFFFFFFFFF
    return mix(np.array([(h + len(hashes)) & 0xFFFFFFFFFFFFFFFF], _U))


def utf8_parts(column: pa.Array | pa.ChunkedArray, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of up to ``most`` bytes (or one longer row): (from, to, bytes, offsets). A null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
