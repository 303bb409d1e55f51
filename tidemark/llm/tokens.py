"""Token ids of whole texts, with a bounded cache of what each piece of text encodes to.

Pieces are what lies between ASCII white space: the vocabulary's normaliser turns that into one space and its pre-tokeniser drops
it, so a text's ids are those of its pieces in order. In plain texts (ASCII without apostrophes, and Latin letters) runs of letters
and of other characters are pieces of their own, and a run of letters goes straight to the BPE model. Probes decide, when a
vocabulary is loaded, whether it works that way; the tests compare with whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np

#: Distinct pieces a worker remembers, and the longest piece (characters) that it does.
CACHE_PIECES, CACHE_PIECE_CHARS = 300_000, 48
#: Bytes of text whose pieces are held at once; a longer text is cut at white space.
HELD_BYTES = 1 << 18
_SPACE = re.compile(rb"[\t-\r ]")
_PLAIN_TEXT = re.compile("[\t\n\r\x20-\x26\x28-\x7eÀ-ÖØ-öø-ÿ]*")
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_PIECES = re.compile("[a-zß-öø-ÿ]+|[^\\sa-zß-öø-ÿ]+")
#: Byte-level BPE's stand-ins for bytes that don't stand for themselves.
_STAND_INS = {b: 290 + b - 128 for b in range(128, 161)} | {173: 323}
_PROBES = ("hello", "WORLD.", "Straße,", "àÖþ. ,(x1y)22", "q - r", "a..b!?C")


def _parts(text: bytes) -> Iterable[bytes]:
    """The text in parts of HELD_BYTES or somewhat more, cut before white space."""
    at = 0
    while len(text) - at > HELD_BYTES and (space := _SPACE.search(text, at + HELD_BYTES)):
        yield text[at : space.start()]
        at = space.start()
    yield text[at:]


class _Index(dict):
    """Piece to its number; a new piece gets the next number and waits in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class PieceTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.plain = self.tokenizer.model, True
        self._forget()
        try:
            self.plain = [self.ids(p.encode()).tolist() for p in _PROBES] == [self._pipeline([p])[0] for p in _PROBES]
        except Exception:  # another kind of model
            self.plain = False
        self._forget()

    def _forget(self) -> None:
        self.index, self.known = _Index(), 0
        self.flat, self.filled = np.empty(1 << 20, np.uint32), 0
        self.start, self.size = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)

    def _pipeline(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        if not self.plain:
            return self._pipeline(pieces)
        model, out, other = self.model.tokenize, [], []
        for piece in pieces:
            if piece.isascii():
                if piece.isalpha() and piece.islower():
                    out.append([t.id for t in model(piece)])
                    continue
            elif _LETTERS.fullmatch(piece):
                out.append([t.id for t in model(piece.encode().decode("latin-1").translate(_STAND_INS))])
                continue
            other.append(len(out))
            out.append(None)
        for i, ids in zip(other, self._pipeline([pieces[i] for i in other]) if other else ()):
            out[i] = ids
        return out

    def _learn(self) -> None:
        ids = self._encode(self.index.new)
        self.index.new = []
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        ends = self.filled + np.cumsum(sizes)
        need, total = int(ends[-1]), len(self.index)
        if need > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.filled], np.empty(2 * need - self.filled, np.uint32)))
        if total > len(self.start):
            grown = np.empty(2 * total - self.known, np.int64)
            self.start, self.size = np.concatenate((self.start[: self.known], grown)), np.concatenate((self.size[: self.known], grown))
        self.flat[self.filled : need] = np.fromiter(chain.from_iterable(ids), np.uint32, need - self.filled)
        self.start[self.known : total], self.size[self.known : total] = ends - sizes, sizes
        self.filled, self.known = need, total

    def _pieces(self, text: bytes) -> Iterable[str]:
        if self.plain:
            whole = text.decode("utf-8", "replace")
            if _PLAIN_TEXT.fullmatch(whole):
                return _PIECES.findall(whole.lower())
        return [c.decode("utf-8", "replace") for c in text.split()]

    def many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, one after the other, and where each text's begin (then their number)."""
        out, sizes = [np.empty(0, np.uint32)], np.zeros(len(texts), np.int64)
        group, owners, held = [], [], 0

        def encode() -> None:
            ids, at = self._group(group)
            out.append(ids)
            np.add.at(sizes, owners, np.diff(at))

        for i, text in enumerate(texts):
            for part in _parts(text):
                group.append(part)
                owners.append(i)
                held += len(part)
                if held >= HELD_BYTES:
                    encode()
                    group, owners, held = [], [], 0
        if group:
            encode()
        return np.concatenate(out), np.concatenate(([0], np.cumsum(sizes)))

    def _group(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self._pieces(t) for t in texts]
        if max((max(map(len, c), default=0) for c in cut), default=0) > CACHE_PIECE_CHARS:
            parts = [self._with_long(c) for c in cut]
            return np.concatenate([np.empty(0, np.uint32), *parts]), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        ids, ends = self._cached(list(chain.from_iterable(cut)))
        at = np.concatenate(([0], np.cumsum([len(c) for c in cut])))
        return ids, np.concatenate(([0], ends))[at]

    def ids(self, text: bytes) -> np.ndarray:
        return self.many([text])[0]

    def _cached(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > CACHE_PIECES:
            self._forget()
        which = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        if len(self.index) > self.known:
            self._learn()
        size = self.size[which]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[which] - ends + size, size)
        return self.flat[at], ends

    def _with_long(self, pieces: Iterable[str]) -> np.ndarray:
        out, short = [], []
        for p in pieces:
            if len(p) <= CACHE_PIECE_CHARS:
                short.append(p)
            else:
                out += [self._cached(short)[0], np.array(self._encode([p])[0], np.uint32)]
                short = []
        return np.concatenate([*out, self._cached(short)[0]])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> PieceTokenizer:
    """One for each vocabulary and worker."""
    return PieceTokenizer(path)
