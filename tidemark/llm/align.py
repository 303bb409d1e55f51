"""Operator 13: alignment of two tokenizers' vocabularies over a corpus.

Method. Each text is cut by a byte-level BPE (side A, which reads a space before the text) and by a piece model (side B, which adds that space
itself). Where a token of both ends, a group ends; the tokens that share a group are linked. The count of an id pair is the number of
documents that hold it linked. Ids of side A are dealt to stripes; a stripe's counts are a dense matrix, its own A ids by all B ids, to
which partial counts are added with np.add.at, and the maxima of its rows are the best counts. Links go to the same deal of stripes,
where their counts wait, and are scored there; sums come back a document.

Scale. One pass reads the texts. It writes links, some bytes for each id pair of a document, and partial counts that are combined in a task up
to HELD_PAIRS. Links are dealt over GROUPS of stripes and over blocks of documents, one for each BLOCK_BYTES of text, so a frequent id's links
are in as many tasks as there are blocks; only the counts of a group of stripes are repeated for each. A document comes back in GROUPS rows at most.

Pieces. Both models work on stretches of text that white space parts, which load-time checks on their vocabularies confirm (else a text is
one stretch), so a worker remembers what each short stretch gives.

Cases. Null and empty texts have no tokens, nor has a text whose tokens' bytes on either side differ from a space and the text (one with
U+2581): zeros and an empty digest. Each row is a document, also where ids repeat or are null. Columns but doc_id and text are
ignored. Empty tables give no rows. Texts of any length are cut whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, small_batches

#: Stripes of A ids (id modulo STRIPES), the groups of stripes that links are dealt over, and the bytes of text in a block of documents.
STRIPES, GROUPS, BLOCK_BYTES = 1024, 16, 1 << 30
#: A pair is A id * PAIR + B id: both vocabularies are smaller than 65,536.
PAIR = 1 << 16
#: Pairs whose counts a task holds before it sends them; links of a batch part.
HELD_PAIRS, PART_LINKS = 2_000_000, 1_000_000
#: Stretches a worker remembers and their characters; stretches that are encoded in one text; characters of texts aligned at once.
CACHE_STRETCHES, CACHE_CHARS, RUN, PART_CHARS = 300_000, 8_000_000, 64, 1 << 18
#: Token pairs of a group from which equal ids are counted first.
LARGE_GROUP = 4096
_STRETCH = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
_BYTE = re.compile("<0x([0-9A-F]{2})>")


def _byte_letters() -> dict[str, int]:
    """Byte-level BPE's letter for each byte: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, the bytes of their tokens, and remembered stretches."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        self.bytes_a = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        if max(self.bytes_a) >= PAIR or len(pieces) >= PAIR:
            raise ValueError("vocabularies of 65,536 ids or more don't fit a pair")
        # A stretch ends before a space or a line feed that follows another character: no piece may cross that, and A's own cut is at white space.
        spec = json.loads(self.a.to_str())
        cut = spec.get("pre_tokenizer") or {}
        self.apart = (
            cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and not spec.get("normalizer")
            and not any("\n" in p or re.search("[^\\s▁][▁ ]", p) for p in pieces)
            and self.b.encode("\nq", out_type=str) == ["▁", "<0x0A>", "q"] and self.b.encode(" q") == [self.b.piece_to_id("▁"), self.b.piece_to_id("▁q")]
        )
        self.space = self.b.piece_to_id("▁")
        top = max(self.bytes_a) + 1
        self.size_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(top)])
        self.size_b = np.array([len(b) for b in self.bytes_b])
        # Ids as text with what follows them: another of the same side and group, the other side, the next group.
        self.text_a = np.array([f"{i}{c}" for c in ",|" for i in range(top)], object).reshape(2, top)
        self.text_b = np.array([f"{i}{c}" for c in ",;" for i in range(len(pieces))], object).reshape(2, len(pieces))
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.spelled: list[str] = []
        self.chars = 0
        self.facts = np.empty((1 << 14, 5), np.int64)  # tokens of A, of B, groups, links; whether bytes agree
        self.pairs, self.times, self.ends = np.empty(1 << 18, np.uint32), np.empty(1 << 18, np.int64), np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of texts that begin with a space or line feed. B adds a space itself: it stands for the text's own, or, before a line
        feed, is the first token, which isn't the text's; an empty text gets none."""
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        return ids_a, [[self.space] if t == " " else x if t[0] == " " else x[1:] for t, x in zip(texts, ids_b)]

    def _bytes(self, ids_a: list[int], ids_b: list[int]) -> tuple[bytes, bytes]:
        return b"".join(map(self.bytes_a.__getitem__, ids_a)), b"".join(map(self.bytes_b.__getitem__, ids_b))

    def _encoded(self, new: list[str]) -> tuple[list[int], list[int], np.ndarray]:
        """Ids of some stretches one after the other, and which stretches' bytes agree (others give none). Those that end in no white space
        are encoded in runs, as nothing crosses from one to the next."""
        runs, open_ = [], False
        for n, s in enumerate(new):
            if not open_ or len(runs[-1]) == RUN:
                runs.append([])
            runs[-1].append(n)
            open_ = self.apart and not s[-1].isspace()
        ids_a, ids_b, agree = [], [], np.ones(len(new), np.int64)
        for run, x, y in zip(runs, *self._ids(["".join(new[n] for n in run) for run in runs])):
            raw = "".join(new[n] for n in run).encode()
            if self._bytes(x, y) != (raw, raw):
                x, y = [], []
                for n, p, q in zip(run, *self._ids([new[n] for n in run])):
                    raw = new[n].encode()
                    agree[n] = self._bytes(p, q) == (raw, raw)
                    if agree[n]:
                        x += p
                        y += q
            ids_a += x
            ids_b += y
        return ids_a, ids_b, agree

    def _learn(self, new: list[str]) -> None:
        ids_a, ids_b, agree = self._encoded(new)
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        size = np.array([len(s.encode()) for s in new]) * agree
        until, end_a, end_b = np.cumsum(size), np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cut = np.intersect1d(end_a, end_b, assume_unique=True)  # where groups end
        owner = np.searchsorted(until, cut, "left")
        group_a, group_b = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
        n_a, n_b = np.bincount(group_a, minlength=len(cut)), np.bincount(group_b, minlength=len(cut))
        facts = np.empty((len(new), 5), np.int64)
        for k, x in enumerate((n_a, n_b, np.ones(len(cut), np.int64), n_a * n_b)):
            facts[:, k] = np.bincount(owner, x, len(new))
        facts[:, 4] = agree
        # Texts: tokens of A, then of B, group by group.
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[np.cumsum(n_a) - 1] = last_b[np.cumsum(n_b) - 1] = 1
        at_a, at_b = np.arange(len(a)) + (np.cumsum(n_b) - n_b)[group_a], np.arange(len(b)) + np.cumsum(n_a)[group_b]
        words = np.empty(len(a) + len(b), object)
        words[at_a], words[at_b] = self.text_a[last_a, a], self.text_b[last_b, b]
        words, to = words.tolist(), np.cumsum(facts[:, 0] + facts[:, 1]).tolist()
        base = len(self.spelled)
        self.index |= {s: base + n for n, s in enumerate(new)}
        self.chars += sum(map(len, new))
        self.spelled += ["".join(words[x:y])[:-1] for x, y in zip([0, *to], to)]
        # Pairs: each A token by all B tokens of its group; of large groups, each id by each with both numbers.
        links = n_a * n_b
        small = np.where(links > LARGE_GROUP, 0, n_b)[group_a]
        start = np.cumsum(n_b) - n_b
        other = np.arange(int(small.sum())) + np.repeat(start[group_a] - np.cumsum(small) + small, small)
        pairs, times, whose = [np.repeat(a, small) * PAIR + b[other]], [np.ones(len(other), np.int64)], [np.repeat(owner[group_a], small)]
        for g in np.flatnonzero(links > LARGE_GROUP).tolist():
            (x, k), (y, m) = (np.unique(ids[group == g], return_counts=True) for ids, group in ((a, group_a), (b, group_b)))
            pairs.append(np.add.outer(x * PAIR, y).ravel())
            times.append(np.outer(k, m).ravel())
            whose.append(np.full(len(x) * len(y), owner[g]))
        pairs, times, whose = np.concatenate(pairs), np.concatenate(times), np.concatenate(whose)
        if (links > LARGE_GROUP).any():
            order = np.argsort(whose, kind="stable")
            pairs, times, whose = pairs[order], times[order], whose[order]
        filled, base = int(self.ends[-1]), len(self.ends) - 1
        if filled + len(pairs) > len(self.pairs):
            more = filled + 2 * len(pairs) - len(self.pairs) + len(self.pairs)
            self.pairs, self.times = (np.concatenate((x[:filled], np.empty(more - filled, x.dtype))) for x in (self.pairs, self.times))
        self.pairs[filled : filled + len(pairs)], self.times[filled : filled + len(pairs)] = pairs, times
        self.ends = np.concatenate((self.ends, filled + np.cumsum(np.bincount(whose, minlength=len(new)))))
        if base + len(new) > len(self.facts):
            self.facts = np.concatenate((self.facts[:base], np.empty((base + 2 * len(new), 5), np.int64)))
        self.facts[base : base + len(new)] = facts

    def align(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of some texts: groups as text, facts (tokens of A, of B, groups, links), and linked pairs, which may repeat, with their text's
        number and the times they are linked. A text that is empty or whose bytes differ has none."""
        cut = [(_STRETCH.findall(" " + t) if self.apart else [" " + t]) if t else [] for t in texts]
        if len(self.index) > CACHE_STRETCHES or self.chars > CACHE_CHARS:
            self._forget()
        index = self.index
        if new := list(dict.fromkeys(s for c in cut for s in c if s not in index)):
            self._learn(new)
        which = np.fromiter(map(self.index.__getitem__, chain.from_iterable(cut)), np.int64)
        ends = np.cumsum([len(c) for c in cut])
        facts = np.diff(np.concatenate((np.zeros((1, 5), np.int64), np.cumsum(self.facts[which], 0)))[np.concatenate(([0], ends))], axis=0)
        bad = facts[:, 4] < [len(c) for c in cut]
        facts[bad] = 0
        spelled, known = [], self.spelled
        for n, (x, y) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
            spelled.append("" if bad[n] else ";".join([known[i] for i in which[x:y].tolist()]))
        text = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        which, text = which[~bad[text]], text[~bad[text]]
        size = self.ends[which + 1] - self.ends[which]
        at = np.arange(int(size.sum())) + np.repeat(self.ends[which] - np.cumsum(size) + size, size)
        return spelled, facts[:, :4], self.pairs[at], np.repeat(text, size), self.times[at]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers in as few bytes as they need: for each its width and length, then all values."""
    arrays = [_narrow(a) for a in arrays]
    head = np.array([v for a in arrays for v in (a.itemsize, len(a))], "<i8")
    return b"".join([np.array([len(arrays)], "<i8").tobytes(), head.tobytes(), *(a.tobytes() for a in arrays)])


def _unpacked(blob: pa.Buffer) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, "<i8", 1)[0])
    head, at, out = np.frombuffer(blob, "<i8", 2 * n, 8), 8 + 16 * n, []
    for width, length in head.reshape(n, 2).tolist():
        out.append(np.frombuffer(blob, f"<u{width}", length, at).astype(np.int64))
        at += width * length
    return out


_PASS = "kind int, stripe int, blob binary, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_PASS_ARROW = pa.schema([("kind", pa.int32()), ("stripe", pa.int32()), ("blob", pa.binary()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())])
_FACTS, _LINKS, _COUNTS = range(3)


def _rows(kind: int, n: int, **columns) -> pa.RecordBatch:
    columns["kind"] = np.full(n, kind, np.int32)
    return pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if (x := columns.get(f.name)) is None else x if isinstance(x, pa.Array) else pa.array(x, f.type) for f in _PASS_ARROW], schema=_PASS_ARROW)


def _parts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Rows of up to PART_CHARS characters or one longer text: (from, to, texts)."""
    texts, lo, held = [], 0, 0
    for n, text in enumerate(column):
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= PART_CHARS or n + 1 == len(column):
            yield lo, n + 1, texts
            texts, lo, held = [], n + 1, 0


def _pass(path_a: str, path_b: str):
    """Of texts: a row of facts for each, its links by group of stripes, and partial counts by stripe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, codes, counts = aligner(path_a, path_b), np.empty(0, np.uint32), np.empty(0, np.int64)

        def add(more: np.ndarray, times: np.ndarray) -> None:
            nonlocal codes, counts
            codes, back = np.unique(np.concatenate((codes, more)), return_inverse=True)
            counts = np.bincount(back, np.concatenate((counts, times))).astype(np.int64)

        def sent() -> pa.RecordBatch:
            stripe = codes // PAIR % STRIPES
            order = np.argsort(stripe, kind="stable")
            cuts = np.searchsorted(stripe[order], np.arange(STRIPES + 1))
            mine = np.flatnonzero(np.diff(cuts))
            blobs = [_packed(codes[o := order[cuts[s] : cuts[s + 1]]], counts[o]) for s in mine]
            return _rows(_COUNTS, len(mine), stripe=mine, blob=blobs)

        def linked(rows: list[int], pairs: list[np.ndarray], docs: list[np.ndarray], times: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            """Links of some documents: distinct pairs, how many documents each has, and those with the times it is linked."""
            code, time = np.concatenate(pairs).astype(np.int64) * len(rows) + np.concatenate(docs), np.concatenate(times)
            once, often = np.unique(code[time == 1], return_counts=True)  # by pair, then document
            if len(more := np.flatnonzero(time > 1)):
                code, time = np.concatenate((once, code[more])), np.concatenate((often, time[more]))
                once, back = np.unique(code, return_inverse=True)
                often = np.zeros(len(once), np.int64)
                np.add.at(often, back, time)
            pair, doc = np.divmod(once, len(rows))
            start = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            counted = np.diff(np.concatenate((start, [len(pair)])))
            add(pair[start].astype(np.uint32), counted)
            group = pair // PAIR % GROUPS
            by_pair = group[start]
            mine = np.unique(by_pair)
            blobs = [_packed(pair[start][by_pair == g], counted[by_pair == g], doc[group == g], often[group == g], np.array(rows)) for g in mine]
            yield _rows(_LINKS, len(mine), stripe=mine, blob=blobs)

        rows, pairs, docs, times = [], [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal rows, pairs, docs, times, codes, counts
            if sum(map(len, pairs)):
                yield from linked(rows, pairs, docs, times)
            rows, pairs, docs, times = [], [], [], []
            if len(codes) > HELD_PAIRS:
                yield sent()
                codes, counts = codes[:0], counts[:0]

        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for lo, hi, texts in _parts(batch.column("text")):
                spelled, facts, pair, doc, time = both.align(texts)
                digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in spelled]
                n_a, n_b, n_groups, n_links = facts.T
                yield _rows(_FACTS, hi - lo, row=batch.column("row").slice(lo, hi - lo), doc_id=ids.slice(lo, hi - lo), n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links, groups_sha256=digests)
                pairs.append(pair)
                docs.append(doc + len(rows))
                times.append(time)
                rows += batch.column("row").slice(lo, hi - lo).to_pylist()
                if sum(map(len, pairs)) > PART_LINKS:
                    yield from flush()
        yield from flush()
        if len(codes):
            yield sent()

    return run


def _stripes(n_b: int):
    """Rows of one stripe follow each other: their counts are added up in a dense block, whose row maxima are the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, np.zeros((PAIR // STRIPES, n_b), np.int64)

        def out() -> pa.RecordBatch:
            mine, other = np.nonzero(block)
            count = block[mine, other]
            best = count == block.max(1)[mine]
            pair = (mine * STRIPES + now) * PAIR + other
            return pa.record_batch({"stripe": pa.array([now], pa.int32()), "counts": pa.array([_packed(pair, count, best)], pa.binary())})

        for batch in batches:
            for stripe, blob in zip(batch.column("stripe").to_pylist(), batch.column("blob")):
                if stripe != now:
                    if now is not None:
                        yield out()
                    now = stripe
                    block[:] = 0
                code, count = _unpacked(blob.as_buffer())
                np.add.at(block, (code // PAIR // STRIPES, code % PAIR), count)
        if now is not None:
            yield out()

    return run


_SCORES = pa.schema([("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _score(links: pa.Table, counts: pa.Table) -> pa.Table:
    """Links of one group of stripes and block of documents, with the counts of that group."""
    parts = [_unpacked(c.as_buffer()) for c in counts.column("counts")]
    pair, count, best = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 3
    order = np.argsort(pair)
    pair, count, best = pair[order], count[order], best[order]
    out = []
    for blob in links.column("blob"):
        mine, docs, doc, time, rows = _unpacked(blob.as_buffer())
        at = np.repeat(np.searchsorted(pair, mine), docs)
        sums = np.zeros((2, len(rows)), np.int64)
        np.add.at(sums[0], doc, time * best[at])
        np.add.at(sums[1], doc, time * count[at])
        out.append(pa.Table.from_arrays([pa.array(rows), pa.array(sums[0]), pa.array(sums[1])], schema=_SCORES))
    return pa.concat_tables(out) if out else _SCORES.empty_table()


def align_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """docs(doc_id, text, ...) to (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row; see the module's text."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "align")
    texts = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    done = scratch.keep(texts.mapInArrow(_pass(path_a, path_b), _PASS), "pass", ["kind"])
    blocks = 1 + docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // BLOCK_BYTES
    partial = done.where(F.col("kind") == _COUNTS).select("stripe", "blob")
    dealt = partial.repartition("stripe").sortWithinPartitions("stripe")
    counts = scratch.keep(dealt.mapInArrow(_stripes(aligner(path_a, path_b).b.get_piece_size()), "stripe int, counts binary"), "counts")
    links = done.where(F.col("kind") == _LINKS).select(F.col("stripe").alias("g"), (F.abs(F.xxhash64("blob")) % blocks).alias("block"), "blob")
    known = counts.select((F.col("stripe") % GROUPS).alias("g"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "counts")
    scored = links.groupBy("g", "block").cogroup(known.groupBy("g", "block")).applyInArrow(_score, "row long, n_best long, count_sum long")
    sums = scored.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    facts = done.where(F.col("kind") == _FACTS).select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return facts.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
