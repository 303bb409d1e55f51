"""Operator 2: benchmark decontamination with an FM-index for each shard of the training texts.

Method. A shard is some 1 MB of documents (or one longer document, whole). Its words become symbols: words that no benchmark
phrase holds are one symbol, and stretches of them count once, as no occurrence can reach into them. An FM-index of the
shard answers all phrases at once by backward search through wavelet ranks; rows are located by sampled suffix positions, every
32nd word of a document. Overlapping occurrences merge into removal spans.

Scale. Documents are never shuffled, each shard is indexed and dropped in one task. The benchmark is split by item into blocks of
some BLOCK_CHARS characters. One block's phrases are sent to every task at a time: a benchmark of one block takes one pass over the
documents; each further block takes a pass over what the one before wrote to the shared folder, after which its phrases are dropped.

Cases. Null or wordless documents have no words and no hits. Benchmark rows without an id or words match nothing; rows that
repeat an id are one item. Ids of any type are compared as text. Repeated documents each keep their row. Columns that
``keep`` names pass through, but for one named like the result column, which wins; ``decontaminate`` keeps all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.fm_index import FMIndex, occurrences
from tidemark.llm.shared import Scratch, without
from tidemark.llm.textops import ALNUM_LOWER, Words, utf8_parts

WINDOW, SAMPLE = 10, 32
SHARD_BYTES = 1 << 20
#: Characters of benchmark text whose phrases are sent to every task at once.
BLOCK_CHARS = 2_000_000

_RUN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
HITS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("words", _RUN), T.StructField("spans", _RUN), T.StructField("items", T.ArrayType(T.StringType()))])
_RUN_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class Phrases:
    """Distinct windows of benchmark items as rows of symbols, right-aligned, and the items of each."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int):
        held, sizes, owner = [np.empty((0, window), np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        self.names = sorted(set(ids))
        number = {x: i for i, x in enumerate(self.names)}
        for lo, hi, data, offsets in utf8_parts(texts, SHARD_BYTES):
            words = Words(data, offsets, ALNUM_LOWER)
            for i in range(hi - lo):
                own = words.hash[words.first[i] : words.first[i + 1]]
                if not len(own):
                    continue
                short = max(window - len(own), 0)  # an item of fewer words is one window
                held.append(np.lib.stride_tricks.sliding_window_view(np.concatenate((np.zeros(short, np.uint64), own)), window))
                sizes.append(np.full(len(held[-1]), window - short))
                owner.append(np.full(len(held[-1]), number[ids[lo + i]]))
        keyed = np.column_stack((np.concatenate(held), np.concatenate(sizes).astype(np.uint64)))
        distinct, which = np.unique(keyed, axis=0, return_inverse=True)
        self.sizes = distinct[:, window].astype(np.int64)
        there = np.arange(window) >= window - self.sizes[:, None]
        self.vocabulary = np.unique(distinct[:, :window][there])
        self.bits = max(2, int(len(self.vocabulary) + 1).bit_length())
        self.rows = np.where(there, np.searchsorted(self.vocabulary, distinct[:, :window]) + 2, 0)
        pairs = np.unique(np.column_stack((which.ravel(), np.concatenate(owner))), axis=0)
        self._item, self._at = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))

    def items(self, which: int) -> list[str]:
        return [self.names[i] for i in self._item[self._at[which] : self._at[which + 1]].tolist()]

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """2 and more for words of the vocabulary, 1 for others."""
        if not len(self.vocabulary):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 2, 1)


def _index(symbols: np.ndarray, first: np.ndarray, bits: int) -> tuple[FMIndex, np.ndarray]:
    """The index of a shard, and the word of each of its positions (-1 for separators)."""
    n, docs = len(symbols), len(first) - 1
    doc_of = np.repeat(np.arange(docs), np.diff(first))
    opens = np.zeros(n, bool)
    opens[first[:-1][np.diff(first) > 0]] = True
    keep = np.ones(n, bool)
    keep[1:] = (symbols[1:] != 1) | (symbols[:-1] != 1) | opens[1:]
    word = np.flatnonzero(keep)
    place = np.arange(len(word)) + doc_of[word]  # after the separators of the documents before
    text, back = np.zeros(len(word) + docs, np.int64), np.full(len(word) + docs, -1, np.int64)
    text[place], back[place] = symbols[word], word
    # A document's first position is sampled, then every SAMPLE-th, so that no walk meets a separator.
    kept_first = np.searchsorted(word, first[:-1]) + np.arange(docs)
    sampled = np.zeros(len(text), bool)
    sampled[place] = (place - kept_first[doc_of[word]]) % SAMPLE == 0
    return FMIndex(text, bits, sampled), back


def _runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _search(shared, keep: list[str], own: str):
    """Adds a block's hits to those that the column ``own`` has from blocks before, if there were any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            for lo, hi, data, offsets in utf8_parts(batch.column("text"), SHARD_BYTES):
                words = Words(data, offsets, ALNUM_LOWER)
                covered = np.zeros(len(words.hash) + 1, np.int64)
                items: dict[int, set[str]] = {}
                if own in batch.schema.names:
                    for i, before in enumerate(batch.column(own).slice(lo, hi - lo).to_pylist()):
                        if before["items"]:
                            items[i] = set(before["items"])
                            for x in before["words"]:
                                covered[words.first[i] + x["start"]] += 1
                                covered[words.first[i] + x["end"]] -= 1
                symbols = phrases.symbols(words.hash)
                if (symbols > 1).any():
                    index, back = _index(symbols, words.first, phrases.bits)
                    for which, at in occurrences(index, phrases.rows, phrases.sizes):
                        start = back[at]
                        np.add.at(covered, start, 1)
                        np.add.at(covered, start + phrases.sizes[which], -1)
                        doc = np.searchsorted(words.first, start, "right") - 1
                        for d, w in np.unique(np.stack((doc, which), 1), axis=0).tolist():
                            items.setdefault(d, set()).update(phrases.items(w))
                covered = np.cumsum(covered)[:-1] > 0
                yield _rows(batch.slice(lo, hi - lo), words, covered, items, keep, own)

    return run


def _rows(batch: pa.RecordBatch, words: Words, covered: np.ndarray, items: dict[int, set[str]], keep: list[str], own: str) -> pa.RecordBatch:
    runs, spans, found = [], [], []
    for i in range(batch.num_rows):
        a, b = words.first[i], words.first[i + 1]
        if i not in items:
            runs.append([]), spans.append([]), found.append([])
            continue
        lo, hi = _runs(covered[a:b])
        base = words.text_at[i]
        points = np.concatenate(([0], np.cumsum((words.buffer[base : words.text_at[i + 1]] & 0xC0) != 0x80)))  # of bytes, before each
        runs.append([{"start": x, "end": y} for x, y in zip(lo.tolist(), hi.tolist())])
        spans.append([{"start": x, "end": y} for x, y in zip(points[words.start[a + lo] - base].tolist(), points[words.end[a + hi - 1] - base].tolist())])
        found.append(sorted(items[i]))
    hits = pa.StructArray.from_arrays([pa.array(words.counts(), pa.int64()), pa.array(runs, _RUN_ARROW), pa.array(spans, _RUN_ARROW), pa.array(found, pa.list_(pa.string()))], ["n_words", "words", "spans", "items"])
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), hits], names=[*keep, own])


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW) -> Iterator[Phrases]:
    """The benchmark's phrases, in blocks of about BLOCK_CHARS characters of text or fewer, one after the other; at least one."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and length(text) > 0")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow()
        yield Phrases(block.column("item_id").to_pylist(), block.column("text"), window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, own: str = "hits") -> DataFrame:
    """docs(text, ...) to its columns ``keep`` and ``own``: n_words, runs of hit words and their spans in code points (ends
    exclusive), and the ids of the items found, as text."""
    spark = docs.sparkSession
    keep = without(keep, own)
    columns = list(dict.fromkeys([*keep, "text"]))

    def pass_(rows: DataFrame, phrases, kept: list[str]) -> DataFrame:
        schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(own, HITS)])
        return rows.mapInArrow(_search(phrases, kept, own), schema)

    scratch, rows, sent = None, docs.select(*(F.col(f"`{c}`") for c in columns)), None
    for phrases in phrase_blocks(benchmark, window):
        if sent is not None:
            scratch = scratch or Scratch(spark, "contamination")
            before, rows = rows, scratch.keep(pass_(rows, sent, columns), "found")
            scratch.drop(before)
            sent.unpersist()
        sent = spark.sparkContext.broadcast(phrases)
    return pass_(rows, sent, keep)


def remove_spans(text: str, spans: str):
    """A column: the text without its spans (ordered, disjoint), each replaced by a line end."""
    t, s = F.col(text), F.col(spans)
    starts = F.transform(s, lambda x: x["start"])
    ends = F.transform(s, lambda x: x["end"])
    froms, tos = F.concat(F.array(F.lit(0)), ends), F.concat(starts, F.array(F.length(t)))
    parts = F.zip_with(froms, tos, lambda a, b: F.substring(t, a + 1, b - a))
    return F.when(F.size(s) == 0, t).otherwise(F.array_join(parts, "\n"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without the passages they share with the benchmark; n_chars follows. Untouched documents stay as they are."""
    own = "__benchmark_hits"
    found = find_contamination(docs, benchmark, docs.columns, own=own)
    touched = F.size(f"{own}.spans") > 0
    cut = found.withColumn("text", remove_spans("text", f"{own}.spans"))
    length = lambda c: F.when(touched, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
    return cut.select(*(length(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))
