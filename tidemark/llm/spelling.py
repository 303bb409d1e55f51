"""Operator 11: groups of spelling variants by letter-parity bitmask bands.

Method. A word's mask has a bit for each letter that it holds an odd number of times. One inserted or deleted letter flips one bit,
one replaced letter two at most, so of the mask's three bands one at least is equal. Words of equal or neighbouring length meet at
equal bands, and the pair is verified by its edit distance once, at the first key that it shares.

Bands alone meet 1.6 billion pairs for the 179,000 words of 0.1 GB, as frequent letters say little. One edit also leaves
the shorter word's first or last half whole; so a band is joined together with that half, which loses no pair.

Counting. Tasks count words in a dictionary of bounded size and send partial counts; no key holds more rows than there are tasks and flushes.

Joins. Every joined table grows with the vocabulary, and the size of its files, which a plan goes by even after an explode, is a small part of its size
in memory. All joins are merged, so that none is gathered on the driver to be broadcast.

Cases. A null text has no words; a null id counts as the empty text where runs are hashed. Repeated rows count each. Empty tables give no
rows. Other columns are ignored. Runs of any length are words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, small_batches

#: Fixed values of the task: letters of a word, its least length, the least occurrences, the modulus that picks runs to damage.
_RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_CHARS, LEAST_COUNT, DAMAGED = 6, 5, 199
#: A form has at least so many times the word's occurrences.
FORM_FACTOR = 5
#: Bits of a mask, dealt to the bands in turn, so that frequent letters are in different ones.
MASK_BITS, BANDS = 63, 3
#: Distinct words that a task counts before it sends them.
HELD_WORDS = 200_000

_LOWER = {c: c + 32 for c in range(65, 91)}
#: Bytes of texts whose characters beyond ASCII are all between U+00C0 and U+00FF: letters stay, the rest separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 0x80 <= b <= 0xBF or b == 0xC3 else 32 for b in range(256))
_OTHER = re.compile(b"[\xc2\xc4-\xff]")


def runs(text: bytes) -> list[bytes]:
    """Maximal runs of letters, A-Z lower-cased, as UTF-8."""
    if text.isascii() or not _OTHER.search(text):
        return text.translate(_FOLD).split()
    return [r.encode() for r in _RUN.findall(text.decode("utf-8", "replace").translate(_LOWER))]


def words(doc_id: int | None, text: bytes) -> Iterator[bytes]:
    """Runs of LEAST_CHARS code points or more, after the damage that their hash with the id decides."""
    long = [r for r in runs(text) if len(r) >= LEAST_CHARS and len(r.decode()) >= LEAST_CHARS] if not text.isascii() else [r for r in runs(text) if len(r) >= LEAST_CHARS]
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for i, h in enumerate(map(crc32, long, repeat(start))):
        if h % DAMAGED == 0:
            run = long[i].decode()
            at = h % len(run)
            long[i] = (run[:at] + run[at + 1 :]).encode() if len(run) > LEAST_CHARS else b""
    return filter(None, long)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.record_batch({"word": pa.array(counts.keys(), pa.binary()).cast(pa.string()), "n": pa.array(counts.values(), pa.int64())})

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            if text.is_valid:
                counts.update(words(doc_id, text.as_buffer().to_pybytes()))
                if len(counts) > HELD_WORDS:
                    yield out()
                    counts.clear()
    yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) to (word, n): words of LEAST_COUNT occurrences or more."""
    parts = docs.select("doc_id", "text").mapInArrow(_count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letter_mask(word: Column) -> Column:
    """Bits of letters that occur an odd number of times. Letters may share a bit: a replaced letter then flips none."""
    code = lambda c: F.when(F.ascii(c) < 0xC0, F.ascii(c) - 97).otherwise(F.ascii(c) - 0xC0 + 26)
    return F.aggregate(F.split(word, "(?!^)"), F.lit(0).cast("long"), lambda acc, c: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), code(c) % MASK_BITS)))


def band(mask: Column, k: int) -> Column:
    return mask.bitwiseAND(F.lit(sum(1 << b for b in range(k, MASK_BITS, BANDS))))


def _keys(shorter: Column) -> Column:
    """Where a word meets those that differ by one edit, if the shorter of both has ``shorter`` letters: by whole half and equal band."""
    half = F.floor(shorter / 2).cast("int")
    sides = (F.substring("word", F.lit(1), half), F.substring("word", F.lit(1) + F.col("length") - (shorter - half), shorter - half))
    return F.array(*(F.struct(shorter.alias("shorter"), F.lit(s).alias("side"), text.alias("half"), F.lit(k).alias("k"), band(F.col("mask"), k).alias("band")) for s, text in enumerate(sides) for k in range(BANDS)))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """vocabulary(word, n) to (word_a, n_a, word_b, n_b), once for each two words that one edit parts."""
    coded = vocabulary.select("word", "n", F.char_length("word").alias("length"), letter_mask(F.col("word")).alias("mask"))
    length = F.col("length")
    a = coded.select("*", F.explode(_keys(length)).alias("key"))
    b = coded.select("*", F.explode(F.concat(_keys(length), _keys(length - 1))).alias("key"))
    named = lambda df, s: df.select("key.*", *(F.col(c).alias(f"{c}_{s}") for c in coded.columns))
    met = named(a, "a").join(named(b, "b").hint("merge"), ["shorter", "side", "half", "k", "band"])
    flipped = F.bit_count(F.col("mask_a").bitwiseXOR(F.col("mask_b")))
    half = F.floor(F.col("shorter") / 2).cast("int")
    first_side = (F.col("side") == 0) | (F.substring("word_a", F.lit(1), half) != F.substring("word_b", F.lit(1), half))
    equal = [band(F.col("mask_a"), k) == band(F.col("mask_b"), k) for k in range(BANDS)]
    first_band = F.when(equal[0], 0).when(equal[1], 1).otherwise(2) == F.col("k")
    apart = (F.col("length_a") < F.col("length_b")) | (F.col("word_a") < F.col("word_b"))
    return met.where(apart & (flipped <= 2) & first_side & first_band & (F.levenshtein("word_a", "word_b", 1) == 1)).select("word_a", "n_a", "word_b", "n_b")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """forms(word, form) to (word, root), by doubling; a form has FORM_FACTOR times the occurrences, so paths are short and end."""
    now = scratch.keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = scratch.keep(now.join(on.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        scratch.drop(now)
        now = step
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def spelling_groups(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) to (word, n, n_near, form, form_n, root), one row per word."""
    scratch = Scratch(docs.sparkSession, "spelling")
    with small_batches(docs.sparkSession):
        vocabulary = scratch.keep(word_counts(docs), "vocabulary")
    pairs = scratch.keep(near_pairs(vocabulary), "pairs")
    both = pairs.toDF("word", "n", "near", "near_n").union(pairs.select("word_b", "n_b", "word_a", "n_a"))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    is_form = -F.col("best.minus") >= FORM_FACTOR * F.col("n")
    near = best.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n"))
    near = scratch.keep(near, "near")
    scratch.drop(pairs)
    roots = _roots(near.where("form is not null"), scratch)
    return (
        vocabulary.join(near.hint("merge"), "word", "left").join(roots.hint("merge"), "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
    )
