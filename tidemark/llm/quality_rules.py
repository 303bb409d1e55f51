"""Operator 9: quality rules with a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Method. Base rules count a text's words, symbols, repeated lines and repeated three-word windows. The verdict is a ratio of two
multinomials over SLOTS hashed n-grams (of word endings, alone and in pairs, so that unseen words still count): the raw corpus,
counted over every document, and a trusted target, counted over every document labelled good. A text's mean log
ratio per n-gram is compared with a fixed threshold, so the same text always gets the same verdict from the same corpus.

Scale. Counting explodes n-grams into a partial aggregate of at most SLOTS groups a task; what is shuffled is SLOTS counts a
task. Ids labelled good are broadcast up to BROADCAST_IDS; above that texts are shuffled once to meet them. Scoring looks the SLOTS log ratios up in an array of fixed size, in each row.

Cases. A null or empty text has no words and fails the base rules. Repeated rows each keep theirs. Without labels or documents
every ratio is 0, which is kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.jaccard_join import BROADCAST_IDS
from tidemark.llm.shared import without

SLOTS = 1 << 14
#: Pseudo-counts a slot; least mean log ratio.
SMOOTHING, THRESHOLD = 0.5, -0.15
LEAST_WORDS, REPEATED_PERCENT = 50, 50
RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio")
_WHITE = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Words between white space; an empty text is one empty word, see ``with_words``."""
    return F.split(F.trim(text, F.lit(_WHITE)), "[ \\t-\\r]+")


def with_words(docs: DataFrame) -> DataFrame:
    """``__t`` (the text, null as empty), ``__words`` and ``__n``, their number."""
    split = docs.withColumn("__t", F.coalesce(F.col("text"), F.lit(""))).withColumn("__words", words_of(F.col("__t")))
    none = F.array().cast("array<string>")
    return split.withColumn("__words", F.when(F.get("__words", F.lit(0)) == "", none).otherwise(F.col("__words"))).withColumn("__n", F.size("__words").cast("long"))


def slots(words: Column) -> Column:
    """Hashed n-grams of words' last three characters: each, and each with the next one's."""
    n = F.size(words)
    own = F.transform(words, lambda w: F.xxhash64(F.right(w, F.lit(3))))
    return F.transform(F.array(own), lambda h: F.concat(F.transform(h, lambda x: F.pmod(x, F.lit(SLOTS)).cast("int")), F.zip_with(F.slice(h, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(h, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(SLOTS)).cast("int"))))[0]


def slot_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(slot, raw, target): n-grams of all documents, and of all that are labelled good, in one pass."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().withColumn("good", F.lit(True))
    good = F.broadcast(good) if good.count() <= BROADCAST_IDS else good
    worded = with_words(docs.select("doc_id", "text").join(good, "doc_id", "left")).where("__n > 0")
    return worded.select("good", F.explode(slots(F.col("__words"))).alias("slot")).groupBy("slot").agg(F.count("*").alias("raw"), F.count("good").alias("target"))


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """Of each slot, the target's log share less the raw corpus'. SLOTS numbers, whatever the input."""
    counts = slot_counts(docs, labels)
    both = docs.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot")).join(counts, "slot", "left").na.fill(0)
    rows = sorted(both.select("slot", "raw", "target").collect())  # SLOTS rows
    raw, target = (np.array([r[c] for r in rows], float) for c in ("raw", "target"))
    if not raw.sum() or not target.sum():
        return [0.0] * SLOTS
    share = lambda x: np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * SLOTS))
    return (share(target) - share(raw)).tolist()


def _repeated(words: Column, n: Column) -> Column:
    """Words within three-word windows that the text holds twice or more."""
    cut = lambda a, start, size: F.slice(a, F.lit(start), F.greatest(size, F.lit(0)))
    windows = F.transform(
        F.array(F.transform(words, lambda w: F.xxhash64(w))),
        lambda h: F.zip_with(F.zip_with(cut(h, 1, n - 2), cut(h, 2, n - 2), lambda a, b: F.xxhash64(a, b)), cut(h, 3, n - 2), lambda a, b: F.xxhash64(a, b)),
    )[0]

    def covered(sorted_windows: Column) -> Column:
        last = F.size(sorted_windows) - 1
        at = lambda i: F.get(sorted_windows, i)["h"]
        twice = F.filter(sorted_windows, lambda x, i: ((i > 0) & (at(F.greatest(i - 1, F.lit(0))) == x["h"])) | ((i < last) & (at(F.least(i + 1, last)) == x["h"])))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    counted = lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(F.transform(F.array(F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))), covered)[0])
    return F.when(n < 4, F.lit(0)).otherwise(F.transform(F.array(windows), counted)[0]).cast("long")


def rate(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """docs(doc_id, text, ...) and labels(doc_id, quality) to docs' columns ``keep`` (but for those named like a result column) and n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, log_ratio (mean per n-gram; null without words) and kept."""
    ratios = F.split(F.lit(",".join(map(repr, log_ratios(docs, labels)))), ",").cast("array<double>")  # folded into one constant
    keep = without(keep, *RESULT)
    worded = with_words(docs.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"]))))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    n, t, words = F.col("__n"), F.col("__t"), F.col("__words")
    counted = worded.select(
        *(F.col(f"`{c}`") for c in keep), n.alias("n_words"), F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.when(F.contains(t, F.lit("\n")), F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0]).otherwise(0).cast("long").alias("n_dup_lines"),
        _repeated(words, F.size(words)).alias("n_repeat_words"),
        F.when(n > 0, F.transform(F.array(slots(words)), lambda s: F.aggregate(s, F.lit(0.0), lambda acc, x: acc + F.get(ratios, x)) / F.size(s))[0]).alias("log_ratio"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    rated = counted.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.col("log_ratio") >= THRESHOLD, F.lit(False)))
    return rated.select(*(F.col(f"`{c}`") for c in keep), *RESULT)
