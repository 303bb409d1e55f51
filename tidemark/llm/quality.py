"""Operator 1: quality classifier, a hashed word n-gram logistic regression with follow-the-regularised-leader updates.

Features are hashed into SLOTS slots: words and word pairs, runs of punctuation and pairs of those, and one slot that counts
three-word sequences seen before in the text. A slot's value is the root of its share of the text's features, so texts of
any length have the same norm. Training uses a bounded sample of labelled documents; scores are sparse dot products over
all documents, in one pass without a shuffle.

Cases. A null or empty text has the intercept only. Without labels every score is 0.5. Repeated rows each get a score. Labels
of the held-out fold, language, source and id are never looked at by the model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.linear import featurised, labelled_sample, scored, train
from tidemark.llm.shared import Scratch, fold_of, without
from tidemark.llm.textops import SPACED_LOWER, Alphabet, Words, ngrams, utf8_parts

SLOTS = 1 << 18
#: Labelled documents that training uses at most, and how often it passes over them.
TRAIN_ROWS, EPOCHS = 8_000, 3
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
PART_BYTES = 1 << 18
_REPEAT = 1  # slot 0 is the intercept
PUNCTUATION = Alphabet(bytes(b for b in range(256) if b >= 0x7F or b <= 0x20 or chr(b).isalnum()), lower=False)


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for lo, hi, data, offsets in utf8_parts(texts, PART_BYTES):
        kinds = []
        triples, triple_at = None, None
        for alphabet, salt in ((SPACED_LOWER, 0), (PUNCTUATION, 1)):
            words = Words(data, offsets, alphabet)
            pairs, pair_at = ngrams(words.hash, words.first, 2)
            kinds += [((words.hash + np.uint64(salt)) % np.uint64(SLOTS - 2) + np.uint64(2), words.first), ((pairs + np.uint64(salt)) % np.uint64(SLOTS - 2) + np.uint64(2), pair_at)]
            if not salt:
                triples, triple_at = ngrams(words.hash, words.first, 3)
        slots, values = [], []
        for i in range(hi - lo):
            own, count = np.unique(np.concatenate([s[at[i] : at[i + 1]] for s, at in kinds]).astype(np.int64), return_counts=True)
            seen = triples[triple_at[i] : triple_at[i + 1]]
            again = len(seen) - len(np.unique(seen))
            total = max(1, count.sum() + again)
            slots.append(np.concatenate(([0, _REPEAT], own)))
            values.append(np.concatenate(([1.0, np.sqrt(again / total)], np.sqrt(count / total))))
        first = np.concatenate(([0], np.cumsum([len(s) for s in slots])))
        yield lo, hi, np.concatenate(slots), np.concatenate(values), first


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    sample = labelled_sample(docs, labels, "quality", fold_of("doc_id", FOLDS) != HELD_OUT, TRAIN_ROWS)
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.keep(featurised(sample, features, "quality", "place"), "sample")
    weights = train(rows, SLOTS, EPOCHS)
    scratch.drop(rows)
    return weights


def score_quality(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """docs(doc_id, text, ...) and labels(doc_id, quality) to docs' columns ``keep``, ``score`` and ``predicted``, which win over kept
    columns of these names."""
    kept = without(keep, "score", "predicted")
    return scored(docs, features, fit(docs, labels), kept).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with their columns, whatever their names."""
    own = "__quality_score"
    return scored(docs, features, fit(docs, labels), docs.columns, own).where(F.col(own) >= THRESHOLD).select(*(F.col(f"`{c}`") for c in docs.columns))
