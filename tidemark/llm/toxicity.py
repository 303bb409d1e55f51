"""Operator 8: toxicity by weak supervision.

Method. Voters look at a text: a fixed lexicon of insults, one voter a word, and patterns (words and beginnings of words) that
mark toxic rows among the labelled documents that may be learned from. A voter says "toxic" where its term
is frequent enough, and else abstains; one more says "clean"
where none of the others fires. A generative label model, fitted by expectation maximisation on the votes of the bounded sample
of labelled documents (their labels are not looked at here), estimates how often each voter fires in either class, its accuracy, and how far
voters fire together within each class; correlated voters share their weight. A linear classifier over hashed words and
beginnings of words is trained on the posterior labels of that sample and scores every whole text.

Scale. One scan draws the sample, which is kept as a table; patterns, votes and training read that only. Scoring is one more scan
without a shuffle.

Cases. A null or empty text has the intercept only. Without labels the lexicon alone votes. Repeated rows each get a score.
Labels of the held-out fold, language, source and id are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.linear import featurised, labelled_sample, scored, sigmoid, train
from tidemark.llm.shared import Scratch, fold_of, without
from tidemark.llm.textops import ALNUM_LOWER, Words, utf8_parts

SLOTS = 1 << 18
#: Labelled rows to take patterns from and to fit the label model and the classifier on, at most.
LABELLED_ROWS, EPOCHS = 20_000, 4
#: A pattern's least number of toxic rows, least odds between toxic and clean rows, and how many are used: the label model's
#: correlations are a matrix of that size squared.
LEAST_ROWS, LEAST_ODDS, MOST_PATTERNS = 5, 8.0, 150
#: A voter fires where its term is at least one in so many words.
RARELY = 400
#: Beginnings of words, in bytes.
BEGINNINGS = (4, 5, 6, 7, 8)
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
PART_BYTES = 1 << 20

#: Insults, a voter each.
LEXICON = (
    "arschloch", "bastard", "clown", "connard", "cretin", "disgusting", "dumb", "dummkopf", "estúpido", "garbage", "idiot", "idiota",
    "imbecile", "imbécil", "imbécile", "loser", "moron", "pathetic", "scum", "stupid", "trash", "vermin", "worthless",
)


def _lexicon() -> np.ndarray:
    return Words(*_bytes_of(LEXICON), ALNUM_LOWER).hash


def _bytes_of(words) -> tuple[np.ndarray, np.ndarray]:
    raw = [w.encode() for w in words]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(w) for w in raw])))


def _terms(texts: pa.Array) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray, int]]]]:
    """Of each text: its distinct terms (hashes of words and of beginnings), how often each occurs, and its number of words."""
    for lo, hi, data, offsets in utf8_parts(texts, PART_BYTES):
        words = Words(data, offsets, ALNUM_LOWER)
        starts = [words.beginnings(k) for k in BEGINNINGS]
        cuts = [np.searchsorted(which, words.first) for _, which in starts]
        yield lo, hi, [
            (*np.unique(np.concatenate((words.hash[words.first[i] : words.first[i + 1]], *(h[c[i] : c[i + 1]] for (h, _), c in zip(starts, cuts)))), return_counts=True), int(words.first[i + 1] - words.first[i]))
            for i in range(hi - lo)
        ]


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for lo, hi, rows in _terms(texts):
        slots, values = [], []
        for terms, count, n in rows:
            at, back = np.unique((terms % np.uint64(SLOTS - 1)).astype(np.int64) + 1, return_inverse=True)
            most = np.zeros(len(at))
            np.maximum.at(most, back, np.sqrt(count))
            slots.append(np.concatenate(([0], at)))
            values.append(np.concatenate(([1.0], most * 5 / np.sqrt(max(50, n)))))
        first = np.concatenate(([0], np.cumsum([len(s) for s in slots])))
        yield lo, hi, np.concatenate(slots), np.concatenate(values), first


def patterns(labelled: DataFrame) -> np.ndarray:
    """Terms that mark toxic rows, from a bounded sample of labelled documents (text, toxic)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(batch.column("toxic").to_pylist())
            for lo, hi, rows in _terms(batch.column("text")):
                terms = np.concatenate([t for t, _, _ in rows])
                is_toxic = np.repeat(toxic[lo:hi], [len(t) for t, _, _ in rows])
                distinct, back = np.unique(terms, return_inverse=True)
                yield pa.record_batch({"term": pa.array(distinct.view(np.int64)), "toxic": pa.array(np.bincount(back, is_toxic, len(distinct)).astype(np.int64)), "rows": pa.array(np.bincount(back, minlength=len(distinct)))})

    kept = labelled.select("text", F.col("toxic").cast("int").alias("toxic"))
    counts = kept.mapInArrow(count, "term long, toxic long, rows long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows"))
    total = kept.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    rate = lambda a, b: (a + 0.5) / (b + 1)
    odds = rate(F.col("toxic"), F.lit(total["t"])) / rate(F.col("rows") - F.col("toxic"), F.lit(total["n"] - total["t"]))
    best = counts.where((F.col("toxic") >= LEAST_ROWS) & (odds >= LEAST_ODDS)).orderBy(F.desc(F.col("toxic") * F.log(odds)), "term").limit(MOST_PATTERNS)
    return np.array([r["term"] for r in best.select("term").collect()], np.int64).view(np.uint64)


def votes(texts: pa.Array, voters: np.ndarray) -> np.ndarray:
    """Which voters (sorted terms) fire in each text; the last column is the one for "clean"."""
    out = np.zeros((len(texts), len(voters) + 1), np.uint8)
    for lo, _, rows in _terms(texts):
        for i, (terms, count, n) in enumerate(rows):
            at = np.minimum(np.searchsorted(terms, voters), max(0, len(terms) - 1))
            if n:
                out[lo + i, :-1] = (terms[at] == voters) & (count[at] * RARELY >= n)
    out[:, -1] = ~out[:, :-1].any(axis=1)
    return out


class LabelModel:
    """How often voters fire in either class, and how much weight each has: one that fires together with others within a class says
    less than one that fires by itself, and their common evidence counts about once."""

    def __init__(self, fired: np.ndarray, rounds: int = 40):
        x = fired.astype(float)
        n, m = x.shape
        self.share = 0.1
        lean = np.where(np.arange(m) == m - 1, 0.05, 0.3)
        self.rate = np.stack((np.where(np.arange(m) == m - 1, 0.9, 0.01), lean))  # of clean, of toxic
        self.weight = np.ones(m)
        for _ in range(rounds if n else 0):
            p = self.posterior(fired)
            for k, q in ((0, 1 - p), (1, p)):
                self.rate[k] = (q @ x + (0.02, 0.5)[k]) / (q.sum() + 1)
            self.rate = np.clip(self.rate, 1e-4, 1 - 1e-3)
            self.share = float(np.clip(p.mean(), 0.005, 0.5))
            self.weight = 1 / self._shared(x, p)

    def _shared(self, x: np.ndarray, p: np.ndarray) -> np.ndarray:
        """1 and more: with how many others each voter fires together within a class, on average over both classes by their shares."""
        total = np.zeros(x.shape[1])
        for rate, q, share in zip(self.rate, (1 - p, p), (1 - self.share, self.share)):
            d = (x - rate) * np.sqrt(q)[:, None]
            c = d.T @ d
            s = np.sqrt(np.maximum(np.diag(c), 1e-9))
            total += share * np.maximum(np.square(np.clip(c / np.outer(s, s), 0, 1)).sum(axis=1), 1)
        return total

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        x = fired.astype(float)
        return sigmoid(np.log(self.share / (1 - self.share)) + x @ (np.log(self.rate[1] / self.rate[0]) * self.weight))


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    scratch = Scratch(docs.sparkSession, "toxicity")
    drawn = labelled_sample(docs, labels, "toxic", fold_of("doc_id", FOLDS) != HELD_OUT, LABELLED_ROWS)
    sample = scratch.keep(drawn.select("text", F.col("toxic").cast("int").alias("toxic"), "place"), "sample")
    voters = np.unique(np.concatenate((_lexicon(), patterns(sample))))

    def fire(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.packbits(votes(batch.column("text"), voters), axis=1)
            yield pa.record_batch({"v": pa.array([r.tobytes() for r in rows], pa.binary())})

    kinds = sample.select("text").mapInArrow(fire, "v binary").groupBy("v").count().collect()  # of a bounded sample
    kinds = sorted((bytes(k["v"]), k["count"]) for k in kinds)
    unpacked = [np.unpackbits(np.frombuffer(raw, np.uint8))[: len(voters) + 1] for raw, _ in kinds]
    fired = np.repeat(np.array(unpacked, np.uint8).reshape(-1, len(voters) + 1), [n for _, n in kinds], axis=0)
    model = LabelModel(fired)

    def believe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.posterior(votes(batch.column("text"), voters))
            yield pa.RecordBatch.from_arrays([batch.column("text"), pa.array(p), batch.column("place")], names=["text", "toxic", "place"])

    posterior = sample.select("text", "place").mapInArrow(believe, "text string, toxic double, place long")
    rows = scratch.keep(featurised(posterior, features, "toxic", "place"), "posterior")
    weights = train(rows, SLOTS, EPOCHS, l1=0.05)
    scratch.drop(sample, rows)
    return weights


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """docs(doc_id, text, ...) and labels(doc_id, toxic) to docs' columns ``keep``, ``score`` and ``predicted``, which win over kept
    columns of these names."""
    kept = without(keep, "score", "predicted")
    return scored(docs, features, fit(docs, labels), kept).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
