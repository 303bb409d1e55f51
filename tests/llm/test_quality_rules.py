import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import quality_rules as Q


def base(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words)


def texts():
    rnd = random.Random(1)
    bits = ["a", "b", "É", "c$", "\n", "\n\n", "\t", "\x0b", "\x1c", " ", "  ", " ", "##", "<|>", "漢\U0001f600", "word", "\r\n"]
    return ["".join(rnd.choice(bits) + rnd.choice(["", " ", "\n"]) for _ in range(rnd.choice([0, 1, 3, 40, 200]))) for _ in range(200)] + [None, "", " \n ", "\n", "a b c a b c", "x " * 100]


def test_base_counts(spark):
    rows = list(enumerate(texts())) + [(1, "again again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words_", F.lit(0)).repartition(2)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in Q.rate(docs, labels, ["doc_id"]).collect())
    assert got == Counter((d, *base(t)) for d, t in rows)


def test_verdict_and_empty_tables(spark):
    rnd = random.Random(3)
    good = lambda: " ".join("".join(rnd.choice(["er", "on", "th", "ing"]) for _ in range(3)) for _ in range(80))
    rows = [(i, good()) for i in range(200)] + [(i, good().replace(" ", "$$$ ")) for i in range(200, 240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(0, 240, 2)], "doc_id long, quality int")
    assert all(r.kept == (r.doc_id < 200) for r in Q.rate(docs, labels, ["doc_id"]).collect())
    assert all(r.kept and r.log_ratio == 0 for r in Q.rate(docs, labels.limit(0), ["doc_id"]).collect())
    assert Q.rate(docs.limit(0), labels, ["doc_id"]).collect() == []


def test_target_counts_every_good_document(spark):
    docs = spark.range(9_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.hex("id"), F.hex(F.col("id") * 7919)).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert set(Q.log_ratios(docs, labels)) == {0.0}  # the target is the corpus
    few = Q.log_ratios(docs, labels.where("doc_id < 100").union(labels.where("doc_id < 50")))
    assert max(few) > 0 > min(few)
