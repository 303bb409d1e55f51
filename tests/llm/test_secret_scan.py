import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import secret_scan as S

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def texts():
    rnd = random.Random(2)
    pieces = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "=", ":", "==", " ", "  ", '"', "'", "\n", "abc", "AKIA", "AKIAABCDEFGH1234", "Z9", "0123456789abcdef" * 2, "é", "漢\U0001f600", "", "$", "\\", "hunter2-hunter2", "x" * 7, ".", "ſecret", "Key"]
    out = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    return [*out, None, "", "token: secret: abcdefgh12", "token==12345678", 'password="a" secret=bbbbbbbb']


def test_base_spans(spark):
    rows = list(enumerate(texts())) + [(0, "token=abcdefgh")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs_", F.lit(1)).repartition(2)
    want = sorted((d, t or "", base(t)) for d, t in rows)
    got = sorted((r.doc_id, r.text or "", [tuple(s) for s in r.spans if s.kind < 3]) for r in S.scan(df).collect())
    assert got == want


def test_random_strings_are_told_from_words(spark):
    rnd = random.Random(9)
    b62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = []
    for i in range(300):
        key = "".join(rnd.choice(b62) for _ in range(44))
        word = "".join(rnd.choice(["ung", "keit", "lich", "sch", "ver", "zu", "heit"]) for _ in range(12))
        rows.append((i, f"use {key} and {word} here", word))
    df = spark.createDataFrame(rows, "doc_id long, text string, w string")
    got = S.scan(df).collect()
    random_found = sum(any(s.kind == 3 and s.start == 4 for s in r.spans) for r in got)
    words_found = sum(any(s.kind == 3 and s.start > 10 for s in r.spans) for r in got)
    # FALSE_SHARE is estimated from a few hundred strings here, so twice that is allowed.
    assert random_found > 270 and words_found <= 2 * S.FALSE_SHARE * (random_found + words_found)
    p = sorted(r.p for r in df.select(S.randomness(F.substring("text", 5, 44)).alias("p")).collect())
    assert np.abs(np.array(p) - (np.arange(300) + 0.5) / 300).max() < 0.12  # near uniform


def test_redact(spark):
    df = spark.createDataFrame([(1, "a token = \"" + "0a" * 20 + "\" z", 99), (2, "plain", 5), (3, None, None), (4, "AKIAABCDEFGH1234 AKIAABCDEFGH1235", 1)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in S.redact(df).collect()}
    assert got == {1: ('a [SECRET]" z', 13), 2: ("plain", 5), 3: (None, None), 4: ("[SECRET] [SECRET]", 17)}
    assert S.redact(df.limit(0)).collect() == []
    assert hashlib.sha256(b"").hexdigest() == S.scan(df.where("doc_id = 2")).select(F.sha2(S.spelled(F.col("spans")), 256)).first()[0]


def test_names_that_clash(spark):
    df = spark.createDataFrame([(1, "token=abcdefgh!", 3, 4, 5)], "doc_id long, text string, base long, runs long, spans long")
    assert S.scan(df).columns == ["doc_id", "text", "base", "runs", "spans"] and S.scan(df).first().spans[0][:] == (0, 0, 14)
    assert S.redact(df).collect() == [(1, "[SECRET]!", 3, 4, 5)]


def test_very_many_matches_in_one_text(spark):
    text = "\n".join(f"token=value{i:06d}" if i % 2 else f"{'0123456789abcdef' * 2}" for i in range(6_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(s) for s in S.scan(df).first().spans] == base(text)
    assert S.redact(df).first().text == "\n".join(["[SECRET]"] * 6_000)


def test_overlapping_spans_are_masked_once(spark):
    text = "x password=token=" + "0a1b" * 10 + "zz 0a"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(s) for s in S.scan(df).first().spans] == base(text) == [(2, 0, 59), (17, 2, 57)]
    assert S.redact(df).first().text == "x [SECRET] 0a"
