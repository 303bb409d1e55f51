import random
import re

import numpy as np

from tidemark.llm import decontaminate as D
from tidemark.llm.fm_index import FMIndex, occurrences, suffix_order


def words_of(text):
    return [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]


def brute(docs, bench):
    wins = {}
    for i, t in bench:
        w = [x[0] for x in words_of(t)]
        if i is None:
            continue
        for k in range(max(len(w) - 9, min(1, len(w)))):
            wins.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = {}
    for d, t in docs:
        w = words_of(t)
        hit, items = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (own := wins.get(tuple(x[0] for x in w[k : k + n]))):
                    hit.update(range(k, k + n))
                    items |= own
        out[d] = (len(w), len(hit), sorted(map(str, items)), hit)
    return out


def test_suffix_order():
    rnd = np.random.default_rng(1)
    for bits in (2, 3, 7, 12, 20, 31):
        for n in (1, 2, 60, 500):
            text = rnd.integers(0, min(3, 1 << bits), n)
            assert suffix_order(text, bits).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


def test_index_finds_all():
    rnd = np.random.default_rng(2)
    text = rnd.integers(1, 4, 400)
    text[[100, 250, 399]] = 0
    sampled = np.zeros(400, bool)
    sampled[::8] = True
    sampled[[0, 101, 251]] = True
    index = FMIndex(text, 2, sampled)
    for pattern in ([1], [2, 3], [1, 1, 2], [3, 3, 3, 3, 1]):
        rows = np.array([[0] * (5 - len(pattern)) + pattern])
        got = [p for _, at in occurrences(index, rows, np.array([len(pattern)]), block=7) for p in at.tolist()]
        assert sorted(got) == [i for i in range(400) if text[i : i + len(pattern)].tolist() == pattern]


def tables(spark, seed=7):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["É", "漢字", "Wx"]
    bench = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    bench += [(3, bench[4][1]), (90, None), (91, " ,"), (None, "w1 w2 w3")]
    docs = []
    for i in range(150):
        w = [rnd.choice(vocab + ["other", "words"]) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 2)):
            k = rnd.randint(0, len(w))
            passage = rnd.choice(bench[:12])[1].upper().replace(" ", ", \n")
            w[k:k] = [passage[: rnd.choice([20, 999])]]
        docs.append((i, " ".join(w)))
    docs += [(500, None), (501, ""), (502, "..."), (503, docs[5][1]), (504, docs[5][1])]
    return docs, bench


def test_equals_brute_force(spark, monkeypatch):
    docs, bench = tables(spark)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as hits0", "length(text) as n_chars").repartition(2)
    b = spark.createDataFrame(bench, "item_id long, text string").selectExpr("*", "1 as doc_id")
    want = brute(docs, bench)
    for most in (D.BLOCK_CHARS, 200):
        monkeypatch.setattr(D, "BLOCK_CHARS", most)
        for r in D.find_contamination(d, b, ["doc_id", "text", "hits0"]).collect():
            n, hit, items, at = want[r.doc_id]
            assert (r.hits.n_words, r.hits["items"]) == (n, items)
            assert {i for x in r.hits.words for i in range(x.start, x.end)} == at
            w = words_of(r.text)
            assert [(x.start, x.end) for x in r.hits.spans] == [(w[x.start][1], w[x.end - 1][2]) for x in r.hits.words]
    for r in D.decontaminate(d, b).collect():
        if want[r.doc_id][1] == 0:
            assert r.text == dict(docs)[r.doc_id]
        else:
            assert r.n_chars == len(r.text) < len(dict(docs)[r.doc_id])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_contamination(docs, none, ["doc_id"]).collect()[0].hits.n_words == 3
    assert D.find_contamination(docs.limit(0), none, ["doc_id"]).collect() == []
